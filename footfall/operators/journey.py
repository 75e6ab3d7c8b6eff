"""Per-device history: shop-to-shop journeys, visit history, sales conversion.

Journeys need each reading's previous area per device, in arrival order.
That is an ordered per-key scan; ``keyed_scan`` does it without putting a
busy device's readings into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.areas import ZONE1_AREAS, area_index_of, area_name
from footfall.functions.timewin import tumble
from footfall.operators.proximity import classify_area
from footfall.operators.scan import keyed_scan, time_slice
from footfall.settings import DEFAULTS, Settings


def customer_journey(readings: DataFrame, zone: int | None = 1, areas=ZONE1_AREAS,
                     settings: Settings = DEFAULTS) -> DataFrame:
    """Entries into shop areas per device: one row each time a device's
    reading is in an area other than the area of its previous in-area
    reading. ``visit_no`` numbers the entries per device. Readings without
    ``arrival`` have no place in a journey and are left out.

    Batch: a keyed scan (balanced under a busy device) gives the previous
    area, a second one over the entries alone numbers them. Stream: a state processor per device keeps its
    last area and entry count."""
    df = readings if zone is None else readings.where(F.col("zone") == F.lit(zone))
    df = df.where(F.col("arrival").isNotNull())
    if df.isStreaming:
        inside = classify_area(df, areas).where(F.col("area").isNotNull()).select(
            "mac", "arrival", "id", "area")
        from footfall.streaming.stateful import journey_stream
        return journey_stream(inside)

    # The scan carries the area's position (an int) so its run summaries
    # stay hash aggregates; names are looked up at the end.
    inside = (df.select("mac", "arrival", "id",
                        area_index_of("latitude", "longitude", areas).alias("area_i"))
                .where(F.col("area_i").isNotNull()))

    slices = time_slice("arrival", settings.scan_slice)
    scanned = keyed_scan(inside, ["mac"], ["arrival", "id"], n=None, lag={"prev_i": "area_i"}, slices=slices)
    entries = scanned.where(F.col("prev_i").isNull() | (F.col("prev_i") != F.col("area_i")))
    entries = keyed_scan(entries, ["mac"], ["arrival", "id"], n="visit_no", slices=slices)
    return entries.select("mac", "visit_no", area_name(F.col("area_i"), areas).alias("area"),
                          area_name(F.col("prev_i"), areas).alias("prev_area"),
                          F.col("arrival").alias("entered_at"), "id")


def visit_history(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per device: readings, distinct visit days, zones seen, first/last seen.

    Readings are first reduced to one row per (device, day, zone) by a
    partial aggregate; the two distinct counts (which Spark plans by
    duplicating rows) then run on that much smaller table.
    """
    per = readings.groupBy("mac", F.date_trunc("day", F.col("arrival")).alias("day"), "zone").agg(
        F.count(F.lit(1)).alias("n"), F.min("arrival").alias("lo"), F.max("arrival").alias("hi"))
    return per.groupBy("mac").agg(
        F.sum("n").alias("readings"),
        F.countDistinct("day").alias("days_seen"),
        F.countDistinct("zone").alias("zones_seen"),
        F.min("lo").alias("first_seen"),
        F.max("hi").alias("last_seen"),
    )


def sales_conversion(readings: DataFrame, purchases: DataFrame,
                     settings: Settings = DEFAULTS) -> DataFrame:
    """Purchases per distinct visiting device, per visit window.

    The two streams share no customer id, so this is a ratio of window
    totals. Devices are deduplicated by an aggregate first (exact); on
    streams the two windowed aggregates meet in a full outer join on the
    window, whose state the watermark evicts.
    """
    size = settings.visit_window
    by_dev = (readings.where(F.col("mac").isNotNull())
                      .groupBy(tumble("arrival", size).alias("window"), "mac")
                      .agg(F.count(F.lit(1)).alias("_n")))
    regroup = (F.window(F.window_time("window"), size) if by_dev.isStreaming
               else F.col("window")).alias("window")
    dev = by_dev.groupBy(regroup).agg(F.count(F.lit(1)).alias("visitors"))
    buys = purchases.groupBy(tumble("arrival", size).alias("window")).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").cast("long").alias("amount"))
    j = dev.join(buys, "window", "full")
    return j.select("window",
                    F.coalesce("visitors", F.lit(0)).alias("visitors"),
                    F.coalesce("purchases", F.lit(0)).alias("purchases"),
                    F.coalesce("amount", F.lit(0)).alias("amount"),
                    (F.col("purchases") / F.col("visitors")).alias("conversion"))
