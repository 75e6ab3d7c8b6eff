"""Proximity traffic, traffic-jam labels and crowd alerts over zone readings.

``proximity_traffic_as_coded`` keys by the reading's *timestamp value*
within a 30-minute window, counts readings that fall in any shop area and
names the last area hit ("" and 0 when none did). ``traffic_jam_as_coded``
windows those results again (20 minutes, on the clock at which each
proximity window closes) per area and labels the last one. Alerts are the
proximity rows at or above the crowd threshold, as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.areas import ZONE1_AREAS, area_index_of, area_name, area_of
from footfall.functions.labels import is_crowded, jam_label
from footfall.functions.ordering import last_by, time_long_key
from footfall.functions.timewin import fix_next_window, next_window, tumble
from footfall.settings import DEFAULTS, Settings


def classify_area(readings: DataFrame, areas=ZONE1_AREAS) -> DataFrame:
    """Add ``area``: the shop box containing the reading, null if none."""
    return readings.withColumn("area", area_of("latitude", "longitude", areas))


def _zone(readings: DataFrame, zone: int | None) -> DataFrame:
    return readings if zone is None else readings.where(F.col("zone") == F.lit(zone))


def proximity_traffic_as_coded(readings: DataFrame, settings: Settings = DEFAULTS,
                               zone: int | None = 1, areas=ZONE1_AREAS) -> DataFrame:
    """Per (30-minute window, timestamp): readings in any area, last area hit.

    The aggregate carries the area's position (an int) instead of its name,
    so it stays a hash aggregate; the name is looked up afterwards.
    """
    df = _zone(readings, zone).withColumn("_area_i", area_index_of("latitude", "longitude", areas))
    in_area = F.col("_area_i").isNotNull()
    g = df.groupBy(tumble("arrival", settings.proximity_window).alias("window"), "ts").agg(
        F.count("_area_i").alias("visitors"),
        last_by("_area_i", when=in_area).alias("_last_i"),
    )
    return g.select("window", "ts",
                    F.coalesce(area_name(F.col("_last_i"), areas), F.lit("")).alias("area"),
                    "visitors")


def proximity_traffic_intended(readings: DataFrame, settings: Settings = DEFAULTS,
                               zone: int | None = 1, areas=ZONE1_AREAS) -> DataFrame:
    """Readings per (30-minute window, area): traffic per shop, as the
    source's comment asks for, instead of per timestamp value."""
    df = classify_area(_zone(readings, zone), areas).where(F.col("area").isNotNull())
    return df.groupBy(tumble("arrival", settings.proximity_window).alias("window"), "area").agg(
        F.count(F.lit(1)).alias("visitors"))


def traffic_jam_as_coded(proximity: DataFrame, settings: Settings = DEFAULTS,
                         threshold: int | None = None) -> DataFrame:
    """Per (20-minute window over proximity emissions, area): the last
    proximity row, labelled. All rows of one proximity window are emitted at
    its end, so ties are broken by timestamp."""
    threshold = settings.crowd_threshold if threshold is None else threshold
    streaming = proximity.isStreaming
    order = time_long_key(F.col("window.end"), F.col("ts"))
    g = proximity.groupBy(next_window(proximity, settings.jam_window).alias("window"), "area").agg(
        F.max_by("visitors", order).alias("visitors"))
    g = fix_next_window(g, streaming)
    return g.select("window", "visitors", "area",
                    jam_label("visitors", threshold, settings).alias("observation"))


def offer_alerts(proximity: DataFrame, settings: Settings = DEFAULTS,
                 threshold: int | None = None) -> DataFrame:
    """One alert row per proximity result at or above the crowd threshold.

    Delivery (SMS, push) is left to the sink: these rows are what the
    source would have sent, one request each.
    """
    threshold = settings.crowd_threshold if threshold is None else threshold
    return proximity.where(is_crowded("visitors", threshold)).select(
        "window", "ts", "area", "visitors",
        F.lit(settings.offer_message).alias("message"),
        F.lit(settings.offer_sender).alias("sender"),
    )


def offer_recipients(readings: DataFrame, alerts: DataFrame, settings: Settings = DEFAULTS,
                     zone: int | None = 1, areas=ZONE1_AREAS) -> DataFrame:
    """Devices to notify: distinct MACs seen in the alert's area, window and
    timestamp. Readings are first reduced to distinct devices per key (a
    partial aggregate), then matched to the alert keys, so a crowded key
    sends one row per device and map task to the join, not its readings.
    The loyalty flag lives only on purchases, which share no customer id
    with readings, so it cannot filter here."""
    seen = (classify_area(_zone(readings, zone), areas)
            .where(F.col("area").isNotNull())
            .groupBy(tumble("arrival", settings.proximity_window).alias("window"),
                     "ts", "area", "mac")
            .agg(F.count(F.lit(1)).alias("readings")))
    keys = alerts.select(F.col("window").alias("_w"), F.col("ts").alias("_ts"),
                         F.col("area").alias("_area"), "message")
    # keyed on the window struct itself: on streams both sides keep their
    # watermark, so the join state is evicted
    j = seen.join(keys, (F.col("window") == F.col("_w")) & (F.col("ts") == F.col("_ts"))
                  & (F.col("area") == F.col("_area")), "inner")
    return j.select("window", "ts", "area", "mac", "message")


def capture_rate(readings: DataFrame, settings: Settings = DEFAULTS,
                 zone: int | None = 1, areas=ZONE1_AREAS) -> DataFrame:
    """Share of the zone's distinct devices that entered each area, per window.

    Distinct counts are exact and stream-safe, from one read: an aggregate
    reduces readings to one row per (window, device) with the areas it was in
    as bits, and a second one counts devices and bits per window (regrouped on
    ``window_time`` in a stream). A device is a non-null MAC; an area that only
    readings without MAC were in has 0 devices.
    """
    size, bits = settings.visit_window, 63
    df = _zone(readings, zone)
    place = area_index_of("latitude", "longitude", areas) - F.lit(1)
    groups = range(0, len(areas), bits)  # one long per 63 areas
    seen = [F.bit_or(F.when((place >= g) & (place < g + bits), F.call_function("shiftleft", F.lit(1).cast("long"), place - g))
                     .otherwise(F.lit(0).cast("long"))).alias(f"_in{g}") for g in groups]
    per = df.groupBy(tumble("arrival", size).alias("window"), "mac").agg(*seen)
    window = F.window(F.window_time("window"), size) if per.isStreaming else F.col("window")

    def was_in(i: int):
        return F.col(f"_in{i // bits * bits}").bitwiseAND(F.lit(1 << i % bits)) != 0

    counts = per.groupBy(window.alias("window")).agg(
        F.count("mac").alias("zone_devices"),
        F.array(*[F.struct(F.lit(a.name).alias("area"), F.count_if(was_in(i) & F.col("mac").isNotNull()).alias("area_devices"),
                           F.max(was_in(i)).alias("entered")) for i, a in enumerate(areas)]).alias("areas"))
    each = counts.select("window", "zone_devices", F.explode("areas").alias("a")).where("a.entered")
    return each.select("window", "a.area", "a.area_devices", "zone_devices",
                       (F.col("a.area_devices") / F.col("zone_devices")).alias("capture_rate"))
