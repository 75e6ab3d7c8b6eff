"""Mall foot traffic: running visitor counts per sensor and zone window joins.

As coded, each zone's readings become a running count per sensor that keeps
the sensor's *first* timestamp forever. Zone 1 and zone 2 counts are
equi-joined on that timestamp inside 10-minute windows; the result is
joined with zone 3 inside 20-minute windows, clocked at the end of the
first window. Every matching pair is one document there, so the document
list of a (window, timestamp) key is a cross product.

We never build that product. A sensor's running counts inside one window
are consecutive, so each zone contributes *ranges* per (window, timestamp,
sensor), and the source's documents for a key are exactly the cross
product of its ranges:

* ``foot_traffic_window_join_12`` / ``foot_traffic_as_coded``: one row per
  key with the readings per zone and ``documents``, the number of documents
  the source indexes for it. Batch: derived from one aggregate per
  (zone, sensor, window) with a conditional aggregation per key; stream:
  per-key aggregates joined on the key. The work grows with keys, never
  with pairs.
* ``foot_traffic_factors``: the ranges behind every key that has documents
  (lossless: expanding them gives the source's documents one for one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.ordering import first_by
from footfall.functions.timewin import tumble
from footfall.operators.scan import keyed_scan, time_slice
from footfall.settings import DEFAULTS, Settings

ZONES = (1, 2, 3)


def running_visitors(readings: DataFrame, zones=ZONES,
                     settings: Settings = DEFAULTS) -> DataFrame:
    """One row per reading with ``first_ts`` (the sensor's first timestamp)
    and ``visitors`` (readings of the sensor so far), per zone and sensor in
    ``(arrival, id)`` order.

    Readings without ``arrival`` are left out, as the windows leave them out.
    Batch: ``keyed_scan`` (a hot sensor is cut into time slices).
    Stream: a stateful processor keeps ``(first_ts, n)`` per sensor.
    """
    df = readings.where(F.col("zone").isin(list(zones))) if zones else readings
    df = df.where(F.col("arrival").isNotNull()).select("id", "arrival", "zone", "sensor_uid", "ts")
    if df.isStreaming:
        from footfall.streaming.stateful import running_visitors_stream
        return running_visitors_stream(df)
    return keyed_scan(df, ["zone", "sensor_uid"], ["arrival", "id"], n="visitors",
                      first={"first_ts": "ts"}, slices=time_slice("arrival", settings.scan_slice))


def running_by_zone(readings: DataFrame, zones=ZONES) -> dict[int, DataFrame]:
    """Running counts per zone, one operator per zone (as one keyed reduce
    per zone topic). Streams need this form: the join sides must not share
    one stateful operator."""
    return {z: running_visitors(readings, zones=(z,)) for z in zones}


def _zone_rows(running, zone: int) -> DataFrame:
    if isinstance(running, dict):
        return running[zone]
    return running.where(F.col("zone") == F.lit(zone))


def _key_readings(running, zone: int, size: str, name: str) -> DataFrame:
    """Readings per (window, first timestamp) of one zone (stream path)."""
    return (_zone_rows(running, zone)
            .groupBy(tumble("arrival", size).alias("window"), F.col("first_ts").alias("timestamp"))
            .agg(F.count(F.lit(1)).alias(name)))


def _fine(running: DataFrame, settings: Settings) -> DataFrame:
    """Batch: the foot-traffic facts at the finest grain,
    (zone, first-join window, first timestamp, sensor) -> count range and
    readings. Every foot-traffic result is derived from this small table.

    From readings (no ``visitors`` column) no per-row running count is
    needed: the counts of a sensor inside a window run from 1 + its readings
    in earlier windows, and its first timestamp is that of its first window.
    That is one aggregate per (zone, sensor, window) and a window function
    over those aggregated rows (one per active window of a sensor, however
    busy the sensor is).
    """
    rows = running.where(F.col("zone").isin(list(ZONES)))
    win = tumble("arrival", settings.foot_join_first).alias("w1")
    if "visitors" in running.columns:
        return (rows.groupBy("zone", win, F.col("first_ts").alias("timestamp"), "sensor_uid")
                .agg(F.min("visitors").alias("visitors_from"), F.max("visitors").alias("visitors_to"),
                     F.count(F.lit(1)).alias("readings")))
    per_w = rows.groupBy("zone", "sensor_uid", win).agg(
        F.count(F.lit(1)).alias("readings"), first_by("ts").alias("_ts0"))
    w = Window.partitionBy("zone", "sensor_uid").orderBy(F.col("w1.start"))
    earlier = F.coalesce(F.sum("readings").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0))
    first_ts = F.first("_ts0").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per_w.select("zone", "w1", first_ts.alias("timestamp"), "sensor_uid",
                        (earlier + 1).alias("visitors_from"),
                        (earlier + F.col("readings")).alias("visitors_to"), "readings")


def _nested(settings: Settings) -> bool:
    from footfall.functions.timewin import _micros
    return _micros(settings.foot_join_second) % _micros(settings.foot_join_first) == 0


def _batch_fine(running, settings: Settings):
    if isinstance(running, dict) or running.isStreaming or not _nested(settings):
        return None
    return _fine(running, settings)


def _with_counts(running, settings: Settings):
    """Batch readings get their running counts; what has them stays as it is."""
    if isinstance(running, dict) or running.isStreaming or "first_ts" in running.columns:
        return running
    return running_visitors(running, settings=settings)


def foot_traffic_window_join_12(running, settings: Settings = DEFAULTS) -> DataFrame:
    """Zone 1 x zone 2 on equal first timestamps within 10-minute windows.

    One row per (window, timestamp) present in both zones: readings of each
    zone and ``documents`` = their product (the source's pair count).
    ``running``: batch readings (zone 1..3), ``running_visitors`` output, or
    ``running_by_zone`` output (required for streams). Batch: a conditional aggregation per key (no
    join). Stream: a join of per-key aggregates whose key includes the window
    struct, so both sides keep their watermark and the join state is evicted.
    """
    fine = _batch_fine(running, settings)
    if fine is not None:
        return _j12_from_fine(fine)
    running = _with_counts(running, settings)
    a = _key_readings(running, 1, settings.foot_join_first, "readings_zone1")
    b = _key_readings(running, 2, settings.foot_join_first, "readings_zone2")
    j = a.join(b, ["window", "timestamp"], "inner")
    return j.select("window", "timestamp", "readings_zone1", "readings_zone2",
                    (F.col("readings_zone1") * F.col("readings_zone2")).alias("documents"))


def _j12_from_fine(fine: DataFrame) -> DataFrame:
    k = fine.where(F.col("zone").isin(1, 2)).groupBy(F.col("w1").alias("window"), "timestamp").agg(
        F.sum(F.when(F.col("zone") == 1, F.col("readings"))).alias("readings_zone1"),
        F.sum(F.when(F.col("zone") == 2, F.col("readings"))).alias("readings_zone2"))
    return (k.where(F.col("readings_zone1").isNotNull() & F.col("readings_zone2").isNotNull())
             .withColumn("documents", F.col("readings_zone1") * F.col("readings_zone2")))


def _j123_from_fine(fine: DataFrame, settings: Settings) -> DataFrame:
    """One aggregate per (second window, timestamp, first window), one more per key: the input is read once."""
    clock = F.when(F.col("zone") == 3, F.col("w1.start")).otherwise(F.col("w1.end"))
    readings = [F.sum(F.when(F.col("zone") == z, F.col("readings"))).alias(f"r{z}") for z in ZONES]
    per = fine.groupBy(F.window(clock, settings.foot_join_second).alias("window"), "timestamp", "w1").agg(*readings)
    k = per.groupBy("window", "timestamp").agg(F.sum(F.col("r1") * F.col("r2")).alias("pairs_12"), F.sum("r3").alias("readings_zone3"))
    return (k.where(F.col("pairs_12").isNotNull() & F.col("readings_zone3").isNotNull())
             .withColumn("documents", F.col("pairs_12") * F.col("readings_zone3")))


def foot_traffic_as_coded(running, settings: Settings = DEFAULTS) -> DataFrame:
    """(zone1 x zone2) x zone3 per 20-minute window and timestamp.

    Rows of the first join enter the 20-minute window at the end of their
    10-minute window. Columns: window, timestamp, pairs_12 (first-join
    documents entering the window), readings_zone3, documents.
    """
    fine = _batch_fine(running, settings)
    if fine is not None:
        return _j123_from_fine(fine, settings)
    second = settings.foot_join_second
    running = _with_counts(running, settings)
    j1 = foot_traffic_window_join_12(running, settings)
    right = _key_readings(running, 3, second, "readings_zone3")
    if j1.isStreaming:
        left = j1.select(F.window(F.col("window.end"), second).alias("lw"),
                         F.col("timestamp").alias("lts"), F.col("documents").alias("d12"))
        j = left.join(right, (F.col("lw") == F.col("window")) & (F.col("lts") == F.col("timestamp")))
        return j.groupBy(F.window(F.window_time("window"), second).alias("window"), "timestamp").agg(
            F.sum("d12").alias("pairs_12"), F.max("readings_zone3").alias("readings_zone3"),
            F.sum(F.col("d12") * F.col("readings_zone3")).alias("documents"))
    left = (j1.groupBy(F.window(F.col("window.end"), second).alias("window"), "timestamp")
              .agg(F.sum("documents").alias("pairs_12")))
    j = left.join(right, ["window", "timestamp"], "inner")
    return j.select("window", "timestamp", "pairs_12", "readings_zone3",
                    (F.col("pairs_12") * F.col("readings_zone3")).alias("documents"))


def foot_traffic_factors(running, settings: Settings = DEFAULTS) -> DataFrame:
    """The ranges whose cross product is the source's document list (batch).

    Columns: window (20 minutes), timestamp, zone, join_window (the window
    the zone was joined in: 10 minutes for zones 1 and 2, the 20-minute
    window for zone 3), sensor_uid, visitors_from, visitors_to. For a
    (window, timestamp) key the source's documents are, for each 10-minute
    join window, (zone-1 ranges x zone-2 ranges of that join window) x
    zone-3 ranges. Ranges are matched to keys with semi joins against the
    per-key tables, so no pair is ever formed.
    """
    if not _nested(settings):
        raise ValueError("the second join window must be a multiple of the first")
    second = settings.foot_join_second
    fine = _fine(running, settings)
    keys = _j123_from_fine(fine, settings).select(
        F.col("window.start").alias("_w"), F.col("timestamp").alias("_k"))
    j1 = _j12_from_fine(fine).select(F.col("window.start").alias("_w1"), F.col("timestamp").alias("_k1"))
    z12 = (fine.where(F.col("zone").isin(1, 2))
               .join(j1, (F.col("w1.start") == F.col("_w1")) & (F.col("timestamp") == F.col("_k1")),
                     "left_semi")
               .select(F.window(F.col("w1.end"), second).alias("window"), "timestamp", "zone",
                       F.col("w1").alias("join_window"), "sensor_uid", "visitors_from", "visitors_to"))
    z3 = (fine.where(F.col("zone") == 3)
              .groupBy(F.window(F.col("w1.start"), second).alias("window"), "timestamp", "zone",
                       "sensor_uid")
              .agg(F.min("visitors_from").alias("visitors_from"),
                   F.max("visitors_to").alias("visitors_to"))
              .select("window", "timestamp", "zone", F.col("window").alias("join_window"),
                      "sensor_uid", "visitors_from", "visitors_to"))
    both = z12.unionByName(z3)
    return both.join(keys, (F.col("window.start") == F.col("_w")) & (F.col("timestamp") == F.col("_k")),
                     "left_semi")


def foot_traffic_intended(readings: DataFrame, settings: Settings = DEFAULTS,
                          zones=ZONES) -> DataFrame:
    """Unique devices (MAC) per zone and visit window, one row per window.

    Exact distinct count in two aggregations: (window, zone, mac) first,
    then per window a conditional count per zone. Stream-safe (the second
    aggregation regroups on ``window_time``).
    """
    df = readings.where(F.col("zone").isin(list(zones)) & F.col("mac").isNotNull())
    dev = df.groupBy(tumble("arrival", settings.visit_window).alias("window"), "zone", "mac").agg(
        F.count(F.lit(1)).alias("_readings"))
    win = (F.window(F.window_time("window"), settings.visit_window).alias("window")
           if dev.isStreaming else F.col("window"))
    return dev.groupBy(win).agg(
        *[F.count(F.when(F.col("zone") == F.lit(z), F.lit(1))).alias(f"visitors_zone{z}")
          for z in zones])
