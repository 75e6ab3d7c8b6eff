"""Foot traffic on a stream by windowed prefix state.

The zone joins need, per sensor and 10-minute window, the range of running
counts that the window's readings got. A stream gets there without seeing a
reading in Python:

1. A native windowed aggregate per (zone, sensor, window) counts the readings
   and keeps the first timestamp. It hands a window on when the watermark
   passes its end, so a sensor's windows come in order, each once, however its
   readings were spread over micro-batches.
2. ``SensorPrefix``, a state processor per (zone, sensor), holds the sensor's
   first timestamp and count so far, and turns each window row into a range.
   Its state is two numbers and never expires, as in the source.
3. ``KeyRanges``, a state processor per (20-minute window, first timestamp),
   keeps the ranges in list state until an event-time timer at the window's end,
   then says which of them take part in the joins and how many documents the
   key has, and drops its state. Ranges flow, never pairs.

Row counts: one row per sensor and window into step 2, one per range out of
step 3. All instants are epoch microseconds except the event-time column. A
reading without timestamp, or whose sensor's first reading has none, joins
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from footfall.functions.ordering import first_by
from footfall.functions.timewin import _micros
from footfall.settings import DEFAULTS, Settings
from footfall.streaming.stateful import use_rocksdb

CHUNK = 4096  # rows of a state list handed on at once

_PREFIX = T.StructType([T.StructField("first_ts", T.LongType()), T.StructField("n", T.LongType())])
_RANGE = "zone int, sensor_uid string, w_start long, w_time timestamp, w_end long, timestamp long, visitors_from long, visitors_to long, readings long"
_HELD = T.StructType([T.StructField("zone", T.IntegerType()), T.StructField("sensor_uid", T.StringType()), T.StructField("w_start", T.LongType()),
                      T.StructField("visitors_from", T.LongType()), T.StructField("visitors_to", T.LongType())])
_RESULT = ("kind string, window_start long, timestamp long, zone int, join_start long, sensor_uid string, visitors_from long, visitors_to long, "
           "pairs_12 long, readings_zone3 long, documents long")
_FIELDS = [f.split()[0] for f in _RESULT.split(", ")]


class SensorPrefix(StatefulProcessor):
    """Per (zone, sensor): window rows to ranges of running counts."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first_and_count", _PREFIX)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One row per window of the sensor that this micro-batch closes.
        windows = sorted(w for part in rows for w in zip(part["w_start"], part["w_time"], part["w_end"], part["readings"], part["ts0"], strict=True))
        first_ts, n = self.state.get() if self.state.exists() else (windows[0][4], 0)
        first_ts = None if pd.isna(first_ts) else int(first_ts)
        out = []
        for start, time, end, readings, _ in windows:
            out.append((key[0], key[1], start, time, end, first_ts, n + 1, n + int(readings), int(readings)))
            n += int(readings)
        self.state.update((first_ts, n))
        frame = pd.DataFrame(out, columns=[f.split()[0] for f in _RANGE.split(", ")])
        frame["timestamp"] = pd.array([first_ts] * len(out), dtype="Int64")
        yield frame

    def close(self) -> None:
        pass


class KeyRanges(StatefulProcessor):
    """Per (second join window, first timestamp): the ranges that join, and the number of documents."""

    def __init__(self, second: int):
        self.second = second

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ranges = handle.getListState("ranges", _HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.handle.registerTimer((key[0] + self.second) // 1000)
        for part in rows:
            held = part[["zone", "sensor_uid", "w_start", "visitors_from", "visitors_to"]]
            self.ranges.appendList([(int(z), s, int(w), int(a), int(b)) for z, s, w, a, b in held.itertuples(index=False)])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        readings: dict[tuple[int, int], int] = {}  # by zone and first join window: a few numbers
        for zone, _, start, low, high in self.ranges.get():
            place = (zone, start if zone != 3 else 0)
            readings[place] = readings.get(place, 0) + high - low + 1
        pairs = {w: n * readings[2, w] for (zone, w), n in readings.items() if zone == 1 and (2, w) in readings}
        third = readings.get((3, 0), 0)
        if pairs and third:
            total = sum(pairs.values())
            out = [("key", *key, None, None, None, None, None, total, third, total * third)]
            merged: dict[str, list[int]] = {}  # zone 3's ranges in both halves of the window are one
            for zone, sensor, start, low, high in self.ranges.get():
                if zone == 3:
                    own = merged.setdefault(sensor, [low, high])
                    own[0], own[1] = min(own[0], low), max(own[1], high)
                elif start in pairs:
                    out.append(("range", *key, zone, start, sensor, low, high, None, None, None))
                if len(out) >= CHUNK:
                    yield self._frame(out)
                    out = []
            out += [("range", *key, 3, key[0], sensor, low, high, None, None, None) for sensor, (low, high) in merged.items()]
            for at in range(0, len(out), CHUNK):
                yield self._frame(out[at:at + CHUNK])
        self.ranges.clear()

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=_FIELDS)
        for c in _FIELDS:
            if c not in ("kind", "sensor_uid"):
                frame[c] = frame[c].astype("Int64")
        return frame

    def close(self) -> None:
        pass


def sensor_ranges(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Ranges of running counts per (zone, sensor, first join window) of a stream with a watermark on ``arrival``."""
    use_rocksdb(readings.sparkSession)
    per = (readings.where(F.col("zone").isin(1, 2, 3))
           .groupBy("zone", "sensor_uid", F.window("arrival", settings.foot_join_first).alias("w"))
           .agg(F.count(F.lit(1)).alias("readings"), first_by("ts").alias("ts0"))
           .select("zone", "sensor_uid", F.unix_micros("w.start").alias("w_start"), F.window_time("w").alias("w_time"),
                   F.unix_micros("w.end").alias("w_end"), "readings", "ts0"))
    return per.groupBy("zone", "sensor_uid").transformWithStateInPandas(
        statefulProcessor=SensorPrefix(), outputStructType=_RANGE, outputMode="Append", timeMode="None", eventTimeColumnName="w_time")


def foot_traffic_rows(readings: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Everything the zone joins give, from one read of the stream: rows of ``kind`` ``key`` (documents of a
    key) and ``range`` (the ranges behind them)."""
    first, second = _micros(settings.foot_join_first), _micros(settings.foot_join_second)
    if second % first:
        raise ValueError("the second join window must be a multiple of the first")
    ranges = sensor_ranges(readings, settings).where(F.col("timestamp").isNotNull())
    # Zones 1 and 2 enter the second window at the end of their first one, zone 3 on its own clock.
    clock = F.when(F.col("zone") == 3, F.col("w_start")).otherwise(F.col("w_end"))
    keyed = ranges.withColumn("window_start", F.floor(clock / F.lit(second)).cast("long") * F.lit(second))
    return keyed.groupBy("window_start", "timestamp").transformWithStateInPandas(
        statefulProcessor=KeyRanges(second), outputStructType=_RESULT, outputMode="Append", timeMode="EventTime")


def _bounds(start: str, size: F.Column, name: str) -> list[F.Column]:
    begin = F.timestamp_micros(start)
    return [F.struct(begin.alias("start"), F.timestamp_micros(F.col(start) + size).alias("end")).alias(name)]


def keys_of(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The rows of ``foot_traffic_as_coded``."""
    size = F.lit(_micros(settings.foot_join_second))
    return rows.where("kind = 'key'").select(*_bounds("window_start", size, "window"), "timestamp", "pairs_12", "readings_zone3", "documents")


def ranges_of(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The rows of ``foot_traffic_factors``."""
    first, second = F.lit(_micros(settings.foot_join_first)), F.lit(_micros(settings.foot_join_second))
    return rows.where("kind = 'range'").select(
        *_bounds("window_start", second, "window"), "timestamp", "zone",
        *_bounds("join_start", F.when(F.col("zone") == 3, second).otherwise(first), "join_window"), "sensor_uid", "visitors_from", "visitors_to")
