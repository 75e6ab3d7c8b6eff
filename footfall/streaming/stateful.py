"""Running visitor count on a stream: one value state per (zone, sensor).

The state holds ``(first_ts, n)`` and never expires, as in the source (a
TTL can be set through ``ttl_ms``). Rows of a key within one micro-batch
are ordered by ``(arrival, id)`` before counting, so the result equals the
batch ``keyed_scan`` on the same rows. ``arrival`` stays the event-time
column of the output, so windows and joins downstream keep a watermark.

Needs the RocksDB state store provider (set here when the session has
none) and a checkpoint location on the query.
"""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("arrival", T.TimestampType()),
    T.StructField("zone", T.IntegerType()),
    T.StructField("sensor_uid", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("first_ts", T.LongType()),
    T.StructField("visitors", T.LongType()),
])

STATE_SCHEMA = T.StructType([
    T.StructField("first_ts", T.LongType()),
    T.StructField("has_first", T.BooleanType()),
    T.StructField("n", T.LongType()),
])


def use_rocksdb(spark) -> None:
    """State processors need this store; a session that names one keeps it."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


CHUNK = 1 << 16  # rows handed on at once


def _ordered(rows: Iterator[pd.DataFrame], value: str) -> pd.DataFrame:
    """A key's rows of a micro-batch by ``(arrival, id)``: three numbers a row, none of the key's texts."""
    return (pd.concat([p[["arrival", "id", value]] for p in rows], ignore_index=True)
            .sort_values(["arrival", "id"], kind="stable", ignore_index=True))


class RunningCount(StatefulProcessor):
    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first_and_count", STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = _ordered(rows, "ts")
        if self.state.exists():
            first_ts, has_first, n = self.state.get()
        else:
            first_ts, has_first, n = None, False, 0
        if not has_first:
            v = pdf["ts"].iloc[0]
            first_ts = None if pd.isna(v) else int(v)
            has_first = True
        self.state.update((first_ts, has_first, n + len(pdf)))
        for at in range(0, len(pdf), CHUNK):
            part = pdf.iloc[at:at + CHUNK]
            m = len(part)
            yield pd.DataFrame({
                "id": part["id"].to_numpy(),
                "arrival": part["arrival"].to_numpy(),
                "zone": pd.array([key[0]] * m, dtype="Int32"),
                "sensor_uid": [key[1]] * m,
                "ts": part["ts"].to_numpy(),
                "first_ts": pd.array([first_ts] * m, dtype="Int64"),
                "visitors": np.arange(n + at + 1, n + at + m + 1, dtype=np.int64),
            })

    def close(self) -> None:
        pass


def running_visitors_stream(readings: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    use_rocksdb(readings.sparkSession)
    return readings.groupBy("zone", "sensor_uid").transformWithStateInPandas(
        statefulProcessor=RunningCount(ttl_ms),
        outputStructType=OUT_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
        eventTimeColumnName="arrival",
    )


JOURNEY_SCHEMA = T.StructType([
    T.StructField("mac", T.StringType()),
    T.StructField("visit_no", T.LongType()),
    T.StructField("area", T.StringType()),
    T.StructField("prev_area", T.StringType()),
    T.StructField("entered_at", T.TimestampType()),
    T.StructField("id", T.LongType()),
])

JOURNEY_STATE = T.StructType([
    T.StructField("last_area", T.StringType()),
    T.StructField("visits", T.LongType()),
])


class JourneyTracker(StatefulProcessor):
    """Per device: the area of its last in-area reading and its entry count.
    Emits one row per entry into an area other than the last one."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last_area_and_visits", JOURNEY_STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names: dict[str, int] = {}  # areas as numbers, while the rows are held
        numbered = (p.assign(area=[names.setdefault(a, len(names)) for a in p["area"]]) for p in rows)
        pdf = _ordered(numbered, "area")
        last, visits = self.state.get() if self.state.exists() else (None, 0)
        known = list(names)
        areas = [known[k] for k in pdf["area"]]
        prev = [last] + areas[:-1]
        entry = np.array([a != p for a, p in zip(areas, prev)], dtype=bool)
        k = int(entry.sum())
        self.state.update((areas[-1], visits + k))
        if k == 0:
            return
        yield pd.DataFrame({
            "mac": [key[0]] * k,
            "visit_no": np.arange(visits + 1, visits + 1 + k, dtype=np.int64),
            "area": [a for a, e in zip(areas, entry) if e],
            "prev_area": [p for p, e in zip(prev, entry) if e],
            "entered_at": pdf["arrival"].to_numpy()[entry],
            "id": pdf["id"].to_numpy()[entry],
        })

    def close(self) -> None:
        pass


def journey_stream(inside: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """``inside``: in-area readings (mac, arrival, id, area) of a stream."""
    use_rocksdb(inside.sparkSession)
    return inside.groupBy("mac").transformWithStateInPandas(
        statefulProcessor=JourneyTracker(ttl_ms),
        outputStructType=JOURNEY_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
        eventTimeColumnName="entered_at",
    )


class BottomK(StatefulProcessor):
    """Per window: the ``k`` rows with the least ``(sales, amount, category)``, numbered. A window's rows come in
    one micro-batch (the aggregate before closes it once), so nothing is kept beyond it, and ``k`` rows within."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        def ordered():
            for part in rows:
                for sales, amount, category in zip(part["sales"].tolist(), part["amount"].tolist(), part["product_category"].tolist(), strict=True):
                    missing = amount is None or amount != amount
                    yield (sales, not missing, 0 if missing else int(amount), category is not None, category or "")
        least = heapq.nsmallest(self.k, ordered())
        yield pd.DataFrame({
            "w_start": [key[0]] * len(least), "w_end": [key[1]] * len(least),
            "category": [c if held else None for _, _, _, held, c in least], "sales": [x[0] for x in least],
            "amount": pd.array([x[2] if x[1] else None for x in least], dtype="Int64"), "rank": list(range(1, len(least) + 1)),
        })

    def close(self) -> None:
        pass


def bottom_k_stream(counts: DataFrame, k: int) -> DataFrame:
    """``counts``: closed windows of a stream (window, product_category, sales, amount)."""
    use_rocksdb(counts.sparkSession)
    flat = counts.select(F.unix_micros("window.start").alias("w_start"), F.unix_micros("window.end").alias("w_end"),
                         "product_category", "sales", "amount")
    return flat.groupBy("w_start", "w_end").transformWithStateInPandas(
        statefulProcessor=BottomK(k), outputStructType="w_start long, w_end long, category string, sales long, amount long, rank long",
        outputMode="Append", timeMode="None").select(
        F.struct(F.timestamp_micros("w_start").alias("start"), F.timestamp_micros("w_end").alias("end")).alias("window"),
        "category", "sales", "amount", "rank")
