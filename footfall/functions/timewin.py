"""Tumbling processing-time windows and chained window clocks.

A window's result is produced when the window ends, so a downstream window
sees the row at ``window.end`` (not ``end - 1us``). In batch we window on
``window.end`` directly. In a stream Spark only accepts the event-time
column of an aggregate (``window_time`` = ``end - 1us``) as the next time
column, so we shift the next window's start by ``size - 1us`` and add the
1us back afterwards; both give the same windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def tumble(time_col: str | Column, size: str) -> Column:
    c = F.col(time_col) if isinstance(time_col, str) else time_col
    return F.window(c, size)


def _micros(size: str) -> int:
    n, unit = size.split()
    mult = {
        "second": 1_000_000, "seconds": 1_000_000,
        "minute": 60_000_000, "minutes": 60_000_000,
        "hour": 3_600_000_000, "hours": 3_600_000_000,
        "day": 86_400_000_000, "days": 86_400_000_000,
    }[unit.lower()]
    return int(n) * mult


def next_window(df: DataFrame, size: str, window_col: str = "window") -> Column:
    """Grouping column for a window over the emissions of ``window_col``.

    Use it as a ``groupBy`` key; pass the grouped result through
    ``fix_next_window`` (a no-op in batch) before reading its bounds.
    """
    if df.isStreaming:
        shift = f"{_micros(size) - 1} microseconds"
        return F.window(F.window_time(F.col(window_col)), size, size, shift)
    return F.window(F.col(f"{window_col}.end"), size)


def fix_next_window(df: DataFrame, source_is_streaming: bool, col: str = "window") -> DataFrame:
    if not source_is_streaming:
        return df
    return df.withColumn(col, F.struct(
        (F.col(f"{col}.start") + F.expr("INTERVAL 1 MICROSECOND")).alias("start"),
        (F.col(f"{col}.end") + F.expr("INTERVAL 1 MICROSECOND")).alias("end"),
    ))
