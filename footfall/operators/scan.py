"""Ordered per-key scans that stay balanced when one key holds most rows.

``keyed_scan`` gives each row, within its key and in a total order: its
1-based position, the first row's value of some columns and the previous
row's value of others. A window ``partitionBy(key)`` would put every row of
a key into one task; here a key is cut into time slices:

1. A slice is a fixed function of the first order column, so the split is
   the same in every run and after a lost executor. One aggregate gives each
   (key, slice) its count and its first and last values.
2. A window over the slices of a key (one row per active slice, however
   busy the key) turns them into one *carry* row per (key, slice): the rows
   before the slice, the key's first values, and the values of the last row
   before the slice.
3. Carry rows are unioned with the rows and sort first in the window
   ``partitionBy(key, slice)``. The carry row is then simply the row before
   the slice's first one: ``lag`` and ``first`` read through it, and
   positions add its count. The rows are shuffled once, with no join.

Nothing is written while the plan is built. The order columns must make the
order total (end with a unique id), and the slice must not decrease along
the order. A row without a value in the first order column (its clock) has no
place in the order and is left out, as windowed grouping leaves it out; null
ids come before all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.ordering import ORDER_COLS, time_long_key
from footfall.functions.timewin import _micros
from footfall.settings import DEFAULTS


def time_slice(col: str, size: str) -> Column:
    """Number of the ``size``-wide slice that timestamp ``col`` falls in."""
    return F.floor(F.unix_micros(F.col(col)) / F.lit(_micros(size))).cast("long")


def scan_key(order: list[str]) -> Column:
    """The order columns as one value; never null where the clock is not."""
    if tuple(order) == ORDER_COLS:
        return time_long_key("arrival", F.coalesce("id", F.lit(-(1 << 63)).cast("long")))
    return F.struct(*[F.col(c) for c in order])


def keyed_scan(df: DataFrame, keys, order, n: str | None = "n",
               first: dict | None = None, lag: dict | None = None,
               slices: Column | None = None) -> DataFrame:
    """Add per-key ordered values to every row of ``df``.

    ``n``: name of the 1-based position column (None: omit).
    ``first``: {output name: column} first row's value within the key.
    ``lag``: {output name: column} previous row's value (null on the first row).
    ``slices``: the slice of a row (default: ``Settings.scan_slice`` wide
    slices of the first order column, which must then be a timestamp).
    """
    keys, order = list(keys), list(order)
    first, lag = dict(first or {}), dict(lag or {})
    firsts = list(dict.fromkeys(first.values()))
    lags = list(dict.fromkeys(lag.values()))
    if slices is None:
        slices = time_slice(order[0], DEFAULTS.scan_slice)
    rows = df.where(F.col(order[0]).isNotNull()).withColumn("_slice", slices)

    per = rows.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_count"),
        *[F.min_by(c, scan_key(order)).alias(f"_first_{c}") for c in firsts],
        *[F.max_by(c, scan_key(order)).alias(f"_last_{c}") for c in lags])
    w = Window.partitionBy(*keys).orderBy("_slice")
    carry = per.select(
        *keys, "_slice", F.lit(0).alias("_row"),
        F.coalesce(F.sum("_count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        *[F.first(f"_first_{c}").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_first_{c}") for c in firsts],
        *[F.lag(f"_last_{c}").over(w).alias(c) for c in lags if c not in keys])

    both = rows.withColumn("_row", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    s = Window.partitionBy(*keys, "_slice").orderBy("_row", *order)
    upto = s.rowsBetween(Window.unboundedPreceding, 0)
    out = both.select(
        *df.columns, "_row",
        (F.first("_before").over(upto) + F.row_number().over(s) - 1).alias("_n"),
        *[F.first(f"_first_{c}").over(upto).alias(f"_out_{name}") for name, c in first.items()],
        *[F.lag(c).over(s).alias(f"_lag_{name}") for name, c in lag.items()])
    return out.where("_row = 1").select(
        *df.columns,
        *([F.col("_n").alias(n)] if n else []),
        *[F.col(f"_out_{name}").alias(name) for name in first],
        *[F.col(f"_lag_{name}").alias(name) for name in lag])
