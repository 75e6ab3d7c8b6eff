"""First/last-by-arrival aggregate expressions.

The source application takes "the last element of the window" in arrival
order. We make that deterministic with the total order ``(arrival, id)``.
Both helpers are ordinary aggregate expressions (``max_by``/``min_by``), so
they take part in partial (map-side) aggregation and work in streaming
aggregations too.

A struct ordering has no fixed-width aggregation buffer, which makes Spark
plan a sort-based aggregate. A (timestamp, long) order is therefore encoded
as one exact DECIMAL(38,0): ``micros * 10^20 + (id + 2^63)``, which orders
like the pair for every long id and for timestamps within +-30 000 years.
With a fixed-width value (long, int, double...) the aggregate then stays a
hash aggregate. Rows whose arrival or id is null are left out, as windowed
grouping already drops null arrivals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER_COLS = ("arrival", "id")

_ID_SHIFT = "9223372036854775808"     # 2^63: makes every long id non-negative
_MICROS_SCALE = "100000000000000000000"  # 10^20 > 2^64: room for the shifted id


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_long_key(ts, n) -> Column:
    """Exact single-column order key for the pair (timestamp ``ts``, long ``n``)."""
    micros = F.unix_micros(_c(ts)).cast("decimal(20,0)")
    shifted = _c(n).cast("decimal(20,0)") + F.lit(_ID_SHIFT).cast("decimal(20,0)")
    return micros * F.lit(_MICROS_SCALE).cast("decimal(21,0)") + shifted


def order_key(*cols: str) -> Column:
    cols = cols or ORDER_COLS
    if tuple(cols) == ORDER_COLS:
        return time_long_key(*ORDER_COLS)
    return F.struct(*[F.col(c) for c in cols])


def last_by(value, *order: str, when: Column | None = None) -> Column:
    """Value of ``value`` on the greatest ``order`` row (optionally only
    among rows where ``when`` holds; null if there are none)."""
    key = order_key(*order)
    if when is not None:
        key = F.when(when, key)
    return F.max_by(_c(value), key)


def first_by(value, *order: str, when: Column | None = None) -> Column:
    key = order_key(*order)
    if when is not None:
        key = F.when(when, key)
    return F.min_by(_c(value), key)
