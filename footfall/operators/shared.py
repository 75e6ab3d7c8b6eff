"""The four in-store results from one read of the purchases.

Category counts, sales (both from POS2), payment counts and stock levels (both
from POS1) are tumbling aggregates of the same rows. Run one by one, each reads
the tills again. ``instore_facts`` reads them once: a purchase becomes one row
per result it takes part in (``kind``), with the result's own window (``slot``)
and key, and ONE aggregate with a common buffer (count, last date, last stock,
last amount) reduces them before the shuffle. Only partial rows are exchanged,
and ``split`` then parts the small outcome by kind into exactly the columns of
the four operators.

On a stream the aggregate groups by the widest of the windows too, whose end
releases all slots inside it: one source, one state store and one query give
all four results; a result of a narrower window comes out with the widest one's
end, up to that much later than from a query of its own, with the same content.

The windows must nest (each divides the widest). Rows without ``arrival`` are
in no window; rows of other tills in no result; null keys are keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.labels import epoch_text, stock_label
from footfall.functions.ordering import last_by
from footfall.functions.timewin import _micros
from footfall.settings import DEFAULTS, Settings

KINDS = ("category", "sales", "payment", "stock")


def _sizes(settings: Settings) -> dict[str, int]:
    return {"category": _micros(settings.category_window), "sales": _micros(settings.sales_window),
            "payment": _micros(settings.payment_window), "stock": _micros(settings.stock_window)}


def nested(settings: Settings = DEFAULTS) -> bool:
    sizes = _sizes(settings).values()
    return all(max(sizes) % s == 0 for s in sizes)


def instore_facts(purchases: DataFrame, settings: Settings = DEFAULTS, counted: str = "POS2", stocked: str = "POS1") -> DataFrame:
    """``window, kind, slot, key, n, last_ts, last_stock, last_amount``; ``slot`` is the start of the kind's
    own window in epoch microseconds. ``counted``: the till of categories and sales, ``stocked``: of payments and stock."""
    if not nested(settings):
        raise ValueError("the in-store windows must divide the widest of them")
    sizes = _sizes(settings)

    def taken(kind: str, key: Column) -> Column:
        size = F.lit(sizes[kind])
        return F.struct(F.lit(kind).alias("kind"), (F.floor(F.unix_micros("arrival") / size) * size).cast("long").alias("slot"), key.cast("string").alias("key"))

    category = F.col("product_category")
    uses = (F.when(F.col("pos") == counted, F.array(taken("category", category), taken("sales", category)))
            .when(F.col("pos") == stocked, F.array(taken("payment", F.col("payment_method")), taken("stock", F.col("productid")))))
    rows = (purchases.where(F.col("pos").isin(counted, stocked) & F.col("arrival").isNotNull())
            .select("id", "arrival", "ts", "available_stock", "amount", F.explode(uses).alias("use")))
    return (rows.groupBy(F.window("arrival", f"{max(sizes.values()) // 1_000_000} seconds").alias("window"),
                         F.col("use.kind").alias("kind"), F.col("use.slot").alias("slot"), F.col("use.key").alias("key"))
            .agg(F.count(F.lit(1)).alias("n"), last_by("ts").alias("last_ts"), last_by("available_stock").alias("last_stock"),
                 last_by("amount").alias("last_amount")))


def split(facts: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """By kind, the columns of ``category_count``, ``total_sales_as_coded``, ``payment_method_count`` and ``stock_availability``."""
    sizes = _sizes(settings)

    def of(kind: str) -> tuple[DataFrame, Column]:
        start = F.timestamp_micros("slot")
        return facts.where(F.col("kind") == kind), F.struct(start.alias("start"), F.timestamp_micros(F.col("slot") + F.lit(sizes[kind])).alias("end")).alias("window")

    date, (category, w1), (sales, w2), (payment, w3), (stock, w4) = epoch_text("last_ts", settings).alias("date"), *map(of, KINDS)
    return {
        "category": category.select(w1, F.col("key").alias("category"), date, F.col("n").alias("total_sales")),
        "sales": sales.select(w2, F.col("key").alias("category"), date, F.col("last_amount").alias("total_sales")),
        "payment": payment.select(w3, F.col("key").alias("payment_method"), F.col("n").alias("count")),
        "stock": stock.select(w4, F.col("key").cast("long").alias("productid"), F.col("last_stock").alias("stock_check"),
                              stock_label("last_stock", settings).alias("observation")),
    }
