"""In-store analytics over purchases: tumbling-window aggregates per key.

Every operator is one ``groupBy(window, key).agg(...)``: Spark runs a
partial aggregate before the shuffle, so a hot key (a category, a payment
method) sends one partial row per map task, not its rows. All work on
batch DataFrames and, after ``withWatermark('arrival', ...)``, on streams.
Outputs keep the ``window`` struct so they can feed a later window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.labels import epoch_text, stock_label
from footfall.functions.ordering import last_by
from footfall.functions.timewin import tumble
from footfall.settings import DEFAULTS, Settings


def _pos(purchases: DataFrame, pos: str | None) -> DataFrame:
    return purchases if pos is None else purchases.where(F.col("pos") == F.lit(pos))


def category_count(purchases: DataFrame, settings: Settings = DEFAULTS,
                   pos: str | None = "POS2") -> DataFrame:
    """Sales count per category and window, with the date of the last sale.

    The count is what the source indexes as ``total_Sales``.
    """
    g = _pos(purchases, pos).groupBy(
        tumble("arrival", settings.category_window).alias("window"), "product_category"
    ).agg(F.count(F.lit(1)).alias("total_sales"), last_by("ts").alias("_last_ts"))
    return g.select("window", F.col("product_category").alias("category"),
                    epoch_text("_last_ts", settings).alias("date"), "total_sales")


def payment_method_count(purchases: DataFrame, settings: Settings = DEFAULTS,
                         pos: str | None = "POS1") -> DataFrame:
    """Purchases per payment method and window."""
    return _pos(purchases, pos).groupBy(
        tumble("arrival", settings.payment_window).alias("window"), "payment_method"
    ).agg(F.count(F.lit(1)).alias("count"))


def stock_availability(purchases: DataFrame, settings: Settings = DEFAULTS,
                       pos: str | None = "POS1") -> DataFrame:
    """Last stock level per product and window, labelled against the threshold."""
    g = _pos(purchases, pos).groupBy(
        tumble("arrival", settings.stock_window).alias("window"), "productid"
    ).agg(last_by("available_stock").alias("stock_check"))
    return g.select("window", "productid", "stock_check",
                    stock_label("stock_check", settings).alias("observation"))


def total_sales_as_coded(purchases: DataFrame, settings: Settings = DEFAULTS,
                         pos: str | None = "POS2") -> DataFrame:
    """Per category and window: date and amount of the last sale.

    The source overwrites its running total with each amount, so the value
    it stores as total sales is the last amount. Its documents drop the
    category; we keep it as a column for the document id only.
    """
    g = _pos(purchases, pos).groupBy(
        tumble("arrival", settings.sales_window).alias("window"), "product_category"
    ).agg(last_by("ts").alias("_last_ts"), last_by("amount").alias("total_sales"))
    return g.select("window", F.col("product_category").alias("category"),
                    epoch_text("_last_ts", settings).alias("date"), "total_sales")


def total_sales_intended(purchases: DataFrame, settings: Settings = DEFAULTS,
                         pos: str | None = "POS2") -> DataFrame:
    """Per category and window: sum of amounts, sales count, date of the last sale."""
    g = _pos(purchases, pos).groupBy(
        tumble("arrival", settings.sales_window).alias("window"), "product_category"
    ).agg(F.sum("amount").cast("long").alias("total_sales"),
          F.count(F.lit(1)).alias("sales"),
          last_by("ts").alias("_last_ts"))
    return g.select("window", F.col("product_category").alias("category"),
                    epoch_text("_last_ts", settings).alias("date"), "total_sales", "sales")


def _same_window(df: DataFrame, size: str) -> Column:
    """Regroup rows that already carry a ``window`` of ``size``."""
    if df.isStreaming:
        return F.window(F.window_time("window"), size).alias("window")
    return F.col("window")


def most_used_payment_method(purchases: DataFrame, settings: Settings = DEFAULTS,
                             pos: str | None = "POS1") -> DataFrame:
    """The payment method used most per window (ties: alphabetically first).

    Two aggregations, no ranking window: the per-window pick is a
    ``min_by`` over ``(-count, method)``.
    """
    counts = payment_method_count(purchases, settings, pos)
    key = F.struct((-F.col("count")).alias("neg"), F.col("payment_method").alias("m"))
    return counts.groupBy(_same_window(counts, settings.payment_window)).agg(
        F.min_by("payment_method", key).alias("payment_method"),
        F.max("count").alias("count"),
        F.sum("count").alias("purchases"),
    )


def underperforming_categories(purchases: DataFrame, settings: Settings = DEFAULTS,
                               pos: str | None = "POS2", k: int | None = None) -> DataFrame:
    """The ``k`` categories with the fewest sales per window.

    Ranked by (sales count, total amount, category). ``k == 1`` is one more
    aggregation (stream-safe). For ``k > 1`` a rank window runs over the
    already aggregated rows of a window: one row per category. A stream ranks
    them in a processor that holds ``k`` rows.
    """
    k = settings.bottom_k if k is None else k
    counts = _pos(purchases, pos).groupBy(
        tumble("arrival", settings.category_window).alias("window"), "product_category"
    ).agg(F.count(F.lit(1)).alias("sales"), F.sum("amount").cast("long").alias("amount"))
    if k == 1:
        key = F.struct("sales", "amount", "product_category")
        return counts.groupBy(_same_window(counts, settings.category_window)).agg(
            F.min_by("product_category", key).alias("category"),
            F.min("sales").alias("sales"),
            F.min_by("amount", key).alias("amount"),
            F.lit(1).cast("long").alias("rank"),
        )
    if counts.isStreaming:
        from footfall.streaming.stateful import bottom_k_stream
        return bottom_k_stream(counts, k)
    w = Window.partitionBy("window").orderBy("sales", "amount", "product_category")
    return (counts.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
                  .select("window", F.col("product_category").alias("category"),
                          "sales", "amount", "rank"))


def sale_sessions(purchases: DataFrame, settings: Settings = DEFAULTS,
                  pos: str | None = None) -> DataFrame:
    """Purchase sessions per seller: a purchase more than the gap after the
    seller's previous purchase (by arrival) starts a new session. Purchases
    without ``arrival`` belong to no session.

    Stream: native ``session_window``, its rows merged into sessions within
    each task before they are shuffled, so a busy seller sends a row per session
    and task. Batch: purchases in one bucket as wide
    as the gap are never more than a gap apart, so they are reduced to one row
    per (seller, bucket) by a partial aggregate first. Sessions then break
    between buckets only; a seller's buckets are ordered, not the purchases.
    """
    from footfall.functions.timewin import _micros

    df = _pos(purchases, pos).where(F.col("arrival").isNotNull())
    if df.isStreaming:
        df.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        return df.groupBy(F.session_window("arrival", settings.sale_session_gap).alias("session"), "seller_name").agg(
            F.count(F.lit(1)).alias("purchases"), F.sum("amount").cast("long").alias("amount"),
            F.min("arrival").alias("first_arrival"), F.max("arrival").alias("last_arrival"))
    gap = _micros(settings.sale_session_gap)
    buckets = df.groupBy("seller_name", F.floor(F.unix_micros("arrival") / F.lit(gap)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("purchases"), F.sum("amount").alias("amount"),
        F.min("arrival").alias("first_arrival"), F.max("arrival").alias("last_arrival"))
    order = Window.partitionBy("seller_name").orderBy("bucket")
    before = F.unix_micros(F.lag("last_arrival").over(order))
    starts = F.when(before.isNull() | (F.unix_micros("first_arrival") - before > F.lit(gap)), 1).otherwise(0)
    g = (buckets.withColumn("starts", starts).withColumn("session_no", F.sum("starts").over(order))
         .groupBy("seller_name", "session_no").agg(
             F.sum("purchases").alias("purchases"), F.sum("amount").cast("long").alias("amount"),
             F.min("first_arrival").alias("first_arrival"), F.max("last_arrival").alias("last_arrival")))
    end = F.timestamp_micros(F.unix_micros("last_arrival") + F.lit(gap))
    return g.select(F.struct(F.col("first_arrival").alias("start"), end.alias("end")).alias("session"),
                    "seller_name", "purchases", "amount", "first_arrival", "last_arrival")


def items_by_shop(purchases: DataFrame) -> DataFrame:
    """Items sold per seller and category: count, total amount, first/last sale."""
    return purchases.groupBy("seller_name", "product_category").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("amount").cast("long").alias("amount"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
