"""Document projections for the seven result indexes.

Each function maps an operator's output to the index's document fields and
adds ``doc_id``: a SHA-256 of the index name, the window start and the
row's key. A replayed micro-batch therefore rewrites the same documents
instead of appending duplicates. Foot-traffic documents describe the
pair-listing join per key (count of its documents) and, separately, by the
ranges that generate them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall import settings as S


def doc_id(index: str, *parts) -> Column:
    cols = [F.lit(index)]
    for p in parts:
        c = F.col(p) if isinstance(p, str) else p
        cols.append(F.coalesce(c.cast("string"), F.lit("<null>")))
    return F.sha2(F.concat_ws("|", *cols), 256)


def _ws() -> Column:
    return F.unix_seconds(F.col("window.start"))


def _bounds(window: str) -> list[Column]:
    return [F.unix_seconds(F.col(f"{window}.{side}")).alias(f"{window}_{side}") for side in ("start", "end")]


def foot_traffic_docs(df: DataFrame) -> DataFrame:
    """One document per (20-minute window, timestamp): how many documents the
    pair-listing join holds for the key, and the readings behind them."""
    return df.select(
        doc_id(S.INDEX_FOOT_TRAFFIC, _ws(), "timestamp").alias("doc_id"),
        *_bounds("window"), F.col("timestamp"),
        F.col("pairs_12").alias("pairs_Zone1_Zone2"),
        F.col("readings_zone3").alias("readings_Zone3"),
        F.col("documents"),
    )


def foot_traffic_factor_docs(df: DataFrame) -> DataFrame:
    """The running-count ranges per zone. For a (window, timestamp) key the
    pair-listing join's documents are, per join window of zones 1 and 2, the
    cross product of their ranges and zone 3's; all bounds are kept, so the
    list can be expanded from these documents alone."""
    return df.select(
        doc_id(S.INDEX_FOOT_TRAFFIC, _ws(), "timestamp", "zone",
               F.unix_seconds(F.col("join_window.start")), "sensor_uid").alias("doc_id"),
        *_bounds("window"), "timestamp", "zone", *_bounds("join_window"), "sensor_uid", "visitors_from", "visitors_to",
    )


def proximity_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_PROXIMITY, _ws(), "ts").alias("doc_id"),
                     F.col("area").alias("Area"), "visitors")


def traffic_jam_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_TRAFFIC_JAM, _ws(), "area").alias("doc_id"),
                     "visitors", "area", F.col("observation").alias("traffic observation"))


def category_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_CATEGORIES, _ws(), "category").alias("doc_id"),
                     "category", "date", F.col("total_sales").alias("total_Sales"))


def payment_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_PAYMENT, _ws(), "payment_method").alias("doc_id"),
                     F.col("payment_method").alias("payment_Method"), "count")


def stock_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_STOCK, _ws(), "productid").alias("doc_id"),
                     F.col("productid").alias("product_ID"), "stock_check", "observation")


def sales_docs(df: DataFrame) -> DataFrame:
    return df.select(doc_id(S.INDEX_SALES, _ws(), "category").alias("doc_id"),
                     "date", F.col("total_sales").alias("total_Sales"))


def alert_docs(df: DataFrame) -> DataFrame:
    """Crowd alerts (one per proximity result at or above the threshold)."""
    return df.select(doc_id("offer-alerts", _ws(), "ts").alias("doc_id"),
                     "ts", "area", "visitors", "message", "sender")


DOCUMENTS = {
    S.INDEX_FOOT_TRAFFIC: foot_traffic_docs,
    S.INDEX_PROXIMITY: proximity_docs,
    S.INDEX_TRAFFIC_JAM: traffic_jam_docs,
    S.INDEX_CATEGORIES: category_docs,
    S.INDEX_PAYMENT: payment_docs,
    S.INDEX_STOCK: stock_docs,
    S.INDEX_SALES: sales_docs,
}
