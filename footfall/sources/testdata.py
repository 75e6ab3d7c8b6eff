"""Adapters from the shared test tables to readings and purchases.

Only ``events`` (event_id, ts, user_id, event_type, value, props) carries a
clock at the needed grain, so both streams are derived from it. Each
expression here has a twin in ``footfall.plans.oracle`` so that Spark and
DuckDB see row-for-row identical inputs. Coordinates are integers divided by
a double (no decimal literal). The reading timestamp is cut to the day and
moved by a minute per group of two sensors, so that sensors of different
zones share first timestamps and a zone has several of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources.files import read_table


def _day_seconds(ts: Column) -> Column:
    return F.unix_seconds(F.date_trunc("day", ts.cast("timestamp")))


def readings_from_events(events: DataFrame, spread_ts: bool = False, grouped_ts: bool = True) -> DataFrame:
    """Sensor readings: zone 1..4 by event id, ten sensors per zone.

    ``spread_ts`` adds ``120 * (user_id % 3)`` seconds to the day-level
    timestamp, so one 30-minute window holds several timestamp keys
    (used for proximity / traffic-jam checks). Without ``grouped_ts`` the
    timestamp is the day alone, and all sensors of a day meet in the zone joins.
    """
    ts = _day_seconds(F.col("ts"))
    if grouped_ts:
        ts = ts + F.lit(60) * (F.col("user_id") % 5)
    if spread_ts:
        ts = ts + F.lit(120) * (F.col("user_id") % 3)
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("arrival"),
        (F.lit(1) + F.col("event_id") % 4).cast("int").alias("zone"),
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("sensor_uid"),
        F.concat(F.lit("M"), (F.col("user_id") % 20).cast("string")).alias("mac"),
        F.lit(None).cast("string").alias("ip"),
        ((F.lit(40419373) + (F.col("event_id") * 37) % 627).cast("double")
         / F.lit(1000000).cast("double")).alias("latitude"),
        ((F.lit(-3705999) + (F.col("event_id") * 53) % 925).cast("double")
         / F.lit(1000000).cast("double")).alias("longitude"),
        ts.cast("long").alias("ts"),
    )


def purchases_from_events(events: DataFrame) -> DataFrame:
    """Purchases: POS1 for even event ids, POS2 for odd ones."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("arrival"),
        F.when(F.col("event_id") % 2 == 0, F.lit("POS1")).otherwise(F.lit("POS2")).alias("pos"),
        F.concat(F.lit("Seller_"), (F.lit(1) + F.col("user_id") % 4).cast("string")).alias("seller_name"),
        (F.lit(1) + F.col("user_id") % 29).cast("long").alias("productid"),
        F.col("event_type").alias("product_category"),
        ((F.col("event_id") * 17) % 101).cast("int").alias("available_stock"),
        F.when(F.col("user_id") % 3 == 0, F.lit("Cash"))
         .when(F.col("user_id") % 3 == 1, F.lit("Mobile Payment"))
         .otherwise(F.lit("Credit Card")).alias("payment_method"),
        F.floor(F.col("value")).cast("int").alias("amount"),
        F.when(F.col("user_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("loyalty_card"),
        _day_seconds(F.col("ts")).cast("long").alias("ts"),
    )


def table_readings(spark: SparkSession, sf_dir: str, spread_ts: bool = False, grouped_ts: bool = True) -> DataFrame:
    return readings_from_events(read_table(spark, sf_dir, "events"), spread_ts, grouped_ts)


def table_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases_from_events(read_table(spark, sf_dir, "events"))


def areas_from_orders(orders: DataFrame) -> DataFrame:
    """An areas table: one box per order, on the lattice that the readings' coordinates lie on, so that points
    fall on edges. Most boxes are a few steps wide, every 500th several hundred; boxes overlap freely."""
    k = F.col("o_orderkey")
    degrees = lambda steps: steps.cast("double") / F.lit(1000000).cast("double")
    lat, lon = F.lit(40419373) + (k * 17) % 627, F.lit(-3705999) + (k * 29) % 925
    high = F.when(k % 500 == 0, 200 + k % 7).otherwise(k % 6)
    wide = F.when(k % 500 == 0, 300 + k % 11).otherwise(k % 9)
    return orders.select(
        F.concat(F.lit("Shop"), k.cast("string")).alias("name"), k.cast("long").alias("position"),
        degrees(lat).alias("lat_lo"), degrees(lat + high).alias("lat_hi"), degrees(lon).alias("lon_lo"), degrees(lon + wide).alias("lon_hi"),
        (k % 2 == 0).alias("lat_lo_closed"), (k % 3 == 0).alias("lat_hi_closed"), (k % 5 != 0).alias("lon_lo_closed"), (k % 7 != 0).alias("lon_hi_closed"))


def table_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas_from_orders(read_table(spark, sf_dir, "orders"))
