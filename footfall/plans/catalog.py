"""Named queries over the shared test tables, each paired with DuckDB SQL.

Every query reads whole tables (``events`` through the adapters of
``footfall.sources.testdata``) and returns a flat DataFrame: window bounds
and other instants become epoch numbers, so Spark and DuckDB results compare
value for value. ``footfall.plans.oracle`` holds the SQL twins.

The crowd threshold on these tables is 2: the busiest proximity group at
sf0.01 has 3 readings, so the default 25 would select nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import labels
from footfall.operators import foot_traffic as ft
from footfall.operators import area_grid, carry, instore, journey, proximity, rollup, shared
from footfall.plans import documents as docs
from footfall.settings import DEFAULTS, Settings
from footfall.sources.testdata import table_areas, table_purchases, table_readings

TEST_SETTINGS: Settings = DEFAULTS.with_(crowd_threshold=2)


def prepare(spark: SparkSession, settings: Settings = DEFAULTS) -> None:
    """Pin the session clock zone (date texts and day cuts depend on it)."""
    spark.conf.set("spark.sql.session.timeZone", settings.session_zone)


def flat(df: DataFrame, col: str = "window", prefix: str = "window") -> DataFrame:
    """Window struct -> ``<prefix>_start``/``<prefix>_end`` epoch seconds."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.unix_seconds(F.col(f"{col}.start")).alias(f"{prefix}_start"),
                     F.unix_seconds(F.col(f"{col}.end")).alias(f"{prefix}_end"), *rest)


def _micros(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.unix_micros(F.col(c)))
    return df


# --- inputs ---------------------------------------------------------------

def _readings(spark, sf_dir, spread=False, grouped=True):
    prepare(spark)
    return table_readings(spark, sf_dir, spread_ts=spread, grouped_ts=grouped)


def _purchases(spark, sf_dir):
    prepare(spark)
    return table_purchases(spark, sf_dir)


# --- foot traffic -----------------------------------------------------------

def q_running_visitors(spark, sf_dir):
    r = ft.running_visitors(_readings(spark, sf_dir))
    return r.select("id", "zone", "sensor_uid", "ts", "first_ts", "visitors")


def q_running_visitors_resumed(spark, sf_dir):
    """The running count in three runs, by ten days each; every 97th reading comes late, with the last run."""
    readings = _readings(spark, sf_dir).where("zone in (1, 2, 3)").select("id", "arrival", "zone", "sensor_uid", "ts")
    run = (F.when(F.col("id") % 97 == 0, 2).when(F.col("arrival") < "2024-01-11", 0).when(F.col("arrival") < "2024-01-21", 1).otherwise(2))
    scan = replace(carry.RUNNING, width="6 hours")
    rows = snapshot = None
    for k in range(3):
        own, snapshot = carry.resume(readings.where(run == k), scan, k, rows, snapshot)
        rows = own if rows is None else rows.unionByName(own)
    return carry.resolve(rows, snapshot, scan).select("id", "zone", "sensor_uid", "ts", "first_ts", "visitors")


def q_foot_traffic_window_join_12(spark, sf_dir):
    return flat(ft.foot_traffic_window_join_12(_readings(spark, sf_dir)))


def q_foot_traffic_as_coded(spark, sf_dir):
    return flat(ft.foot_traffic_as_coded(_readings(spark, sf_dir)))


def q_foot_traffic_factors(spark, sf_dir):
    f = ft.foot_traffic_factors(_readings(spark, sf_dir))
    return flat(flat(f), "join_window", "join_window")


def q_foot_traffic_intended(spark, sf_dir):
    return flat(ft.foot_traffic_intended(_readings(spark, sf_dir)))


def q_unique_devices_by_week(spark, sf_dir):
    """Devices per zone and week, united from day sketches (exact at these numbers of devices)."""
    days = rollup.day_devices(_readings(spark, sf_dir))
    weeks = rollup.unique_devices(days, "week")
    return weeks.select(F.unix_seconds("begin").alias("week_start"), "zone", "readings", "devices")


# --- proximity ------------------------------------------------------------------

def q_classify_area(spark, sf_dir):
    return proximity.classify_area(_readings(spark, sf_dir)).select(
        "id", "zone", "latitude", "longitude", "area")


def q_classify_by_table(spark, sf_dir):
    """Every reading against an areas table of one box per order."""
    return area_grid.classify_by_table(_readings(spark, sf_dir), table_areas(spark, sf_dir)).select("id", "latitude", "longitude", "area")


def _prox(spark, sf_dir):
    return proximity.proximity_traffic_as_coded(_readings(spark, sf_dir, spread=True), TEST_SETTINGS)


def q_proximity_traffic_as_coded(spark, sf_dir):
    return flat(_prox(spark, sf_dir))


def q_proximity_traffic_intended(spark, sf_dir):
    return flat(proximity.proximity_traffic_intended(_readings(spark, sf_dir, spread=True), TEST_SETTINGS))


def q_traffic_jam_as_coded(spark, sf_dir):
    return flat(proximity.traffic_jam_as_coded(_prox(spark, sf_dir), TEST_SETTINGS))


def q_offer_alerts(spark, sf_dir):
    return flat(proximity.offer_alerts(_prox(spark, sf_dir), TEST_SETTINGS))


def q_offer_recipients(spark, sf_dir):
    readings = _readings(spark, sf_dir, spread=True)
    alerts = proximity.offer_alerts(
        proximity.proximity_traffic_as_coded(readings, TEST_SETTINGS), TEST_SETTINGS)
    return flat(proximity.offer_recipients(readings, alerts, TEST_SETTINGS))


def q_capture_rate(spark, sf_dir):
    return flat(proximity.capture_rate(_readings(spark, sf_dir)))


# --- in-store ---------------------------------------------------------------------

def q_category_count(spark, sf_dir):
    return flat(instore.category_count(_purchases(spark, sf_dir)))


def q_payment_method_count(spark, sf_dir):
    return flat(instore.payment_method_count(_purchases(spark, sf_dir)))


def q_stock_availability(spark, sf_dir):
    return flat(instore.stock_availability(_purchases(spark, sf_dir)))


def q_total_sales_as_coded(spark, sf_dir):
    return flat(instore.total_sales_as_coded(_purchases(spark, sf_dir))).drop("category")


def q_total_sales_intended(spark, sf_dir):
    return flat(instore.total_sales_intended(_purchases(spark, sf_dir)))


def q_most_used_payment_method(spark, sf_dir):
    return flat(instore.most_used_payment_method(_purchases(spark, sf_dir)))


def q_underperforming_categories(spark, sf_dir):
    return flat(instore.underperforming_categories(_purchases(spark, sf_dir), k=2))


def q_underperforming_category(spark, sf_dir):
    """The default: the one category with the fewest sales."""
    return flat(instore.underperforming_categories(_purchases(spark, sf_dir)))


def q_sale_sessions(spark, sf_dir):
    s = instore.sale_sessions(_purchases(spark, sf_dir))
    s = s.select(F.unix_micros(F.col("session.start")).alias("session_start"),
                 F.unix_micros(F.col("session.end")).alias("session_end"),
                 "seller_name", "purchases", "amount", "first_arrival", "last_arrival")
    return _micros(s, "first_arrival", "last_arrival")


def q_instore_shared(spark, sf_dir):
    """The four in-store results from one read and one aggregate, as rows of their ``kind``."""
    facts = shared.instore_facts(_purchases(spark, sf_dir))
    size = F.when(F.col("kind") == "sales", 1800).otherwise(900)
    start = F.expr("slot div 1000000")
    has = lambda *kinds: F.col("kind").isin(*kinds)
    return facts.select(
        "kind", start.alias("window_start"), (start + size).alias("window_end"), "key",
        F.when(has("category", "payment"), F.col("n")).alias("count"),
        F.when(has("category", "sales"), labels.epoch_text("last_ts", DEFAULTS)).alias("date"),
        F.when(has("sales"), F.col("last_amount")).alias("total_sales"),
        F.when(has("stock"), F.col("last_stock")).alias("stock_check"),
        F.when(has("stock"), labels.stock_label("last_stock", DEFAULTS)).alias("observation"))


def q_items_by_shop(spark, sf_dir):
    return instore.items_by_shop(_purchases(spark, sf_dir))


# --- per device ---------------------------------------------------------------------

def q_customer_journey(spark, sf_dir):
    return _micros(journey.customer_journey(_readings(spark, sf_dir)), "entered_at")


def q_visit_history(spark, sf_dir):
    return _micros(journey.visit_history(_readings(spark, sf_dir)), "first_seen", "last_seen")


def q_sales_conversion(spark, sf_dir):
    return flat(journey.sales_conversion(_readings(spark, sf_dir), _purchases(spark, sf_dir)))


# --- documents of the seven indexes ---------------------------------------------

def q_docs_foot_traffic(spark, sf_dir):
    return docs.foot_traffic_docs(ft.foot_traffic_as_coded(_readings(spark, sf_dir)))


def q_docs_foot_traffic_factors(spark, sf_dir):
    """By the readings' days alone, so that the sensors of all groups share their first timestamps."""
    return docs.foot_traffic_factor_docs(ft.foot_traffic_factors(_readings(spark, sf_dir, grouped=False)))


def q_docs_proximity(spark, sf_dir):
    return docs.proximity_docs(_prox(spark, sf_dir))


def q_docs_traffic_jam(spark, sf_dir):
    return docs.traffic_jam_docs(proximity.traffic_jam_as_coded(_prox(spark, sf_dir), TEST_SETTINGS))


def q_docs_categories(spark, sf_dir):
    return docs.category_docs(instore.category_count(_purchases(spark, sf_dir)))


def q_docs_payment(spark, sf_dir):
    return docs.payment_docs(instore.payment_method_count(_purchases(spark, sf_dir)))


def q_docs_stock(spark, sf_dir):
    return docs.stock_docs(instore.stock_availability(_purchases(spark, sf_dir)))


def q_docs_sales(spark, sf_dir):
    return docs.sales_docs(instore.total_sales_as_coded(_purchases(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "running_visitors": q_running_visitors,
    "running_visitors_resumed": q_running_visitors_resumed,
    "foot_traffic_window_join_12": q_foot_traffic_window_join_12,
    "foot_traffic_as_coded": q_foot_traffic_as_coded,
    "foot_traffic_factors": q_foot_traffic_factors,
    "foot_traffic_intended": q_foot_traffic_intended,
    "unique_devices_by_week": q_unique_devices_by_week,
    "classify_area": q_classify_area,
    "classify_by_table": q_classify_by_table,
    "proximity_traffic_as_coded": q_proximity_traffic_as_coded,
    "proximity_traffic_intended": q_proximity_traffic_intended,
    "traffic_jam_as_coded": q_traffic_jam_as_coded,
    "offer_alerts": q_offer_alerts,
    "offer_recipients": q_offer_recipients,
    "capture_rate": q_capture_rate,
    "category_count": q_category_count,
    "payment_method_count": q_payment_method_count,
    "stock_availability": q_stock_availability,
    "total_sales_as_coded": q_total_sales_as_coded,
    "total_sales_intended": q_total_sales_intended,
    "most_used_payment_method": q_most_used_payment_method,
    "underperforming_categories": q_underperforming_categories,
    "underperforming_category": q_underperforming_category,
    "sale_sessions": q_sale_sessions,
    "instore_shared": q_instore_shared,
    "items_by_shop": q_items_by_shop,
    "customer_journey": q_customer_journey,
    "visit_history": q_visit_history,
    "sales_conversion": q_sales_conversion,
    "docs_foot_traffic": q_docs_foot_traffic,
    "docs_foot_traffic_factors": q_docs_foot_traffic_factors,
    "docs_proximity": q_docs_proximity,
    "docs_traffic_jam": q_docs_traffic_jam,
    "docs_categories": q_docs_categories,
    "docs_payment": q_docs_payment,
    "docs_stock": q_docs_stock,
    "docs_sales": q_docs_sales,
}
