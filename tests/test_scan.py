"""keyed_scan against a brute-force window, under a hot key and many splits."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from footfall.operators.scan import keyed_scan, time_slice


def brute(df):
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.row_number().over(w).cast("long").alias("n"),
                     F.first("v").over(upto).alias("fv"), F.first("s").over(upto).alias("fs"),
                     F.lag("v").over(w).alias("pv"), F.lag("s").over(w).alias("ps"))


@pytest.mark.parametrize("width,hot", [(1000, 0.0), (7, 0.6), (1, 0.95)])
def test_scan_equals_window(spark, width, hot):
    rnd = random.Random(width)
    rows = []
    for i in range(600):
        k = "hot" if rnd.random() < hot else rnd.choice(["a", "b", None, "c"])
        rows.append((i, k, rnd.randint(0, 40), rnd.choice([None, 1.5, 2.5]), rnd.choice(["x", None])))
    df = spark.createDataFrame(rows, "id long, k string, t int, v double, s string")
    got = keyed_scan(df, ["k"], ["t", "id"], n="n", first={"fv": "v", "fs": "s"},
                     lag={"pv": "v", "ps": "s"}, slices=F.floor(F.col("t") / width))
    assert sorted(got.collect(), key=str) == sorted(brute(df).select(got.columns).collect(), key=str)


def test_hot_key_is_split_across_partitions(spark):
    df = spark.range(2000).select(F.col("id"), F.lit("hot").alias("k"), F.col("id").alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows are few
    try:
        got = keyed_scan(df, ["k"], ["t", "id"], n="n", slices=F.floor(F.col("t") / 50))
        parts = (got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
        assert len(parts) >= 4  # one key, several tasks
        assert got.agg(F.max("n")).first()[0] == 2000
        assert got.where("n = id + 1").count() == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scan_on_a_table_in_time_slices(spark):
    from conftest import SF001
    from footfall.sources.testdata import table_purchases

    df = table_purchases(spark, SF001).select("seller_name", "arrival", "id")
    w = Window.partitionBy("seller_name").orderBy("arrival", "id")
    ref = df.select("*", F.lag("arrival").over(w).alias("ref_prev"),
                    F.row_number().over(w).cast("long").alias("rn"))
    for slices in (None, time_slice("arrival", "1 hour")):
        got = keyed_scan(df, ["seller_name"], ["arrival", "id"], n="n", lag={"prev": "arrival"}, slices=slices)
        j = got.join(ref, ["seller_name", "id"])
        assert j.count() == df.count()
        assert j.where(~F.col("prev").eqNullSafe(F.col("ref_prev")) | (F.col("n") != F.col("rn"))).count() == 0


def test_planning_writes_nothing(spark):
    df = spark.range(10).select("id", F.lit("k").alias("k"), F.col("id").alias("t"))
    plan = keyed_scan(df, ["k"], ["t", "id"], slices=F.col("t"))._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "Broadcast" not in plan


@pytest.mark.parametrize("width,hot", [(1000, 0.0), (7, 0.6), (1, 0.95)])
def test_hits_are_numbered_by_a_second_scan(spark, width, hot):
    """Rows whose value differs from the previous row's, numbered per key."""
    rnd = random.Random(100 + width)
    rows = [(i, "hot" if rnd.random() < hot else rnd.choice(["a", "b", None]),
             rnd.randint(0, 300), rnd.choice(["x", "y", None]))
            for i in range(700)]
    df = spark.createDataFrame(rows, "id long, k string, t int, s string")
    slices = F.floor(F.col("t") / width)
    changed = keyed_scan(df, ["k"], ["t", "id"], n=None, lag={"ps": "s"}, slices=slices).where(
        ~F.col("s").eqNullSafe(F.col("ps")))
    got = keyed_scan(changed, ["k"], ["t", "id"], n="chg", slices=slices)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = (df.withColumn("ps", F.lag("s").over(w)).where(~F.col("s").eqNullSafe(F.col("ps")))
             .withColumn("chg", F.row_number().over(w).cast("long")))
    assert sorted(got.collect(), key=str) == sorted(ref.select(got.columns).collect(), key=str)
