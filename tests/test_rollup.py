"""Day tables rolled up, against counts over all rows; streams against batch."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF0001
from footfall.operators import journey, proximity, rollup
from footfall.schemas import READING
from footfall.sources.testdata import table_readings
from test_streaming import _same, _stream_vs_batch


def test_a_month_of_day_sketches_is_within_its_error(spark):
    """Devices return on several days, so adding up days would count them up to seven times."""
    r = spark.range(400_000).select(
        F.col("id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 7 % (30 * 86400)).alias("arrival"),
        (F.col("id") % 3).cast("int").alias("zone"), F.concat(F.lit("m"), F.pmod(F.xxhash64("id"), F.lit(60_000)).cast("string")).alias("mac"))
    exact = {x.zone: x.n for x in r.groupBy("zone").agg(F.countDistinct("mac").alias("n")).collect()}
    days = rollup.day_devices(r)
    assert days.count() == 90 and days.agg(F.max(F.length("devices"))).first()[0] < 10_000
    halves = [days.where(F.dayofmonth("window.start") % 2 == k) for k in (0, 1)]
    for got in (rollup.unique_devices(days), rollup.unique_devices(halves[0].unionByName(halves[1]))):
        rows = got.collect()
        assert sum(x.readings for x in rows) == 400_000
        assert all(abs(x.devices - exact[x.zone]) < 3 * rollup.ERROR * exact[x.zone] for x in rows) and len(rows) == 3


def test_small_sets_are_exact_and_nulls_are_no_device(spark):
    t = datetime(2024, 1, 1, 10)
    rows = [(1, t, 1, "S", None, None, 0.0, 0.0, 0), (2, t, 1, "S", "a", None, 0.0, 0.0, 0), (3, t, 2, "S", None, None, 0.0, 0.0, 0), (4, None, 1, "S", "b", None, 0.0, 0.0, 0)]
    got = rollup.unique_devices(rollup.day_devices(spark.createDataFrame(rows, READING))).collect()
    assert sorted((x.zone, x.readings, x.devices) for x in got) == [(1, 2, 1), (2, 1, 0)]
    r = table_readings(spark, SF0001).where("zone = 1")
    areas = {x.area: x.devices for x in rollup.unique_devices(rollup.day_devices_by_area(r), by="area").collect()}
    inside = proximity.classify_area(r).where("area is not null").groupBy("area").agg(F.countDistinct("mac").alias("n")).collect()
    assert areas == {x.area: x.n for x in inside} and areas


def test_history_from_device_days_equals_visit_history(spark):
    r = table_readings(spark, SF0001)
    _same(rollup.history_of(rollup.device_days(r)), journey.visit_history(r))


def test_day_tables_from_a_stream(spark, scratch):
    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    flush = [{"zone": 1, "ts": 0, "mac": "late"}]
    _stream_vs_batch(spark, f"{scratch}/a", "s_device_days", r, READING, rollup.device_days, flush)
    _same(rollup.history_of(spark.table("s_device_days")), journey.visit_history(r))
    _stream_vs_batch(spark, f"{scratch}/b", "s_day_devices", r, READING,
                     lambda d: rollup.day_devices(d).select("window", "zone", "readings", F.hll_sketch_estimate("devices").alias("n")), flush)
