"""Property checks (seeded): invariants that must hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from footfall.functions.areas import ZONE1_AREAS
from footfall.operators import foot_traffic as ft
from footfall.operators import instore, proximity
from footfall.plans.catalog import prepare
from footfall.settings import DEFAULTS
from footfall.sources.testdata import table_purchases, table_readings

EDGES = sorted({v for a in ZONE1_AREAS for v in (a.lat_lo, a.lat_hi, a.lon_lo, a.lon_hi)})
LATS = [v for v in EDGES if v > 0]
LONS = [v for v in EDGES if v < 0]
lat = st.one_of(st.sampled_from(LATS), st.floats(40.4192, 40.4201, allow_nan=False))
lon = st.one_of(st.sampled_from(LONS), st.floats(-3.7061, -3.7049, allow_nan=False))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(lat, lon), min_size=150, max_size=150))
def test_area_expression_equals_box_model(spark, points):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(points)],
                               "id long, latitude double, longitude double")
    got = {r.id: r.area for r in proximity.classify_area(df).collect()}
    for i, (a, b) in enumerate(points):
        hits = [x.name for x in ZONE1_AREAS if x.contains_py(a, b)]
        assert len(hits) <= 1  # boxes are disjoint
        assert got[i] == (hits[0] if hits else None)


def test_counts_add_up(spark):
    prepare(spark)
    p = table_purchases(spark, SF001)
    pos2 = p.where("pos = 'POS2'").count()
    assert instore.category_count(p).agg(F.sum("total_sales")).first()[0] == pos2
    pos1 = p.where("pos = 'POS1'").count()
    assert instore.payment_method_count(p).agg(F.sum("count")).first()[0] == pos1
    r = table_readings(spark, SF001, spread_ts=True)
    in_area = proximity.classify_area(r.where("zone = 1")).where("area IS NOT NULL").count()
    assert proximity.proximity_traffic_as_coded(r).agg(F.sum("visitors")).first()[0] == in_area


def test_running_counts_are_one_to_n_per_sensor(spark):
    prepare(spark)
    r = table_readings(spark, SF001)
    run = ft.running_visitors(r, settings=DEFAULTS.with_(scan_slice="5 minutes"))
    per = run.groupBy("zone", "sensor_uid").agg(
        F.count(F.lit(1)).alias("n"), F.max("visitors").alias("mx"), F.min("visitors").alias("mn"),
        F.countDistinct("visitors").alias("d"), F.countDistinct("first_ts").alias("firsts"))
    assert per.where("mn != 1 OR mx != n OR d != n OR firsts != 1").count() == 0


def test_partitioning_does_not_change_results(spark):
    prepare(spark)
    r = table_readings(spark, SF001)
    a = ft.running_visitors(r, settings=DEFAULTS.with_(scan_slice="3 minutes")).select("id", "first_ts", "visitors")
    b = ft.running_visitors(r.repartition(11), settings=DEFAULTS.with_(scan_slice="1 hour")).select("id", "first_ts", "visitors")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    x = ft.foot_traffic_factors(r)
    y = ft.foot_traffic_factors(r.repartition(7, "sensor_uid"))
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_area_position_round_trips_to_name(spark):
    from footfall.functions.areas import area_index_of, area_name, area_of

    r = table_readings(spark, SF001)
    d = r.select(area_of().alias("a"), area_name(area_index_of()).alias("n"))
    assert d.where(~F.col("a").eqNullSafe(F.col("n"))).count() == 0


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-2 * 10**9, 4 * 10**9), st.integers(-2**63, 2**63 - 1)),
                min_size=200, max_size=200, unique=True))
def test_time_long_key_orders_like_the_pair(spark, pairs):
    from footfall.functions.ordering import time_long_key

    df = spark.createDataFrame([(s, i) for s, i in pairs], "sec long, id long").select(
        F.timestamp_seconds("sec").alias("t"), "sec", "id")
    got = [(r.sec, r.id) for r in df.orderBy(time_long_key("t", "id")).collect()]
    assert got == sorted(pairs)
