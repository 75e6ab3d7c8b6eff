"""Ticks close windows; sessions are merged before the shuffle; bottom-k on streams; one read per result."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from footfall import settings as S
from footfall.operators import foot_traffic as ft
from footfall.operators import instore, proximity
from footfall.schemas import PURCHASE, READING
from footfall.sources.files import stream_files
from footfall.sources.testdata import table_purchases, table_readings
from footfall.streaming import clock, jobs
from footfall.streaming.sinks import read_documents, write_documents
from test_streaming import NOW, _append, _flush_rows, _same, _stream_vs_batch, _write_in_chunks


def _memory(df, name, ck):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    return q


def test_the_last_windows_are_written_without_dated_rows(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    _write_in_chunks(p, f"{scratch}/in", n_files=2)

    def start(stream):
        return jobs.start_instore_shared(stream, f"{scratch}/out", NOW, trigger={"availableNow": True}, checkpoint_base=f"{scratch}/ck")

    clock.run_to_end(start, lambda: stream_files(spark, f"{scratch}/in", PURCHASE, max_files_per_trigger=1), f"{scratch}/ticks",
                     datetime(2024, 3, 1), settings=NOW)
    for index, want in jobs.instore_documents(p, NOW).items():
        _same(read_documents(spark, f"{scratch}/out", index).drop("batch"), want)


def test_the_last_foot_traffic_windows_are_written_without_dated_rows(spark, scratch):
    r = table_readings(spark, SF001).where("zone < 4").select([f.name for f in READING.fields])
    _write_in_chunks(r, f"{scratch}/in", n_files=1)

    def start(stream):
        return jobs.start_foot_traffic(stream, f"{scratch}/out", NOW, trigger={"availableNow": True}, checkpoint_base=f"{scratch}/ck")

    clock.run_to_end(start, lambda: stream_files(spark, f"{scratch}/in", READING), f"{scratch}/ticks", datetime(2024, 3, 1), clock.ZONES, NOW)
    for index, want in jobs.foot_traffic_documents(r, NOW).items():
        _same(read_documents(spark, f"{scratch}/out", index).drop("batch"), want)


def test_an_idle_till_does_not_hold_back_the_other(spark, scratch):
    """POS2 sells nothing; a tick closes the windows of POS1, and counts in no result."""
    p = table_purchases(spark, SF0001).where("pos = 'POS1'").select([f.name for f in PURCHASE.fields])
    last = p.agg(F.max("arrival")).first()[0]
    _append(p, f"{scratch}/in")

    def run():
        stream = clock.with_ticks(stream_files(spark, f"{scratch}/in", PURCHASE), f"{scratch}/ticks", NOW)
        d = jobs.instore_documents(stream, NOW)[S.INDEX_PAYMENT]
        q = write_documents(d, S.INDEX_PAYMENT, root=f"{scratch}/out", checkpoint=f"{scratch}/ck", trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None, q.exception()
        return read_documents(spark, f"{scratch}/out", S.INDEX_PAYMENT).drop("batch")

    want = jobs.instore_documents(p, NOW)[S.INDEX_PAYMENT]
    open_ = instore.payment_method_count(p, NOW).where(F.col("window.end") > F.lit(last)).count()
    assert run().count() == want.count() - open_ and open_ > 0
    clock.tick(spark, f"{scratch}/ticks", PURCHASE, last + timedelta(minutes=20))
    _same(run(), want)


@pytest.mark.parametrize("k", [1, 2, 5])
def test_bottom_k_stream_equals_batch(spark, scratch, k):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    nothing = spark.createDataFrame([(10**9 + i, datetime(2024, 2, 5, 10), "POS2", "s", 1, c, 1, "Cash", a, "true", 0)
                                     for i, (c, a) in enumerate([(None, 1), ("a", None), ("b", 3), ("b", 4), ("c", 1), ("d", 1)])], PURCHASE)
    _stream_vs_batch(spark, scratch, f"s_bottom_{k}", p.unionByName(nothing), PURCHASE,
                     lambda d: instore.underperforming_categories(d, NOW, k=k), [{"pos": "POS2", "product_category": "Men", "ts": 0}])


def test_sessions_of_a_busy_seller_are_merged_before_the_shuffle(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    p = p.withColumn("seller_name", F.when(F.col("id") % 10 > 0, "busy").otherwise(F.col("seller_name")))
    p = p.withColumn("arrival", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 30 % 40_000))
    _write_in_chunks(p, f"{scratch}/in")
    _append(_flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0, "seller_name": "nobody"}), f"{scratch}/in")
    stream = jobs.with_clock(stream_files(spark, f"{scratch}/in", PURCHASE, max_files_per_trigger=1), NOW.with_(watermark_delay="2 days"))
    q = _memory(instore.sale_sessions(stream, NOW), "s_busy", f"{scratch}/ck")
    _same(spark.table("s_busy"), instore.sale_sessions(p, NOW))
    plan = q._jsq.explainInternal(False)
    assert plan.index("Exchange") < plan.rindex("MergingSessions"), plan  # read from the top: merged below, that is before, the exchange


@pytest.mark.parametrize("op", [ft.foot_traffic_as_coded, proximity.capture_rate, ft.foot_traffic_window_join_12])
def test_results_read_their_input_once(spark, op):
    plan = op(table_readings(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_capture_rate_with_many_areas(spark):
    """More areas than a long has bits, null devices, and areas that hold nobody."""
    from footfall.functions.areas import Area

    areas = tuple(Area(f"a{i}", float(i), i + 1.0, 0.0, 1.0, True, False, True, False) for i in range(130))
    t = datetime(2024, 1, 1, 10)
    rows = [(k, t, 1, "S", None if k % 11 == 0 else f"M{k % 7}", None, float(k * 13 % 131) + 0.5, 0.5, 0) for k in range(400)]
    r = spark.createDataFrame(rows, READING)
    got = {x.area: (x.area_devices, x.zone_devices) for x in proximity.capture_rate(r, areas=areas).collect()}
    want = {}
    for _, _, _, _, mac, _, lat, _, _ in rows:
        if lat < 130:
            want.setdefault(f"a{int(lat)}", set()).add(mac)
    assert got == {a: (len(m - {None}), 7) for a, m in want.items()}
