"""Batch/stream parity and replay safety.

Rows are written as several files, streamed one file per trigger with
``availableNow``, and closed by flush rows whose late ``arrival`` moves the
watermark past every window under test. The stream's documents must equal
the batch documents of the same rows (flush rows left out).
"""

import os
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from conftest import SF0001
from footfall import settings as S
from footfall.schemas import PURCHASE, READING
from footfall.settings import DEFAULTS
from footfall.sources.files import stream_files
from footfall.sources.testdata import table_purchases, table_readings
from footfall.streaming import jobs
from footfall.streaming.sinks import read_documents
from test_fixtures import foot_readings

NOW = DEFAULTS.with_(watermark_delay="0 seconds", crowd_threshold=2)
FLUSH = datetime(2030, 1, 1)


def _append(df, path):
    """Append one parquet file and give it a later mtime than every file
    already there: the file source reads files in mtime order, and files
    written within one clock tick would otherwise come in random order."""
    before = set(Path(path).glob("*.parquet")) if Path(path).exists() else set()
    df.coalesce(1).write.mode("append").parquet(path)
    latest = max((p.stat().st_mtime for p in before), default=0.0)
    for i, f in enumerate(sorted(set(Path(path).glob("*.parquet")) - before)):
        t = max(latest + 10 + i, f.stat().st_mtime)
        os.utime(f, (t, t))


def _write_in_chunks(df, path, n_files=4):
    """Write rows ordered by arrival as n_files separate parquet files."""
    lo, hi = df.agg(F.min("id"), F.max("id")).first()
    step = (hi - lo) // n_files + 1
    for k in range(n_files):
        part = df.where((F.col("id") >= lo + k * step) & (F.col("id") < lo + (k + 1) * step))
        _append(part, path)


def _flush_rows(spark, schema, template: dict, n=1):
    rows = []
    for i in range(n):
        r = dict(template)
        r.update(id=10**12 + i, arrival=FLUSH + timedelta(hours=i))
        rows.append(tuple(r.get(f.name) for f in schema.fields))
    return spark.createDataFrame(rows, schema)


def _run(start, stream, root, ck, **kw):
    qs = start(stream, root=root, settings=NOW, trigger={"availableNow": True},
               checkpoint_base=ck, **kw)
    for q in qs.values():
        q.awaitTermination(300)
        assert q.exception() is None, q.exception()
    return qs


def _same(a, b):
    cols = sorted(a.columns)
    x = sorted((tuple(r) for r in a.select(cols).collect()), key=str)
    y = sorted((tuple(r) for r in b.select(cols).collect()), key=str)
    assert x == y


def test_instore_stream_equals_batch(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    src = f"{scratch}/in"
    _write_in_chunks(p, src)
    flush = _flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0})
    _append(flush.union(flush.withColumn("pos", F.lit("POS2"))), src)
    stream = stream_files(spark, src, PURCHASE, max_files_per_trigger=1)
    _run(jobs.start_instore, stream, f"{scratch}/out", f"{scratch}/ck")
    batch = jobs.instore_documents(p, NOW)
    for index in (S.INDEX_CATEGORIES, S.INDEX_PAYMENT, S.INDEX_STOCK, S.INDEX_SALES):
        got = read_documents(spark, f"{scratch}/out", index).drop("batch")
        _same(got, batch[index])


def test_proximity_chain_stream_equals_batch(spark, scratch):
    r = table_readings(spark, SF0001, spread_ts=True).where("zone = 1").select(
        [f.name for f in READING.fields])
    src = f"{scratch}/in"
    _write_in_chunks(r, src)
    _append(_flush_rows(spark, READING, {"zone": 1, "ts": 0, "latitude": 0.0, "longitude": 0.0}), src)
    stream = stream_files(spark, src, READING, max_files_per_trigger=1)
    _run(jobs.start_proximity, stream, f"{scratch}/out", f"{scratch}/ck", threshold=2)
    batch = jobs.proximity_documents(r, NOW, threshold=2)
    for index in (S.INDEX_PROXIMITY, S.INDEX_TRAFFIC_JAM):
        got = read_documents(spark, f"{scratch}/out", index).drop("batch")
        _same(got, batch[index])


def test_foot_traffic_stream_equals_batch(spark, scratch):
    r = foot_readings(spark)
    src = f"{scratch}/in"
    _append(r.where("arrival < '2024-01-01 01:00:00'"), src)
    _append(r.where("arrival >= '2024-01-01 01:00:00'"), src)
    flush = None
    for z in (1, 2, 3):
        f = _flush_rows(spark, READING, {"zone": z, "sensor_uid": "late", "ts": 5, "latitude": 0.0,
                                         "longitude": 0.0}).withColumn("id", F.col("id") + z)
        flush = f if flush is None else flush.union(f)
    _append(flush, src)
    stream = stream_files(spark, src, READING, max_files_per_trigger=1)
    _run(jobs.start_foot_traffic, stream, f"{scratch}/out", f"{scratch}/ck")
    got = read_documents(spark, f"{scratch}/out", S.INDEX_FOOT_TRAFFIC).drop("batch")
    batch = jobs.foot_traffic_documents(r, NOW)[S.INDEX_FOOT_TRAFFIC]
    assert batch.agg(F.sum("documents")).first()[0] == 12
    _same(got, batch)


def test_foot_traffic_ranges_from_the_stream_expand_to_brute_force_pairs(spark, scratch):
    """Rows of every window are spread over all files, so windows fill over several micro-batches."""
    from collections import Counter
    from types import SimpleNamespace

    from conftest import SF001
    from oracle_compare import duck
    from test_fixtures import expand
    from test_pair_list import PAIRS

    r = table_readings(spark, SF001).where("zone < 4").select([f.name for f in READING.fields])
    src = f"{scratch}/in"
    # The watermark's delay keeps all windows open until the flush rows.
    for k in range(4):
        _append(r.where(F.col("id") % 4 == k), src)
    for at in range(2):
        flush = None
        for z in (1, 2, 3):
            f = _flush_rows(spark, READING, {"zone": z, "sensor_uid": "late", "ts": 5, "latitude": 0.0, "longitude": 0.0}).withColumn("id", F.col("id") + z + 10 * at)
            flush = f if flush is None else flush.union(f)
        _append(flush, src)
    stream = stream_files(spark, src, READING, max_files_per_trigger=1)
    patient = NOW.with_(watermark_delay="60 days")
    queries = jobs.start_foot_traffic(stream, root=f"{scratch}/out", settings=patient, trigger={"availableNow": True}, checkpoint_base=f"{scratch}/ck")
    assert len(queries) == 1
    for q in queries.values():
        q.awaitTermination(300)
        assert q.exception() is None, q.exception()
        assert len(q.recentProgress) >= 5
    batch = jobs.foot_traffic_documents(r, NOW)
    for index, want in batch.items():
        _same(read_documents(spark, f"{scratch}/out", index).drop("batch"), want)
    got = read_documents(spark, f"{scratch}/out", f"{S.INDEX_FOOT_TRAFFIC}-ranges").collect()
    rows = [SimpleNamespace(window=SimpleNamespace(start=d.window_start * 1_000_000), timestamp=d.timestamp, zone=d.zone,
                            join_window=SimpleNamespace(start=d.join_window_start), visitors_from=d.visitors_from, visitors_to=d.visitors_to) for d in got]
    assert expand(rows) == Counter(duck(SF001).sql(PAIRS).fetchall())


def test_readings_without_arrival_are_left_out_alike(spark, scratch):
    """Batch and stream: the running count, the journey and the sessions."""
    from footfall.operators import foot_traffic as ft
    from footfall.operators import instore, journey

    t = datetime(2024, 1, 1, 10)
    rows = [(1, t, 1, "S1", "M1", None, 40.4195, -3.7058, 100), (2, None, 1, "S1", "M1", None, 40.4195, -3.7058, 200),
            (3, t + timedelta(minutes=30), 1, "S1", "M1", None, 40.41975, -3.7055, 300)]
    r = spark.createDataFrame(rows, READING)
    got = ft.running_visitors(r)
    assert sorted((x.id, x.first_ts, x.visitors) for x in got.collect()) == [(1, 100, 1), (3, 100, 2)]
    assert [x.visit_no for x in journey.customer_journey(r).orderBy("visit_no").collect()] == [1, 2]
    _append(r, f"{scratch}/in")
    stream = jobs.with_clock(stream_files(spark, f"{scratch}/in", READING), NOW)
    q = (ft.running_visitors(stream).writeStream.format("memory").queryName("s_null_clock").outputMode("append")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    _same(spark.table("s_null_clock").select(got.columns), got)
    p = spark.createDataFrame([(1, t, "POS1", "s", 1, "Men", 1, "Cash", 5, "true", 0), (2, None, "POS1", "s", 1, "Men", 1, "Cash", 5, "true", 0)], PURCHASE)
    assert [(x.purchases, x.session.start) for x in instore.sale_sessions(p).collect()] == [(1, t)]


def test_replayed_batch_does_not_duplicate(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    src = f"{scratch}/in"
    _write_in_chunks(p, src, n_files=2)
    flush = _flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0})
    _append(flush, src)
    out, ck = f"{scratch}/out", f"{scratch}/ck"

    def run():
        stream = stream_files(spark, src, PURCHASE, max_files_per_trigger=1)
        d = jobs.instore_documents(stream, NOW)[S.INDEX_PAYMENT]
        from footfall.streaming.sinks import write_documents
        q = write_documents(d, S.INDEX_PAYMENT, root=out, checkpoint=f"{ck}/pay",
                            trigger={"availableNow": True})
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = read_documents(spark, out, S.INDEX_PAYMENT).drop("batch")
    n = first.count()
    assert n > 0 and first.select("doc_id").distinct().count() == n
    # Forget that the last batch committed: Spark replays it on restart.
    commits = sorted(Path(f"{ck}/pay/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    os.remove(commits[-1])
    crc = commits[-1].with_name(f".{commits[-1].name}.crc")
    if crc.exists():
        os.remove(crc)
    run()
    again = read_documents(spark, out, S.INDEX_PAYMENT).drop("batch")
    assert again.count() == n
    assert again.select("doc_id").distinct().count() == n


def _stream_vs_batch(spark, scratch, name, table, schema, op, flush_templates):
    """Run ``op`` on a file stream of ``table`` (plus late flush rows) and on
    the batch table; the stream's output must equal the batch output.

    Spark pushes an operator's filters below the watermark, so a flush row
    only moves the clock if it passes them: give one per filtered branch."""
    src = f"{scratch}/in"
    _write_in_chunks(table, src)
    flush = None
    for i, t in enumerate(flush_templates):
        f = _flush_rows(spark, schema, t).withColumn("id", F.col("id") + i)
        flush = f if flush is None else flush.union(f)
    _append(flush, src)
    stream = jobs.with_clock(stream_files(spark, src, schema, max_files_per_trigger=1), NOW)
    q = (op(stream).writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    got = spark.table(name)
    want = op(table)
    assert got.count() > 0
    _same(got, want)


def test_intended_instore_streams(spark, scratch):
    from footfall.operators import instore

    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    flush = [{"pos": pos, "product_category": "Men", "ts": 0, "seller_name": "Seller_1"}
             for pos in ("POS1", "POS2")]
    ops = {
        "s_total_sales": lambda d: instore.total_sales_intended(d, NOW),
        "s_most_used": lambda d: instore.most_used_payment_method(d, NOW),
        "s_under": lambda d: instore.underperforming_categories(d, NOW, k=1),
    }
    for i, (name, op) in enumerate(ops.items()):
        _stream_vs_batch(spark, f"{scratch}/{i}", name, p, PURCHASE, op, flush)


def test_sessions_stream_equals_balanced_batch(spark, scratch):
    from footfall.operators import instore

    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    flush = [{"pos": "POS1", "product_category": "Men", "ts": 0, "seller_name": "nobody"}]
    _stream_vs_batch(spark, scratch, "s_sessions", p, PURCHASE,
                     lambda d: instore.sale_sessions(d, NOW), flush)


def test_intended_foot_traffic_stream(spark, scratch):
    from footfall.operators import foot_traffic as ft
    from footfall.operators import proximity

    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    # inside Area 1, so it passes the area filter pushed below the watermark
    flush = [{"zone": 1, "ts": 0, "latitude": 40.4195, "longitude": -3.7058, "mac": "late"}]
    _stream_vs_batch(spark, f"{scratch}/a", "s_unique", r, READING,
                     lambda d: ft.foot_traffic_intended(d, NOW), flush)
    _stream_vs_batch(spark, f"{scratch}/b", "s_prox_area", r, READING,
                     lambda d: proximity.proximity_traffic_intended(d, NOW), flush)


def test_journey_stream_equals_batch(spark, scratch):
    from footfall.operators import journey

    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    src = f"{scratch}/in"
    _write_in_chunks(r, src)
    stream = jobs.with_clock(stream_files(spark, src, READING, max_files_per_trigger=1), NOW)
    q = (journey.customer_journey(stream).writeStream.format("memory").queryName("s_journey")
         .outputMode("append").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    got = spark.table("s_journey")
    assert got.count() > 0
    _same(got, journey.customer_journey(r))


def test_command_line_runs_instore(spark, scratch):
    from footfall import cli

    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    src = f"{scratch}/in"
    _write_in_chunks(p, src)
    flush = _flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0})
    _append(flush.union(flush.withColumn("pos", F.lit("POS2"))), src)
    qs = cli.main(["instore", "--files", src, "--out", f"{scratch}/out", "--checkpoint",
                   f"{scratch}/ck", "--watermark", "0 seconds", "--available-now",
                   "--max-files-per-trigger", "1"], spark=spark)
    assert set(qs) == {S.INDEX_CATEGORIES, S.INDEX_PAYMENT, S.INDEX_STOCK, S.INDEX_SALES}
    got = read_documents(spark, f"{scratch}/out", S.INDEX_PAYMENT).drop("batch")
    _same(got, jobs.instore_documents(p, NOW)[S.INDEX_PAYMENT])


def test_capture_rate_stream(spark, scratch):
    from footfall.operators import proximity

    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    flush = [{"zone": 1, "ts": 0, "latitude": 40.4195, "longitude": -3.7058, "mac": "late"}]
    _stream_vs_batch(spark, scratch, "s_capture", r, READING,
                     lambda d: proximity.capture_rate(d, NOW), flush)


def test_sales_conversion_stream(spark, scratch):
    from footfall.operators import journey

    r = table_readings(spark, SF0001).select([f.name for f in READING.fields])
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    _write_in_chunks(r, f"{scratch}/r")
    _append(_flush_rows(spark, READING, {"zone": 1, "ts": 0, "mac": "late"}), f"{scratch}/r")
    _write_in_chunks(p, f"{scratch}/p")
    _append(_flush_rows(spark, PURCHASE, {"pos": "POS1", "ts": 0, "amount": 1}), f"{scratch}/p")
    rs = jobs.with_clock(stream_files(spark, f"{scratch}/r", READING, max_files_per_trigger=1), NOW)
    ps = jobs.with_clock(stream_files(spark, f"{scratch}/p", PURCHASE, max_files_per_trigger=1), NOW)
    q = (journey.sales_conversion(rs, ps, NOW).writeStream.format("memory").queryName("s_conv")
         .outputMode("append").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()
    got = spark.table("s_conv")
    assert got.count() > 0
    _same(got, journey.sales_conversion(r, p, NOW))


def test_offer_recipients_stream(spark, scratch):
    from footfall.operators import proximity

    def op(d):
        alerts = proximity.offer_alerts(proximity.proximity_traffic_as_coded(d, NOW), NOW)
        return proximity.offer_recipients(d, alerts, NOW)

    from conftest import SF001  # sf0.001 has no crowded group at threshold 2

    r = table_readings(spark, SF001, spread_ts=True).select([f.name for f in READING.fields])
    flush = [{"zone": 1, "ts": 0, "latitude": 40.4195, "longitude": -3.7058, "mac": "late"}]
    _stream_vs_batch(spark, scratch, "s_recipients", r, READING, op, flush)


def test_command_line_batch_writes_last_windows_and_keeps_older_runs(spark, scratch):
    from footfall import cli

    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    p.write.parquet(f"{scratch}/in")
    args = ["instore", "--files", f"{scratch}/in", "--out", f"{scratch}/out", "--batch"]
    first, second = cli.main(args, spark=spark), cli.main(args, spark=spark)
    for index, want in jobs.instore_documents(p).items():
        assert first[index] != second[index]
        for path in (first[index], second[index]):
            _same(spark.read.parquet(path), want)
