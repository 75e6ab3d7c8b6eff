"""The shared in-store scan against the four operators; published runs under restarts, kills and replays."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF0001, SF001
from footfall import settings as S
from footfall.operators import instore, shared
from footfall.schemas import PURCHASE
from footfall.sources.files import stream_files
from footfall.sources.testdata import table_purchases
from footfall.streaming import jobs, published
from footfall.streaming.sinks import read_documents, write_documents
from test_streaming import NOW, _append, _flush_rows, _run, _same, _write_in_chunks


def _own(p):
    return {"category": instore.category_count(p), "sales": instore.total_sales_as_coded(p),
            "payment": instore.payment_method_count(p), "stock": instore.stock_availability(p)}


def test_each_split_equals_its_own_operator(spark):
    p = table_purchases(spark, SF001)
    odd = spark.createDataFrame([(10**9, None, "POS1", "s", 1, "Men", 1, "Cash", 5, "true", 0), (10**9 + 1, None, "POS9", "s", 1, "Men", 1, "Cash", 5, "true", 0)], PURCHASE)
    null_keys = odd.withColumn("arrival", F.timestamp_seconds(F.lit(1_704_070_000))).withColumn("payment_method", F.lit(None).cast("string"))
    p = p.select([f.name for f in PURCHASE.fields]).unionByName(odd).unionByName(null_keys)
    got = shared.split(shared.instore_facts(p))
    for kind, want in _own(p.where("arrival is not null")).items():
        assert got[kind].columns == want.columns
        a, b = (sorted(map(str, x.collect())) for x in (got[kind], want))
        assert a == b and a


def test_one_scan_and_one_exchange(spark):
    plan = shared.instore_facts(table_purchases(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_windows_must_nest(spark):
    with pytest.raises(ValueError):
        shared.instore_facts(table_purchases(spark, SF0001), NOW.with_(stock_window="25 minutes"))


def test_one_stream_gives_four_indexes(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    _write_in_chunks(p, f"{scratch}/in")
    flush = _flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0})
    _append(flush, f"{scratch}/in")
    stream = stream_files(spark, f"{scratch}/in", PURCHASE, max_files_per_trigger=1)
    queries = _run(jobs.start_instore_shared, stream, f"{scratch}/out", f"{scratch}/ck")
    assert len(queries) == 1
    for index, want in jobs.instore_documents(p, NOW).items():
        _same(read_documents(spark, f"{scratch}/out", index).drop("batch"), want)
    paths = jobs.write_instore_shared(p, f"{scratch}/batch", NOW)
    for index, want in jobs.instore_documents(p, NOW).items():
        _same(spark.read.parquet(paths[index]), want)


def _publish(spark, src, out, ck):
    d = jobs.instore_documents(stream_files(spark, src, PURCHASE, max_files_per_trigger=1), NOW)[S.INDEX_PAYMENT]
    q = write_documents(d, S.INDEX_PAYMENT, checkpoint=ck, writer=published.publisher(out, S.INDEX_PAYMENT, checkpoint=ck), trigger={"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None, q.exception()


def test_published_runs_survive_a_new_checkpoint_a_replay_and_a_killed_write(spark, scratch):
    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    src, out = f"{scratch}/in", f"{scratch}/out"
    _write_in_chunks(p, src, n_files=2)
    _append(_flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0}), src)
    want = jobs.instore_documents(p, NOW)[S.INDEX_PAYMENT]
    _publish(spark, src, out, f"{scratch}/ck1")
    _same(published.published(spark, out, S.INDEX_PAYMENT), want)
    batches = published.commits(spark, out, S.INDEX_PAYMENT).count()

    # A replay: the last batch runs again, its documents do not double.
    commits = sorted(Path(f"{scratch}/ck1/commits").glob("[0-9]*"), key=lambda x: int(x.name))
    os.remove(commits[-1])
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink(missing_ok=True)
    _publish(spark, src, out, f"{scratch}/ck1")
    assert published.commits(spark, out, S.INDEX_PAYMENT).count() == batches
    everything = published.every_document(spark, out, S.INDEX_PAYMENT)
    assert everything.count() == want.count()
    _same(published.published(spark, out, S.INDEX_PAYMENT), want)

    # A new checkpoint at the old root, on other rows: nothing is lost.
    later = p.withColumn("arrival", F.col("arrival") + F.expr("INTERVAL 100 DAYS"))
    _write_in_chunks(later, f"{scratch}/in2", n_files=2)
    _append(_flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0}), f"{scratch}/in2")
    _publish(spark, f"{scratch}/in2", out, f"{scratch}/ck2")
    both = want.unionByName(jobs.instore_documents(later, NOW)[S.INDEX_PAYMENT])
    _same(published.published(spark, out, S.INDEX_PAYMENT), both)
    # The first input once more with a third checkpoint: the same documents, once each.
    _publish(spark, src, out, f"{scratch}/ck3")
    _same(published.published(spark, out, S.INDEX_PAYMENT), both)

    # A write that was killed before its commit record is not seen.
    run = published.publish_batch(want.withColumn("count", F.lit(0).cast("long")), out, S.INDEX_PAYMENT)
    assert published.published(spark, out, S.INDEX_PAYMENT).where("count = 0").count() > 0  # committed: the latest by doc_id
    Path(out, f"index={S.INDEX_PAYMENT}", "commits", f"{run}.0.json").unlink()
    _same(published.published(spark, out, S.INDEX_PAYMENT), both)

    published.compact(spark, out, S.INDEX_PAYMENT)
    assert published.commits(spark, out, S.INDEX_PAYMENT).count() == 1
    _same(published.published(spark, out, S.INDEX_PAYMENT), both)


def test_the_latest_document_of_an_id_counts(spark, scratch):
    for k in range(3):
        published.publish_batch(spark.createDataFrame([("a", k), (None, k), (f"own{k}", k)], "doc_id string, v int"), scratch, "x")
    got = sorted(((r.doc_id, r.v) for r in published.published(spark, scratch, "x").collect()), key=str)
    assert got == sorted([("a", 2), ("own0", 0), ("own1", 1), ("own2", 2), (None, 0), (None, 1), (None, 2)], key=str)


def test_command_line_publishes_from_one_read(spark, scratch):
    from footfall import cli

    p = table_purchases(spark, SF0001).select([f.name for f in PURCHASE.fields])
    _write_in_chunks(p, f"{scratch}/in", n_files=2)
    _append(_flush_rows(spark, PURCHASE, {"pos": "POS1", "product_category": "Men", "ts": 0}), f"{scratch}/in")
    for ck in ("one", "two"):
        args = ["instore", "--files", f"{scratch}/in", "--out", f"{scratch}/out", "--checkpoint", f"{scratch}/{ck}", "--watermark", "0 seconds",
                "--available-now", "--max-files-per-trigger", "1", "--shared", "--publish"]
        assert len(cli.main(args, spark=spark)) == 1
    cli.main(["instore", "--files", f"{scratch}/in", "--out", f"{scratch}/batch", "--batch", "--publish"], spark=spark)
    for index, want in jobs.instore_documents(p, NOW).items():
        _same(published.published(spark, f"{scratch}/out", index), want)
        assert published.published(spark, f"{scratch}/batch", index).count() == want.count() + (index in (S.INDEX_PAYMENT, S.INDEX_STOCK))  # the flush row's windows too
