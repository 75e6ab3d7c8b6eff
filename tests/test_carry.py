"""Runs one by one against one scan over all rows: late rows, null keys, killed runs."""

import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from footfall.operators import carry as C
from footfall.operators.foot_traffic import running_visitors
from footfall.operators.scan import keyed_scan, time_slice
from footfall.sources.testdata import table_readings


def _table(rows):
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("late,runs", [(0.0, 1), (0.0, 4), (0.3, 4), (1.0, 3)])
def test_runs_equal_one_scan(spark, late, runs):
    rnd = random.Random(int(late * 10) + runs)
    rows = []
    for i in range(400):
        minute = rnd.randint(0, 300)
        run = rnd.randrange(runs) if rnd.random() < late else minute * runs // 301
        rows.append((i if rnd.random() < 0.99 else None, rnd.choice(["hot", "hot", "a", None]), minute, rnd.choice([None, 1.5, 2.5]), run))
    rows += [(1000 + k, "a", None, 9.0, 0) for k in range(3)]
    df = (spark.createDataFrame(rows, "id long, k string, minute int, v double, run int").dropDuplicates(["id"])
          .withColumn("arrival", F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("minute"))))
    scan = C.Scan(("k",), n="n", first={"fv": "v"}, lag={"pv": "v"})
    written, snapshot = None, None
    for run in range(runs):
        own, snapshot = C.resume(df.where(F.col("run") == run), scan, run, written, snapshot)
        written = own if written is None else written.unionByName(own)
    got = C.resolve(written, snapshot, scan)
    want = keyed_scan(df, ["k"], ["arrival", "id"], n="n", first={"fv": "v"}, lag={"pv": "v"}, slices=time_slice("arrival", "1 hour"))
    assert _table(got.select(want.columns)) == _table(want) and want.count() > 300


def test_a_run_reads_only_its_rows_and_the_slices_it_reopens(spark, scratch):
    """The files of earlier runs hold all rows; a late row rewrites its slice and nothing else."""
    r = table_readings(spark, SF0001).where("zone < 4").select("id", "arrival", "zone", "sensor_uid", "ts")
    days = [("2024-01-11", "2000-01-01"), ("2024-01-21", "2024-01-11"), ("2030-01-01", "2024-01-21")]
    late = F.col("id") % 13 == 0
    parts = [r.where((F.col("arrival") < end) & (F.col("arrival") >= begin) & ~late) for end, begin in days]
    parts[2] = parts[2].unionByName(r.where(late))
    scan = replace(C.RUNNING, width="1 day")
    for run, part in enumerate(parts):
        C.run_on_files(part, scratch, scan, run)
        rows = spark.read.parquet(f"{scratch}/rows/{run}")
        if run < 2:  # nothing is late yet
            assert rows.count() == part.count()
    slices = parts[2].select("zone", "sensor_uid", time_slice("arrival", "1 day").alias("s")).distinct()
    everything = r.select("zone", "sensor_uid", time_slice("arrival", "1 day").alias("s"))
    assert rows.count() == everything.join(slices, ["zone", "sensor_uid", "s"]).count() < r.count()
    written, snapshot = C.stored(spark, scratch)
    assert written.count() > r.count()  # reopened rows stand twice in the files, once in the result
    got = C.resolve(written, snapshot, scan)
    want = running_visitors(r)
    assert _table(got.select(want.columns)) == _table(want)


def test_killed_run_is_invisible_and_can_be_run_again(spark, scratch):
    r = table_readings(spark, SF0001).where("zone < 4").select("id", "arrival", "zone", "sensor_uid", "ts")
    first, second = r.where("arrival < '2024-01-15'"), r.where("arrival >= '2024-01-15'")
    assert C.stored(spark, scratch) is None
    C.run_on_files(first, scratch, C.RUNNING, 1)
    C.run_on_files(second, scratch, C.RUNNING, 2)
    commit = Path(scratch, "commits", "2")
    commit.unlink()  # as if the run had been killed before its commit
    got = C.resolve(*C.stored(spark, scratch), C.RUNNING)
    assert _table(got.select("id", "visitors")) == _table(running_visitors(first).select("id", "visitors"))
    C.run_on_files(second, scratch, C.RUNNING, 2)
    C.run_on_files(second, scratch, C.RUNNING, 2)
    got = C.resolve(*C.stored(spark, scratch), C.RUNNING)
    want = running_visitors(r)
    assert _table(got.select(want.columns)) == _table(want)
    with pytest.raises(ValueError):
        C.run_on_files(second, scratch, C.RUNNING, 0)
    C.run_on_files(second.where("false"), scratch, C.RUNNING, 3)
    assert C.resolve(*C.stored(spark, scratch), C.RUNNING).count() == r.count()
