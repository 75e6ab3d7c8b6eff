"""Ordered per-key scans that go on from run to run, without reading old rows again.

``keyed_scan`` numbers a table's rows per key in one go. Readings come every
day, and the running state of a key never expires, so a run over today's rows
would have to read all days before it. Here a run leaves a *snapshot*: per (key,
time slice) the number of rows, the first and the last values, and the run that
wrote the slice last. Snapshots of disjoint rows merge by an aggregate.

``resume`` takes new rows and the snapshot so far. It numbers the new rows
within their slices only; what stood before a slice is not in the rows but in
the snapshot. A late row reopens its slice: that slice's stored rows (and no
others) are read, numbered again with the late one and stored under the new run;
the snapshot then points to them, so the old ones are no longer seen. Rows of
later slices stay as they are, though all their counts move on.

``resolve`` puts both together: one join on (key, slice, run) adds the rows
before the slice and the key's first values. Its carry has one row per slice,
however busy the key, and one key's rows are spread over its slices.

``run_on_files`` keeps rows and snapshots in a folder: a run writes its rows, its
snapshot, and a commit record last. Only committed runs are read, so a run that
was killed is as if it had not been; running it again writes it anew.

Rows without a value in the first order column have no place in the order and
are left out; null ids come before all others; null keys are keys. The order
columns must make the order total over all runs. A run without rows changes
nothing.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.functions.ordering import ORDER_COLS
from footfall.operators.scan import scan_key, time_slice
from footfall.settings import DEFAULTS


@dataclass(frozen=True)
class Scan:
    """What a resumable scan keeps: keys, order, and ``{output: column}`` of first and previous values."""

    keys: tuple[str, ...]
    order: tuple[str, ...] = ORDER_COLS
    n: str = "n"
    first: dict = field(default_factory=dict)
    lag: dict = field(default_factory=dict)
    width: str = DEFAULTS.scan_slice

    def sliced(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col(self.order[0]).isNotNull()).withColumn("_slice", time_slice(self.order[0], self.width))

    @property
    def place(self) -> list[str]:
        return [*self.keys, "_slice"]


#: The running visitor count: per zone and sensor, with the sensor's first timestamp.
RUNNING = Scan(("zone", "sensor_uid"), n="visitors", first={"first_ts": "ts"})


def _on(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """A join in which null keys are equal; the right side's own names are lost."""
    right = right.select(*[F.col(c).alias(f"_r_{c}" if c in names else c) for c in right.columns])
    condition = F.lit(True)
    for c in names:
        condition = condition & left[c].eqNullSafe(F.col(f"_r_{c}"))
    joined = left.join(right, condition, how)
    return joined if how == "left_semi" else joined.drop(*[f"_r_{c}" for c in names])


def summaries(rows: DataFrame, scan: Scan, run: int) -> DataFrame:
    """The snapshot of ``rows`` (with ``_slice``) alone."""
    key = scan_key(list(scan.order))
    return rows.groupBy(*scan.place).agg(
        F.lit(run).cast("long").alias("_run"), F.count(F.lit(1)).alias("_count"),
        F.min(key).alias("_low"), F.max(key).alias("_high"),
        *[F.min_by(c, key).alias(f"_first_{c}") for c in dict.fromkeys(scan.first.values())],
        *[F.max_by(c, key).alias(f"_last_{c}") for c in dict.fromkeys(scan.lag.values())])


def merged(a: DataFrame, b: DataFrame, scan: Scan) -> DataFrame:
    """The snapshot of the rows of two disjoint ones together."""
    return a.unionByName(b).groupBy(*scan.place).agg(
        F.max("_run").alias("_run"), F.sum("_count").alias("_count"),
        *[F.min_by(f"_first_{c}", "_low").alias(f"_first_{c}") for c in dict.fromkeys(scan.first.values())],
        *[F.max_by(f"_last_{c}", "_high").alias(f"_last_{c}") for c in dict.fromkeys(scan.lag.values())],
        F.min("_low").alias("_low"), F.max("_high").alias("_high"))


def resume(new: DataFrame, scan: Scan, run: int, rows: DataFrame | None = None,
           snapshot: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, snapshot)`` after ``run``: the rows that this run writes, and the snapshot of all runs.

    ``rows`` and ``snapshot``: those of all runs before (None: there are none).
    ``run`` must grow from run to run.
    """
    fresh = scan.sliced(new)
    own = summaries(fresh, scan, run)
    if snapshot is None:
        every, after = fresh, own
    else:
        reopened = _on(snapshot, own.select(*scan.place), scan.place, "left_semi").select(*scan.place, "_run")
        stored = _on(rows, reopened, [*scan.place, "_run"], "left_semi").select(*fresh.columns)
        every, after = fresh.unionByName(stored), merged(snapshot, own, scan)
    inside = Window.partitionBy(*scan.place).orderBy(*scan.order)
    written = every.select(
        *fresh.columns, F.lit(run).cast("long").alias("_run"), F.row_number().over(inside).alias("_nth"),
        *[F.lag(c).over(inside).alias(f"_lag_{name}") for name, c in scan.lag.items()])
    return written, after


def resolve(rows: DataFrame, snapshot: DataFrame, scan: Scan) -> DataFrame:
    """Every row of all runs with its position in its key, the key's first values and the previous row's."""
    order = Window.partitionBy(*scan.keys).orderBy("_slice")
    before = F.coalesce(F.sum("_count").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = snapshot.select(
        *scan.place, "_run", before.alias("_before"),
        *[F.first(f"_first_{c}").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_out_{name}") for name, c in scan.first.items()],
        *[F.lag(f"_last_{c}").over(order).alias(f"_prev_{name}") for name, c in scan.lag.items()])
    met = _on(rows, carry, [*scan.place, "_run"], "inner")
    own = [c for c in rows.columns if c not in ("_slice", "_run", "_nth") and not c.startswith("_lag_")]
    previous: dict[str, Column] = {name: F.when(F.col("_nth") == 1, F.col(f"_prev_{name}")).otherwise(F.col(f"_lag_{name}")) for name in scan.lag}
    return met.select(*own, (F.col("_before") + F.col("_nth")).alias(scan.n), *[F.col(f"_out_{name}").alias(name) for name in scan.first],
                      *[value.alias(name) for name, value in previous.items()])


def _commits(spark: SparkSession, root: str):
    """The folder of commit records, its file system, and Hadoop's path class."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{root.rstrip('/')}/commits")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration()), path


def committed_runs(spark: SparkSession, root: str) -> list[int]:
    folder, fs, _ = _commits(spark, root)
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()) if fs.exists(folder) else []


def stored(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame] | None:
    """``(rows, snapshot)`` of the committed runs; None if there is none."""
    runs = committed_runs(spark, root)
    if not runs:
        return None
    rows = spark.read.parquet(*[f"{root.rstrip('/')}/rows/{r}" for r in runs])
    return rows, spark.read.parquet(f"{root.rstrip('/')}/snapshots/{runs[-1]}")


def run_on_files(new: DataFrame, root: str, scan: Scan, run: int) -> None:
    """One run over ``new`` rows, on the rows and snapshots under ``root``. A committed run is not run again."""
    spark = new.sparkSession
    runs = committed_runs(spark, root)
    if run in runs:
        return
    if runs and run < runs[-1]:
        raise ValueError(f"run {run} is older than run {runs[-1]}, which is committed")
    rows, snapshot = stored(spark, root) or (None, None)
    written, after = resume(new, scan, run, rows, snapshot)
    written.write.mode("overwrite").parquet(f"{root.rstrip('/')}/rows/{run}")
    after.write.mode("overwrite").parquet(f"{root.rstrip('/')}/snapshots/{run}")
    folder, fs, path = _commits(spark, root)
    fs.mkdirs(folder)
    draft = path(folder, f"{run}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"run": run}).encode()))
    out.close()
    fs.rename(draft, path(folder, str(run)))
