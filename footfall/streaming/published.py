"""Published runs: an index that readers see whole batches of, whatever happens to its writers.

``publisher`` is a ``foreachBatch`` writer. A *run* is a streaming query's
checkpoint: a query that starts with a new checkpoint numbers its batches from 0
again, but as another run, so it writes beside what the old one left and not over
it. Every attempt at a batch writes its documents to a folder of its own,

    index=<name>/data/run=<run>/batch=<n>/attempt=<a>/part-*

and then one commit record (a JSON line, put in place by a rename),

    index=<name>/commits/<run>.<n>.json

that names the attempt. A replayed batch writes another attempt and puts its
record in place of the older one.

``published`` reads an index: it joins the documents with the commit records, so
a write that was killed before its record, and the attempt that a replay
replaced, are not seen. Of documents with one ``doc_id`` the one committed last
counts. The records are one small row per batch; ``compact`` writes what they
show as one batch of a new run and removes the records behind it, then the files
that no record names any more.

No document is dropped: an empty batch commits no files; documents without
``doc_id`` are kept each as it is.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RECORD = "run string, batch long, attempt string, committed_at long"
_PLACE = ("run", "batch", "attempt")


def _index(root: str, index: str) -> str:
    return f"{root.rstrip('/')}/index={index}"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A name for the run of a streaming query: the id that its checkpoint keeps over restarts."""
    (line,) = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").limit(1).collect()
    return "q" + json.loads(line.value)["id"].replace("-", "")


def _commit(spark: SparkSession, root: str, index: str, record: dict) -> None:
    folder = f"{_index(root, index)}/commits"
    fs, path = _files(spark, folder)
    fs.mkdirs(path(folder))
    name = f"{record['run']}.{record['batch']}.json"
    draft, final = path(folder, f"_{name}.{record['attempt']}"), path(folder, name)
    out = fs.create(draft, True)
    out.write(bytearray((json.dumps(record) + "\n").encode()))
    out.close()
    if not fs.rename(draft, final):  # the batch was committed before: the new record takes its place
        fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"cannot commit {final}")


def publish(documents: DataFrame, root: str, index: str, run: str, batch: int = 0) -> None:
    """Write ``documents`` as one batch of ``run`` and commit it."""
    spark = documents.sparkSession
    attempt = f"a{uuid.uuid4().hex}"
    documents.write.parquet(f"{_index(root, index)}/data/run={run}/batch={batch}/attempt={attempt}")
    _commit(spark, root, index, {"run": run, "batch": batch, "attempt": attempt, "committed_at": time.time_ns() // 1000})


def publisher(root: str, index: str, checkpoint: str | None = None, run: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for ``write_documents``; give the query's checkpoint, or the run's name."""
    if (run is None) == (checkpoint is None):
        raise ValueError("give a checkpoint or a run")

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, root, index, run or run_of(batch.sparkSession, checkpoint), batch_id)
    return write


def publish_batch(documents: DataFrame, root: str, index: str) -> str:
    """The documents of a finished input as a run of its own; its name."""
    run = f"b{uuid.uuid4().hex}"
    publish(documents, root, index, run)
    return run


def commits(spark: SparkSession, root: str, index: str) -> DataFrame:
    """``run, batch, attempt, committed_at`` of the batches that readers see."""
    return spark.read.schema(_RECORD).json(f"{_index(root, index)}/commits")


def every_document(spark: SparkSession, root: str, index: str) -> DataFrame:
    """All committed documents with their batch, also those that later ones replace."""
    records = commits(spark, root, index).select(*[F.col(c).alias(f"_{c}") for c in _PLACE], "committed_at")
    # The names of runs and attempts begin with a letter, so that no folder name reads as a number.
    found = spark.read.option("mergeSchema", "true").parquet(f"{_index(root, index)}/data")
    here = (F.col("run") == F.col("_run")) & (F.col("batch") == F.col("_batch")) & (F.col("attempt") == F.col("_attempt"))
    return found.join(records, here).drop(*[f"_{c}" for c in _PLACE])


def published(spark: SparkSession, root: str, index: str) -> DataFrame:
    """The documents of an index: committed batches, the latest of each ``doc_id``."""
    found = every_document(spark, root, index)
    own = [c for c in found.columns if c not in (*_PLACE, "committed_at")]
    latest = F.max_by(F.struct(*own), F.struct("committed_at", "run", "batch")).alias("d")
    keyed = found.where("doc_id is not null").groupBy("doc_id").agg(latest).select("d.*")
    return keyed.unionByName(found.where("doc_id is null").select(*own))


def compact(spark: SparkSession, root: str, index: str) -> None:
    """One batch in place of all committed ones. Not while a query writes to the index."""
    old = [tuple(r) for r in commits(spark, root, index).select("run", "batch").collect()]  # a row per batch
    publish_batch(published(spark, root, index), root, index)
    fs, path = _files(spark, root)
    for run, batch in old:
        fs.delete(path(f"{_index(root, index)}/commits/{run}.{batch}.json"), False)
    for run, batch in old:
        fs.delete(path(f"{_index(root, index)}/data/run={run}/batch={batch}"), True)
