"""Replay-safe document sinks.

``write_documents`` starts a checkpointed streaming query whose
``foreachBatch`` writes each micro-batch to ``<root>/index=<name>/batch=<id>``
with ``overwrite``: when Spark replays a batch after a failure, it rewrites
the same directory instead of appending duplicates. Every document carries a
stable ``doc_id`` (see ``footfall.plans.documents``), so a search-index
writer given as ``writer`` can upsert by id instead. A query that starts with a
new checkpoint numbers its batches from 0 again and would overwrite the old
ones: ``footfall.streaming.published`` keeps runs apart and commits batches.

Checkpoints go under the session's ``spark.checkpoint.dir`` unless a
location is given; no machine-local folder is assumed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster configuration."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir (a shared folder) or pass a checkpoint location")
    return root.rstrip("/")


def checkpoint_of(spark: SparkSession, root: str | None, name: str, checkpoint: str | None = None) -> str:
    """Where a query keeps its checkpoint. Jobs that write to different roots share no offsets."""
    place = hashlib.sha256((root or "").encode()).hexdigest()[:16]
    return checkpoint or f"{checkpoint_root(spark)}/{place}/{name}"


def batch_path(root: str, index: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/index={index}/batch={batch_id}"


def file_writer(root: str, index: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(batch_path(root, index, batch_id))
    return write


def search_index_writer(index: str, options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Upsert by ``doc_id`` through the Elasticsearch Spark connector (its jar
    must be on the classpath; not part of a plain PySpark install)."""
    opts = {"es.resource": index, "es.mapping.id": "doc_id", "es.write.operation": "upsert"}
    opts.update(options or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("org.elasticsearch.spark.sql").options(**opts).mode("append").save()
    return write


def kafka_writer(topic: str, bootstrap_servers: str,
                 options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Documents back to a Kafka topic: key = ``doc_id``, value = the document
    as JSON (needs the Kafka data source package on the classpath)."""
    from pyspark.sql import functions as F

    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(options or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(F.col("doc_id").cast("string").alias("key"),
                           F.to_json(F.struct(*[F.col(c) for c in batch.columns])).alias("value"))
        out.write.format("kafka").options(**opts).save()
    return write


def write_documents(docs: DataFrame, index: str, root: str | None = None,
                    checkpoint: str | None = None, writer=None,
                    trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Start the sink query for one index.

    ``writer(batch_df, batch_id)`` defaults to idempotent Parquet files under
    ``root``. ``trigger`` is passed to ``DataStreamWriter.trigger``, e.g.
    ``{"availableNow": True}`` for backfills and tests.
    """
    spark = docs.sparkSession
    if writer is None:
        if root is None:
            raise ValueError("give a root folder or a writer")
        writer = file_writer(root, index)
    ck = checkpoint_of(spark, root, query_name or index, checkpoint)
    w = (docs.writeStream.outputMode("append").option("checkpointLocation", ck)
             .foreachBatch(writer))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_batch(docs: DataFrame, index: str, root: str, fmt: str = "parquet") -> str:
    """Write the documents of a finished (batch) input beside the streams'
    batches, in a folder of their own: nothing older is overwritten. Unlike
    a stream, a batch run also writes its last windows."""
    path = f"{root.rstrip('/')}/index={index}/batch=backfill-{uuid.uuid4().hex}"
    docs.write.mode("errorifexists").format(fmt).save(path)
    return path


def read_documents(spark: SparkSession, root: str, index: str, fmt: str = "parquet") -> DataFrame:
    """All documents written for an index (every batch directory)."""
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/index={index}")
