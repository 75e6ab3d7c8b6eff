"""Reading the corpus and cutting lineage with tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors see.

    Where it is unset, a local master gets a folder of its own; a cluster
    without a shared folder is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return sc.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later readers survive a lost executor without recomputing what led here.
    Unlike ``checkpoint()`` this evaluates the plan once and keeps the columns
    prunable. ``compression``: a Parquet codec other than the session's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def unused(table: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores before those that ``table`` has."""
    held = {c.lower() for c in table.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name = f"_{name}"
        out.append(name)
    return out


def discard(table: DataFrame) -> None:
    """Remove the files of a table that ``staged`` returned and that nothing reads any more."""
    jvm = table.sparkSession._jvm
    conf = table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
