"""File sources: batch tables and file streams with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a test-data directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_files(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """Batch read of a directory of files under a fixed schema."""
    return spark.read.schema(schema).format(fmt).load(path)


def stream_files(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of files dropped into ``path`` (never infers a schema)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
