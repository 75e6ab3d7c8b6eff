"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing, BPE.

``STAGES`` lists the stages; each takes ``(spark, docs, sf_dir)`` and returns
a DataFrame that the next one reads. All but the last return the columns of
documents. ``run`` applies them to the documents table, writing each stage's
result to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, lines, mixing, near_dedup, toxicity
from footfall.llm.common import documents, staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores below 0.5."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that others keep for it; ``n_chars`` follows the text."""
    own = {c: F.col(f"doc.`{c}`") for c in docs.columns}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("doc.text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return lines.dedup_lines(docs).select(*[column.alias(name) for name, column in own.items()])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, with or without id: shingles of five words, similarity 0.8 or more."""
    return near_dedup.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes; those it takes twice stand twice."""
    return mixing.mixed(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of the text they decode to."""
    coded = bpe.encode_and_decode(docs)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_stage), ("line dedup", line_stage), ("near-dedup", near_stage), ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: The near-dedup signatures and the fitted model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs)
    return docs
