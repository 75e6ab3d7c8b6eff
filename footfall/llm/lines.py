"""Line dedup: lines that many documents share stay in one document only.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z
lower-cased. A key of ``LEAST`` or more code points in ``MIN_DOCS`` or more
documents loses its lines everywhere but in the largest doc_id that holds it.

Keys are hashed to 128 bits and leave the text behind. The rows (hash, slice,
doc_id, position) are range-partitioned by hash and slice with a secondary sort
by document and position; ``slice`` is one of ``slices`` parts of the
documents (a parameter, thousands on a large cluster), so a line that a third
of all documents hold spreads over as many tasks. A stream over each sorted group marks the first document and how many
there are; the slices' summaries (at most ``slices`` rows a key) decide.
Dropped positions return as sparse bitmaps, 64 lines a word, and are applied
to each text where it stands.

Rows: one result per input row. Null and empty texts have one empty line.
Documents are told apart by doc_id: repeated rows are one document, rows
without doc_id are one document below all others. A row's bitmap belongs to
its doc_id and text. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import staged

LEAST, MIN_DOCS, SLICES = 20, 3, 1024
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def keep_bitmaps(docs: DataFrame, least: int = LEAST, min_docs: int = MIN_DOCS, slices: int = SLICES) -> DataFrame:
    """``id, text_hash, dropped``: a map from word number to 64 flags, for the texts that lose lines."""
    lines = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    trimmed = lines.select("id", "text_hash", "pos", F.btrim("line", F.lit(BLANK)).alias("line")).where(F.char_length("line") >= least)
    keyed = trimmed.select("id", "text_hash", "pos", F.translate("line", UPPER, LOWER).alias("key"))
    # Written once: sampling the range bounds would otherwise split all texts a second time.
    rows = (staged(keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(29), "key").alias("h2"),
                                F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int").alias("slice"), "id", "text_hash", "pos"))
            .repartitionByRange("h1", "h2", "slice").sortWithinPartitions("h1", "h2", "slice", F.desc_nulls_last("id"), "pos"))
    group = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc_nulls_last("id"))
    streamed = (rows.withColumn("nth", F.dense_rank().over(group))
                .groupBy("h1", "h2", "slice").agg(F.max("id").alias("top"), F.max("nth").alias("n")))
    doomed = (streamed.groupBy("h1", "h2").agg(F.max("top").alias("keeper"), F.sum("n").alias("n"), F.collect_set("slice").alias("slices"))
              .where(F.col("n") >= min_docs).select("h1", "h2", F.explode("slices").alias("slice"), "keeper"))
    dropped = rows.join(doomed, ["h1", "h2", "slice"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    words = (dropped.groupBy("id", "text_hash", F.expr("pos div 64").cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    return (words.groupBy("id", "text_hash")
            .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped")))


def dedup_lines(docs: DataFrame, least: int = LEAST, min_docs: int = MIN_DOCS, slices: int = SLICES) -> DataFrame:
    """The columns of ``docs`` (text without its dropped lines) under the struct ``doc``, with ``n_lines`` and ``n_dropped``."""
    maps = (keep_bitmaps(docs, least, min_docs, slices)
            .select(F.struct("id", "text_hash").alias("m_key"), "dropped"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).withColumn("text", F.coalesce("doc.text", F.lit("")))
    joined = own.join(maps, F.col("doc.doc_id").eqNullSafe(F.col("m_key.id")) & (F.xxhash64("doc.text") == F.col("m_key.text_hash")), "left")
    counted = (joined.withColumn("n_lines", F.size(F.split("text", "\n")).cast("bigint"))
               .withColumn("n_dropped", F.expr("coalesce(aggregate(map_values(dropped), 0L, (a, x) -> a + bit_count(x)), 0L)"))
               .withColumn("flags", F.expr("transform(sequence(0, cast((n_lines - 1) div 64 as int)), w -> coalesce(element_at(dropped, w), 0L))")))
    kept = F.expr("""CASE WHEN dropped IS NULL THEN text ELSE
        array_join(filter(split(text, '\n'), (x, i) -> bit_get(get(flags, i div 64), i % 64) = 0), '\n') END""")
    return counted.select(F.col("doc").withField("text", F.when(F.col("doc.text").isNotNull(), kept)).alias("doc"), "n_lines", "n_dropped")
