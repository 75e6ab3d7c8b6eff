"""Mixing sources to target weights by hash-threshold histograms.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating; they
share ``share`` times all words. A target stops at ``most`` times its source's
words, and the excess goes to the others by weight until none is above.

Choice: a source whose target is below its words takes documents by a hash of
doc_id; one whose target is above takes every document once and documents by
the same hash a second time. The hash threshold that meets a source's budget
comes from histograms: words are summed by source and the hash's top 12 bits,
a running sum finds the bucket where the budget is spent, and only that
boundary bucket is split by the next 12 bits, five times. Thresholds for
smaller budgets are lower, so mixes are nested. Nothing is sorted but
histograms (at most 4096 rows a source); documents are then filtered by
comparing their hash with their source's threshold.

Rows: one result per input row. Null texts have size 0; a null source is a
source of its own. Documents with equal doc_id share a hash and are taken
together (a null doc_id hashes like an empty one). With no words at all every
target is 0. Extra columns are ignored; only doc_id, source and text are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import staged, unused

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
_BITS, _LEVELS = 12, 5


def n_words(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, sid, source_size, target`` from one row ``(source, source_size)`` per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    named = (sizes.withColumn("sid", F.row_number().over(by_name).cast("bigint"))
             .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int")))
             .withColumn("most", F.col("source_size") * F.lit(most)))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    # If the sources before this one stop at their most, the rest get ``level`` per unit of weight.
    level = ((share * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    leveled = named.withColumn("level", level)
    first = F.min(F.when(F.col("most") / F.col("weight") >= F.col("level"), F.struct(F.col("most") / F.col("weight"), "sid", "level"))).over(whole)
    return (leveled.withColumn("final", first["level"])
            .select("source", "sid", "source_size",
                    F.least(F.col("most").cast("double"), F.coalesce(F.col("weight") * F.col("final"), F.col("most").cast("double"))).alias("target")))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``sid, threshold, rest, last`` for ``rows(sid, hash, size)`` and ``budgets(sid, budget)``.

    Hashes below the threshold fit the budget, ``rest`` of it stays, and
    documents of hash ``threshold`` itself hold ``last`` words. Where all
    documents fit, the threshold is beyond every hash.
    """
    beyond = 1 << (_BITS * _LEVELS)
    state = budgets.select("sid", F.col("budget").alias("rest"), F.lit(0).cast("bigint").alias("prefix"))
    closed = None
    for level in range(_LEVELS):
        shift = _BITS * (_LEVELS - 1 - level)
        bucket = F.shiftright("hash", shift)
        inside = rows if level == 0 else rows.join(
            state.select("sid", F.col("prefix").alias("own")), "sid").where(F.shiftright("hash", shift + _BITS) == F.col("own"))
        sums = inside.groupBy("sid", bucket.alias("bucket")).agg(F.sum("size").alias("words")).where("words > 0")
        running = Window.partitionBy("sid").orderBy("bucket")
        found = (sums.join(state.select("sid", "rest"), "sid").withColumn("upto", F.sum("words").over(running))
                 .where("upto > rest").groupBy("sid").agg(F.min(F.struct("bucket", "upto", "words", "rest")).alias("x"))
                 .select("sid", F.col("x.bucket").alias("prefix"), (F.col("x.rest") - F.col("x.upto") + F.col("x.words")).alias("rest"),
                         F.col("x.words").alias("last")))
        if level == 0:
            found = staged(found)
            closed = budgets.join(found, "sid", "left_anti").select("sid", F.lit(beyond).alias("threshold"), F.lit(0.0).alias("rest"), F.lit(0).cast("bigint").alias("last"))
        state = found
    return state.select("sid", F.col("prefix").alias("threshold"), "rest", "last").unionByName(closed)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``doc_id, size, source, source_size, target, copies, taken`` for every row of ``docs``."""
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("bigint")
    rows = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), hashed.alias("hash")))
    sources = staged(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most))
    rows = (rows.withColumnRenamed("source", "of").join(sources, F.col("of").eqNullSafe(F.col("source")))
            .select("doc_id", "source", "size", "hash", "sid", "source_size", "target"))
    base = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    budgets = sources.select("sid", (F.col("target") - base * F.col("source_size")).alias("budget"))
    limits = staged(thresholds(rows.select("sid", "hash", "size"), budgets))
    extra = (F.col("hash") < F.col("threshold")) | ((F.col("hash") == F.col("threshold")) & (2 * F.col("rest") >= F.col("last")))
    return (rows.join(limits, "sid").withColumn("copies", base + F.when(extra, 1).otherwise(0))
            .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` that the mix takes, in its own columns; those taken twice stand twice."""
    of, source, copies, nth = unused(docs, "m_id", "m_source", "copies", "m_copy")
    taken = (mix(docs, weights, share, most).where("copies > 0")
             .select(F.col("doc_id").alias(of), F.col("source").alias(source), F.col("copies").alias(copies)).distinct())
    chosen = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(of)) & F.col("source").eqNullSafe(F.col(source)))
    return chosen.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
