"""Document fingerprints by consistent weighted sampling.

A text's terms are its words ``[^\\x20\\x09-\\x0D]+``; a term that stands n
times weighs 1 + floor(log2 n). For each of ``SAMPLES`` samples, every weighted
term draws r and c from Gamma(2, 1) and b from U(0, 1) by hashing (term,
sample); t = floor(ln(weight) / r + b), and the term with the smallest
a = c * exp(-r * (t - b) - r) wins. Two texts have the same winner (term, t)
with probability equal to the generalised Jaccard similarity of their weights,
so the share of equal samples estimates it.

Each text's words are sorted in place and read as a stream: the last copy of a
word in the sorted array finds its weight by looking 1, 3, 7, ... places back,
so no words are grouped or shuffled. The samples are map-side combined minima;
one row a text leaves a task. A sample is one integer: ln(a) in its high bits,
a hash of (term, t) in its low ones.

Neighbours by doc_id: ids are cut into ranges by their quantiles; each range
also receives the first row of the next one, so the next text is found within
the range and no task sees all rows.

Rows: one result per input row. Null texts are empty; texts without words
share the empty fingerprint, alike to each other (1) and to no other (0).
Rows without doc_id come after all others; rows of equal doc_id follow by
text. A single row's next document is itself. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import staged

SAMPLES = 24
_DOUBLINGS = 30  # an array has fewer than 2**31 words, so no weight is beyond 31


def _uniform(bits: Column, shift: int) -> Column:
    """32 bits of a hash as a number between 0 and 1, both excluded."""
    return (F.shiftright(bits, shift).bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(0.5)) / F.lit(float(1 << 32))


def _sample(j: int) -> Column:
    """The packed draw of one weighted term (columns ``term``, ``ln_weight``) in sample ``j``; null without a term."""
    one = F.xxhash64("term", F.lit(3 * j))
    two = F.xxhash64("term", F.lit(3 * j + 1))
    r = -F.log(_uniform(one, 32) * _uniform(one, 0))
    b = _uniform(F.xxhash64("term", F.lit(3 * j + 2)), 0)
    t = F.floor(F.col("ln_weight") / r + b)
    ln_a = F.log(-F.log(_uniform(two, 32) * _uniform(two, 0))) - r * (t - b + 1)
    return F.shiftleft(((ln_a + 200) * (1 << 30)).cast("bigint"), 24).bitwiseOR(F.xxhash64("term", t).bitwiseAND(F.lit((1 << 24) - 1)))


def weighted_terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, term, ln_weight``: a row per distinct word of ``text``; a row of nulls too where it is empty or has blanks at an end."""
    texts = texts.select(*keys, F.sort_array(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")).alias("words"))
    rows = texts.select(*keys, "words", F.posexplode("words").alias("at", "word"))
    last = ~F.col("word").eqNullSafe(F.get("words", F.col("at") + 1))
    weight = F.lit(_DOUBLINGS + 1)
    for k in range(_DOUBLINGS, 0, -1):
        weight = F.when(~F.col("word").eqNullSafe(F.get("words", F.col("at") - (2**k - 1))), k).otherwise(weight)
    real = F.col("word") != ""
    return rows.where(last).select(*keys, F.when(real, F.xxhash64("word")).alias("term"), F.when(real, F.log(weight.cast("double"))).alias("ln_weight"))


def _code(samples: Column) -> Column:
    """Eight hex digits a sample; the empty fingerprint is all dashes."""
    return F.array_join(F.transform(samples, lambda x: F.when(x.isNull(), "--------").otherwise(
        F.lpad(F.lower(F.hex(F.xxhash64(x).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"))), "")


def _likeness(a: Column, b: Column) -> Column:
    equal = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"].eqNullSafe(x["b"])))
    return equal / F.size(a)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``docs`` columns plus ``samples`` (an array of integers, all null for a text without words)."""
    keys = [c for c in docs.columns if c != "text"]
    terms = weighted_terms(docs, keys)
    return (terms.groupBy(*keys).agg(*[F.min(_sample(j)).alias(f"s{j}") for j in range(samples)])
            .select(*keys, F.array(*[f"s{j}" for j in range(samples)]).alias("samples")))


def neighbours(docs: DataFrame, ranges: int) -> DataFrame:
    """``part, nth, doc_id, text, next_part, next_nth, next_text`` by descending doc_id; after the last, the first."""
    lowest = -(1 << 63)
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(lowest)).alias("id"),
                      F.col("doc_id").isNull().alias("nameless"))
    cuts = own.agg(F.percentile_approx("id", F.array(*[F.lit(k / ranges) for k in range(1, ranges)]), F.lit(10 * ranges))).first()[0] if ranges > 1 else None
    cuts = sorted(set(cuts or ()))
    part = F.size(F.filter(F.array(*[F.lit(c).cast("bigint") for c in cuts]), lambda c: c > F.col("id"))) if cuts else F.lit(0)
    rows = own.withColumn("part", part)
    tie = F.xxhash64("text")
    heads = rows.groupBy("part").agg(F.max_by(F.struct("doc_id", "text", "id", "nameless"), F.struct(~F.col("nameless"), "id", tie, "text")).alias("x"))
    by_part = Window.orderBy("part")  # one row a range
    around = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.coalesce(F.lag("part").over(by_part), F.last("part").over(around)).alias("to"), "x.*", F.col("part").alias("home"))
    every = rows.select("part", "doc_id", "text", "id", "nameless", F.lit(False).alias("extra"), F.col("part").alias("home")).unionByName(
        heads.select(F.col("to").alias("part"), "doc_id", "text", "id", "nameless", F.lit(True).alias("extra"), "home"))
    order = Window.partitionBy("part").orderBy("extra", "nameless", F.desc("id"), F.desc(tie), F.desc("text"))
    return (every.withColumn("nth", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
            .withColumn("next_part", F.lead("home").over(order))
            .withColumn("next_nth", F.when(F.lead("extra").over(order), 1).otherwise(F.col("nth") + 1))
            .where(~F.col("extra")).select("part", "nth", "doc_id", "text", "next_part", "next_nth", "next_text"))


def compared(docs: DataFrame, samples: int = SAMPLES, ranges: int | None = None) -> DataFrame:
    """Every text's fingerprint beside that of its edited text and of the next document.

    The edited text replaces the last third (rounded down) of the code points
    by as many from the start of the next document, or all it has.
    """
    ranges = ranges or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = neighbours(docs, ranges).withColumn("n_chars", F.char_length("text").cast("bigint"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring(F.col("next_text"), F.lit(1), third))
    both = near.select("part", "nth", "doc_id", "n_chars", "next_part", "next_nth", "text", edited.alias("edited"))
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["part", "nth", "doc_id", "n_chars", "next_part", "next_nth", "edited_sha256"]
    each = both.select(*keys, F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("text")),
                                                F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))).alias("x")).select(*keys, "x.*")
    sampled = fingerprints(each, samples)
    paired = staged(sampled.groupBy(*keys).agg(F.max(F.when(~F.col("is_edited"), F.col("samples"))).alias("samples"),
                                               F.max(F.when(F.col("is_edited"), F.col("samples"))).alias("edited_samples")))
    following = paired.select(F.col("part").alias("next_part"), F.col("nth").alias("next_nth"), F.col("samples").alias("next_samples"))
    return (paired.join(following, ["next_part", "next_nth"])
            .select("doc_id", "n_chars", "edited_sha256", _code(F.col("samples")).alias("fingerprint"), _code(F.col("edited_samples")).alias("edited_fingerprint"),
                    _likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
                    _likeness(F.col("samples"), F.col("next_samples")).alias("near_next")))
