"""Quality rules: counts per document and a target-against-raw likelihood ratio.

Words are ``[^\\x20\\x09-\\x0D]+``. Unigrams and bigrams of words are hashed
into ``BUCKETS`` buckets. The raw multinomial counts every document; the
target multinomial counts the trusted ones: all documents labelled good. A
document's score is the mean log ratio of its n-grams' smoothed probabilities,
so length does not enter. The threshold is the ``QUANTILE`` of the trusted
documents' own scores, less ``MARGIN`` times its distance to their median
(other documents score a little lower): deterministic, and the same for every
document.

The texts are read twice. The first pass shuffles them by id, where they meet
the trusted ids (however many; none are sent to every task), and counts; counts
come back as one row per bucket and task. The weights (``BUCKETS`` numbers) go out
with the second pass, whose results are staged; the threshold is found from
histograms of the staged scores.

Rows: one result per input row. Null, empty and blank texts have no words, all
counts 0, score 0, fail the base rules and are not kept. Repeated rows repeat
(and count as often as they stand). Without trusted documents every weight is
0 and only the base rules decide. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged
from footfall.llm.textkit import Block, RollingHash, U, Words, blocks, grams, mix64, words

BUCKETS = 1 << 14
QUANTILE = 0.002
MARGIN = 0.5
SHRINK = 4.0  # n-grams that every mean is padded with, at weight 0
_HASH = RollingHash(31)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def _ngrams(block: Block, w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text of each."""
    of = np.repeat(np.arange(len(w.count)), w.count)
    pairs = grams(hashes, 2)
    inside = of[1:] == of[:-1]
    every = np.concatenate([mix64(hashes + U(1)), mix64(pairs[inside] + U(2))])
    return (every % U(BUCKETS)).astype(np.int64), np.concatenate([of, of[1:][inside]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        trusted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for block in blocks(batch.column(0)):
            w = words(block)
            bucket, of = _ngrams(block, w, RollingHash.ranges(_HASH.prefix(block.data), w.start, w.end))
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[trusted[block.lo:block.hi][of]], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])


def _marked(block: Block, w: Words, hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Per text: words in windows of ``size`` words found twice or more."""
    out = np.zeros(len(w.count), dtype=np.int64)
    windows = grams(hashes, size)
    for k in np.flatnonzero(w.count > size).tolist():
        own = windows[w.first[k]:w.first[k] + w.count[k] - size + 1]
        order = np.argsort(own)
        ordered = own[order]
        same = ordered[1:] == ordered[:-1]
        if same.any():
            twice = np.zeros(len(own) + size, dtype=np.int64)
            at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
            twice[at] += 1
            np.add.at(twice, at + size, -1)
            out[k] = np.count_nonzero(np.cumsum(twice)[:w.count[k]] > 0)
    return out


def _repeated_lines(texts: pa.Array) -> list[int]:
    out = []
    for text in texts.to_pylist():
        lines = (text or "").split("\n")
        if len(lines) > 1:
            lines = [x for x in lines if x.strip(" \t\n\x0b\x0c\r")]
            out.append(len(lines) - len(set(lines)))
        else:
            out.append(0)
    return out


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _score(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                n = block.hi - block.lo
                w = words(block)
                hashes = RollingHash.ranges(_HASH.prefix(block.data), w.start, w.end)
                bucket, of = _ngrams(block, w, hashes)
                total = np.bincount(of, weights=weights[bucket], minlength=n)
                sums = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
                chars = np.bincount(np.repeat(np.arange(n), w.count), weights=sums[w.end] - sums[w.start], minlength=n)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.lo, n), pa.array(w.count.astype(np.int64)), pa.array(chars.astype(np.int64)),
                    pa.array(_per_text(_SYMBOLS[block.data], block.offsets)),
                    pa.array(_repeated_lines(batch.column(1).slice(block.lo, n)), pa.int64()),
                    pa.array(_marked(block, w, hashes)), pa.array(total / (np.bincount(of, minlength=n) + SHRINK)),
                ], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])
    return run


_FIELDS = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, score double")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all labelled-good documents, each once."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def fit(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log ratio of the target's and the raw corpus's smoothed probability, per bucket."""
    marked = docs.select("doc_id", "text").join(trusted.withColumn("good", F.lit(True)).hint("shuffle_hash"), "doc_id", "left")
    rows = (marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
            .mapInArrow(_count, "bucket bigint, raw bigint, target bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())  # BUCKETS rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.any():
        return np.zeros(BUCKETS)
    # The prior is the raw distribution, so an n-gram the target lacks is unlikely but not impossible.
    share, prior = np.maximum(raw, 1) / raw.sum(), 0.5 * BUCKETS
    weights = np.log((target + prior * share) / (target.sum() + prior)) - np.log(share)
    return np.where(raw > 0, weights, 0.0)


def quantiles(scores: DataFrame, shares: tuple[float, ...]) -> list[float]:
    """Of the column ``score`` as ``percentile`` gives them, but for 2**-26; none without rows.

    A histogram of steps of 2**-10 finds the steps that hold the wanted ranks,
    one of steps of 2**-26 in these the values: no task sees all scores.
    """
    def steps(rows: DataFrame, power: int) -> list:
        step = F.floor(F.col("score") * 2.0**power)
        return sorted(rows.groupBy(step.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).collect(), key=lambda r: r["at"])

    coarse = steps(scores, 10)
    ends = np.cumsum([r.n for r in coarse])
    if not len(ends):
        return []
    places = [share * float(ends[-1] - 1) for share in shares]
    ranks = sorted({int(f(p)) for p in places for f in (np.floor, np.ceil)})
    wanted = sorted({int(np.searchsorted(ends, r, side="right")) for r in ranks})
    fine = steps(scores.where(F.floor(F.col("score") * 2.0**10).isin([coarse[k]["at"] for k in wanted])), 26)
    value = {}
    for k in wanted:
        own = [r for r in fine if r["at"] >> 16 == coarse[k]["at"]]
        upto = ends[k] - coarse[k].n + np.cumsum([r.n for r in own])
        value |= {r: own[int(np.searchsorted(upto, r, side="right"))].low for r in ranks if ends[k] - coarse[k].n <= r < ends[k]}
    return [value[int(np.floor(p))] + (p - np.floor(p)) * (value[int(np.ceil(p))] - value[int(np.floor(p))]) for p in places]


def rate(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Counts, ``score``, ``threshold``, ``base_failed`` and ``kept`` for every row of ``docs``."""
    trusted = trusted_ids(labels)
    pairs = docs.select(F.col("doc_id").cast("bigint"), "text")
    scored = staged(pairs.mapInArrow(_score(fit(docs, trusted)), _FIELDS))
    own = staged(scored.select("doc_id", "score").join(trusted.hint("shuffle_hash"), "doc_id", "left_semi").select("score"))
    found = quantiles(own, (quantile, 0.5))
    threshold = found[0] - MARGIN * (found[1] - found[0]) if found else 0.0
    base = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    return (scored.withColumn("threshold", F.lit(threshold)).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))))
