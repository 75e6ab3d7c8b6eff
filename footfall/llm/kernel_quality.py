"""Quality classifier: a Gaussian kernel over document statistics, by random Fourier features.

Every whole text becomes ``STATS`` numbers (lengths, shares of kinds of
characters and words, repetition, entropy). They are standardised by the mean
and deviation over all documents and mapped to ``FEATURES`` random Fourier
features, cosines whose products approximate a Gaussian kernel. Ridge scores
come from normal equations, sums over labelled documents, kept apart by
``FOLDS``: taking a fold's sums away gives the model that never saw it. Those
models score their own fold, and isotonic regression of the labels on these
scores calibrates the final model's. Between the middles of neighbouring steps
the calibrated score runs in a straight line, so it also ranks within a step.

How the work is spread: texts are read once; 2 bytes a statistic go to the
shared folder. Labels meet the statistics, not the texts, by ``doc_id``. Tasks
add up their own products and send one row per cell; the driver gets the sums
(``FOLDS`` x ``FEATURES`` squared), the moments and one row per bin of
out-of-fold scores, none of which grows with the input. All sums are over
integers (statistics and cosines are rounded first), so no result hangs on the
order or number of tasks.

Rows: one result per input row; equal texts get equal scores. Null and empty
texts have statistics of zero and are scored like others. Labels are read from
rows with a ``doc_id`` and a ``quality``; an id with both labels has none; a
document that stands twice counts twice. Without any label, or without
documents, scores are 0.5. Only ``doc_id`` and ``text`` are read. A task holds
one block of texts (or one longer text) and some tens of bytes for each of its
bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged
from footfall.llm.textkit import LOWER, Block, RollingHash, U, blocks, grams, mix64, words

FEATURES = 192
FOLDS = 3
SPREAD = 1.0  # kernel width, in units of the square root of the number of statistics
RIDGE = 1e-3  # added to the diagonal, as a share of the documents fitted
BINS = 4096  # bins of out-of-fold scores between -1 and 2
PRIOR = 1.0  # documents of the average label that every step of the calibration is padded with
CLIP = 6.0  # standardised statistics end here
_UNIT = 256  # statistics are kept as multiples of 1/256
_COSINE = 1 << 14
_HASH = RollingHash(47)

_KINDS = ("lower", "upper", "digit", "space", "newline", "mark", "symbol", "ascii", "lead", "tail")


def _classes() -> np.ndarray:
    kind = np.full(256, _KINDS.index("ascii"))
    kind[ord("a"):ord("z") + 1] = _KINDS.index("lower")
    kind[ord("A"):ord("Z") + 1] = _KINDS.index("upper")
    kind[ord("0"):ord("9") + 1] = _KINDS.index("digit")
    kind[[9, 11, 12, 13, 32]] = _KINDS.index("space")
    kind[10] = _KINDS.index("newline")
    kind[list(b".,;:!?")] = _KINDS.index("mark")
    kind[list(b"#*$%&|<>")] = _KINDS.index("symbol")
    kind[0xC0:] = _KINDS.index("lead")
    kind[0x80:0xC0] = _KINDS.index("tail")
    return kind


_CLASS = _classes()
STATS = (
    "log_bytes", "log_words", *(f"{k}_share" for k in _KINDS[:-1]), "word_length", "word_deviation", "long_words", "letters_alone",
    "capital_words", "symbol_words", "marked_words", "distinct_words", "top_word", "same_as_before", "repeated_grams", "repeated_lines",
    "line_length", "byte_entropy", "word_entropy",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _runs(of: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every distinct hash of a text: the text, and how often it stands there."""
    key = mix64(hashes ^ (of.astype(U) * U(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    ordered = key[order]
    new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])
    return of[order[new]], np.diff(np.append(new, len(ordered)))


def _entropy(of: np.ndarray, counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    p = counts / np.maximum(total, 1)[of]
    return np.bincount(of, weights=-p * np.log2(p), minlength=len(total))


def _histograms(block: Block, piece: int = 1 << 20) -> np.ndarray:
    """How often every byte stands in every text, counted piece by piece."""
    n = block.hi - block.lo
    out = np.zeros(n * 256, dtype=np.int64)
    for at in range(0, len(block.data), piece):
        own = block.data[at:at + piece]
        lo, hi = np.searchsorted(block.offsets, [at, at + len(own) - 1], side="right") - 1
        inner = np.clip(block.offsets[lo:hi + 2], at, at + len(own))
        of = np.repeat(np.arange(hi - lo + 1), np.diff(inner))
        out[lo * 256:(hi + 1) * 256] += np.bincount(of * 256 + own, minlength=(hi - lo + 1) * 256)
    return out.reshape(n, 256)


def statistics(block: Block) -> np.ndarray:
    """The ``STATS`` of every text of a block, as integers."""
    n, data = block.hi - block.lo, block.data
    size = np.diff(block.offsets)
    per_byte = _histograms(block)
    kinds = np.zeros((n, len(_KINDS)), dtype=np.int64)
    np.add.at(kinds.T, _CLASS, per_byte.T)
    chars = size - kinds[:, _KINDS.index("tail")]
    per = lambda of, w=None: np.bincount(of, weights=w, minlength=n)

    w = words(block)
    of, m = np.repeat(np.arange(n), w.count), w.count
    ahead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    length = ahead[w.end] - ahead[w.start]
    mean = _share(per(of, length), m)
    hashes = RollingHash.ranges(_HASH.prefix(LOWER[data]), w.start, w.end)
    first, last = data[w.start] if len(of) else data[:0], data[w.end - 1] if len(of) else data[:0]
    symbols = np.concatenate([[0], np.cumsum(_CLASS[data] == _KINDS.index("symbol"))])
    distinct_of, often = _runs(of, hashes)
    top = np.zeros(n, dtype=np.int64)
    np.maximum.at(top, distinct_of, often)
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1]))[:len(of)]

    five = grams(hashes, 5)
    inside = of[:len(five)] == of[4:] if len(five) else np.zeros(0, dtype=bool)
    gram_of, gram_often = _runs(of[:len(five)][inside], five[inside])
    repeated = per(gram_of, np.where(gram_often > 1, gram_often, 0))

    newline = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([block.offsets[:-1][size > 0], newline + 1]))
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    line_of = np.searchsorted(block.offsets, starts, side="right") - 1
    full = ends - starts > 1
    same_of, same = _runs(line_of[full], RollingHash.ranges(_HASH.prefix(data), starts[full], ends[full]))
    lines = per(line_of[full])

    pairs = per_byte.reshape(-1)
    held = np.flatnonzero(pairs)
    columns = [
        np.log1p(size), np.log1p(m), *(8 * _share(kinds[:, k], chars) for k in range(len(_KINDS) - 1)),
        np.log1p(mean), np.log1p(np.sqrt(np.maximum(_share(per(of, length * length), m) - mean * mean, 0))),
        8 * _share(per(of, length > 15), m), 8 * _share(per(of, length == 1), m),
        8 * _share(per(of, _CLASS[first] == _KINDS.index("upper")), m), 8 * _share(per(of, symbols[w.end] > symbols[w.start]), m),
        8 * _share(per(of, _CLASS[last] == _KINDS.index("mark")), m),
        8 * _share(per(distinct_of), m), 8 * _share(top, m), 8 * _share(per(of, again), m), 8 * _share(repeated, per(gram_of, gram_often)),
        8 * _share(lines - per(same_of), lines), np.log1p(_share(size, lines)), _entropy(held // 256, pairs[held], size), _entropy(distinct_of, often, m),
    ]
    return np.round(np.column_stack(columns) * _UNIT).astype(np.int16)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = 2 * len(STATS)
    for batch in batches:
        for block in blocks(batch.column(1)):
            rows = np.ascontiguousarray(statistics(block))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.lo, block.hi - block.lo),
                 pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())],
                names=["doc_id", "stats"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int16).reshape(len(column), len(STATS)).astype(np.int64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, one, two = 0, np.zeros(len(STATS), dtype=np.int64), np.zeros(len(STATS), dtype=np.int64)
    for batch in batches:
        x = _matrix(batch.column(0))
        n, one, two = n + len(x), one + x.sum(axis=0), two + (x * x).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(STATS))), pa.array(np.full(len(STATS), n)), pa.array(one), pa.array(two)],
                                     names=["stat", "n", "one", "two"])


@dataclass
class Model:
    """Standardisation, random directions, weights (one column per fold, then the final one), and calibration."""

    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    at: np.ndarray | None = None  # ridge scores, rising
    value: np.ndarray | None = None  # calibrated scores there

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Integer cosines, with a last column of ones (in the same unit)."""
        z = np.clip((stats - self.mean) / self.deviation, -CLIP, CLIP)
        cosines = np.round(np.cos(z @ self.directions + self.phases) * _COSINE)
        return np.column_stack([cosines, np.full(len(z), float(_COSINE))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        """Scores of all folds' models and the final one, rounded to a millionth."""
        return np.round(self.features(stats) @ self.weights / _COSINE, 6)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        return np.interp(self.ridge(stats)[:, -1], self.at, self.value)


def _blank(described: DataFrame, seed: int) -> Model:
    rows = (described.select("stats").mapInArrow(_moments, "stat bigint, n bigint, one bigint, two bigint")
            .groupBy("stat").agg(*(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "one", "two"))).collect())  # a row per statistic
    n, one, two = (np.array([float(x) for _, x in sorted((r.stat, r[c]) for r in rows)] or [0.0] * len(STATS)) for c in ("n", "one", "two"))
    mean = one / np.maximum(n, 1)
    deviation = np.sqrt(np.maximum(two / np.maximum(n, 1) - mean * mean, 0))
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((len(STATS), FEATURES)) / (SPREAD * np.sqrt(len(STATS)))
    return Model(mean, np.maximum(deviation, _UNIT / 64), directions, rng.uniform(0, 2 * np.pi, FEATURES))


def _products(model: Model) -> Callable:
    """Upper triangle of the products of features and label, added up by fold."""
    size = FEATURES + 2
    cells = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, size, size), dtype=np.int64)
        for batch in batches:
            x = np.column_stack([model.features(_matrix(batch.column(0))), batch.column(1).to_numpy() * float(_COSINE)])
            fold = batch.column(2).to_numpy()
            for f in range(FOLDS):
                own = x[fold == f]
                sums[f] += (own.T @ own).astype(np.int64)  # whole numbers below 2**53: exact
        used = [f for f in range(FOLDS) if sums[f][-2, -2]]
        places = np.arange(len(cells[0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([places + f * len(places) for f in used] or [places[:0]])),
             pa.array(np.concatenate([sums[f][cells] for f in used] or [places[:0]]))], names=["cell", "total"])
    return run


def _solved(total: np.ndarray) -> np.ndarray | None:
    """Ridge weights from a matrix of summed products whose last row holds the labels."""
    n = total[-2, -2]
    if not n:
        return None
    left = total[:-1, :-1] + RIDGE * n * np.diag([1.0] * FEATURES + [0.0])
    return np.linalg.solve(left, total[:-1, -1])


def isotonic(at: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps that fit the shares ``good / n`` best (pool adjacent violators): their middles and values.

    Steps are padded with ``PRIOR`` documents of the average share after pooling, and pooled once more.
    """
    share = good.sum() / n.sum()
    for pad in (0.0, PRIOR):
        steps: list[list[float]] = []  # weighted place, documents, good ones with padding, weight with padding
        for a, k, g in zip(at, n, good, strict=True):
            steps.append([a * k, k, g + pad * share, k + pad])
            while len(steps) > 1 and steps[-2][2] * steps[-1][3] >= steps[-1][2] * steps[-2][3]:
                top = steps.pop()
                steps[-1] = [x + y for x, y in zip(steps[-1], top, strict=True)]
        at, n, good = (np.array(x) for x in ([s[0] / s[1] for s in steps], [s[1] for s in steps], [s[2] - (s[3] - s[1]) * share for s in steps]))
    return at, np.array([s[2] / s[3] for s in steps])


def held_out(doc_id: Column) -> Column:
    """The documents whose labels nothing is learnt from; a null id is not among them and has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every row, written to the shared folder."""
    return staged(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_describe, "doc_id bigint, stats binary"))


def fit(described: DataFrame, labels: DataFrame, seed: int = 11) -> Model:
    """The model from all labels that are not held out."""
    model = _blank(described, seed)
    known = (labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
             .where("quality = most").drop("most"))
    labelled = (described.join(known, "doc_id")
                .select("stats", (F.col("quality") > 0).cast("double").alias("good"), F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")))
    sums = labelled.mapInArrow(_products(model), "cell bigint, total bigint").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    size = FEATURES + 2
    cells = np.triu_indices(size)
    flat = np.zeros(FOLDS * len(cells[0]))
    for r in sums.collect():  # FOLDS triangles at most
        flat[r.cell] = float(r.total) / _COSINE**2
    each = np.zeros((FOLDS, size, size))
    for f in range(FOLDS):
        each[f][cells] = flat[f * len(cells[0]):(f + 1) * len(cells[0])]
        each[f] += np.triu(each[f], 1).T
    whole = _solved(each.sum(axis=0))
    if whole is None:
        return model
    without = [_solved(each.sum(axis=0) - each[f]) for f in range(FOLDS)]
    model.weights = np.column_stack([*(whole if x is None else x for x in without), whole])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros(BINS, dtype=np.int64), np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            stats, label, fold = _matrix(batch.column(0)), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            own = model.ridge(stats)[np.arange(len(stats)), fold]
            bin_ = np.clip(np.floor((own + 1) / 3 * BINS), 0, BINS - 1).astype(np.int64)
            n += np.bincount(bin_, minlength=BINS)
            good += np.bincount(bin_, weights=label, minlength=BINS).astype(np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(good[at])], names=["bin", "n", "good"])

    bins = sorted(tuple(r) for r in labelled.mapInArrow(binned, "bin bigint, n bigint, good bigint")
                  .groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect())  # BINS rows at most
    at, n, good = (np.array(c, dtype=float) for c in zip(*bins, strict=True))
    model.at, model.value = isotonic((at + 0.5) * 3 / BINS - 1, n, good)
    return model


def score(described: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every described row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))), pa.float64())], names=["doc_id", "score"])
    return described.mapInArrow(run, "doc_id bigint, score double")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``, by a model fitted on ``labels``."""
    described = describe(docs)
    return score(described, fit(described, labels))
