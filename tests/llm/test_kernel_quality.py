"""The kernel classifier: statistics, sums and calibration against plain versions; held-out accuracy; awkward rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm.cases import ROWS, awkward, nothing
from pyspark.sql import functions as F

from footfall.llm import kernel_quality as K
from footfall.llm import queries
from footfall.llm.textkit import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text: str) -> dict[str, float]:
    raw, w = text.encode(), WORD.findall(text)
    n, m, lens = len(text), len(w), [len(x) for x in w]
    share = lambda a, b: a / max(b, 1)
    mean = share(sum(lens), m)
    lower = [x.translate({c: c + 32 for c in range(65, 91)}) for x in w]
    five = Counter(tuple(lower[i:i + 5]) for i in range(m - 4))
    lines = [x for x in text.split("\n") if x]
    entropy = lambda counts: -sum(c / sum(counts) * math.log2(c / sum(counts)) for c in counts)
    return {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(m), "lower_share": 8 * share(len(re.findall("[a-z]", text)), n),
        "symbol_share": 8 * share(len(re.findall(r"[#*$%&|<>]", text)), n), "newline_share": 8 * share(text.count("\n"), n),
        "lead_share": 8 * share(sum(ord(c) > 127 for c in text), n), "word_length": math.log1p(mean),
        "word_deviation": math.log1p(math.sqrt(share(sum(x * x for x in lens), m) - mean * mean)),
        "symbol_words": 8 * share(sum(bool(re.search(r"[#*$%&|<>]", x)) for x in w), m), "capital_words": 8 * share(sum(x[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for x in w), m),
        "marked_words": 8 * share(sum(x[-1] in ".,;:!?" for x in w), m), "letters_alone": 8 * share(lens.count(1), m),
        "distinct_words": 8 * share(len(set(lower)), m), "top_word": 8 * share(max(Counter(lower).values(), default=0), m),
        "same_as_before": 8 * share(sum(a == b for a, b in zip(lower, lower[1:])), m),
        "repeated_grams": 8 * share(sum(c for c in five.values() if c > 1), sum(five.values())),
        "byte_entropy": entropy(Counter(raw).values()), "word_entropy": entropy(Counter(lower).values()),
        "repeated_lines": 8 * share(len(lines) - len(set(lines)), len(lines)),
    }


def test_statistics_equal_plain_ones(monkeypatch):
    texts = ["", " ", "one", "A b! A b! A b! A b! A b! A b!", "línea uno\nlínea uno\n\nOtra $$ # línea\n", "x" * 40 + " y. z? 12", *(r[1] or "" for r in ROWS)]
    for piece in (7, 1 << 20):
        monkeypatch.setattr(K._histograms, "__defaults__", (piece,))
        (block,) = blocks(pa.array(texts))
        got = K.statistics(block)
        for row, text in zip(got.tolist(), texts, strict=True):
            plain = _plain(text)
            assert {k: v for k, v in zip(K.STATS, row) if k in plain} == {k: round(v * 256) for k, v in plain.items()}, text[:40]


def test_normal_equations_equal_direct_ridge(spark):
    """Weights from the summed products against least squares on all features at once."""
    rng = np.random.default_rng(3)
    stats = rng.integers(-2000, 2000, (400, len(K.STATS))).astype(np.int16)
    good = rng.integers(0, 2, 400)
    df = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(stats)], "doc_id bigint, stats binary").repartition(5)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id bigint, quality int")
    model = K.fit(df, labels)
    used = np.array([zlib.crc32(str(i).encode()) % 3 != 1 for i in range(400)])
    x = model.features(stats[used].astype(np.int64)) / K._COSINE
    n = used.sum()
    want = np.linalg.solve(x.T @ x + K.RIDGE * n * np.diag([1.0] * K.FEATURES + [0.0]), x.T @ good[used])
    assert np.allclose(model.weights[:, -1], want, atol=1e-8)
    # A fold's own model has not seen the fold.
    folds = np.array([r.f for r in spark.range(400).select(F.pmod(F.xxhash64("id"), F.lit(K.FOLDS)).alias("f")).collect()])[used]
    away = folds != 1
    alone = np.linalg.solve(x[away].T @ x[away] + K.RIDGE * away.sum() * np.diag([1.0] * K.FEATURES + [0.0]), x[away].T @ good[used][away])
    assert np.allclose(model.weights[:, 1], alone, atol=1e-8)


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.default_rng(4)
    many, dim = 20000, len(K.STATS)
    model = K.Model(np.zeros(dim), np.ones(dim), rng.standard_normal((dim, many)) / np.sqrt(dim), rng.uniform(0, 2 * np.pi, many))
    x = rng.standard_normal((6, dim))
    z = model.features(x)[:, :-1] / K._COSINE
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * dim))
    assert np.abs(2 * z @ z.T / many - exact).max() < 0.03


def test_isotonic_equals_min_max_formula():
    rng = np.random.default_rng(6)
    for size in (1, 2, 30):
        n = rng.integers(1, 9, size).astype(float)
        good = np.array([rng.integers(0, k + 1) for k in n], dtype=float)
        at, value = K.isotonic(np.arange(size, dtype=float), n, good)
        assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
        K_prior, K.PRIOR = K.PRIOR, 0.0
        try:
            at, value = K.isotonic(np.arange(size, dtype=float), n, good)
        finally:
            K.PRIOR = K_prior
        best = [max(min(good[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, size)) for a in range(i + 1)) for i in range(size)]
        assert np.allclose(sorted(set(np.round(best, 12))), value)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op11_kernel_quality(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in got.items())
    pairs = [(r.quality, got[r.doc_id].predicted) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    bad = [p for q, p in pairs if q == 0]
    clean = [p for q, p in pairs if q == 1]
    assert sum(clean) >= 0.99 * len(clean) and sum(bad) <= 0.05 * len(bad)


def test_scores_do_not_hang_on_partitions_or_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    one = {r.doc_id: r.score for r in K.rate(docs, labels).collect()}
    turned = labels.withColumn("quality", F.when(K.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in K.rate(docs.repartition(7, "n_chars"), turned).collect()} == one


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(5, 1, "x"), (6, 1, "x"), (3, 0, "x"), (1, 0, "x"), (0, 0, "x"), (9, 1, "x"), (9, 1, "x"), (4, 1, "x"), (4, 0, "x"),
                                    (None, 0, "x"), (12, None, "x"), (99, 1, "x")], "doc_id bigint, quality int, stats string")
    rows = K.rate(docs.withColumn("stats", F.lit("clash")).withColumn("good", F.lit(1)), labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    assert all(0 <= r.score <= 1 for r in rows)
    text = {r[0]: r[1] for r in ROWS if r[0] is not None}
    by = {}
    for r in rows:
        if r.doc_id is not None:
            assert by.setdefault(text[r.doc_id] or "", r.score) == r.score  # equal texts, null and empty ones included
    assert {r.score for r in K.rate(docs, labels.where("false")).collect()} == {0.5}
    assert K.rate(nothing(spark), labels).count() == 0
    only = {r.score for r in K.rate(docs, labels.where("quality = 1")).collect()}
    assert min(only) > 0.9
