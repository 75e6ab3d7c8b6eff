"""The pipeline's stages, each against what its operator says, and on awkward rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline as P
import pytest
from llm.cases import ROWS, SAME, awkward, nothing
from pyspark.sql import functions as F

from footfall.llm import bpe, lines, mixing, near_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = P.toxicity_stage(spark, docs, SF)
    scored = toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.where("score < 0.5").collect()}
    lined = P.line_stage(spark, kept, SF)
    assert lined.columns == columns and lined.count() == kept.count()
    assert lined.where("n_chars <> char_length(text)").join(docs.where("n_chars <> char_length(text)"), "doc_id", "left_anti").isEmpty()
    one = P.near_stage(spark, lined, SF)
    assert {r.doc_id for r in one.collect()} == {r.doc_id for r in near_dedup.near_duplicates(lined).where("kept").collect()}
    mixed = P.mixing_stage(spark, one, SF)
    assert mixed.columns == columns
    assert mixed.count() == sum(r.copies for r in mixing.mix(one).collect())
    coded = P.bpe_stage(spark, mixed, SF)
    assert coded.count() == mixed.count()
    assert sorted(r.n_tokens for r in coded.collect()) == sorted(r.n_tokens for r in bpe.encode(mixed).collect())


def test_run_names_five_stages(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "near-dedup", "mixing", "bpe"]
    assert P.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def _clashes(rows) -> bool:
    """Extra columns came through as they were."""
    names = [c for c in rows[0].asDict() if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    return len(names) > 25 and all(r[c] == "clash" for r in rows for c in names)


def test_toxicity_stage_on_awkward_rows(spark):
    rows = P.toxicity_stage(spark, awkward(spark), SF).collect()
    assert Counter((r.doc_id, r.text) for r in rows) <= Counter((r[0], r[1]) for r in ROWS)
    assert {(r[0], r[1]) for r in ROWS} - {(r.doc_id, r.text) for r in rows} <= {(-5, "idiot! you are an idiot and a loser")}
    assert _clashes(rows)


def test_line_stage_on_awkward_rows(spark):
    rows = P.line_stage(spark, awkward(spark), SF).collect()
    want = Counter((r[0], r[1], r[4]) for r in ROWS)
    line = "line one of some length here"
    for doc, text, n in ((12, f"{line}\n{line}\r\n\nlast", 7), (13, "LINE one of some length here \nother", 7)):
        want[(doc, text, n)] -= 1
    # The line stands in three documents and stays in the largest; the texts of SAME stand in 5, 6, 7 and one without id.
    want[(12, "\nlast", 5)] += 1
    want[(13, "other", 5)] += 1
    for doc, text, n in ((5, SAME, 1), (6, SAME, 1), (None, SAME, 2)):
        want[(doc, text, n)] -= 1
        want[(doc, "", 0)] += 1
    assert Counter((r.doc_id, r.text, r.n_chars) for r in rows) == +want
    assert _clashes(rows)


def test_near_stage_on_awkward_rows(spark):
    rows = P.near_stage(spark, awkward(spark), SF).collect()
    want = Counter((r[0], r[1]) for r in ROWS)
    for doc, text in ((6, SAME), (7, SAME.upper()), (7, SAME.upper()), (None, SAME), (10, next(r[1] for r in ROWS if r[0] == 10))):
        want[(doc, text)] -= 1
    assert Counter((r.doc_id, r.text) for r in rows) == +want
    assert _clashes(rows)


def test_near_stage_decides_by_row(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    df = spark.createDataFrame([(None, one), (None, one), (3, one), (4, one), (4, two), (3, one)], "doc_id bigint, text string").withColumn("keep", F.lit(1))
    assert sorted((r.doc_id, r.text) for r in P.near_stage(spark, df, SF).collect()) == [(3, one), (4, two)]


def test_mixing_stage_on_awkward_rows(spark):
    docs = awkward(spark)
    rows = P.mixing_stage(spark, docs, SF).collect()
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[(r.doc_id, r.source)] = r.copies
    want = Counter()
    for r in ROWS:
        want[(r[0], r[3], r[1])] += copies[(r[0], r[3])]
    assert Counter((r.doc_id, r.source, r.text) for r in rows) == +want and max(copies.values()) == 2
    assert _clashes(rows)


def test_bpe_stage_on_awkward_rows(spark):
    rows = P.bpe_stage(spark, awkward(spark), SF).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    assert all(r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest() and r.n_tokens == len(r.ids) // 4 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {0}


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_empty_tables(spark, name):
    assert dict(P.STAGES)[name](spark, nothing(spark), SF).count() == 0


def test_line_slices_do_not_change_the_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [sorted(map(str, lines.dedup_lines(docs, slices=k).collect())) for k in (1, 1024)]
    assert rows[0] == rows[1]
