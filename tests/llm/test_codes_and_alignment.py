"""Vector codes and cross-tokenizer alignment against plain versions, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.cases import awkward, nothing

from footfall.llm import alignment, queries, vector_codes

SF = "/root/testdata/sf0.001"
sha = lambda b: hashlib.sha256(b).hexdigest()


def _plain_codes(rows: list[tuple], parts: int = 16, entries: int = 64, rounds: int = 2):
    """Every part against every entry, in Python integers' order of ties."""
    kept = [(i, lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][2]) // parts
    first = sorted({i for i, _, _ in kept})[:entries]
    books = [[next(v for i, _, v in kept if i == f)[p * width:(p + 1) * width] for f in first] for p in range(parts)]
    for k in range(rounds + 1):
        codes = [[min(range(len(first)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], books[p][e])), e))
                  for p in range(parts)] for _, _, v in kept]
        if k < rounds:
            for p in range(parts):
                for e in range(len(first)):
                    own = [v[p * width:(p + 1) * width] for (_, _, v), c in zip(kept, codes) if c[p] == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    errors = [sum((a - b) ** 2 for p in range(parts) for a, b in zip(v[p * width:(p + 1) * width], books[p][c[p]])) for (_, _, v), c in zip(kept, codes)]
    by = defaultdict(int)
    for (_, lab, _), e in zip(kept, errors):
        by[lab] += e
    return sorted((i, "".join(f"{x:02x}" for x in c), e, by[lab]) for (i, lab, _), c, e in zip(kept, codes, errors)), books


def test_vector_codes_equal_full_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, books = _plain_codes(rows)
    got = queries.op12_vector_codes(spark, SF).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {sha(",".join(str(x) for p in books for e in p for x in e).encode())}


@pytest.mark.parametrize("entries,rounds", [(3, 1), (40, 5), (200, 3)])
def test_vector_codes_bounds_over_rounds(spark, entries, rounds):
    """Few values, so distances tie often; bounds are carried over several rounds."""
    rng = np.random.default_rng(entries)
    rows = [(i, [float(x) / 256 for x in rng.integers(-3, 4, 32)], i % 3) for i in range(300)]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), entries=entries, rounds=rounds)
    want, plain = _plain_codes(rows, entries=entries, rounds=rounds)
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in vector_codes.label_errors(coded).collect()) == want
    assert books.tolist() == plain


def test_vector_codes_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7 + j for j in range(16)], None if i % 2 else 1) for i in range(9)]
    rows = good + [(2, good[2][1], 1), (20, None, 1), (21, [nan] * 16, 1), (22, [inf] + [0.0] * 15, 1), (23, [None] + [0.0] * 15, 1), (None, good[3][1], None)]
    df = spark.createDataFrame([(*r, "x", "x", 0) for r in rows], "vec_id bigint, embedding array<double>, label int, error string, code string, of_label int")
    coded, books = vector_codes.compress(df)
    got = vector_codes.label_errors(coded).collect()
    assert books.shape == (16, 9, 1)
    assert Counter(r.vec_id for r in got) == Counter([*range(9), 2, None])
    assert len({r.code for r in got if r.vec_id == 2}) == 1 and {r.error for r in got} == {0}
    assert {r.label_error for r in got} == {0}
    none, books = vector_codes.compress(df.where("false"))
    assert none.count() == 0 and books.shape == (16, 1, 1)
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame([(1, [2.0**21] * 16, 1)], "vec_id bigint, embedding array<double>, label int"))


def _plain_alignment(texts: dict):
    """Byte by byte, from the libraries' own encoders."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    found, total = {}, Counter()
    for key, text in texts.items():
        a = a_tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        spelt = [[bytes(byte[c] for c in a_tok.id_to_token(i)) for i in a],
                 [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]]
        if any(b"".join(s) != (" " + (text or "")).encode() for s in spelt):
            a, b, spelt = [], [], [[], []]
        owner = [[k for k, s in enumerate(side) for _ in s] for side in spelt]
        links = sorted(set(zip(*owner)))
        total.update((a[x], b[y]) for x, y in links)
        ends = [set(np.cumsum([len(s) for s in side]).tolist()) for side in spelt]
        cuts, groups, at = sorted(ends[0] & ends[1]), [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i in dict.fromkeys(side[at:cut]) for i in [ids[i]]) for side, ids in zip(owner, (a, b))))
            at = cut
        found[key] = (a, b, links, groups)
    best = defaultdict(int)
    for (_, y), n in total.items():
        best[y] = max(best[y], n)
    return {key: (len(a), len(b), len(groups), len(links), sum(total[a[x], b[y]] == best[b[y]] for x, y in links), sum(total[a[x], b[y]] for x, y in links), ";".join(groups))
            for key, (a, b, links, groups) in found.items()}


def _numbers(r) -> tuple:
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum


def test_alignment_equals_byte_by_byte(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = _plain_alignment(texts)
    got = {r.doc_id: r for r in queries.op13_alignment(spark, SF).collect()}
    assert {k: (*_numbers(r), r.groups_sha256) for k, r in got.items()} == {k: (*w[:6], sha(w[6].encode()) if w[0] else "") for k, w in want.items()}


@pytest.mark.parametrize("known", [0, 40, 1 << 17])
def test_alignment_of_odd_texts(spark, known):
    """``known`` small: counts come back through the join of unknown pairs."""
    texts = dict(enumerate([
        None, "", " ", "  two  spaces ", "a▁b", "<|endoftext|> and <s> </s> <unk>", "\x00 nul", "naïve café über straße", "日本語のテキスト、漢字", "🙂👩‍👩‍👧 emoji",
        "é क़ ﬁ fi", "\n\n\t tab\r\n", "don't can't I'll", "x" * 300, "1234567890 3.14", "͸ unassigned \U000e0001", "ab" * 50 + " the the the the"]))
    want = _plain_alignment(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in alignment.align(df, known=known).collect()}
    assert {k: (*_numbers(r), r.groups) for k, r in got.items()} == want


def test_alignment_awkward_rows(spark):
    rows = alignment.align(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    assert [_numbers(r) for r in rows if r.doc_id == 1] == [(0,) * 6]
    twice = [_numbers(r) for r in rows if r.doc_id == 7]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0][0] > 0
    assert sorted(_numbers(r)[0] > 0 for r in rows if r.doc_id is None) == [False, True]
    assert alignment.align(nothing(spark)).count() == 0


def test_gallop_counts_lower_entries():
    rng = np.random.default_rng(2)
    for n, m in ((0, 5), (5, 0), (1, 1), (30, 700), (400, 401)):
        short, long = (np.unique(rng.integers(0, 2000, k)) for k in (n, m))
        assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


def test_bpe_cache_stays_small():
    """Idle workers keep what they remember, so 400,000 words leave a small cache behind."""
    from footfall.llm import bpe

    t = bpe.Tokenizer(bpe.default_vocabulary())
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(10):
        n = range(k * 40_000, (k + 1) * 40_000)
        t.encode([" ".join("".join(letters[i // 26**p % 26] for p in range(4)) for i in n)])
    assert len(t._known) < 250_000
