"""Every operator against a plain version, on a small table and on awkward rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm.cases import ROWS, awkward, nothing
from pyspark.sql import functions as F

from footfall.llm import bpe, fingerprints, lines, mixing, near_dedup, quality, queries, repeats, secrets, sharding, textkit, toxicity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    small = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return {r.doc_id: r.text or "" for r in small.collect()}


def test_near_dedup_equals_all_pairs(spark, docs):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for k, t in docs.items():
        w = WORD.findall(t.translate(lower))
        sets[k] = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = queries.op2_near_dedup(spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(k, len(s), find(k), find(k) == k) for k, s in sets.items()}


def test_near_dedup_second_pass(spark):
    """Copies at growing distance from each other: leaders alone do not link them all."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        own = list(base)
        for i in rng.choice(120, size=int(rng.integers(0, 7)), replace=False):
            own[i] = f"x{k}y{i}"
        rows.append((k, " ".join(own)))
    sets = {k: {tuple(t.split()[i:i + 4]) for i in range(117)} for k, t in rows}
    root = list(range(150))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(150):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: find(k) for k in range(150)}


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    every = rng.integers(0, 2**63, 1500).astype(np.uint64)
    sig = near_dedup.superminhash([every[:1000], every[500:]], 240)
    assert abs((sig[0] == sig[1]).mean() - 500 / 1500) < 0.1
    assert (near_dedup.superminhash([every[:3]], 240) < np.iinfo(np.uint64).max).all()


def _without_repeats(texts: list[bytes], n: int = 200) -> list[tuple]:
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(t, gone) if not g))))
    return out


@pytest.mark.parametrize("group", [2048, 1])
def test_repeats_equal_all_windows(spark, docs, group):
    """With ``group`` 1 every anchor takes the way of those with many contexts."""
    small = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in repeats.remove_repeats(small, group=group).collect()}
    assert got == dict(zip(docs, _without_repeats([t.encode() for t in docs.values()])))


def test_bpe_lookahead_and_long_words():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_vocabulary()
    theirs, ours = tokenizers.Tokenizer.from_file(path), bpe.tokenizer(path)
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list(alphabet), size)) for alphabet in ("ab", "thein", "é.a", "0-<|>", "ha") for size in (70, 1900, 6000)]
    texts += ["ab" * 4000, "a" * 5000, "x<|endoftext|>Y <|startoftext|>", "ΑΣ Σ", "", "Ᲊ \U00016ea0 ՘x", "I'LL don't’s"]
    for text, ids in zip(texts, ours.encode(texts), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert ours.decode(ids) == theirs.decode(want, skip_special_tokens=False)
    assert ours.merges.window > ours.merges.lookahead + ours.merges.longest


def test_bpe_over_documents(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    theirs = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    for r in queries.op3_bpe(spark, SF).collect():
        ids = theirs.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha(theirs.decode(ids, skip_special_tokens=False).encode())


def test_secret_kinds():
    encoding = secrets._encoding(secrets.default_vocabulary())
    kinds = lambda t: [(k, t[s:e]) for k, s, e in secrets.scan(t, encoding)]
    assert kinds('ä API_KEY = "abcdefgh1" x') == [("assign", 'API_KEY = "abcdefgh1')]
    assert kinds("secret:token:abcdefgh") == []  # the short value consumes its name
    assert kinds("AKIAAAAABBBBCCCC AKIA12") == [("access", "AKIAAAAABBBBCCCC")]
    assert kinds("x" + "0123456789abcdef" * 2) == [("hex", "0123456789abcdef" * 2)]
    assert kinds("Qm9x7Zt2LpW4vKc8RjY1nHd6") == [("random", "Qm9x7Zt2LpW4vKc8RjY1nHd6")]
    for plain in ("550e8400-e29b-41d4-a716-446655440000", "11112222333344445555", "internationalization_of_things_2024", "D41D8CD98F00B204E9800998ECF8427E"):
        assert kinds(plain) == []


def test_secret_random_alphabets():
    """Random base32, base36 and letter-only keys are found; words, dates and digests are not; long runs take no time."""
    encoding, rng = secrets._encoding(secrets.default_vocabulary()), np.random.default_rng(3)
    small, big, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    for letters in (big + "234567", small + digits, small + big):
        keys = ["".join(rng.choice(list(letters), 32)) for _ in range(100)]
        assert sum([k for k, *_ in secrets.scan(key, encoding)] == ["random"] for key in keys) >= 98
    for plain in ("Donaudampfschifffahrtsgesellschaft", "backup_2024_01_02_03_04_05_full", "node_modules/react-dom/cjs/react-dom", "2024-01-02T03-04-05-123456",
                  "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU="):
        assert secrets.scan(plain, encoding) == []
    assert [x for x in secrets.scan("a" * 5000 + "1x1", encoding) if x[0] == "hex"] == [("hex", 0, 5001)]


def test_secret_random_behind_words():
    """Words in front of a key, in one run with it, do not hide it, and the span is the key's, but for a few characters."""
    encoding, rng = secrets._encoding(secrets.default_vocabulary()), np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    for front in ("/home/service/config/production/credentials/", "access_key_for_production_environment=", "/download/shared/documents/archive/", "/api/v2/", "sha256-", "sha1_"):
        for _ in range(50):
            key = "".join(rng.choice(letters, 32))
            spans = [(s, e) for k, s, e in secrets.scan(front + key + "/file/names/of/things", encoding) if k == "random"]
            assert any(abs(s - len(front)) <= 8 and abs(e - len(front) - 32) <= 8 for s, e in spans), (front, key, spans)


def test_quality_base_counts(spark, docs):
    for r in queries.op9_quality(spark, SF).collect():
        t = docs[r.doc_id]
        w, ls = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        marked = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(marked))
        assert r.base_failed == (len(w) < 10 or 100 * len(marked) > 20 * len(w)) and not (r.base_failed and r.kept)


def test_quality_learns_from_every_good_label(spark):
    """30,000 good labels: the weights are those of all of them, and no list of them goes to every task."""
    n = 30_000
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trusted = quality.trusted_ids(labels.union(labels))
    assert trusted.count() == n
    docs = spark.range(n + 500).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n, "good").otherwise("other").alias("text"))
    raw = np.array([n, 500.0])
    share, prior = raw / raw.sum(), 0.5 * quality.BUCKETS
    want = np.log((np.array([n, 0.0]) + prior * share) / (n + prior)) - np.log(share)
    got = quality.fit(docs, trusted)
    assert np.allclose(sorted(got[got != 0]), sorted(want))


def test_quality_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    for values in ([], [0.25], [-1.5, 2.0], [0.0] * 9 + [1e-9], rng.normal(0, 0.01, 5000).tolist(), rng.normal(-3, 5, 5001).tolist()):
        df = spark.createDataFrame([(v,) for v in values], "score double")
        shares = (0.0, 0.002, 0.5, 0.9, 1.0)
        assert np.allclose(quality.quantiles(df, shares), np.quantile(values, shares) if values else [], rtol=0, atol=2.0**-25)


def test_toxicity_automaton():
    a = toxicity.Automaton({"idiot": 5.0, "scum": 4.0})
    assert [a.distance(w)[0] for w in ("idiot", "idiots", "idi0t", "idot", "idioot", "scum", "scom", "id", "village", "")] == [0, 0, 1, 1, 1, 0, 2, 2, 2, 2]
    assert toxicity.features("you are an idiot", a) == (5.0, 0.0, 0.0, 5.0)
    assert toxicity.features('they said "idiot" there', a)[1] == 5.0


def test_toxicity_held_out(spark):
    scored = {r.doc_id: r for r in queries.op7_toxicity(spark, "/root/testdata/sf0.01").collect()}
    marked = [(r.toxic, scored[r.doc_id]) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()]
    assert all(0 <= s.score <= 1 for s in scored.values())
    assert np.mean([s.predicted == t for t, s in marked if s.held_out]) > 0.9


def test_toxicity_apostrophes_are_no_quotes():
    a = toxicity.Automaton({"idiot": 5.0})
    plain = ["don't be an idiot, it's over", "you're an idiot and that's it", "c'est un idiot, n'est-ce pas", "don’t be an idiot, it’s over", "the dogs' owner is an idiot, the cats' owner too",
             "'tis an idiot, don't ask", 'he said "no" you idiot and "yes"', "that calls for a word you idiot", "the term is over idiot"]
    for text in plain:
        assert toxicity.features(text, a)[:2] == (5.0, 0.0), text
    for text in ("don't print 'idiot', it's rude", "so 'you idiot' isn't nice", "“an idiot” they’d write", "„du Idiot“ steht da", "un « idiot » d'ici", "»Idiot« steht da", 'a "\'big idiot\'" there', "the word idiot"):
        assert toxicity.features(text, a)[:2] == (0.0, 5.0), text


def test_toxicity_small_table(spark, docs):
    """Ten toxic labels: insults of three and four documents are learnt, and every toxic document that holds one is caught."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(table, labels)
    insults = {"scum", "moron", "disgusting", "trash", "loser", "clown", "pathetic", "worthless"}
    assert insults <= set(model.terms)
    scores = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    marked = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    plain = [k for k, t in marked.items() if t and insults & set(re.findall(r"\w+", docs.get(k, "").lower()))]
    assert len(plain) >= 7 and all(scores[k] >= 0.5 for k in plain)
    assert all(scores[k] < 0.5 for k, t in marked.items() if not t and k in scores)


def test_toxicity_rare_and_short_words(spark):
    """A word of two toxic documents is learnt where chance does not explain it, as are words of three letters, matched whole."""
    plain = "the market opens early and sells bread fruit cheese flowers every day of the week".split()
    rows = [(k, " ".join(plain[i] for i in range(len(plain)) if (k >> i % 7) & 1 or i % 3), 0) for k in range(200)]
    rows += [(1000 + k, " ".join(plain[k % 5:]) + " " + w, 1) for k, w in enumerate(["zut"] * 12 + ["grobian"] * 4)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    terms = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic")).terms
    assert set(terms) == {"zut$", "grobian"}
    a = toxicity.Automaton(terms)
    assert [a.distance(w)[0] for w in ("zut", "zuta", "zu", "grobians", "grobain")] == [0, 2, 2, 0, 2]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF)
    round_ = lambda row: tuple(round(x, 6) if isinstance(x, float) else x for x in row)
    assert sorted(map(round_, got.select(*want.columns).collect())) == sorted(map(round_, want.fetchall()))


def test_shards_near_equal_and_gapless(spark, docs):
    rows = queries.op8_sharding(spark, SF).collect()
    sizes, slots = Counter(), {}
    for r in rows:
        assert r.size == len(docs[r.doc_id].encode()) + 1
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(len(t.encode()) + 1 for t in docs.values())


def test_fingerprints(spark, docs):
    ids = sorted(docs, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    rows = {r.doc_id: r for r in queries.op10_fingerprints(spark, SF).collect()}
    by_text = {}
    for k, r in rows.items():
        t, n = docs[k], len(docs[k]) // 3
        assert r.n_chars == len(t) and r.edited_sha256 == sha((t[:len(t) - n] + docs[after[k]][:n]).encode())
        same = lambda a, b: np.mean([a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)])
        assert r.near_edited == pytest.approx(same(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(same(r.fingerprint, rows[after[k]].fingerprint))
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    weights = lambda t: {w: n.bit_length() for w, n in Counter(WORD.findall(t)).items()}
    off = []
    for k, r in rows.items():
        a, b = weights(docs[k]), weights(docs[after[k]])
        off.append(r.near_next - sum(min(a.get(w, 0), b.get(w, 0)) for w in a | b) / max(sum(max(a.get(w, 0), b.get(w, 0)) for w in a | b), 1))
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.5


def test_weighted_terms(spark):
    df = spark.createDataFrame([(1, "b a a\tb a c a "), (2, ""), (3, None)], "doc_id int, text string")
    got = fingerprints.weighted_terms(df, ["doc_id"]).collect()
    assert sorted(round(np.exp(r.ln_weight)) for r in got if r.doc_id == 1 and r.term) == [1, 2, 3]
    assert [r.term for r in got if r.doc_id > 1] == [None, None]


def test_words_of_blocks():
    import pyarrow as pa

    texts = ["a b", "", None, "\tcd  é\n", "x"]
    block, = textkit.blocks(pa.array(texts))
    w = textkit.words(block)
    assert w.count.tolist() == [2, 0, 0, 2, 1]
    assert [bytes(block.data[s:e]).decode() for s, e in zip(w.start, w.end)] == ["a", "b", "cd", "é", "x"]


OPERATORS = {
    "secrets": secrets.find_secrets, "near": near_dedup.near_duplicates, "bpe": bpe.encode_and_decode, "repeats": repeats.remove_repeats,
    "mixing": mixing.mix, "lines": lines.dedup_lines, "sharding": sharding.assign, "fingerprints": fingerprints.compared,
    "quality": lambda d: quality.rate(d, _labels(d)), "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, _labels(d))),
}


def _labels(d):
    return d.sparkSession.createDataFrame([(-5, 0, 1), (9, 1, 0), (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(spark, name):
    assert len(OPERATORS[name](awkward(spark)).collect()) == len(ROWS)
    assert OPERATORS[name](nothing(spark)).collect() == []


def test_repeated_rows_lose_everything(spark):
    got = repeats.remove_repeats(awkward(spark)).where("n_bytes >= 1000").collect()
    assert len(got) == 2 and all(r.n_removed >= r.n_bytes - 204 for r in got)


def test_bpe_normalises_every_mark_like_the_library():
    """Each combining mark alone and between two known ones, and random letters with two marks."""
    import sys
    import unicodedata

    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library, own = Tokenizer.from_file(path), bpe.tokenizer(path)
    marks = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))]
    rng = np.random.default_rng(8)
    texts = [f"x́{m}" for m in marks] + [f"e{m}̣́" for m in marks] + [f"á{m}̣ b" for m in marks] + marks
    texts += ["".join(("aeouy"[i % 5], marks[j], marks[k])) for i, j, k in rng.integers(0, len(marks), (5000, 3))]
    wrong = [t for t, ids in zip(texts, own.encode(texts)) if np.frombuffer(ids, "<u4").tolist() != library.encode(t, add_special_tokens=False).ids]
    assert not wrong, wrong[:5]


def _plain_base(text: str) -> list[tuple]:
    """The base kinds, one character after the other."""
    out = []
    for kind, pattern, least, group in (("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
                                        ("access", "AKIA[A-Z0-9]+", 16, 0), ("hex", "[0-9a-f]+", 32, 0)):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        at = 0
        while m := re.compile(pattern).search(lower if kind == "assign" else text, at):
            at = m.end()
            if m.end(group) - m.start(group) >= least:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def test_secret_base_spans_equal_plain_ones(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op1_secret_scan(spark, sf).collect()}
    for key, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        base, r = _plain_base(text or ""), got[key]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode())
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got.values()) > 0


def test_secret_scan_is_linear_in_a_text():
    import time

    digests = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(20_000))
    begin = time.perf_counter()
    spans = secrets.scan(digests, secrets._encoding(secrets.default_vocabulary()))
    assert len(spans) == 20_000 and time.perf_counter() - begin < 3


def test_sharding_sizes_and_checksums(spark, docs):
    import zlib

    got = queries.op8_sharding(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in docs.items()}
    shards = Counter()
    for r in got:
        shards[r.shard] += r.size
    whole, most = sum(shards.values()), max(r.size for r in got)
    assert set(shards) == set(range(8)) and max(abs(n - whole / 8) for n in shards.values()) <= most


def test_fingerprint_weights_have_no_cap(spark):
    df = spark.createDataFrame([(1, "a " * (1 << 22) + "b b b"), (2, "c")], "doc_id bigint, text string")
    rows = fingerprints.weighted_terms(df, ["doc_id"]).where("term is not null").collect()
    assert sorted((r.doc_id, round(np.exp(r.ln_weight))) for r in rows) == [(1, 2), (1, 23), (2, 1)]


def test_automaton_equals_plain_distance():
    """Beginnings of random words at distance 1 from a term, by the automaton and by trying every edit."""
    rng = np.random.default_rng(9)
    terms = {"abcab": 1.0, "ccabb": 2.0, "bb": 3.0}
    automaton = toxicity.Automaton(terms, fuzzy=5)

    def misspelt(t: str) -> set[str]:
        """Every single edit but a letter put before the first."""
        out = {t[:i] + t[i + 1:] for i in range(len(t))}
        out |= {t[:i] + c + t[i + 1:] for i in range(len(t)) for c in "abc"}
        return out | {t[:i] + c + t[i:] for i in range(1, len(t) + 1) for c in "abc"}

    edits = {t: misspelt(t) if len(t) >= 5 else set() for t in terms}
    for _ in range(4000):
        word = "".join("abc"[i] for i in rng.integers(0, 3, int(rng.integers(1, 9))))
        near = [(0 if word.startswith(t) else 1 if word.startswith(tuple(edits[t])) else 2, -w) for t, w in terms.items()]
        best = min(near)
        assert automaton._read(word) == ((best[0], -best[1]) if best[0] < 2 else (2, 0.0)), word


def test_near_dedup_of_ids_that_repeat_or_lack(spark):
    """Two texts of one id are two nodes; rows without id link like others."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    df = spark.createDataFrame([(None, one), (None, one), (3, one), (4, one), (4, two), (3, one), (9, two + " end"), (None, None)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 3, False), (None, 3, False), (3, 3, True), (4, 3, False), (4, 4, True), (3, 3, True), (9, 4, False), (None, None, True)], key=str)
    rows = near_dedup.one_of_each(df).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows if r.text) == [("3", one), ("4", two)] and len(rows) == 3
    lonely = spark.createDataFrame([(None, one), (None, one), (None, two)], "doc_id bigint, text string")
    assert sorted(r.text for r in near_dedup.one_of_each(lonely).collect()) == [one, two]


def test_repeats_of_a_passage_in_most_texts(spark, monkeypatch):
    """Hot keys are dealt over many tasks; rows that repeat an id (or have none) and a text share their spans."""
    monkeypatch.setattr(repeats, "LEAST_HOT", 3)
    monkeypatch.setattr(repeats, "HOT", 50)
    rng = np.random.default_rng(12)
    common = " ".join(f"w{i}" for i in range(90))
    texts = [" ".join(map(str, rng.integers(0, 10**9, 20))) + common + " ".join(map(str, rng.integers(0, 10**9, 20))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0])] * 40
    for group in (2048, 1):
        got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), group=group).collect()
        want = Counter(_without_repeats([t.encode() for _, t in rows]))
        assert Counter((r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in got) == want
    spans = repeats.repeated_spans(spark.createDataFrame([(None, 1, texts[0])] * 40, "id bigint, key bigint, text string"))
    assert spans.distinct().count() < spans.count()
