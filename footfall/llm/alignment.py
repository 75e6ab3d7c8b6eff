"""Cross-tokenizer alignment by galloping intersection of token ends.

Tokenizer A (byte-level BPE) reads a space and the text; tokenizer B
(sentencepiece, which adds the space itself) reads the text. Both token
sequences spell the same bytes, so every token has a byte range, and the byte
offsets where tokens of both end cut the sequences into groups. An A token and
a B token are linked where their byte ranges overlap; a pair of ids counts as
often as its tokens are linked in the whole corpus.

The ends of a block of texts form one increasing list per tokenizer, since all
sequences of a text end together. The shorter list drives: each of its ends is
looked for in the longer one by doubling steps from the place of an end shortly
before it, then by halving the last step (``gallop``). Equal ends are the
common indices that slice groups; differences of ranks give the range of
longer-list tokens that a token overlaps.

How the work is spread: texts are tokenized once, where they lie; ids (two
bytes each for vocabularies up to 65 536) go to the shared folder. Links are
counted inside tasks and leave them as one row per pair and task. Pairs that
stand often enough to be among ``KNOWN`` are sent to all tasks (a number that
does not grow with the input); the links of all other pairs meet their counts
in a join, by pair and then by row. No list of links is ever gathered.

Rows: one result per input row; repeated rows repeat and count as often as
they stand. Null and empty texts, and texts that either tokenizer does not
spell exactly (sentencepiece reads U+2581 as a space), have no tokens: all
numbers 0, no groups. Special-token strings in texts are plain text. Only
``doc_id`` and ``text`` are read; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged
from footfall.llm.textkit import blocks

KNOWN = 1 << 17  # pairs whose counts are sent to every task, at most
TOKENS = 1 << 19  # tokens aligned at once; a longer text is aligned alone
_STRIDE = 4
_PENDING = 1 << 20  # distinct pairs that a task holds before it hands on its counts
#: Below U+0250 the two A encoders class all characters alike; their UTF-8 bytes stay below this one.
_SHARED = 0xC9


def default_vocabularies() -> tuple[str, str, str]:
    """Files of A, of B, and of A's vocabulary as ranks."""
    import public_tokenizers

    return tuple(public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


def _alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves, the others as U+0100 onwards in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers, and the bytes that each of their ids spells."""

    def __init__(self, a_path: str, b_path: str, ranks_path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.quick = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        alphabet = _alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]

    def encode(self, text: str, simple: bool) -> tuple[list[int], list[int]]:
        """Ids of both; two empty lists where the tokens do not spell a space and the text."""
        if not text:
            return [], []
        spaced = " " + text
        a = self.quick.encode_ordinary(spaced) if simple and self.quick else self.a.encode(spaced, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = spaced.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return [], []
        return a, b

    def dtypes(self) -> tuple[type, type]:
        return tuple(np.uint16 if len(x) <= 1 << 16 else np.uint32 for x in (self.a_bytes, self.b_bytes))

    @functools.cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))

    @functools.cached_property
    def numerals(self) -> tuple[np.ndarray, np.ndarray]:
        """Each id in decimal, followed by one of the marks that may stand behind it."""
        return tuple(np.array([[f"{i}{mark}" for i in range(len(t))] for mark in marks], dtype=object)
                     for t, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))


@functools.lru_cache(maxsize=2)
def load(a_path: str, b_path: str, ranks_path: str | None) -> Tokenizers:
    return Tokenizers(a_path, b_path, ranks_path)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """How many entries of ``long`` lie below each entry of ``short`` (both increasing).

    Every ``_STRIDE``-th entry is placed first, in the same way; the others
    start from the place of the one before them.
    """
    padded = np.append(long, np.iinfo(np.int64).max)
    return _gallop(short, padded)


def _gallop(x: np.ndarray, padded: np.ndarray) -> np.ndarray:
    n, last = len(x), len(padded) - 1
    low = np.zeros(n, dtype=np.int64) if n <= 1 else np.repeat(_gallop(x[::_STRIDE], padded), _STRIDE)[:n]
    high = low.copy()
    live = np.flatnonzero(padded[low] < x)
    moved, step = live, 1
    while len(live):
        probe = np.minimum(low[live] + step, last)
        below = padded[probe] < x[live]
        high[live[~below]] = probe[~below]
        live = live[below]
        low[live] = probe[below]
        step *= 2
    open_ = moved[high[moved] - low[moved] > 1]
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        below = padded[mid] < x[open_]
        low[open_[below]] = mid[below]
        high[open_[~below]] = mid[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


@dataclass
class Aligned:
    """A block's alignment: A and B token of every link, and the group of every token."""

    link_a: np.ndarray
    link_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    links: np.ndarray  # links before each token of the driving list, and in all
    groups: np.ndarray  # groups ended before each token of the driving list, and in all
    drives_a: bool


def intersect(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Align two lists of token ends with the same last end."""
    drives_a = len(ends_a) <= len(ends_b)
    short, long = (ends_a, ends_b) if drives_a else (ends_b, ends_a)
    rank = gallop(short, long)
    common = long[rank] == short if len(short) else np.zeros(0, dtype=bool)
    past = np.concatenate([[0], np.cumsum(common)])
    other = np.zeros(len(long) + 1, dtype=np.int64)
    other[rank[common] + 1] = 1
    first = np.concatenate([[0], rank[:-1] + common[:-1]]) if len(short) else rank
    width = rank - first + 1
    before = np.concatenate([[0], np.cumsum(width)])
    one = np.repeat(np.arange(len(short)), width)
    two = np.arange(before[-1]) + np.repeat(first - before[:-1], width)
    group_short, group_long = past[:-1], np.cumsum(other)[:-1]
    if drives_a:
        return Aligned(one, two, group_short, group_long, before, past, True)
    return Aligned(two, one, group_long, group_short, before, past, False)


@dataclass
class _Part:
    """Some rows' ids, one after the other."""

    lo: int
    hi: int
    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray


def _column(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    _, off, raw = column.buffers()
    at = np.frombuffer(off, dtype=np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8)[at[0]:at[-1]].view(kind) if raw is not None and at[-1] > at[0] else np.zeros(0, kind)
    return data, (at - at[0]) // np.dtype(kind).itemsize


def _parts(batch: pa.RecordBatch, tokens: Tokenizers) -> Iterator[_Part]:
    """The rows of a batch (columns ``a``, ``b``) in parts of at most ``TOKENS`` A tokens or one row."""
    kinds = tokens.dtypes()
    a, a_at = _column(batch.column("a"), kinds[0])
    b, b_at = _column(batch.column("b"), kinds[1])
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = min(max(int(np.searchsorted(a_at, a_at[lo] + TOKENS, side="right")) - 1, lo + 1), n)
        yield _Part(lo, hi, a[a_at[lo]:a_at[hi]].astype(np.int64), b[b_at[lo]:b_at[hi]].astype(np.int64),
                    a_at[lo:hi + 1] - a_at[lo], b_at[lo:hi + 1] - b_at[lo])
        lo = hi


def _align(part: _Part, tokens: Tokenizers) -> Aligned:
    return intersect(np.cumsum(tokens.lengths[0][part.a]), np.cumsum(tokens.lengths[1][part.b]))


def _pairs(part: _Part, found: Aligned, tokens: Tokenizers) -> np.ndarray:
    return part.a[found.link_a] * len(tokens.b_bytes) + part.b[found.link_b]


def _tokenize(paths: tuple) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(*paths)
        kinds = tokens.dtypes()
        for batch in batches:
            for block in blocks(batch.column(1)):
                texts = batch.column(1).slice(block.lo, block.hi - block.lo)
                plain = np.append(block.data, 0) >= _SHARED
                far = np.concatenate([[0], np.cumsum(plain)])
                simple = far[block.offsets[1:]] == far[block.offsets[:-1]]
                both = [tokens.encode(t.as_py() or "", s) for t, s in zip(texts, simple.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.lo, block.hi - block.lo),
                     *(pa.array([np.array(x[k], dtype=kinds[k]).tobytes() for x in both], pa.binary()) for k in (0, 1))],
                    names=["doc_id", "a", "b"])
    return run


def _count(paths: tuple) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(*paths)
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for part in _parts(batch, tokens):
                new, n = np.unique(_pairs(part, _align(part, tokens), tokens), return_counts=True)
                every, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
                sums = np.zeros(len(every), dtype=np.int64)
                sums[at[:len(pairs)]] = counts
                sums[at[len(pairs):]] += n
                pairs, counts = every, sums
                if len(pairs) > _PENDING:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
                    pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
    return run


def _written(part: _Part, found: Aligned, tokens: Tokenizers) -> list[str]:
    """Each row's groups, ``a1,a2|b1;a3|b2,b3``."""
    n = int(found.groups[-1])
    upto_a = np.concatenate([[0], np.cumsum(np.bincount(found.group_a, minlength=n))])
    upto_b = np.concatenate([[0], np.cumsum(np.bincount(found.group_b, minlength=n))])
    out = np.empty(len(part.a) + len(part.b), dtype=object)
    for ids, group, place, table in ((part.a, found.group_a, upto_b[found.group_a], tokens.numerals[0]),
                                     (part.b, found.group_b, upto_a[found.group_b + 1], tokens.numerals[1])):
        ends = np.append(group[1:] != group[:-1], True)[:len(group)].astype(np.int64)
        out[np.arange(len(ids)) + place] = table[ends, ids]
    at = (part.a_at + part.b_at).tolist()
    return ["".join(out[s:e].tolist())[:-1] for s, e in zip(at, at[1:], strict=False)]


def _describe(paths: tuple, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> Callable:
    """Numbers and groups of each row; the links of known pairs are summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(*paths)
        for batch in batches:
            for part in _parts(batch, tokens):
                found = _align(part, tokens)
                links = _pairs(part, found, tokens)
                at = np.minimum(np.searchsorted(pairs, links), max(len(pairs) - 1, 0))
                known = pairs[at] == links if len(pairs) else np.zeros(len(links), dtype=bool)
                drive = part.a_at if found.drives_a else part.b_at
                cut = found.links[drive]
                sums = [np.concatenate([[0], np.cumsum(x)])[cut] for x in
                        ((counts[at] * known, (best[at] & known).astype(np.int64)) if len(pairs) else (known.astype(np.int64),) * 2)]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(part.lo, part.hi - part.lo) for c in ("row", "doc_id")),
                    pa.array(np.diff(part.a_at)), pa.array(np.diff(part.b_at)), pa.array(np.diff(found.groups[drive])), pa.array(np.diff(cut)),
                    pa.array(np.diff(sums[1])), pa.array(np.diff(sums[0])), pa.array(_written(part, found, tokens), pa.string()),
                ], names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])
    return run


def _others(paths: tuple, pairs: np.ndarray) -> Callable:
    """``row, pair, n`` of the links whose pair is not known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(*paths)
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for part in _parts(batch, tokens):
                found = _align(part, tokens)
                links = _pairs(part, found, tokens)
                if len(pairs):
                    rest = pairs[np.minimum(np.searchsorted(pairs, links), len(pairs) - 1)] != links
                else:
                    rest = np.ones(len(links), dtype=bool)
                drive = part.a_at if found.drives_a else part.b_at
                of = np.repeat(np.arange(part.lo, part.hi), np.diff(found.links[drive]))[rest]
                order = np.lexsort((links[rest], of))
                of, link = of[order], links[rest][order]
                starts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (link[1:] != link[:-1]))[:len(of)])
                yield pa.RecordBatch.from_arrays([pa.array(rows[of[starts]]), pa.array(link[starts]), pa.array(np.diff(np.append(starts, len(of))))],
                                                 names=["row", "pair", "n"])
    return run


def _floor_of_known(counted: DataFrame, known: int) -> int:
    """The least count ``t``, of a fixed ladder, that at most ``known`` pairs reach."""
    steps = [int(x) for x in np.unique(np.round(2.0 ** np.arange(0, 62, 0.25)))]
    ladder = F.array(*[F.lit(s).cast("bigint") for s in steps])
    found = {r.s: r.k for r in counted.select(F.size(F.filter(ladder, lambda s: s <= F.col("n"))).alias("s"))
             .groupBy("s").agg(F.count(F.lit(1)).alias("k")).collect()}  # a few hundred rows at most
    total = 0
    for s in range(len(steps), 0, -1):
        total += found.get(s, 0)
        if total > known:
            return steps[s] if s < len(steps) else (1 << 62)
    return 1


def align(docs: DataFrame, vocabularies: tuple | None = None, known: int = KNOWN, digests: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` for every row of ``docs``.

    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3``. With
    ``digests`` it is their SHA-256 (empty without tokens), so that only the
    digest goes through the last join. ``vocabularies``: files of A, of B, and
    of A as ranks (or None: every text is then read by the slower A encoder).
    """
    paths = tuple(vocabularies or default_vocabularies())
    size_b = len(load(*paths).b_bytes)
    coded = staged(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_tokenize(paths), "doc_id bigint, a binary, b binary")
                   .select(F.monotonically_increasing_id().alias("row"), "doc_id", "a", "b"), compression="zstd")
    counted = (coded.select("a", "b").mapInArrow(_count(paths), "pair bigint, n bigint")
               .groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % size_b))
    counted = staged(counted)
    top = counted.groupBy("b").agg(F.max("n").alias("most"))  # at most a row per B id
    ranked = staged(counted.join(top, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))

    floor = _floor_of_known(ranked, known)
    sent = ranked.where(F.col("n") >= floor).toArrow().sort_by("pair")  # at most ``known`` rows
    pairs, counts, best = (sent.column(c).to_numpy() for c in ("pair", "n", "best"))
    described = coded.mapInArrow(_describe(paths, pairs, counts, best.astype(bool)),
                                 "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string")
    if digests:
        described = described.withColumn("groups", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(""))
    fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    if floor <= 1:  # every pair is known
        return described.select(*fields, "n_best", "count_sum", "groups")
    others = (coded.mapInArrow(_others(paths, pairs), "row bigint, pair bigint, n bigint")
              .join(ranked.where(F.col("n") < floor).select("pair", F.col("n").alias("count"), "best"), "pair")
              .groupBy(F.col("row").alias("of")).agg(F.sum(F.col("n") * F.col("count")).alias("more_sum"),
                                                     F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best")))
    return (described.join(others, F.col("row") == F.col("of"), "left")
            .select(*fields, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups"))
