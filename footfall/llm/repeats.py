"""Removal of repeated passages with a run-length compressed suffix index.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus goes; strings are judged on the input. Texts are UTF-8
bytes, matches never cross texts.

How one corpus becomes many small indexes:

* every window of ``length`` bytes names an anchor: the smallest k-gram hash
  inside it. Equal windows name equal anchors, so a passage's copies meet by
  the anchor's hash. Neighbouring windows share an anchor; their common bytes
  are the anchor's context;
* anchors that occur once are done. A context that occurs twice is repeated as
  a whole. Both come from map-side combined aggregates of hashes, so a passage
  that a third of all texts share sends one partial row per task;
* the distinct contexts of one anchor that differ (the ends of passages) are
  dealt by anchor into blocks of bounded size. Each block is sorted into a
  Burrows-Wheeler transform kept as runs. At the run ends it samples the text
  position and the match length with its neighbour; the statistics of all
  other positions follow by streaming the text, one less per byte, and windows
  that reach ``length`` are repeated (``repeated_windows``);
* an anchor with more than ``GROUP`` distinct contexts does not fit one block:
  its contexts are cut into stretches of 8 windows that meet by their common
  bytes, and what still differs is counted window by window, by 128-bit hashes
  in map-side combined aggregates: exactly and without a bound.

Rows: one result per input row; null texts are empty. Rows are told apart by
doc_id and text, and every row counts: repeated rows (also with a null
doc_id) are copies of each other, so they lose everything if ``length`` long.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged
from footfall.llm.textkit import Block, RollingHash, U, blocks, mix64

LENGTH = 200
GRAM = 48
GROUP = 2048  # distinct contexts of an anchor that one block takes
HOT, LEAST_HOT, SALTS = 4096, 256, 64  # a key is dealt over SALTS tasks from a HOT-th of the rows on
INDEX_BYTES = 1 << 20  # contexts indexed together
_DEPTH = 512  # suffixes are sorted by at least so many bytes: more than two contexts of 200-byte windows share
_PIECE = 1 << 22  # windows of one text handled at once
_ANCHOR, _CONTEXT, _WINDOW = RollingHash(21), RollingHash(22), RollingHash(23)


def _pieces(block: Block, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first byte, bytes, text offsets)``; a very long text comes in overlapping pieces."""
    if len(block.data) <= _PIECE + length:
        yield 0, block.data, block.offsets
        return
    for at in range(0, max(len(block.data) - length + 1, 1), _PIECE):
        part = block.data[at:at + _PIECE + length - 1]
        yield at, part, np.array([0, len(part)])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text number, first window, number of windows, the anchor's place in the first, anchor and context hashes."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    sums = _ANCHOR.prefix(data)
    at = np.arange(len(data) - gram + 1)
    hashes = RollingHash.ranges(sums, at, at + gram)
    least = (hashes & ~U((1 << 24) - 1)) | at.astype(U)  # ties go to the leftmost
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[:have - width], least[width - have:])
    place = (least & U((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(len(place) + 1, dtype=np.int64)
    long = offsets[1:] - offsets[:-1] >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    fresh = valid.copy()
    fresh[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    start = np.flatnonzero(fresh)
    last = valid.copy()
    last[:-1] &= (place[1:] != place[:-1]) | ~valid[1:]
    end = np.flatnonzero(last) + 1
    context = mix64(RollingHash.ranges(_CONTEXT.prefix(data), start, end + length - 1)
                    + U(1024) * (place[start] - start).astype(U) + (end - start).astype(U))
    owner = np.searchsorted(offsets, start, side="right") - 1
    return owner, start - offsets[owner], end - start, place[start] - start, hashes[place[start]], context


def _find(length: int, gram: int, brief: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = None if brief else batch.column(1).cast(pa.int64())
            keys = None if brief else batch.column(2)
            for block in blocks(batch.column(0)):
                for base, data, offsets in _pieces(block, length):
                    owner, start, count, off, anchor, context = anchors(data, offsets, length, gram)
                    anchor = pa.array(anchor.view(np.int64))
                    if brief:
                        yield pa.RecordBatch.from_arrays([anchor], names=["anchor"])
                        continue
                    rows = pa.array(owner + block.lo)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(rows), keys.take(rows), pa.array((start + base).astype(np.int32)), pa.array(count.astype(np.int16)),
                         pa.array(off.astype(np.int16)), anchor, pa.array(context.view(np.int64))], names=["id", "key", "at", "n", "off", "anchor", "context"])
    return run


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Which windows of each text also start elsewhere among the texts; texts are at most 512 bytes.

    Sorts all suffixes by their first 640 bytes (rank doubling), takes the
    run-length form of the transform, samples position and neighbour's match
    length at the run ends, and streams the lengths of all other positions
    from them. Position 0 of a text always ends runs, so no length is streamed
    from one text into the next.
    """
    joined = b"\xff".join(texts) + b"\xff" * _DEPTH  # \xff is in no UTF-8 text
    data = np.frombuffer(joined, dtype=np.uint8)
    n = len(data) - _DEPTH
    if n >= 1 << 21:
        raise ValueError("a block holds less than 2 MiB")
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    # A sort key holds two ranks and the position in 21 bits each, so plain sorting orders the positions.
    at, low = np.arange(n, dtype=U), U((1 << 21) - 1)
    packed = np.zeros(n, dtype=U)
    for k in range(5):
        packed = (packed << U(8)) | data[k:k + n]
    levels, depth = [], 5
    while True:
        ordered = np.sort((packed << U(21)) | at)
        order = (ordered & low).astype(np.int64)
        ordered >>= U(21)
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]), dtype=np.int32)
        levels.append((depth, rank))
        if depth >= _DEPTH or rank[order[-1]] == n - 1:
            break
        packed = rank.astype(U) << U(21)
        packed[:max(n - depth, 0)] |= rank[depth:].astype(U) + U(1)
        depth *= 2
    before = np.empty(n, dtype=np.int64)
    before[1:] = data[:n - 1]
    before[starts[:-1]] = -1 - np.arange(len(texts))  # every text starts a run of its own
    transform = before[order]
    head = np.flatnonzero(transform[1:] != transform[:-1]) + 1  # first rows of runs; the row above ends one
    a, b = order[head - 1], order[head]
    match = np.zeros(len(head), dtype=np.int64)
    for depth, rank in reversed(levels):
        x, y = np.minimum(a + match, n - 1), np.minimum(b + match, n - 1)
        match[(rank[x] == rank[y]) & (a + match < n) & (b + match < n)] += depth
    for _ in range(4):
        more = data[np.minimum(a + match, n)] == data[np.minimum(b + match, n)]
        if not more.any():
            break
        match += more
    reach = np.zeros(n, dtype=np.int64)
    np.maximum.at(reach, a, a + match)
    np.maximum.at(reach, b, b + match)
    statistics = np.maximum.accumulate(reach) - np.arange(n)
    return [statistics[s:s + max(len(t) - length + 1, 0)] >= length for s, t in zip(starts.tolist(), texts, strict=False)]


def _runs(flags: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """Byte ranges that the flagged windows cover."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + length - 1).tolist()


def _index(length: int) -> Callable:
    """Blocks of whole anchor groups (rows sorted by anchor) to spans of the contexts that occur once."""
    def solve(rows: list) -> Iterator[pa.RecordBatch]:
        out = []
        for row, flags in zip(rows, repeated_windows([r["piece"] for r in rows], length), strict=True):
            if row["copies"] == 1 and flags.any():
                out += [(row["id"], row["key"], row["at"] + s, row["at"] + e) for s, e in zip(*_runs(flags, length), strict=True)]
        names, kinds = ["id", "key", "start", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held >= INDEX_BYTES and row["anchor"] != rows[-1]["anchor"]:
                    yield from solve(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row["piece"])
        if rows:
            yield from solve(rows)
    return run


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts, cut from the texts that hold them."""
    for batch in batches:
        texts, cols = batch.column(0), {k: [] for k in ("anchor", "context", "copies", "wide", "id", "key", "at", "off", "piece")}
        for text, wanted in zip(texts, batch.column(1).to_pylist(), strict=True):
            raw = text.as_buffer() if text.is_valid else b""
            view = memoryview(raw)
            for w in wanted:
                for k in ("anchor", "context", "copies", "wide", "id", "key", "at", "off"):
                    cols[k].append(w[k])
                cols["piece"].append(bytes(view[w["at"]:w["at"] + w["n"] + length - 1]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[k], t) for k, t in zip(cols, kinds, strict=True)], names=list(cols))


def _stretches(length: int, width: int) -> Callable:
    """Cut contexts into stretches of at most ``width`` windows, at anchor-relative places.

    ``core`` hashes the bytes that all windows of a stretch share, so equal
    windows lie in stretches of equal core; ``whole`` hashes the stretch.
    """
    names = ["core", "whole", "place", "id", "key", "at", "n", "copies", "piece"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                raw = np.frombuffer(row["piece"], dtype=np.uint8)
                n = len(raw) - length + 1
                rel = row["off"] - np.arange(n)  # the anchor's place in each window
                first = np.flatnonzero(np.concatenate([[True], rel[1:] // width != rel[:-1] // width]))
                count = np.diff(np.concatenate([first, [n]]))
                begin = row["off"] - rel[first] // width * width
                core = RollingHash.ranges(_ANCHOR.prefix(raw), begin, begin + length - width + 1)
                whole = RollingHash.ranges(_WINDOW.prefix(raw), first, first + count + length - 1)
                for k, (s, c) in enumerate(zip(first.tolist(), count.tolist(), strict=True)):
                    out.append((core[k], whole[k], rel[s], row["id"], row["key"], row["at"] + s, c, row["copies"], row["piece"][s:s + c + length - 1]))
            cols = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(c, dtype=U).view(np.int64)) if k < 2 else pa.array(c, t) for k, (c, t) in enumerate(zip(cols, kinds, strict=True))], names=names)
    return run


def _each_window(length: int) -> Callable:
    """Single windows of stretches, as 128-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            count = [len(r["piece"]) - length + 1 for r in rows]
            hashes = [[np.zeros(0, dtype=U)], [np.zeros(0, dtype=U)]]
            for row, n in zip(rows, count, strict=True):
                raw, at = np.frombuffer(row["piece"], dtype=np.uint8), np.arange(n)
                for k, h in enumerate((_ANCHOR, _WINDOW)):
                    hashes[k].append(RollingHash.ranges(h.prefix(raw), at, at + length))
            spread = lambda name: np.repeat(np.array([r[name] for r in rows], dtype=np.int64), count)
            start = spread("at") + np.concatenate([np.arange(n) for n in [0, *count]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes[0]).view(np.int64)), pa.array(np.concatenate(hashes[1]).view(np.int64)),
                 pa.array([r["id"] for r, n in zip(rows, count, strict=True) for _ in range(n)], pa.int64()), pa.array(spread("key")),
                 pa.array(start.astype(np.int32)), pa.array(spread("copies"))], names=["one", "two", "id", "key", "start", "copies"])
    return run


def _strip(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = memoryview(text.as_buffer() if text.is_valid else b"")
                merged: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                sha, at = hashlib.sha256(), 0
                for s, e in merged:
                    sha.update(raw[at:s])
                    at = e
                sha.update(raw[at:])
                out.append((len(raw), sum(e - s for s, e in merged), merged, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 pa.array([x[2] for x in out], pa.list_(pa.list_(pa.int64()))), pa.array([x[3] for x in out], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "removed", "kept_sha256"])
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Byte spans ``(id, key, start, end)`` of ``docs(id, key, text)`` that repeated windows cover; spans may overlap."""
    if not gram < length <= 256:
        raise ValueError("the index takes 256 bytes at most, and an anchor shorter than that")
    often = staged(docs.select("text").mapInArrow(_find(length, gram, brief=True), "anchor bigint")
                   .groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    found = staged(_among(docs.select("text", "id", "key")
                          .mapInArrow(_find(length, gram, brief=False), "id bigint, key bigint, at int, n smallint, off smallint, anchor bigint, context bigint"),
                          often, ["anchor"]))
    distinct = staged(found.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "key", "at", "n", "off")).alias("x")).select("anchor", "context", "copies", "x.*"))
    twice = distinct.where("copies > 1").select("anchor", "context", F.col("copies").alias("n"))
    whole = (_among(found, twice, ["anchor", "context"])
             .select("id", "key", F.col("at").alias("start"), (F.col("at") + F.col("n") + F.lit(length - 1)).cast("int").alias("end")))
    # Anchors with contexts that differ, one of which at least is not settled.
    mixed = (distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.min("copies").alias("least"))
             .where("contexts > 1 and least = 1").select("anchor", (F.col("contexts") > group).alias("wide")))
    wanted = (distinct.join(mixed, "anchor").groupBy("id", "key")
              .agg(F.collect_list(F.struct("anchor", "context", "copies", "wide", "id", "key", "at", "n", "off")).alias("wanted")))
    pieces = staged(docs.join(wanted.withColumnsRenamed({"id": "w_id", "key": "w_key"}),
                              F.col("id").eqNullSafe(F.col("w_id")) & (F.col("key") == F.col("w_key")))
                    .select("text", "wanted")
                    .mapInArrow(lambda b: _cut(b, length), "anchor bigint, context bigint, copies bigint, wide boolean, id bigint, key bigint, at int, off smallint, piece binary"))
    narrow = (pieces.where("not wide").repartition("anchor").sortWithinPartitions("anchor")
              .mapInArrow(_index(length), "id bigint, key bigint, start int, end int"))
    return whole.unionByName(narrow).unionByName(_wide_spans(pieces.where("wide"), length))


def _among(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The ``rows`` whose key is one of ``keys``, which say in ``n`` how many rows a key has.

    A key with more than a ``HOT``-th of all these rows is dealt over ``SALTS`` tasks. As the counts add up to
    all, there are at most ``HOT`` such keys; only they are broadcast.
    """
    total = keys.agg(F.sum("n")).first()[0] or 0
    least = max(total // HOT, LEAST_HOT)
    hot = keys.where(F.col("n") > least).select(*on, F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("salt", salt).drop("hot")
    places = F.when(F.col("n") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(keys.select(*on, F.explode(places).alias("salt")), [*on, "salt"], "left_semi").drop("salt").select(*rows.columns)


def _wide_spans(pieces: DataFrame, length: int, width: int = 8) -> DataFrame:
    """The same for anchors with many contexts: stretches of a few windows meet by what all their windows share.

    As with anchors and contexts, equal stretches are repeated as a whole, and
    only stretches that differ around an equal core are counted window by window.
    """
    stretches = staged(pieces.mapInArrow(_stretches(length, width),
                                         "core bigint, whole bigint, place int, id bigint, key bigint, at int, n int, copies bigint, piece binary"))
    form = ["core", "whole", "place"]
    forms = staged(stretches.groupBy(*form).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"), F.min(F.struct("id", "key", "at", "piece")).alias("x"))
                   .select(*form, "copies", "rows", "x.*"))
    end = (F.col("at") + F.col("n") + F.lit(length - 1)).cast("int")
    whole = (_among(stretches.where("copies = 1"), forms.where("copies > 1").select(*form, F.col("rows").alias("n")), form)
             .select("id", "key", F.col("at").alias("start"), end.alias("end")))
    mixed = forms.groupBy("core").agg(F.count(F.lit(1)).alias("forms"), F.min("copies").alias("least")).where("forms > 1 and least = 1").select("core")
    windows = staged(forms.join(mixed, "core").select("id", "key", "at", "copies", "piece").mapInArrow(
        _each_window(length), "one bigint, two bigint, id bigint, key bigint, start int, copies bigint"))
    again = staged(windows.groupBy("one", "two").agg(F.sum("copies").alias("c"), F.count(F.lit(1)).alias("n")).where("c > 1").select("one", "two", "n"))
    broad = (_among(windows.where("copies = 1"), again, ["one", "two"])
             .select("id", "key", "start", (F.col("start") + length).alias("end")))
    return whole.unionByName(broad)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, removed, kept_sha256`` per row; ``removed`` lists maximal ``[start, end)`` runs."""
    told = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("key"), "text")
    spans = (repeated_spans(told, length, gram, group).groupBy(F.col("id").alias("s_id"), F.col("key").alias("s_key"))
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))  # rows that repeat id and text share their spans
    joined = told.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")), "left")
    return joined.select("id", "text", "spans").mapInArrow(
        _strip(length), "doc_id bigint, n_bytes bigint, n_removed bigint, removed array<array<bigint>>, kept_sha256 string")
