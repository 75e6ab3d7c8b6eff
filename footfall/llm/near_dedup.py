"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

A text's set is its distinct word shingles (A-Z lower-cased; words are
``[^\\x20\\x09-\\x0D]+``). With fewer words than a shingle, the whole
sequence is one shingle; without words the set is empty and links with
nothing. Two texts link when 100 * shared >= percent * united shingles.

How the work is spread:

* one pass turns every whole text into its set's size, a 128-bit digest and
  the hashes of its signature's bands; texts are not shuffled;
* texts with the same set become one class (a map-side combined aggregate),
  so copies are never paired;
* each band bucket names a leader per random order, by a map-side combined
  aggregate. Members are verified against leaders, not against each other.
  Members of buckets that then still hold different components go to a second
  pass, so no link between different texts is lost: similar sets must share
  one of their rarest shingles, and sets of different components that do are
  verified. An edited copy's rarest shingles are its own, so the many distant
  copies of one text do not meet;
* verification reads full sets, of the texts in question only.

Rows: one result per input row. Classes are named by their sets, not by ids:
two texts of one ``doc_id`` are two nodes and may lie in different components,
and rows without ``doc_id`` link like others. ``component_id`` is the smallest
id of a component (null where none of its rows has one); ``kept`` says whether
it is the row's own id, so of rows that repeat an id and a text all are kept or
none. ``one_of_each`` decides by row instead. Null or empty texts have 0
shingles, are their own component and are kept. Extra columns are ignored;
only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged, unused
from footfall.llm.components import components
from footfall.llm.textkit import LOWER, Block, RollingHash, U, blocks, grams, mix64, words

BANDS, ROWS = 40, 6  # a pair of similarity 0.8 shares no band with probability 5e-6, one of 0.2 some with 3e-3
FREQUENCIES = 1 << 19
ORDERS = 8  # random orders by which buckets choose leaders
_HASH = RollingHash(11)
_CHUNK = 1 << 17  # elements whose permutations are held at once


def shingle_sets(block: Block, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block."""
    block = Block(block.lo, block.hi, LOWER[block.data], block.offsets)
    w = words(block)
    single = RollingHash.ranges(_HASH.prefix(block.data), w.start, w.end)
    full = grams(single, n)
    out = []
    for first, count in zip(w.first.tolist(), w.count.tolist(), strict=True):
        if count >= n:
            out.append(np.unique(full[first:first + count - n + 1]))
        elif count:
            out.append(grams(single[first:first + count], count) ^ U(count))
        else:
            out.append(np.zeros(0, dtype=U))
    return out


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, one row of ``m`` registers per set.

    Every element draws a random permutation of the registers (Fisher-Yates)
    and offers register ``p[j]`` the value ``j`` plus a random fraction. Step
    ``j`` runs for all elements of all sets at once; a set stops as soon as no
    register can still improve. Empty sets keep the largest value.
    """
    out = np.full(len(sets) * m, np.iinfo(np.uint64).max, dtype=U)
    if not sets:
        return out.reshape(0, m)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for at in range(0, len(every), _CHUNK):
        h, doc = every[at:at + _CHUNK], owner[at:at + _CHUNK]
        rows = np.arange(len(h))
        perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(h), 1))
        for j in range(m):
            x = mix64(h + U(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
            k = j + (((x >> U(32)) * U(m - j)) >> U(32)).astype(np.int64)
            register = perm[rows, k].astype(np.int64)
            perm[rows, k] = perm[rows, j]
            value = (U(j) << U(48)) | (mix64(x ^ U(0xA5A5A5A5)) >> U(16))
            np.minimum.at(out, doc * m + register, value)
            lo, hi = doc[0], doc[-1] + 1
            worst = out[lo * m:hi * m].reshape(-1, m).max(axis=1)
            live = (worst >= U(j + 1) << U(48))[doc - lo]
            if not live.all():
                h, doc, rows = h[live], doc[live], rows[live]
                if not len(h):
                    break
    return out.reshape(len(sets), m)


def _describe(n: int, number_of_bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(batch.column(1)):
                sets = shingle_sets(block, n)
                signature = superminhash(sets, number_of_bands * rows).reshape(len(sets), number_of_bands, rows)
                keys = np.broadcast_to(mix64(np.arange(1, number_of_bands + 1, dtype=U)), signature.shape[:2]).copy()
                for k in range(rows):
                    keys = mix64(keys * U(0x9FB21C651E98DF25) + signature[:, :, k])
                size = np.array([len(s) for s in sets], dtype=np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, number_of_bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(block.lo, block.hi - block.lo), batch.column(2).slice(block.lo, block.hi - block.lo), pa.array(size),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[size > 0].reshape(-1).view(np.int64))),
                ], names=["doc_id", "text_hash", "n_shingles", "digest", "bands"])
    return run


def _as_sets(n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.lo, block.hi - block.lo),
                    pa.array([s.tobytes() for s in shingle_sets(block, n)], pa.binary())], names=["node", "members"])
    return run


def _similar(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, dtype=U), np.frombuffer(b, dtype=U)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(FREQUENCIES, dtype=np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            np.add.at(counts, (np.frombuffer(raw, dtype=U) % U(FREQUENCIES)).astype(np.int64), 1)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])


def _frequencies(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle, counted in ``FREQUENCIES`` hashed slots (all that comes to the driver)."""
    out = np.zeros(FREQUENCIES, dtype=np.int32)
    for r in sets.select("members").mapInArrow(_tally, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r.slot] = min(r.n, np.iinfo(np.int32).max)
    return out


def _rarest(percent: int, counts: np.ndarray) -> Callable:
    """Each set's rarest shingles, so many that two similar sets must share one of them.

    Any common order of shingles is right; the counts only make it a good one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = []
            for raw in batch.column("members").to_pylist():
                s = np.frombuffer(raw, dtype=U)
                order = np.lexsort((s, counts[(s % U(FREQUENCIES)).astype(np.int64)]))
                tokens.append(s[order[:len(s) - (percent * len(s) + 99) // 100 + 1]])
            rows = pa.array(np.repeat(np.arange(len(tokens)), [len(x) for x in tokens]))
            place = pa.array(np.concatenate([np.arange(len(x)) for x in [[], *tokens]]).astype(np.int64))
            flat = np.concatenate([*tokens, np.zeros(0, dtype=U)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), *(batch.column(c).take(rows) for c in ("node", "size", "part")), place],
                                             names=["token", "node", "size", "part", "place"])
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough."""
    return (pairs.join(sets.select(F.col("node").alias("u"), F.col("members").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("members").alias("b")), "v")
            .select("u", "v", "a", "b").mapInArrow(_similar(percent), "u bigint, v bigint"))


def _sized(percent: int) -> F.Column:
    """Sets whose sizes differ too much cannot be similar."""
    return 100 * F.least("u_size", "v_size") >= percent * F.greatest("u_size", "v_size")


def _clustered(docs: DataFrame, n_words: int, percent: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Every row as ``doc_id, text_hash, n_shingles, digest``, and every set as ``digest, root`` (its component's name)."""
    texts = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("text_hash"))
    described = staged(texts.mapInArrow(
        _describe(n_words, bands, rows), "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, bands array<bigint>"))
    # A class is read again through one of its rows: one with an id, where there is one.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = staged(described.where("n_shingles > 0").groupBy("digest")
                     .agg(F.min(row).alias("row"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
                     .withColumn("node", F.monotonically_increasing_id()))
    members = classes.select(F.explode("bands").alias("bucket"), "node", "size", "digest")
    order = F.pmod(F.col("bucket"), F.lit(ORDERS))
    chosen = (members.groupBy("bucket")
              .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64(order, "digest").alias("h"), "node", "size")).alias("x"))
              .where("n > 1").select("bucket", F.col("x.node").alias("u"), F.col("x.size").alias("u_size")))
    # Only buckets that hold two classes matter from here on.
    shared = staged(members.drop("digest").join(chosen, "bucket").select("bucket", "node", "size", "u", "u_size"))
    first = staged(shared.where("u <> node").select("u", "u_size", F.col("node").alias("v"), F.col("size").alias("v_size"))
                   .where(_sized(percent)).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())

    involved = (classes.join(shared.select("node").distinct(), "node", "left_semi")
                .select("node", F.col("row.doc_id").alias("row_id"), F.col("row.text_hash").alias("row_hash")))
    wanted = texts.join(involved, (F.col("text_hash") == F.col("row_hash")) & F.col("doc_id").eqNullSafe(F.col("row_id")))
    # A row that stands many times is read as often, but its set counts once.
    sets = staged(wanted.select("node", "text").mapInArrow(_as_sets(n_words), "node bigint, members binary")
                  .groupBy("node").agg(F.first("members").alias("members")))
    links = staged(_verified(first, sets, percent))
    found = components(links)

    # Second pass: members of buckets that still hold different components, by their rarest shingles.
    told = (shared.join(found, "node", "left").select("bucket", "node", "size", F.coalesce("component", "node").alias("part")))
    split = told.groupBy("bucket").agg(F.min("part").alias("a"), F.max("part").alias("z")).where("a <> z").select("bucket")
    open_ = staged(told.join(split, "bucket", "left_semi").select("node", "size", "part").distinct())
    kept = staged(sets.join(open_, "node").select("node", "size", "part", "members"))
    rare = staged(kept.mapInArrow(_rarest(percent, _frequencies(kept)), "token bigint, node bigint, size bigint, part bigint, place bigint"))
    sides = [rare.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "size", "part", "place")]) for side in "uv"]
    # The first shingle that two sets share, in the common order, has all others behind it in both.
    enough = F.expr(f"least(u_size - u_place, v_size - v_place) * {100 + percent} >= {percent} * (u_size + v_size)")
    rest = (sides[0].join(sides[1], "token").where((F.col("u_node") < F.col("v_node")) & (F.col("u_part") != F.col("v_part")) & _sized(percent) & enough)
            .select(F.col("u_node").alias("u"), F.col("v_node").alias("v")).distinct().join(first, ["u", "v"], "left_anti"))
    more = staged(_verified(rest, sets, percent))
    if not more.isEmpty():
        found = components(links.unionByName(more))
    return described.drop("bands"), classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("root"), F.col("row.doc_id").alias("first_id"))


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``; see the module's text."""
    described, classes = _clustered(docs, n_words, percent, bands, rows)
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = classes.join(least, "root").select("digest", "component_id", F.lit(True).alias("real"))
    return (described.withColumn("digest", F.when(F.col("n_shingles") > 0, F.col("digest"))).join(named, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("real"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each(docs: DataFrame, n_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` without all but one row of each component, in the columns of ``docs``.

    The row that stays has the smallest id of its component (rows without id come last), of several
    texts of that id the one with the smaller hash, and of rows that repeat both an arbitrary one. Rows
    whose text has no words all stay.
    """
    described, classes = _clustered(docs, n_words, percent, bands, rows)
    taken = unused(docs, "row_id", "row_hash", "copies")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    rooted = described.where("n_shingles > 0").groupBy("digest", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).join(classes.select("digest", "root"), "digest")
    first = rooted.groupBy("root").agg(F.min(at).alias("first"))
    judged = (rooted.join(first, "root").withColumn("stays", at == F.col("first")).where("not stays or n > 1")
              .select(F.col("doc_id").alias(taken[0]), F.col("text_hash").alias(taken[1]), F.when(F.col("stays"), F.col("n")).otherwise(0).alias(taken[2])))
    own = F.col("doc_id").cast("bigint").eqNullSafe(F.col(taken[0])) & (F.xxhash64("text") == F.col(taken[1]))
    met = docs.join(staged(judged), own, "left")
    # Rows that repeat both id and text are told apart by a number among themselves; there are none in most tables.
    own_columns = [F.col(f"`{c}`") for c in docs.columns]
    single = met.where(F.col(taken[2]).isNull()).select(*own_columns)
    again = met.where(F.col(taken[2]) > 0).select(*own_columns)
    return single.unionByName(_one_row_each(again))


def _one_row_each(rows: DataFrame) -> DataFrame:
    """One of the rows of every (doc_id, text)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    kept = rows.groupBy(F.col("doc_id").alias("a"), F.col("text").alias("b")).agg(F.first(whole).alias("c"))
    return kept.select("c.*")
