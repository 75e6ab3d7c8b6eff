"""Vector code compression: a codebook per part, assigned with Drake and Hamerly's adaptive bounds.

Components become integers floor(256 * x). Vectors are cut into ``PARTS``
equal parts; a part position's codebook starts as that part of the vectors of
the ``ENTRIES`` smallest ids and is refined ``ROUNDS`` times: every part goes
to its nearest entry (squared Euclidean distance, ties to the lower index),
and an entry becomes the componentwise floor of its parts' mean (an entry
without parts stays). Then parts are assigned once more.

Only the first assignment measures all entries. It keeps, for every part, the
``b`` closest entries after its own with ordered lower bounds of their
distances, and one outer bound for all others. When entries move, a lower bound
falls by its entry's movement and the outer bound by the largest movement. A
part whose exact distance to its own entry is below all bounds stays; below the
outer bound alone, only the kept entries are measured; otherwise all are.
Whatever the bounds leave open is decided on integers, so the codes are those
of a full search. ``b`` starts at a quarter of the entries and follows the
depth that the parts of a batch needed, down to an eighth.

How the work is spread: vectors never move. A round reads the table with its
bounds, writes the next one to the shared folder (the one before is removed)
and adds up its parts inside tasks: one row per entry and component leaves a
task, and as many (``ENTRIES`` times the vector's length) reach the driver.
Bounds are two bytes each. The last assignment writes codes only.

Rows: one result per kept row. Rows whose vector is null or has null or
non-finite components are dropped. Vectors shorter than the longest one, and
lengths that are no multiple of ``PARTS``, are filled up with zeros. Rows with
a null id are coded but start no entry; an id that stands more than once gives
one entry, from its smallest vector. With fewer ids than ``ENTRIES`` the
codebook is smaller; with none at all (no rows, or null ids alone) it is one
entry of zeros. Components of 2**20 or more in size are an error, as the errors
returned are 64-bit integers. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import discard, staged

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LARGEST = 1 << 28
_NEVER = 0xFFFF  # a bound beyond every distance
_ROWS = 2048  # rows coded at once
_STATE = "vec_id bigint, label {label}, ints binary, codes binary, near binary, bounds binary"


def integers(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, v``: the kept rows, their components as integers."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return (vectors.where(x.isNotNull() & finite)
            .select(F.col("vec_id").cast("bigint"), F.col(f"`{label}`").alias("label"), x.alias("x"))
            .select("vec_id", "label", F.transform("x", lambda c: F.floor(c.cast("double") * 256)).alias("v")))


class Codebooks:
    """The entries of every part, and what is needed to bound distances between versions of them."""

    def __init__(self, entries: np.ndarray, largest: int):
        self.entries = entries  # part, entry, position
        self.parts, self.n, self.width = entries.shape
        # The unit in which bounds are kept: two bytes hold the largest distance there can be.
        self.unit = max(2.0 * (largest + 1) * np.sqrt(self.width) / (_NEVER - 2), 1e-6)
        # Products of floats are exact up to 2**53; beyond, distances are taken integer by integer.
        self.small = 8 * self.width * (largest + 1) ** 2 < 1 << 52
        self.squares = (entries.astype(np.int64) ** 2).sum(axis=2)

    def every(self, part: int, x: np.ndarray) -> np.ndarray:
        """Squared distances of the rows of ``x`` to all entries of ``part``."""
        c = self.entries[part]
        if self.small:
            product = (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
            return (x * x).sum(axis=1)[:, None] - 2 * product + self.squares[part]
        return np.stack([((x - e) ** 2).sum(axis=1) for e in c], axis=1)

    def some(self, part: int, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared distances of each row of ``x`` to its own entries ``at``."""
        return ((x[:, None, :] - self.entries[part][at]) ** 2).sum(axis=2)

    def down(self, squared: np.ndarray) -> np.ndarray:
        """Distances as bounds, rounded down."""
        return np.floor(np.sqrt(squared.astype(np.float64)) * (1 - 1e-9) / self.unit)

    def moves(self, before: Codebooks) -> np.ndarray:
        """How far every entry moved, in units, rounded up."""
        squared = ((self.entries - before.entries) ** 2).sum(axis=2).astype(np.float64)
        return np.ceil(np.sqrt(squared) * (1 + 1e-9) / self.unit)


def _closest(books: Codebooks, part: int, x: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A full search: own entry, its squared distance, the ``b`` next entries, and their bounds with the outer one."""
    squared = books.every(part, x)
    rows = np.arange(len(x))
    own = squared.argmin(axis=1)
    least = squared[rows, own]
    squared[rows, own] = np.iinfo(np.int64).max
    order = np.argsort(squared, axis=1)[:, :b + 1]
    bounds = np.full((len(x), b + 1), float(_NEVER))
    real = min(b + 1, books.n - 1)
    bounds[:, :real] = books.down(squared[rows[:, None], order[:, :real]])
    near = np.zeros((len(x), b), dtype=np.int64)
    near[:, :min(b, books.n - 1)] = order[:, :min(b, books.n - 1)]
    return own, least, near, bounds


def _update(books: Codebooks, moves: np.ndarray, part: int, x: np.ndarray, own: np.ndarray, near: np.ndarray, bounds: np.ndarray):
    """One assignment by bounds. Returns own, squared distance, near, bounds and the depth that each row needed."""
    b = near.shape[1]
    real = bounds < _NEVER
    bounds[:, :b] -= np.where(real[:, :b], moves[part][near], 0)
    bounds[:, b] -= np.where(real[:, b], moves[part].max(), 0)
    np.maximum(bounds, 0, out=bounds)
    order = np.argsort(bounds[:, :b], axis=1, kind="stable")
    near = np.take_along_axis(near, order, axis=1)
    bounds[:, :b] = np.take_along_axis(bounds[:, :b], order, axis=1)
    least = books.some(part, x, own[:, None])[:, 0]
    reach = np.sqrt(least.astype(np.float64)) * (1 + 1e-9) / books.unit
    depth = (bounds[:, :b] <= reach[:, None]).sum(axis=1)
    lost = bounds[:, b] <= reach
    depth[lost] = b + 1

    unsure = np.flatnonzero((depth > 0) & ~lost)
    if len(unsure):
        at = np.concatenate([own[unsure, None], near[unsure]], axis=1)
        squared = books.some(part, x[unsure], at)
        squared[:, 1:][bounds[unsure, :b] >= _NEVER] = np.iinfo(np.int64).max  # places that hold no entry
        order = np.lexsort((at, squared))  # by distance, then by index
        at, squared = np.take_along_axis(at, order, axis=1), np.take_along_axis(squared, order, axis=1)
        own[unsure], least[unsure], near[unsure] = at[:, 0], squared[:, 0], at[:, 1:]
        held = squared[:, 1:] < np.iinfo(np.int64).max
        bounds[unsure, :b] = np.where(held, books.down(np.where(held, squared[:, 1:], 0)), _NEVER)
    full = np.flatnonzero(lost)
    if len(full):
        own[full], least[full], near[full], bounds[full] = _closest(books, part, x[full], b)
    return own, least, near, bounds, depth


def _cut(near: np.ndarray, bounds: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Keep ``b`` entries; the outer bound then also holds for those let go."""
    outer = bounds[:, :, b:].min(axis=2, keepdims=True)
    return near[:, :, :b], np.concatenate([bounds[:, :, :b], outer], axis=2)


def _binary(a: np.ndarray, kind: type) -> pa.Array:
    a = np.ascontiguousarray(a.reshape(len(a), -1).astype(kind))
    size = a.shape[1] * a.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(a), [None, pa.py_buffer(a.tobytes())]).cast(pa.binary()) if size else pa.array([b""] * len(a), pa.binary())


def _rows(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), *shape)


def _first(books: Codebooks, kind: type, b: int) -> Callable:
    """Rows ``vec_id, label, v`` to the first assignment, with bounds."""
    length = books.parts * books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                v, n = batch.column(2), batch.num_rows
                sizes = np.diff(v.offsets.to_numpy())
                x = np.zeros((n, length), dtype=np.int64)
                x[np.arange(length) < sizes[:, None]] = v.flatten().to_numpy()
                cut = x.reshape(n, books.parts, books.width)
                codes, near, bounds = np.zeros((n, books.parts), np.uint8), np.zeros((n, books.parts, b), np.uint8), np.zeros((n, books.parts, b + 1))
                for p in range(books.parts):
                    codes[:, p], _, near[:, p], bounds[:, p] = _closest(books, p, cut[:, p], b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), _binary(x, kind), _binary(codes, np.uint8), _binary(near, np.uint8), _binary(bounds, np.uint16)],
                    names=["vec_id", "label", "ints", "codes", "near", "bounds"])
    return run


def _next(books: Codebooks, before: Codebooks, kind: type, least_b: int, last: bool) -> Callable:
    """The state of a round to that of the next one; ``last``: to ``vec_id, label, code, error``."""
    moves = books.moves(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # Rows written with different b are not mixed; a task keeps them apart by what it wrote.
            widths = np.array([len(x) for x in whole.column("near").to_pylist()], dtype=np.int64)
            edges = [0, *(np.flatnonzero(widths[1:] != widths[:-1]) + 1).tolist(), len(widths)]
            for lo, hi in ((a, min(a + _ROWS, z)) for s, z in zip(edges, edges[1:], strict=False) for a in range(s, z, _ROWS)):
                batch, n, b = whole.slice(lo, hi - lo), hi - lo, int(widths[lo]) // books.parts
                cut = _rows(batch.column("ints"), kind, books.parts, books.width).astype(np.int64)
                own = _rows(batch.column("codes"), np.uint8, books.parts).astype(np.int64)
                near = _rows(batch.column("near"), np.uint8, books.parts, b).astype(np.int64)
                bounds = _rows(batch.column("bounds"), np.uint16, books.parts, b + 1).astype(np.float64)
                error, deepest = np.zeros(n, dtype=np.int64), 0
                for p in range(books.parts):
                    own[:, p], squared, near[:, p], bounds[:, p], depth = _update(books, moves, p, cut[:, p], own[:, p].copy(), near[:, p].copy(), bounds[:, p].copy())
                    error += squared
                    deepest = max(deepest, int(depth.max(initial=0)))
                if last:
                    codes = own.astype(np.uint8)
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([r.tobytes().hex() for r in codes], pa.string()), pa.array(error)],
                                                     names=["vec_id", "label", "code", "error"])
                else:
                    near, bounds = _cut(near, bounds, min(b, max(least_b, deepest)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id"), batch.column("label"), batch.column("ints"), _binary(own, np.uint8), _binary(near, np.uint8), _binary(bounds, np.uint16)],
                        names=["vec_id", "label", "ints", "codes", "near", "bounds"])
    return run


def _sums(parts: int, n: int, width: int, kind: type) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * n, width), dtype=np.int64), np.zeros(parts * n, dtype=np.int64)
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                x = _rows(batch.column("ints"), kind, parts, width).astype(np.int64)
                entry = _rows(batch.column("codes"), np.uint8, parts).astype(np.int64) + np.arange(parts) * n
                np.add.at(sums, entry.reshape(-1), x.reshape(-1, width))
                counts += np.bincount(entry.reshape(-1), minlength=parts * n)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))), pa.array(sums[used].reshape(-1)), pa.array(np.repeat(counts[used], width))],
            names=["entry", "place", "total", "n"])
    return run


def _refined(books: Codebooks, state: DataFrame, kind: type, largest: int) -> Codebooks:
    sums = (state.select("ints", "codes").mapInArrow(_sums(books.parts, books.n, books.width, kind), "entry bigint, place bigint, total bigint, n bigint")
            .groupBy("entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    entries = books.entries.copy()
    for r in sums.collect():  # a codebook's size
        entries[r.entry // books.n, r.entry % books.n, r.place] = r.total // r.n
    return Codebooks(entries, largest)


def _seeds(kept: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids, by id."""
    ids = [r.vec_id for r in kept.select("vec_id").where("vec_id is not null").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return [[]]
    first = kept.where(F.col("vec_id").between(ids[0], ids[-1])).where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v"))
    return [r.v for r in sorted(first.collect(), key=lambda r: r.vec_id)]


def compress(vectors: DataFrame, vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept row, and the codebooks (part, entry, position).

    ``entries`` is at most 256; a code has two hex digits a part.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    kept = integers(vectors, vector, label)
    size, largest = kept.agg(F.max(F.size("v")), F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0)))).first()
    if (largest or 0) >= LARGEST:
        raise ValueError("a vector has a component of 2**20 or more")
    largest, width = largest or 0, -(-max(size or 0, 1) // parts)
    kind = np.int16 if largest < 1 << 15 else np.int32
    first = _seeds(kept, entries)
    start = np.zeros((len(first), parts * width), dtype=np.int64)
    for k, v in enumerate(first):
        start[k, :len(v)] = v
    books = Codebooks(start.reshape(len(first), parts, width).transpose(1, 0, 2).copy(), largest)
    b = max(1, -(-books.n // 4))
    fields = _STATE.format(label=kept.schema["label"].dataType.simpleString())
    state = staged(kept.mapInArrow(_first(books, kind, b), fields), compression="zstd")
    for k in range(rounds):
        before, books = books, _refined(books, state, kind, largest)
        last = k == rounds - 1
        step = _next(books, before, kind, max(1, b // 2), last)
        found = staged(state.mapInArrow(step, fields if not last else f"vec_id bigint, label {kept.schema['label'].dataType.simpleString()}, code string, error bigint"),
                       compression="zstd")
        discard(state)
        state = found
    if rounds == 0:
        still = _next(books, books, kind, 1, True)
        state = state.mapInArrow(still, f"vec_id bigint, label {kept.schema['label'].dataType.simpleString()}, code string, error bigint")
    return state, books.entries


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, in decimal, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over equal labels (nulls together)."""
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
