"""Sharding by histogram sort: shards of near equal bytes, in key order.

A row's key is the hash of its text, then the hash of its doc_id, so equal
texts are neighbours. Seven splitters cut eight shards of near equal bytes.
They are found by counting: probes cut the interval around each missing
splitter into 512 parts, the exact bytes below every probe are summed over all
partitions (at most 7 * 512 rows come back), and the interval that holds the
target is probed again until a probe is within ``tolerance`` of a shard's
bytes. Only a text whose copies outweigh the tolerance is cut by doc_id. Then
rows are exchanged once, to number them within their shard.

Numbering needs no task that holds a shard: rows are numbered within one of
at most 65 536 key ranges, whose starting numbers are running sums of counts.

Rows: one result per input row. Null texts have size 1 and the checksum of an
empty text. Rows equal in doc_id and text share a key and a shard, and get
different slots. Extra columns are ignored; doc_id and text are read. With
fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import staged

TOLERANCE = 0.001
_STEP, _HALF = 9, 63  # bits a round, bits of each half of the key


def splitters(keyed: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Keys ``(k1, k2)`` at which shards 1, 2, ... begin, from ``keyed(k1, k2, size)``."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    # Of each missing splitter: its target, the interval's key prefix, and the bytes below the interval.
    open_ = {k: (0, 0) for k in range(1, shards)}
    found: dict[int, int] = {}
    for depth in range(0, 2 * _HALF, _STEP):
        if not open_ or not total:
            break
        prefixes = sorted({p for p, _ in open_.values()})
        if depth < _HALF:
            inside = F.shiftright("k1", _HALF - depth).isin(prefixes) if depth else F.lit(True)
            part = F.shiftright("k1", _HALF - depth - _STEP)
            rows = keyed.where(inside).groupBy(part.alias("part")).agg(F.sum("size").alias("bytes")).collect()
            sums = {r.part: r.bytes for r in rows}
        else:
            sums, deep = {}, depth - _HALF
            for k1 in sorted({p >> deep for p in prefixes}):
                own = [p & ((1 << deep) - 1) for p in prefixes if p >> deep == k1]
                inside = F.shiftright("k2", _HALF - deep).isin(own) if deep else F.lit(True)
                for r in (keyed.where((F.col("k1") == k1) & inside).groupBy(F.shiftright("k2", _HALF - deep - _STEP).alias("part"))
                          .agg(F.sum("size").alias("bytes")).collect()):
                    sums[(k1 << (deep + _STEP)) | r.part] = r.bytes
        left = 2 * _HALF - depth - _STEP
        for k, (prefix, below) in list(open_.items()):
            target = total * k / shards
            for part in range(prefix << _STEP, (prefix + 1) << _STEP):
                upto = below + sums.get(part, 0)
                if upto >= target or part + 1 == (prefix + 1) << _STEP:
                    near, edge = min((target - below, part), (upto - target, part + 1))
                    if near <= tolerance * total / shards or not left:
                        found[k] = edge << left
                        del open_[k]
                    else:
                        open_[k] = (part, below)
                    break
                below = upto
    return [(found.get(k, 0) >> _HALF, found.get(k, 0) & ((1 << _HALF) - 1)) for k in range(1, shards)]


def assign(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = staged(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("k1"), F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 1).alias("k2")))
    shard = F.lit(0)
    for k1, k2 in splitters(keyed, shards, tolerance):
        shard = shard + F.when((F.col("k1") > k1) | ((F.col("k1") == k1) & (F.col("k2") >= k2)), 1).otherwise(0)
    # Key ranges: 1024 by text and 64 by document.
    rows = keyed.withColumn("shard", shard.cast("int")).withColumn(
        "range", (F.shiftright("k1", 53) * 64 + F.shiftright("k2", 57)).cast("int"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("shard", "range").count()
              .select("shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("shard", "range").orderBy("k1", "k2", "doc_id")
    numbered = rows.withColumn("nth", F.row_number().over(within))
    # At most 65 536 ranges and one more per splitter and document slice.
    return (numbered.join(F.broadcast(starts), ["shard", "range"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).alias("slot")))
