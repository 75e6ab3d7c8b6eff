"""Connected components of a link table, by local union-find and then star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one batch: each node to its smallest local root."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x: int, parent=parent) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = [(x, find(x)) for x in parent]
        pairs = [(x, r) for x, r in pairs if x != r]
        yield pa.RecordBatch.from_pydict(
            {"u": pa.array([x for x, _ in pairs], pa.int64()), "v": pa.array([r for _, r in pairs], pa.int64())})


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: hang neighbours on the smallest of the neighbourhood.

    The smallest comes from a map-side combined aggregate, so a node with very
    many links sends one partial row per task; links then join that one row.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(u, v)``; the component is its smallest node.

    Each task first contracts its own links by union-find; large and small star
    steps then run until every node hangs on the smallest of its component.
    Nodes without links are absent. No links: an empty table.
    """
    links = staged(links.select("u", "v").where("u <> v").mapInArrow(_contract, "u bigint, v bigint"))
    while True:
        links = staged(_star(_star(links, large=True), large=False))
        # A forest of stars: every node has one parent, and no parent has one.
        loose = (links.groupBy("u").count().where("count > 1").select("u")
                 .unionByName(links.join(links.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")))
        if loose.isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
