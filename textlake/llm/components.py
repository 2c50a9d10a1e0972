"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.workspace import land

#: Links that one union-find takes before it hands on its forest.
FOREST_LINKS = 500_000


def _forest(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) by union-find, without the roots themselves."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
        parent.setdefault(low, low)
    return [(x, r) for x in list(parent) if (r := find(x)) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links: list[tuple[int, int]] = []

    def flush() -> pa.RecordBatch:
        forest = _forest(links)
        links.clear()
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in forest], pa.int64()) for i in (0, 1)], ["u", "v"])

    for batch in batches:
        links += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        if len(links) >= FOREST_LINKS:
            yield flush()
    yield flush()


def _settled(edges: DataFrame) -> bool:
    """Is each component a star, its members tied to its smallest node and to nothing else?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.where("up > 1 or up > 0 and down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `links`, two columns of ids without nulls.

    The component is its smallest node. Every task first replaces its links by the
    forest that a union-find makes of them; then each node is tied to the smallest
    node it sees, from its larger neighbours and to its smaller ones in turn, until
    each component is a star. Every round is written to the shared folder; only whether
    one more is needed reaches the driver.
    """
    a, b = links.columns
    # u > v in every row
    edges = land(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").mapInArrow(_contract, "u long, v long").distinct(), "links")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select("u", F.col("m").alias("v")).unionByName(tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = land(small.distinct(), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
