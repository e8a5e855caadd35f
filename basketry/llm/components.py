"""Connected components of an edge table: forests of its parts, then alternating large and small stars.

The edges are dealt evenly into parts of a bounded size, whose number grows with the table. Each part keeps one edge a
node, to the least node it reaches there. Star steps join the parts: each is a minimum per vertex (combined before the
shuffle) and a join of the edges with those minima, so a vertex with very many edges is never gathered. Steps
are cut by written tables; the loop ends when the edges are stars around the least node of each component,
which the forest of a table of one part is from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import stage


#: Edges of a part: 16 MB of longs, held several times over.
PART = 1_000_000


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the least node each reaches."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    one, two = ends[:len(u)], ends[len(u):]
    root = np.arange(len(nodes))
    while True:
        a, b = root[one], root[two]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while not np.array_equal(root, root[root]):
            root = root[root]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a part as stars around the least node of each of its components."""
    parts = [[batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)] for batch in batches]
    if parts:
        u, v = (np.concatenate(column) for column in zip(*parts))
        nodes, least = least_reached(u, v)
        moved = nodes != least
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(least[moved])], names=["u", "v"])


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v."""
    rows = edges.unionByName(_turned(edges)) if large else edges
    low = rows.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = rows.join(stage(low, "star-minima"), "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
    return stage(out.where("u > v").distinct(), "star-edges")


def _are_stars(edges: DataFrame) -> bool:
    """True if every node is either a root or has one edge, to a root."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root")))).alias("e")).select("e.*")
    wrong = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where("child + root > 1")
    return wrong.isEmpty()


def connected(edges: DataFrame, part: int = PART) -> DataFrame:
    """(node, component) of every node that is not itself the least of its component; a written table.

    ``edges`` has two long columns u and v in any direction and must be cheap to read twice; nulls and loops are ignored.
    An empty table gives no rows. ``part`` is how many edges a task holds.
    """
    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    parts = -(-edges.count() // part) or 1
    edges = stage(edges.repartition(parts).mapInArrow(_forest, "u long, v long"), "forests")
    while parts > 1 and not _are_stars(edges):
        edges = _star(_star(edges, large=True), large=False)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
