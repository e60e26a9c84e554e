"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


#: Edges that one task settles by itself (16 bytes each).
FEW_EDGES = 1_000_000


def settled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) of all nodes of an edge list."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)  # ascending
    left, right = at[:len(a)], at[len(a):]
    up = np.arange(len(nodes))
    while True:
        x, y = up[left], up[right]
        if (x == y).all():
            return nodes, nodes[up]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]


def _settle_few(edges: DataFrame) -> DataFrame:
    def run(batches):
        held = list(batches)
        if held:
            t = pa.Table.from_batches(held)
            node, root = settled(*(t[c].to_numpy() for c in ("a", "b")))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])

    return edges.coalesce(1).mapInArrow(run, "node long, root long")


def components(edges: DataFrame, max_rounds: int = 60, few: int = FEW_EDGES) -> DataFrame:
    """(node, root): the smallest node reachable, for every node on an edge.

    ``edges`` has bigint columns ``a`` and ``b``.  Up to ``few`` edges are
    settled in one task; more by alternating large-star and
    small-star rounds (Kiveris et al., 2014): every node hands its larger, then
    its smaller neighbours to its smallest neighbour, until only stars are
    left.  Minima are aggregated before the shuffle, so a node with a very
    large share of the edges is no hot group; each round is written to the
    shared folder.
    """
    now = staged(_oriented(edges.select("a", "b")), "links")
    mark = _mark(now)
    if mark[0] <= few:
        return staged(_settle_few(now), "roots")
    for _ in range(max_rounds):
        now = staged(_small_star(_large_star(now)), "links")
        seen, mark = mark, _mark(now)
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _oriented(edges: DataFrame) -> DataFrame:
    """Larger end first, no loops, no repeats."""
    return (edges.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"),
                    F.sum(F.shiftright(h, 24)).alias("s")).first()
    return row["n"], row["x"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _oriented(both.join(least, "a").where("b > a").select("b", "m").toDF("a", "b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionAll(least.select("a", F.col("m").alias("b"))))
