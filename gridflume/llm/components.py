"""Connected components of an edge table by alternating large-star and small-star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir

#: Parts that a node's edges are dealt over, so that a hub's do not meet in one task.
SALTS = 64
#: Edges that a worker thins at once.
EDGES = 1 << 20
#: Edges in a part of a round, about, and parts at least: each task of a shuffle leaves files, and rounds shuffle often.
PART_EDGES, LEAST_PARTS = 50_000, 8


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges node-to-root that connect the same nodes as the pairs (a, b) and are no more than the nodes."""
    nodes, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = where[: len(a)], where[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the edges of some batches connect, with no more edges than nodes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def thinned() -> pa.RecordBatch:
        u, v = spanning(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for b in batches:
        held.append((b.column("u").to_numpy(), b.column("v").to_numpy()))
        if sum(len(u) for u, _ in held) >= EDGES:
            yield thinned()
            held.clear()
    if held:
        yield thinned()


def _settled(edges: DataFrame, parts: int) -> bool:
    """Whether each node with an edge down has one only, and none leads to it: then all edges end at roots."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down + up > 1 and down > 0").coalesce(parts).take(1)


def _with_least(edges: DataFrame, parts: int) -> DataFrame:
    """Edges (u, v) with ``m``, the least v of their u, found and joined in parts so that no task gets a whole hub."""
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    partial = dealt.groupBy("u", "salt").agg(F.min("v").alias("m")).coalesce(parts)
    least = partial.groupBy("u").agg(F.min("m").alias("m"))
    known = partial.select("u", "salt").join(least, "u").coalesce(parts)
    return dealt.join(known, ["u", "salt"]).select("u", "v", "m").coalesce(parts)


def _large_star(edges: DataFrame, parts: int) -> DataFrame:
    both = _with_least(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), parts)
    return both.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, parts: int) -> DataFrame:
    down = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), parts)
    # each edge moves to the least neighbour, and the one to that neighbour stays
    return down.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct().coalesce(parts)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest node that it reaches.

    ``edges`` has the long columns ``u`` and ``v``. Null ends and loops are ignored, repeated and
    mirrored edges count once, an empty table gives an empty result. The edges stay in Spark; batches
    are thinned to what they connect first, a hub's edges are dealt over tasks, and each round is
    checkpointed in the shared folder, so it survives lost executors. A round has as many parts as
    its edges ask for, however many the session's shuffles have.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = now.mapInArrow(_forest, "u long, v long").distinct().checkpoint()
    parts = max(LEAST_PARTS, -(-now.count() // PART_EDGES))
    now = now.coalesce(parts)
    for _ in range(most_rounds):
        if _settled(now, parts):
            break
        # apart, for a plan of both reads the edges many times over
        now = _small_star(_large_star(now, parts).checkpoint(), parts).checkpoint()
    else:
        raise RuntimeError("components did not converge")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().coalesce(parts))
