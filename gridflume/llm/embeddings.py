"""Embedding near-dedup with a robust-pruned flat graph.

Distinct vectors of a label are dealt to the shards of their nearest centres, each to ``OVERLAP`` of
them (and a shard that is too large is split by a hash). A shard's graph is built by inserting
vectors in doubling batches: each searches the graph so far greedily from the medoid, its visited
set is robustly pruned to a few diverse neighbours, and links back are pruned alike. The adjacency
lists of all shards are united per vector. Searches then start at the medoids of a vector's shards
and expand their range: every vector met within it is expanded in turn, over edges from any shard.
Pairs found are verified in double precision. An audit compares with brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import components

#: Vectors that a shard is meant to hold; one of twice as many is split.
SHARD = 1000
OVERLAP = 2
#: Vectors, by a hash, that the centres of a label are fitted on, and centres at most.
FITTED, CENTRES = 20_000, 512
DEGREE, BEAM, SLACK = 32, 64, 2.5


def _near(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Distances 1 - cosine of each query (a row) to its own candidates; -1 is none."""
    d = 1 - np.einsum("qd,qkd->qk", queries, vectors[ids])
    d[ids < 0] = np.inf
    return d


def greedy(vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Greedy beam search of a batch of queries, side by side: ids and distances of each one's visited vectors, -1 beyond."""
    q = np.arange(len(queries))
    ids = np.full((len(queries), beam), -1)
    ids[:, : len(starts)] = starts[:beam]
    dist, done = _near(vectors, queries, ids), np.zeros(ids.shape, bool)
    visited = []
    while True:
        open_dist = np.where(done | (ids < 0), np.inf, dist)
        at = open_dist.argmin(axis=1)
        live = np.isfinite(open_dist[q, at])
        if not live.any():
            break
        done[q[live], at[live]] = True
        here = np.where(live, ids[q, at], -1)
        visited.append((here, np.where(live, dist[q, at], np.inf)))
        new = np.where(live[:, None], graph[here], -1)
        new[(new[:, :, None] == ids[:, None, :]).any(axis=2)] = -1
        all_ids = np.concatenate([ids, new], axis=1)
        all_dist = np.concatenate([dist, _near(vectors, queries, new)], axis=1)
        all_done = np.concatenate([done, np.zeros(new.shape, bool)], axis=1)
        order = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        ids, dist, done = (np.take_along_axis(x, order, axis=1) for x in (all_ids, all_dist, all_done))
    if not visited:
        return np.full((len(queries), 1), -1), np.full((len(queries), 1), np.inf)
    return np.stack([v[0] for v in visited], axis=1), np.stack([v[1] for v in visited], axis=1)


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, dist: np.ndarray, degree: int = DEGREE, slack: float = SLACK) -> np.ndarray:
    """Of each point's candidates the nearest, then those not ``slack`` times closer to a chosen one, up to ``degree``."""
    alive = (candidates >= 0) & (candidates != points[:, None])
    rows, chosen = np.arange(len(points)), np.full((len(points), degree), -1)
    own = vectors[candidates]
    for k in range(degree):
        d = np.where(alive, dist, np.inf)
        at = d.argmin(axis=1)
        live = np.isfinite(d[rows, at])
        if not live.any():
            break
        pick = candidates[rows, at]
        chosen[live, k] = pick[live]
        between = 1 - np.einsum("qd,qkd->qk", vectors[pick], own)
        alive &= ~live[:, None] | ((slack * between > dist) & (candidates != pick[:, None]))
    return chosen


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM) -> tuple[np.ndarray, int]:
    """Adjacency (rows of ``degree`` ids, -1 beyond) and medoid of one shard of unit vectors."""
    n = len(vectors)
    graph = np.full((n + 1, degree), -1)  # the last row answers for -1
    mean = vectors.mean(axis=0)
    medoid = int((vectors @ mean).argmax())
    order = np.random.default_rng(1).permutation(n)
    order = np.r_[medoid, order[order != medoid]]
    at = 1
    while at < n:
        points = order[at : at + min(at, 256)]
        visited, dist = greedy(vectors, graph, np.array([medoid]), vectors[points], beam)
        graph[points] = robust_prune(vectors, points, visited, dist, degree)
        to, back = graph[points].ravel(), np.repeat(points, degree)
        real = to >= 0
        to, back = to[real], back[real]
        by = np.argsort(to, kind="stable")
        to, back = to[by], back[by]
        targets, lo, count = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(targets), degree + int(count.max())), -1)
        wide[:, :degree] = graph[targets]
        for i, (a, c) in enumerate(zip(lo, count, strict=True)):
            wide[i, degree : degree + c] = back[a : a + c]
        wide_dist = _near(vectors, vectors[targets], wide)
        graph[targets] = robust_prune(vectors, targets, wide, wide_dist, degree)
        at += len(points)
    return graph[:n], medoid


def expand(vectors: np.ndarray, graph: np.ndarray, query: np.ndarray, hits: np.ndarray, least: float) -> np.ndarray:
    """All vectors of cosine ``least`` and more that edges reach from ``hits`` without leaving the range."""
    seen = np.zeros(len(vectors), bool)
    seen[hits] = True
    edge = hits
    while len(edge):
        new = np.unique(graph[edge])
        new = new[new >= 0]
        new = new[~seen[new]]
        edge = new[vectors[new] @ query >= least]
        seen[edge] = True
    return np.flatnonzero(seen)


def _matrix(column) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _graph_of(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("node")
    graph, medoid = build(_matrix(part.embedding))
    node = part.node.to_numpy()
    return pd.DataFrame({"node": node, "neighbours": [node[g[g >= 0]] for g in graph], "medoid": np.arange(len(node)) == medoid})


def _pairs_frame(node: list, found: list) -> pd.DataFrame:
    """Kinds are stated, since an empty list would become a column of doubles."""
    return pd.DataFrame({"node": pd.Series(node, dtype="int64"), "found": pd.Series(found, dtype="object")})


def _searched(least: float):
    def run(key: tuple, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        """All searches of one shard; its members carry their united lists, and those of other shards that these name come along."""
        if not len(queries) or not len(members):
            return _pairs_frame([], [])
        members = members.drop_duplicates("node").sort_values("node")
        node, vectors = members.node.to_numpy(), _matrix(members.embedding)
        lists = members.neighbours.tolist()
        graph = np.full((len(node) + 1, max([1, *map(len, lists)])), -1)
        for i, named in enumerate(lists):
            at = np.searchsorted(node, named)
            at = at[(at < len(node)) & (node[np.minimum(at, len(node) - 1)] == named)]
            graph[i, : len(at)] = at
        starts = np.flatnonzero(members.medoid.to_numpy())[:BEAM]
        found_node, found = [], []
        mine = queries.node.to_numpy()
        asked = _matrix(queries.embedding)
        for at in range(0, len(mine), 256):
            block = asked[at : at + 256]
            visited, dist = greedy(vectors, graph, starts, block)
            for i in range(len(block)):
                hits = visited[i][(dist[i] <= 1 - least + 1e-9) & (visited[i] >= 0)]
                own = np.flatnonzero(node == mine[at + i])
                near = expand(vectors, graph[:-1], block[i], np.union1d(hits, own), least - 1e-9)
                # verified as the contract has it: cosine in double precision
                near = near[vectors[near] @ block[i] >= least]
                near = near[node[near] != mine[at + i]]
                if len(near):
                    found_node.append(mine[at + i])
                    found.append(node[near])
        return _pairs_frame(found_node, found)

    return run


def _usable(embedding: Column) -> Column:
    """Vectors without null or non-finite components, and not zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0)


def _centres(sample: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(5)
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(8):
        near = (sample @ centres.T).argmax(axis=1)
        for j in range(len(centres)):
            if (near == j).any():
                m = sample[near == j].mean(axis=0)
                centres[j] = m / max(np.linalg.norm(m), 1e-12)
    return centres


def _dealt(centres: dict, overlap: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for (label, dims), part in b.groupby(["label", "dims"]):
                c = centres[(label, dims)]
                near = np.argsort(-(_matrix(part.embedding) @ c.T), axis=1)[:, :overlap]
                for k in range(near.shape[1]):
                    out.append(part.assign(cell=near[:, k].astype(np.int32), primary=k == 0))
            if out:
                yield pd.concat(out)

    return run


def linked(rows: DataFrame, least: float = 0.98) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null labels (and dimensions) link at cosine ``least`` and more. Null and zero
    vectors, ones with null or non-finite components, and ones of null labels link with nothing. Equal
    vectors always link; they are searched once and counted each. A repeated row is another vector with
    the same id. Null ids link, but are not chosen where another is there. An empty table gives no rows.
    """
    given = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    usable = given.where(_usable(F.col("embedding")) & F.col("label").isNotNull())
    classes = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = staged(classes.withColumn("dims", F.size("embedding")).withColumn("node", F.xxhash64("label", "embedding")), "vector_classes")

    sizes = {(r[0], r[1]): r[2] for r in classes.groupBy("label", "dims").count().collect()}  # a row for each label
    scale = 1 << 30
    rate = F.coalesce(*[F.when((F.col("label") == a) & (F.col("dims") == b), F.lit(min(scale, scale * FITTED // n))) for (a, b), n in sizes.items()], F.lit(0)) if sizes else F.lit(0)
    sample = classes.where(F.pmod(F.xxhash64("node", F.lit("centres")), F.lit(scale)) < rate).select("label", "dims", "embedding").toPandas() if sizes else pd.DataFrame(columns=["label", "dims", "embedding"])
    centres = {}
    for key, part in sample.groupby(["label", "dims"]):
        centres[key] = _centres(_matrix(part.embedding), min(CENTRES, -(-sizes[key] // SHARD)))
    for label, dims in sizes:
        centres.setdefault((label, dims), np.eye(1, dims))

    kinds = "node long, label string, dims int, embedding array<double>"
    dealt = classes.select("node", "label", "dims", "embedding").mapInPandas(_dealt(centres, OVERLAP), f"{kinds}, cell int, primary boolean")
    dealt = staged(dealt, "dealt_vectors")
    cells = dealt.groupBy("label", "dims", "cell").agg(F.ceil(F.count("*") / (2 * SHARD)).cast("int").alias("splits"))
    dealt = staged(dealt.join(cells, ["label", "dims", "cell"]).withColumn("split", F.pmod(F.xxhash64("node", F.lit("split")), F.col("splits")).cast("int")), "shards")
    shard = ["label", "dims", "cell", "split"]
    graphs = staged(dealt.groupBy(*shard).applyInPandas(_graph_of, "node long, neighbours array<long>, medoid boolean"), "graphs")
    united = graphs.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"), F.max("medoid").alias("medoid"))
    united = staged(united.join(classes.select("node", "embedding"), "node"), "united")

    # a shard is searched with its members and with what their lists name in other shards
    inside = dealt.select(*shard, "node").join(united, "node")
    outside = inside.select(*shard, F.explode("neighbours").alias("node")).distinct().join(dealt.select(*shard, "node"), [*shard, "node"], "left_anti")
    outside = outside.join(united, "node").withColumn("medoid", F.lit(False))
    members = staged(inside.select(*shard, "node", "embedding", "neighbours", "medoid").unionByName(outside.select(*shard, "node", "embedding", "neighbours", "medoid")), "members")
    # each vector asks all parts of its own cells
    asked = dealt.select("node", "embedding", "label", "dims", "cell", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))
    asked = staged(asked, "queries")
    found = asked.groupBy(*shard).cogroup(members.groupBy(*shard)).applyInPandas(_searched(least), "node long, found array<long>")
    found = staged(found, "found")

    pairs = found.select("node", F.explode("found").alias("other"))
    pairs = staged(pairs.union(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    weights = classes.select("node", "first_id", "copies")
    links = pairs.join(weights.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("more"))
    roots = components(pairs.select(F.col("node").alias("u"), F.col("other").alias("v")))
    rooted = weights.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_id = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owners = rooted.join(least_id, "root").select("node", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    asking = given.select("vec_id", F.when(_usable(F.col("embedding")) & F.col("label").isNotNull(), F.xxhash64("label", "embedding")).alias("node"))
    return asking.join(owners, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(F.col("n_links").isNull(), F.lit(True)).otherwise(F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"),
    )


def audit(rows: DataFrame, result: DataFrame, least: float = 0.98, asked: int = 200) -> float:
    """Recall of links for about ``asked`` vectors by a hash, against brute force over all rows."""
    given = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label").where(_usable(F.col("embedding")) & F.col("label").isNotNull())
    n = given.count()
    scale = 1 << 30
    some = given.where(F.pmod(F.xxhash64("vec_id", F.lit("audit")), F.lit(scale)) < scale * asked // max(1, n))
    norm = lambda x: F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b))
    unit = lambda df: df.select("vec_id", "label", F.transform("embedding", lambda x: x / norm(F.col("embedding"))).alias("unit"))
    left = F.broadcast(unit(some).select(F.col("vec_id").alias("asked_id"), "label", F.col("unit").alias("mine")))  # bounded by ``asked``
    dot = F.aggregate(F.zip_with("mine", "unit", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    true = unit(given).join(left, "label").where((F.col("vec_id") != F.col("asked_id")) & (dot >= least)).groupBy("asked_id").agg(F.count("*").alias("true"))
    both = true.join(result, true.asked_id == result.vec_id).agg(F.sum(F.least("n_links", "true")), F.sum("true")).head()
    return 1.0 if not both[1] else float(both[0] / both[1])
