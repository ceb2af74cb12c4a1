"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 and more.

Texts that SimHash links (within 2 bits, as ``simhash`` has it) are one group from the start. Candidates
beyond those are texts that agree in a band of ``ROWS`` of ``ROWS * BANDS`` minimum hashes; at a similarity
of 0.8 a pair has none in common with a chance of 3e-6, at 0.9 of 1e-11. Candidates are verified on the whole
texts. First each group is compared with one other per band; then texts still apart that bands connect are compared
with one another in tiles, which give no more links than it takes to connect what is alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import staged, text_hash, utf8_texts, word_hashes
from .components import components
from .simhash import fingerprint, near_edges

SHINGLE, LEAST = 5, 0.8
ROWS, BANDS = 4, 24
#: Of the minimum hashes (a byte of each), how many a plausible pair shares; at a similarity of 0.8 a pair shares fewer with a chance of 3e-7.
AGREEING = 56
#: Shingles of the texts that are compared in one piece, about.
TILE = 500_000
_U = np.uint64
_FACTORS = np.random.default_rng(11).integers(0, 1 << 64, ROWS * BANDS, dtype=np.uint64) | _U(1)
_ADDED = np.random.default_rng(12).integers(0, 1 << 64, ROWS * BANDS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; of a shorter text, of all its words; empty without words."""
    words = text.lower().split()
    w = word_hashes(words)
    size = min(SHINGLE, len(w))
    n = len(w) - size + 1 if size else 0
    joined = np.full(n, size, np.uint64)
    for k in range(size):
        joined = joined * _U(0x9E3779B97F4A7C15) + w[k : k + n]
    return np.unique(_mixed(joined))


def minima(found: np.ndarray) -> np.ndarray:
    """Minimum hashes of a set of shingles."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        least = np.minimum(least, (_FACTORS[:, None] * found[None, at : at + 512] + _ADDED[:, None]).min(axis=1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A hash for each band of minimum hashes."""
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * _U(0x9E3779B97F4A7C15) + row)
    return key.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = utf8_texts(b.column("text"))
        found = [shingles(x) for x in texts]
        prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
        least = [minima(x) for x in found]
        keys = pa.array([bands(m) if len(x) else [] for x, m in zip(found, least, strict=True)], pa.list_(pa.int64()))
        low = pa.array([(m >> _U(56)).astype(np.uint8).tobytes() for m in map(_mixed, least)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("node"), pa.array(prints), pa.array([len(x) for x in found], pa.int64()), keys, low], names=["doc_id", "node", "fp", "size", "bands", "minima"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [shingles(x).view(np.int64) for x in utf8_texts(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])


def _tile_edges(key: tuple, xs: pd.DataFrame, ys: pd.DataFrame) -> pd.DataFrame:
    """Edges between the groups of two tiles' texts that are near copies, no more of them than connect what is alike."""
    parent: dict[int, int] = {}

    def top(r: int) -> int:
        while (up := parent.get(r, r)) != r:
            r = up
        return r

    edges: list[tuple[int, int]] = []
    if len(xs) and len(ys):
        least_x, least_y = (np.frombuffer(b"".join(t.minima), np.uint8).reshape(-1, ROWS * BANDS) for t in (xs, ys))
        size_x, size_y, root_x, root_y = xs["size"].to_numpy(), ys["size"].to_numpy(), xs["root"].to_numpy(), ys["root"].to_numpy()
        sets_x, sets_y = list(xs.shingles), list(ys.shingles)
        for i in range(len(size_x)):
            alike = ((least_y == least_x[i]).sum(axis=1) >= AGREEING) & (root_y != root_x[i])
            alike &= np.minimum(size_y, size_x[i]) >= LEAST * np.maximum(size_y, size_x[i]) - 1e-9
            for k in np.flatnonzero(alike).tolist():
                a, b = top(int(root_x[i])), top(int(root_y[k]))
                if a != b:
                    both = len(np.intersect1d(sets_x[i], sets_y[k], assume_unique=True))
                    if both >= LEAST * (size_x[i] + size_y[k] - both) - 1e-9:
                        parent[max(a, b)] = min(a, b)
                        edges.append((a, b))
    return pd.DataFrame(edges, columns=["u", "v"], dtype="int64")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, mine = None, None
    for b in batches:
        keep = []
        for x, y in zip(utf8_texts(b.column("text_u")), utf8_texts(b.column("text_v")), strict=True):
            if x != last:
                last, mine = x, shingles(x)
            other = shingles(y)
            both = len(np.intersect1d(mine, other, assume_unique=True))
            keep.append(both >= LEAST * (len(mine) + len(other) - both) - 1e-9)
        yield pa.RecordBatch.from_arrays([b.column("root_u"), b.column("root_v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _linking(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (u, v) between the groups of those pairs (u, v, root_u, root_v) whose texts are near copies."""
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    return pairs.join(left, "u").join(right, "v").select("root_u", "root_v", "text_u", "text_v").mapInArrow(_verified, "u long, v long").distinct()


def _sides(of: str, as_: str) -> list:
    return [F.col(f"{of}.node").alias(as_), F.col(f"{of}.size").alias(f"size_{as_}"), F.col(f"{of}.root").alias(f"root_{as_}")]


def _fitting(pairs: DataFrame) -> DataFrame:
    """Pairs once each, without those whose sizes alone rule the similarity out."""
    fits = F.least("size_u", "size_v") >= LEAST * F.greatest("size_u", "size_v") - 1e-9
    return pairs.where(fits).groupBy("u", "v").agg(F.first("root_u").alias("root_u"), F.first("root_v").alias("root_v"))


def _regrouped(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """Groups (fp, root) after joining roots that edges connect."""
    roots = components(edges).select(F.col("node").alias("root"), F.col("root").alias("joined"))
    return groups.join(roots, "root", "left").select("fp", F.coalesce("joined", "root").alias("root"))


def near_copies(docs: DataFrame, radius: int = 2) -> DataFrame:
    """One row per input row: doc_id, component_id, text_hash.

    ``component_id`` is the smallest doc_id reachable over SimHash links of ``radius`` bits and over pairs of
    similarity ``LEAST`` and more. Texts without words are linked by their fingerprint alone. Rows with a null
    doc_id link too, but are not chosen where another is there. Rows that repeat an id with another text are rows
    of their own, told apart by ``text_hash``. An empty table gives no rows.
    """
    named = docs.select("doc_id", "text", text_hash().alias("node"))
    signed = named.mapInArrow(_signed, docs.select("doc_id").schema.add("node", "long").add("fp", "long").add("size", "long").add("bands", ArrayType(LongType())).add("minima", "binary"))
    signed = staged(signed, "signed")
    fps = signed.select("fp").distinct()
    # edges are staged before they are joined up: else one task holds two Python workers, and an executor keeps twice as many
    linked = components(staged(near_edges(signed, radius), "near_edges"))
    groups = staged(fps.join(linked, fps.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root")), "groups")

    placed = signed.select("node", "fp", "size", F.explode("bands").alias("band")).distinct()
    shared = placed.groupBy("band").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select("band")
    placed = staged(placed.join(shared, "band"), "placed")
    texts = named.select("node", "text").join(placed.select("node").distinct(), "node", "left_semi")
    texts = staged(texts.dropDuplicates(["node"]), "candidate_texts")

    each = placed.join(groups, "fp").groupBy("band", "root").agg(F.min(F.struct("node", "size", "root")).alias("x"))
    pivots = each.groupBy("band").agg(F.min("x").alias("pivot"))
    stars = each.join(pivots, "band").where("x.root <> pivot.root").select(*_sides("pivot", "u"), *_sides("x", "v"))
    tested = staged(_fitting(stars), "star_pairs")
    groups = staged(_regrouped(groups, _linking(tested, texts)), "star_groups")

    # what is still apart: texts that bands connect are a class, and all pairs of a class are compared in tiles
    held = placed.join(groups, "fp")
    apart = held.groupBy("band").agg(F.countDistinct("root").alias("n"), F.min("node").alias("first")).where("n > 1").select("band", "first")
    met = staged(held.join(apart, "band").select("node", "first", "size", "root").distinct(), "apart")
    classes = components(met.select(F.col("node").alias("u"), F.col("first").alias("v"))).select("node", F.col("root").alias("class"))
    facts = met.select("node", "size", "root").distinct().join(classes, "node").join(signed.select("node", "minima").dropDuplicates(["node"]), "node")
    sizes = facts.groupBy("class").agg(F.ceil(F.sum("size") / TILE).cast("int").alias("blocks"))
    sets = texts.join(met.select("node").distinct(), "node", "left_semi").mapInArrow(_shingled, "node long, shingles array<long>")
    members = facts.join(sizes, "class").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(sets, "node")
    members = staged(members.select("class", "block", "blocks", "node", "size", "root", "minima", "shingles"), "class_members")
    columns = ["size", "root", "minima", "shingles"]
    left = members.select("class", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), *columns)
    right = members.select("class", F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), *columns)
    tile = ["class", "i", "j"]
    apart = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(_tile_edges, "u long, v long")
    groups = _regrouped(groups, staged(apart, "tile_edges"))

    rooted = signed.select("doc_id", "node", "fp").join(groups, "fp").select("doc_id", "node", "root")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root").select("doc_id", "component_id", F.col("node").alias("text_hash"))

