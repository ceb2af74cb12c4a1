"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles.

Equal fingerprints are collapsed first. The rest are laid in tiles by the population counts of
their four 16-bit quarters. Two fingerprints that differ in at most ``radius`` bits have quarter
counts that differ by at most ``radius`` in sum, so only such tile pairs are compared, bit by bit,
with numpy exclusive-or and bit counts; all other pairs of tiles are skipped, and no link is lost.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, utf8_texts
from .components import components, spanning

#: Fingerprints in a tile at most (on average; a tile of a busy key is one of several).
TILE = 2048


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_digest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)]
    bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(n, 8), axis=1)
    whole = n // 255 * 255
    count = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = np.fromiter((fingerprint(x) for x in utf8_texts(b.column("text"))), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def _quarters(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(4)]


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Steps between quarter counts within the radius; of two opposite steps the one that is not negative."""
    steps = itertools.product(range(-radius, radius + 1), repeat=4)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0, 0, 0, 0)]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, same = batch.column("left"), batch.column("right"), batch.column("same").to_pylist()
            found_u, found_v = [], []
            for i in range(batch.num_rows):
                a, b = left[i].values.to_numpy(), right[i].values.to_numpy()
                pairs_a, pairs_b = [], []
                step = max(1, (1 << 20) // max(1, len(b)))
                for at in range(0, len(a), step):
                    near = np.bitwise_count((a[at : at + step, None] ^ b[None, :]).view(np.uint64)) <= radius
                    x, y = np.nonzero(near)
                    pairs_a.append(a[at + x])
                    pairs_b.append(b[y])
                x, y = np.concatenate(pairs_a), np.concatenate(pairs_b)
                if same[i]:
                    x, y = x[x != y], y[x != y]
                if len(x):
                    x, y = spanning(x, y)
                    found_u.append(x)
                    found_v.append(y)
            if found_u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found_u)), pa.array(np.concatenate(found_v))], names=["u", "v"])

    return run


def near_edges(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (u, v) that connect distinct fingerprints ``fp`` as all links within ``radius`` bits do."""
    key = F.struct(*[q.alias(f"q{i}") for i, q in enumerate(_quarters(F.col("fp")))])
    keyed = prints.select("fp").distinct().select("fp", key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    # sizes has at most 17**4 rows, whatever the input
    dealt = keyed.join(F.broadcast(sizes), "key").select("key", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), "fp")
    tiles = staged(dealt.groupBy("key", "block").agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"q{i}") for i, x in enumerate(s)]) for s in _offsets(radius)])
    left = tiles.select("key", F.col("block").alias("left_block"), F.col("fps").alias("left"), F.explode(steps).alias("step")).select(
        F.struct(*[(F.col(f"key.q{i}") + F.col(f"step.q{i}")).alias(f"q{i}") for i in range(4)]).alias("key"), "left_block", "left",
        (sum((F.abs(F.col(f"step.q{i}")) for i in range(1, 4)), F.abs(F.col("step.q0"))) == 0).alias("own"),
    )
    right = tiles.select("key", F.col("block").alias("right_block"), F.col("fps").alias("right"))
    pairs = left.join(right, "key").where("not own or left_block <= right_block")
    return pairs.select("left", "right", (F.col("own") & (F.col("left_block") == F.col("right_block"))).alias("same")).mapInArrow(_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, fp (the same as a signed long).

    ``component_id`` is the smallest doc_id reachable over links of at most ``radius`` bits, itself
    included. Null texts count as empty; texts without words have fingerprint zero and link like any
    other. Rows with a null doc_id link too, but their id is never chosen unless no other is there.
    Repeated rows share a component; an empty table gives no rows.
    """
    prints = staged(docs.select("doc_id", "text").mapInArrow(_fingerprints, docs.select("doc_id").schema.add("fp", "long")), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    linked = components(near_edges(prints, radius))
    rooted = classes.join(linked, classes.fp == linked.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    owner = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(owner, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "fp")
