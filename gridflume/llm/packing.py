"""Best-fit-decreasing packing of documents into token sequences.

Documents are cut into pieces of at most ``capacity`` tokens. Best-fit decreasing treats pieces of
equal length alike, so its whole plan follows from how many pieces have each length: a histogram of
at most ``capacity`` rows, whatever the input. The plan is made on that histogram with a segment
tree over remaining capacities, which finds the tightest open bin in logarithmic time; pieces then
find their place in Spark by their rank within their length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import staged

CAPACITY = 2048
#: Entries of a worker's cache of encoded words; it is emptied when full.
CACHE = 200_000


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    The vocabulary's pre-tokeniser always cuts before a lone space between two other characters, so
    texts are encoded in such parts, and the parts' ids are remembered. Texts that hold a special
    token's string go to ``tokenizers`` whole, which has rules of its own for them; a text with a
    part that begins or ends in white space is encoded whole too.
    """

    def __init__(self, tokenizer_json: str) -> None:
        self.whole = Tokenizer.from_file(tokenizer_json)
        with open(tokenizer_json, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        special = set(self.special)
        to_byte = {c: b for b, c in _byte_alphabet().items()}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes | None] = {}

    def _part(self, part: str, lead: str) -> bytes | None:
        if not part or part[0].isspace() or part[-1].isspace():
            return None
        return np.asarray(self.fast.encode_ordinary(lead + part), "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        known = self.known
        parts = [self._part(first, "")]
        for p in rest:
            try:
                parts.append(known[p])
            except KeyError:
                if len(known) >= CACHE:
                    known.clear()
                known[p] = got = self._part(p, " ")
                parts.append(got)
        if None in parts:
            return np.asarray(self.fast.encode_ordinary(text), "<u4").tobytes()
        return b"".join(parts)


#: Fixed value: how a byte-level vocabulary of this kind cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(1)
def _encoder(tokenizer_json: str) -> Encoder:
    return Encoder(tokenizer_json)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces behind a first one that may be shorter."""
    head = n % capacity if n > capacity else n
    found = [(0, head)] if head else []
    return found + [(s, capacity) for s in range(head, n, capacity)]


def _pieces(tokenizer_json: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = _encoder(tokenizer_json).ids, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "") + b"\0\0\0\0"
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), seen[length]))
                    seen[length] += 1
            cols = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("doc_id"), pa.array(cols[0])), pa.array(cols[1], pa.int32()), *(pa.array(c) for c in cols[2:]), pa.array(np.full(len(rows), part, np.int32))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "local_rank", "part"],
            )

    return run


class CapacityTree:
    """Segment tree over remaining capacities; a leaf holds how many open bins have that much room."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.total = [0] * (2 * self.size)

    def add(self, room: int, bins: int) -> None:
        at = room + self.size
        while at:
            self.total[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that some open bin has."""
        at = least + self.size
        if self.total[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.total[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.total[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram: steps (length, first rank, pieces, first bin, pieces in each bin, offset).

    Ranks of a length are dealt in order: the step's bins, from its first bin on, each take the given
    number of pieces (the last may take fewer) from the offset on. Placing runs of equal pieces at once
    gives the bins that placing them one by one does: a bin that took one stays the tightest while it
    has room. Bins with equal room are taken in the order in which they came to have it.
    """
    tree, open_bins, steps, bins = CapacityTree(capacity), {}, [], 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            open_bins.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, bins, -(-left // (capacity // length))
                bins += count
            else:
                first, count = open_bins[room].pop(0)
                tree.add(room, -count)
            each = room // length
            used = min(count, -(-left // each))
            put(room, first + used, count - used)
            pieces = min(left, used * each)
            steps.append((length, rank, pieces, first, each, capacity - room))
            full = pieces // each
            put(room - each * length, first, full)
            if pieces % each:
                put(room - pieces % each * length, first + full, 1)
            left, rank = left - pieces, rank + pieces
    return steps


def _placed(steps: list[tuple[int, int, int, int, int, int]]):
    table = np.array(steps, np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    by_length = {n: np.flatnonzero(table[:, 0] == n) for n in np.unique(table[:, 0]).tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                rows, own = np.flatnonzero(length == n), table[by_length[n]]
                r = rank[rows]
                step = own[np.searchsorted(own[:, 1], r, side="right") - 1]
                inside = r - step[:, 1]
                sequence[rows] = step[:, 3] + inside // step[:, 4]
                offset[rows] = step[:, 5] + inside % step[:, 4] * n
            keep = [n for n in b.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each document ends in id 0; null and empty texts are that id alone. Repeated rows and null ids are
    packed like any other row. An empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    head = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long"
    pieces = staged(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer_json, capacity), f"{head}, local_rank long, part int"), "pieces")
    # a row for each length and writing task
    parts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r[0]: r[1] for r in parts.groupBy("length").agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    steps = plan(histogram, capacity)
    base = parts.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).select("length", "part", "base")
    ranked = pieces.join(base, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local_rank")).alias("rank"))
    shared = spark.sparkContext.broadcast(steps)
    return ranked.mapInArrow(lambda it: _placed(shared.value)(it), f"{head}, sequence_id long, offset long")
