"""Line dedup by a sorted stream of line hashes; what is returned are bitmaps of the lines that stay.

Every line that is long enough gives a 128-bit hash of its key with its document and position. The
hashes are dealt to ranges, sorted by document (largest first) and position within a hash, and read
as a stream: the first document of a run keeps its lines, those of all others go once a third
document is seen. A stream remembers a few rows of the current run, however long it is. A run may be
cut by the end of a range, as the ranges are over hash, document and position together, so that a
line of a third of all documents is dealt over many tasks; what the two ends of a range leave open is
settled by a table of at most two runs a range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_hash, text_or_empty

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: Bytes of text that are split at once.
PIECE = 16 << 20
#: Stands for a null id, which is less than any other.
NO_ID = -(1 << 63)

_SPACE = " \t\n\x0b\x0c\r"
_COLUMNS = ("h1", "h2", "doc", "text_hash", "position")
_LINES = "h1 long, h2 long, doc long, text_hash long, position int"
_RUNS = f"{_LINES}, docs array<long>"


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of about ``PIECE`` bytes of text, a row at least."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PIECE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _line_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in _pieces(whole, "text"):
            lines = pc.split_pattern(b.column("text"), "\n")
            counts = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = pc.ascii_lower(pc.ascii_trim(lines.flatten(), characters=_SPACE))
            long = pc.greater_equal(pc.utf8_length(keys), LEAST_CHARS)
            at = np.flatnonzero(long.to_numpy(zero_copy_only=False))
            if not len(at):
                continue
            hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys.filter(long).cast(pa.binary()).to_pylist())), ">i8").astype(np.int64).reshape(-1, 2)
            row = np.repeat(np.arange(len(counts)), counts)[at]
            position = (at - np.repeat(np.cumsum(counts) - counts, counts)[at]).astype(np.int32)
            of = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), b.column("doc").take(of), b.column("text_hash").take(of), pa.array(position)], names=list(_COLUMNS)
            )


class _Stream:
    """The runs of one range: which of their rows go, which stay open, and the documents of the first and the last run."""

    def __init__(self) -> None:
        self.first: tuple[int, int] | None = None
        self.held: list[np.ndarray] | None = None

    def read(self, *columns: np.ndarray) -> list[pa.RecordBatch]:
        """Take the next rows of the range. The last run is held back, but for rows that surely go."""
        rows = [*columns, np.zeros(len(columns[0]), bool)]
        if self.held:
            rows = [np.concatenate(x) for x in zip(self.held, rows, strict=True)]
        if self.first is None:
            self.first = (int(rows[0][0]), int(rows[1][0]))
        starts, rank, docs = self._ranked(rows)
        last = starts[-1]
        run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(rank)]))
        goes = (rank >= 1) & (docs[run] >= LEAST_DOCUMENTS) & ~rows[5]
        out = [self._gone(rows, goes)]
        if len(starts) > 1 and (int(rows[0][0]), int(rows[1][0])) == self.first:
            out += self._end([x[: starts[1]] for x in rows])
        rows[5] = rows[5] | goes
        self.held = [x[last:] for x in rows]
        if docs[-1] >= LEAST_DOCUMENTS:
            # what is left of a settled run: the first document's rows where they may go yet, and a row of two more documents
            rank = rank[last:]
            keep = np.zeros(len(rank), bool)
            keep[[0, int(np.searchsorted(rank, 1)), len(rank) - 1]] = True
            keep |= rank == 0 if (int(self.held[0][0]), int(self.held[1][0])) == self.first else False
            self.held = [x[keep] for x in self.held]
        return out

    def close(self) -> list[pa.RecordBatch]:
        return self._end(self.held) if self.held else []

    def _end(self, rows: list[np.ndarray]) -> list[pa.RecordBatch]:
        """The open rows of the first or last run of the range, and its first documents."""
        _, rank, docs = self._ranked(rows)
        settled = docs[0] >= LEAST_DOCUMENTS
        is_first = (int(rows[0][0]), int(rows[1][0])) == self.first
        is_open = ~rows[5] & (((rank == 0) & is_first) if settled else True)
        firsts = rows[2][[int(np.searchsorted(rank, k)) for k in range(min(docs[0], LEAST_DOCUMENTS))]]
        summary = [pa.array(x[:1]) for x in rows[:2]] + [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([firsts.tolist()], pa.list_(pa.int64()))]
        opened = [pa.array(x[is_open]) for x in rows[:5]]
        opened.append(pa.nulls(len(opened[0]), pa.list_(pa.int64())))
        return [pa.RecordBatch.from_arrays(x, names=[*_COLUMNS, "docs"]) for x in (summary, opened)]

    @staticmethod
    def _ranked(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where runs start, each row's document as a number within its run, and each run's documents."""
        h1, h2, doc = rows[:3]
        new_run = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        new_doc = np.cumsum(new_run | np.r_[True, doc[1:] != doc[:-1]])
        starts = np.flatnonzero(new_run)
        rank = new_doc - np.repeat(new_doc[starts], np.diff(np.r_[starts, len(h1)]))
        return starts, rank, rank[np.r_[starts[1:], len(h1)] - 1] + 1

    @staticmethod
    def _gone(rows: list[np.ndarray], goes: np.ndarray) -> pa.RecordBatch:
        n = int(goes.sum())
        columns = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *(pa.array(x[goes]) for x in rows[2:5]), pa.nulls(n, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=[*_COLUMNS, "docs"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stream = _Stream()
    for b in batches:
        if b.num_rows:
            yield from stream.read(*(b.column(c).to_numpy(zero_copy_only=False) for c in _COLUMNS))
    yield from stream.close()


@F.pandas_udf(T.BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    def one(gone: np.ndarray) -> bytes:
        bits = np.ones(int(max(gone)) // 8 * 8 + 8, bool)
        bits[gone] = False
        return zlib.compress(np.packbits(bits).tobytes())

    return positions.map(one)


def stays(bitmap: bytes | None, n: int) -> np.ndarray:
    """For each of ``n`` lines whether it stays; lines beyond the end of the bitmap do."""
    if bitmap is None:
        return np.ones(n, bool)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n].astype(bool)
    return np.r_[bits, np.ones(n - len(bits), bool)]


@F.pandas_udf(T.StringType())
def _kept(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
    def one(text: str, bitmap: bytes | None) -> str:
        if bitmap is None:
            return text
        lines = text.split("\n")
        return "\n".join([line for line, s in zip(lines, stays(bitmap, len(lines)), strict=True) if s])

    return pd.Series([one(t, b) for t, b in zip(texts, bitmaps, strict=True)], dtype=object)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_or_empty().alias("text"), text_hash().alias("text_hash"))


def lost_lines(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, n_dropped, keep_bitmap) of each document that loses lines, staged.

    The compressed bitmap has a zero bit for each line that goes and ends with the byte of the last of them.
    """
    lines = _rows(docs).select("doc", "text_hash", "text").mapInArrow(_line_keys, _LINES)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("text_hash"), F.col("position")]
    runs = staged(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_runs, _RUNS), "line_runs")
    each = runs.where("docs is not null").select("h1", "h2", F.explode("docs").alias("doc"))
    settled = each.groupBy("h1", "h2").agg(F.max("doc").alias("keeper"), F.count_distinct("doc").alias("n")).where(F.col("n") >= LEAST_DOCUMENTS)
    # at most two runs for each range of the shuffle, whatever the input
    ends = runs.where("docs is null and h1 is not null").join(F.broadcast(settled), ["h1", "h2"]).where("doc < keeper")
    gone = runs.where("docs is null and h1 is null").select("doc", "text_hash", "position").union(ends.select("doc", "text_hash", "position"))
    grouped = gone.groupBy("doc", "text_hash").agg(F.collect_set("position").alias("gone"))
    return staged(grouped.select("doc", "text_hash", F.size("gone").cast("long").alias("n_dropped"), _bitmap("gone").alias("keep_bitmap")), "lost_lines")


def _n_lines():
    return (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, keep_bitmap, text_hash; no text is moved.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of 20 code points or
    more found in 3 documents or more lose their lines, except all of those in the largest doc_id that
    holds them. ``keep_bitmap`` is null where all lines stay; see ``stays``. Null and empty texts are one
    empty line. Rows of one doc_id are one document, each cut by its own lines; ``text_hash`` tells those
    with different texts apart. Rows of null ids together are one document, less than any other. An
    empty table gives no rows; other columns play no part, whatever their names.
    """
    rows = _rows(docs).select("doc_id", "doc", "text_hash", _n_lines())
    return rows.join(lost_lines(docs), ["doc", "text_hash"], "left").select("doc_id", "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep_bitmap", "text_hash")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines (before), n_dropped, keep_bitmap and kept_text, the lines that stay joined by a line feed.

    Cases are as in ``keep_bitmaps``; a text of which no line stays is empty.
    """
    # one plan at every size: what is lost grows with the documents, so it is never broadcast
    joined = _rows(docs).join(lost_lines(docs).hint("merge"), ["doc", "text_hash"], "left")
    return joined.select("doc_id", _n_lines(), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep_bitmap", _kept("text", "keep_bitmap").alias("kept_text"))
