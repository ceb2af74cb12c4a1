"""Exact dedup by counting quotient filters, with byte verification of what they flag.

Every text gets a 64-bit fingerprint of its normalised bytes. A counting quotient filter is built
per partition over these fingerprints; a quotient (the high bits) names a run, a run holds sorted
remainders with their counters. Filters are cut into slices by quotient and shuffled by slice, where
they are merged losslessly by sorted remainders. A fingerprint whose merged count is one belongs to
a text that has no equal; texts of all others are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_PATTERN, staged, text_hash, text_or_empty

REMAINDER_BITS = 40
#: Fingerprints that a slice is meant to hold; with more of them there are more slices, up to one per quotient.
SLICE_FINGERPRINTS = 1 << 20


@dataclass
class CountingQuotientFilter:
    """Sorted runs of remainders: ``quotients[i]`` owns the next ``lengths[i]`` remainders, each with a counter."""

    quotients: np.ndarray
    lengths: np.ndarray
    remainders: np.ndarray
    counters: np.ndarray

    @classmethod
    def of(cls, fingerprints: np.ndarray, counters: np.ndarray | None = None) -> CountingQuotientFilter:
        """From unsigned 64-bit fingerprints, each counted once or ``counters`` times."""
        order = np.argsort(fingerprints, kind="stable")
        values = fingerprints[order]
        times = np.ones(len(values), np.int64) if counters is None else counters[order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
        values, times = values[starts], np.add.reduceat(times, starts) if len(starts) else times
        quotients, lengths = np.unique(values >> np.uint64(REMAINDER_BITS), return_counts=True)
        return cls(quotients, lengths, values & np.uint64((1 << REMAINDER_BITS) - 1), times)

    def fingerprints(self) -> np.ndarray:
        return (np.repeat(self.quotients, self.lengths) << np.uint64(REMAINDER_BITS)) | self.remainders

    @classmethod
    def merged(cls, parts: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all inputs together, sorted once; no remainder is lost and counters add up."""
        return cls.of(np.concatenate([p.fingerprints() for p in parts]), np.concatenate([p.counters for p in parts]))

    def repeated(self) -> np.ndarray:
        """Fingerprints counted more than once."""
        return self.fingerprints()[self.counters > 1]

    def slices(self, bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        """Parts by the high ``bits`` of the quotient."""
        part = self.quotients >> np.uint64(64 - REMAINDER_BITS - bits)
        at = np.r_[0, np.cumsum(self.lengths)]
        for k in np.unique(part):
            lo, hi = np.searchsorted(part, k), np.searchsorted(part, k, side="right")
            runs = slice(at[lo], at[hi])
            yield int(k), CountingQuotientFilter(self.quotients[lo:hi], self.lengths[lo:hi], self.remainders[runs], self.counters[runs])


_FILTER = "slice int, quotients array<long>, lengths array<long>, remainders array<long>, counters array<long>"


def _filters(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        if not seen:
            return
        as_long = lambda x: pa.array([x.astype(np.int64)], pa.list_(pa.int64()))
        for k, part in CountingQuotientFilter.of(np.concatenate(seen)).slices(bits):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), as_long(part.quotients), as_long(part.lengths), as_long(part.remainders), as_long(part.counters)],
                names=["slice", "quotients", "lengths", "remainders", "counters"],
            )

    return run


def _merged(parts: pd.DataFrame) -> pd.DataFrame:
    each = [
        CountingQuotientFilter(np.asarray(r.quotients, np.uint64), np.asarray(r.lengths, np.int64), np.asarray(r.remainders, np.uint64), np.asarray(r.counters, np.int64))
        for r in parts.itertuples(index=False)
    ]
    return pd.DataFrame({"fingerprint": CountingQuotientFilter.merged(each).repeated().view(np.int64)})


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE_PATTERN, " ")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, text_hash.

    Null texts count as empty, so they equal the empty text but not a text of spaces alone. Of equal
    texts the smallest doc_id stays; rows that repeat it are all kept, and null ids are never chosen
    unless the whole group has no other: then keep_id is null and, as none is first, all of it is kept,
    so that no text is lost. Rows that repeat an id with another text are rows of their own;
    ``text_hash`` tells them apart. An empty table gives no rows; other columns of ``docs`` play no
    part, whatever their names.
    """
    rows = docs.select("doc_id", normalised().alias("norm"), text_hash().alias("text_hash")).withColumn("fingerprint", F.xxhash64("norm"))
    digests = staged(rows.select("doc_id", "fingerprint", F.sha2("norm", 256).alias("text_sha256"), "text_hash"), "digests")
    bits = min(64 - REMAINDER_BITS, max(0, digests.count() // SLICE_FINGERPRINTS).bit_length())
    flagged = digests.select("fingerprint").mapInArrow(_filters(bits), _FILTER).groupBy("slice").applyInPandas(_merged, "fingerprint long")
    flagged = staged(flagged, "flagged")
    verified = (
        rows.join(flagged, "fingerprint", "left_semi").groupBy("fingerprint", "norm").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("fingerprint", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    alone = F.col("group_size").isNull()
    return digests.join(verified, ["fingerprint", "text_sha256"], "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256", "text_hash",
    )
