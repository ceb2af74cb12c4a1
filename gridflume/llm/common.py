"""Helpers that several operators share: the shared folder, staged tables, words of a text."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words; the complement is a word character.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


#: Words whose hashes a worker remembers.
CACHE = 200_000
#: Rows that a Python worker gets at once; texts may be long, and a worker keeps the memory of its largest batch.
BATCH_ROWS = 2000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word; a worker remembers those of late."""
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset and all tasks run on this machine (a local master, as in tests), a new one.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="gridflume-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/gridflume/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile drops its shuffle files when it is there, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage with a copy that outlives executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    with shuffles_dropped(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Have texts sent to Python workers in batches of ``BATCH_ROWS`` at most."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_hash(column: str = "text") -> Column:
    """With the id it tells rows apart, where an id is null or stands for more than one text; null counts as empty."""
    return F.xxhash64(text_or_empty(column))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def utf8_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
