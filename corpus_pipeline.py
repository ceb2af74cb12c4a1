"""A training corpus from ``documents``: language ID, exact dedup, near-dedup, substring dedup, packing.

Each stage reads what its predecessor kept and returns the columns of documents; the last returns
packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflume.llm import exact_dedup, language, near_copies, packing, substring
from gridflume.llm.common import bounded_batches, id_crc, new_path, table, text_hash
from gridflume.llm.queries import BYTE_BPE


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected; learned from the labelled rows outside the held-out fold."""
    bounded_batches(spark)
    return language.filtered(docs, language.fit(docs, F.pmod(id_crc(), F.lit(4)) != 2))


def _keyed(docs: DataFrame, found: DataFrame):
    """``docs`` with their text hash, ``found`` (doc_id, text_hash, ...) renamed, and when rows of the two are the same.

    An id alone may be null or stand for several texts. What an operator says of a row follows from its id
    and text, so rows equal in both share it.
    """
    left = docs.withColumn("_row_hash", text_hash())
    right = found.withColumnsRenamed({"doc_id": "_found_id", "text_hash": "_found_hash"}).dropDuplicates(["_found_id", "_found_hash"])
    return left, right, left["doc_id"].eqNullSafe(right["_found_id"]) & (left["_row_hash"] == right["_found_hash"])


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    left, right, same = _keyed(docs, gone)
    return left.join(right, same, "left_anti").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the row with the smallest id.

    Rows that repeat that id and text all stay; a null id stays only where all of its group are null.
    """
    bounded_batches(spark)
    gone = exact_dedup.exact_duplicates(docs).where("not kept").select("doc_id", "text_hash")
    return _without(docs, gone)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by fingerprints and by five-word shingles of similarity 0.8, the row with the smallest id.

    Rows that repeat that id all stay; null ids stay only where all of their group are null.
    """
    bounded_batches(spark)
    found = near_copies.near_copies(docs)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_hash")
    return _without(docs, gone)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; one of which nothing is left goes, all others stay.

    Each row is cut by what was found for its own id and text; rows of null ids lose nothing.
    """
    bounded_batches(spark)
    changed = substring.repeated_passages(docs).where("n_removed > 0").select("doc_id", "text_hash", F.col("kept_text").alias("_kept_text"))
    left, right, same = _keyed(docs, changed)
    joined = left.join(right, same, "left").where(F.col("_kept_text").isNull() | (F.col("_kept_text") != ""))
    now = {"text": F.coalesce("_kept_text", "text"), "n_chars": F.when(F.col("_kept_text").isNull(), F.col("n_chars")).otherwise(F.length("_kept_text"))}
    return joined.select(*(now.get(f.name, F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit-decreasing sequences of 2048 tokens."""
    bounded_batches(spark)
    return packing.packed(docs, BYTE_BPE, 2048)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack),
]

#: Language ID and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
