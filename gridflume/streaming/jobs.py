"""Structured Streaming forms of the refresh operators.

A job takes a streaming DataFrame and gives one; ``finished`` runs it over all that is there now into
a table in the shared folder, as a scheduled refresh does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import new_path


def endpoint_days(stream: DataFrame, key: str, stamp: str, value: str, delay: str = "2 hours") -> DataFrame:
    """UTC-day reductions over the endpoints 01:00 to the next midnight, given out once the watermark has passed the day.

    Windows are closed on the left, so stamps are moved back a microsecond, as a column of its own:
    inside the window the watermark would be lost.
    """
    moved = stream.withColumn("_t", F.col(stamp) - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_t", delay)
    days = moved.groupBy(key, F.window("_t", "1 day")).agg(F.count(value).alias("samples"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("greatest"))
    return days.select(key, F.to_date("window.start").alias("day"), "samples", "total", "least", "greatest")


def six_hour_blocks(stream: DataFrame, constraint: DataFrame, key: str, stamp: str, value: str, delay: str = "6 hours", how: str = "inner") -> DataFrame:
    """Block totals ending 00, 06, 12 and 18, joined with the constraint that arrives for (key, block_end).

    A block waits for its constraint, and a constraint for its block, as far as the watermarks of both go. Blocks whose constraint has
    not come by then are dropped, or given without one where ``how`` is ``left_outer``.
    """
    moved = stream.withColumn("_t", F.col(stamp) - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_t", delay)
    blocks = moved.groupBy(key, F.window("_t", "6 hours")).agg(F.sum(value).alias("total"), F.count(value).alias("samples"))
    # the time of a window is a microsecond before its end, and keeps the watermark
    blocks = blocks.select(F.col(key).alias("_key"), F.window_time("window").alias("_at"), "total", "samples")
    side = constraint.withColumn("_at2", F.col("block_end") - F.expr("INTERVAL 1 MICROSECOND")).withWatermark("_at2", delay)
    joined = blocks.join(side, (F.col("_key") == F.col(key)) & (F.col("_at") == F.col("_at2")), how)
    given = [c for c in constraint.columns if c not in (key, "block_end")]
    return joined.select(F.col("_key").alias(key), (F.col("_at") + F.expr("INTERVAL 1 MICROSECOND")).alias("block_end"), "total", "samples", *given)


def deduplicated(stream: DataFrame, keys: list[str], stamp: str, delay: str = "7 days") -> DataFrame:
    """Identical records once, as far back as the lookback reaches."""
    return stream.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(keys)


def latest(stream: DataFrame, keys: list[str], stamp: str, revision: str, fields: list[str], delay: str = "7 days") -> DataFrame:
    """Of each record (keys and stamp) the fields of its last revision, given out once no revision within the lookback can come."""
    held = stream.withWatermark(stamp, delay).groupBy(*keys, stamp).agg(F.max(F.struct(revision, *fields)).alias("_last"))
    return held.select(*keys, stamp, f"_last.{revision}", *(f"_last.{f}" for f in fields))


def finished(spark: SparkSession, out: DataFrame, name: str) -> DataFrame:
    """Run a streaming job over what is there, in append mode, and read its table. Tables and state go to the shared folder."""
    path = new_path(spark, f"stream-{name}")
    query = out.writeStream.format("parquet").option("path", f"{path}/table").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/table")
