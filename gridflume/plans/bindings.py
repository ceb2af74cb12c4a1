"""How the operators' inputs are derived from the tables that the queries read, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Added before rounding, so values that lie right between two rounded ones go the same way in both engines.
NUDGE = 3.3e-9


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(column) if isinstance(column, str) else column) + NUDGE, digits)


def seconds(stamp: Column | str) -> Column:
    """A stamp as seconds since 1970, so that engines need not agree on how they show it."""
    return F.unix_timestamp(F.col(stamp) if isinstance(stamp, str) else stamp)


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-ending means per station (the event type) and their counts."""
    ts = F.date_trunc("hour", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 HOUR")
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("station"), ts.alias("hour_end")).agg(F.avg("value").alias("value"), F.count("*").alias("n"))


HOURLY = "SELECT event_type AS station, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end, avg(value) AS value, count(*) AS n FROM events GROUP BY ALL"


def station_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-ending means per user and event type."""
    ts = F.date_trunc("hour", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 HOUR")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("station"), F.col("event_type").alias("product"), ts.alias("hour_end")).agg(F.avg("value").alias("value"))


STATION_HOURS = "SELECT user_id AS station, event_type AS product, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end, avg(value) AS value FROM events GROUP BY ALL"


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thermodynamic state per event."""
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), (240 + v / 6).alias("t"), (0.001 + v / 100000).alias("q"), (70000 + v * 50).alias("p"),
        (F.col("user_id") * 10.0).alias("z0"), F.lit(500.0).alias("z1"), (200 + v / 4).alias("lw"), (v / 10 - 20).alias("u"), (15 - v / 20).alias("v"),
        (25 + F.col("user_id") % 28).cast("double").alias("lat"), (-125 + F.col("user_id") % 58).cast("double").alias("lon"),
    )


STATE = """SELECT event_id AS id, ts, 240 + value / 6 AS t, 0.001 + value / 100000 AS q, 70000 + value * 50 AS p, user_id * 10.0::DOUBLE AS z0, 500.0::DOUBLE AS z1,
200 + value / 4 AS lw, value / 10 - 20 AS u, 15 - value / 20 AS v, (25 + user_id % 28)::DOUBLE AS lat, (-125 + user_id % 58)::DOUBLE AS lon FROM events"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells 20 columns wide, numbered by part key."""
    k = F.col("p_partkey")
    y, x = F.floor(k / 20), k % 20
    return table(spark, sf_dir, "part").select(k.alias("cell"), y.alias("y"), x.alias("x"), (25 + y * 0.25).alias("lat"), (-125 + x * 3.0).alias("lon"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("value"))


GRID = """SELECT p_partkey AS cell, p_partkey // 20 AS y, p_partkey % 20 AS x, 25 + (p_partkey // 20) * 0.25::DOUBLE AS lat, -125 + (p_partkey % 20) * 3.0::DOUBLE AS lon,
p_size AS size, p_retailprice AS value FROM part"""


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")).agg(F.sum("l_quantity").alias("weight"))


LINKS = "SELECT l_partkey AS src, l_suppkey AS dst, sum(l_quantity) AS weight FROM lineitem GROUP BY ALL"


def reaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("link"), F.floor(k / 2).alias("to_link"), F.col("c_mktsegment").alias("kind"), F.col("c_nationkey").alias("domain"))


REACHES = "SELECT c_custkey AS link, c_custkey // 2 AS to_link, c_mktsegment AS kind, c_nationkey AS domain FROM customer"


#: ``temporal.signature`` over a column ``h`` of rows' SHA-256.
DIGEST = "count(*) || '.' || " + " || '.' || ".join(f"sum(('0x' || substr(h, {1 + 8 * k}, 8))::BIGINT)::HUGEINT" for k in range(4))
