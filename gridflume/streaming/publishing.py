"""Publications that streams extend: whole days, routed late rows, and the receipts of what was written.

A batch writes its data under its own number and then a manifest of what it decided; only what a manifest names is
published. A batch that is run again, after a crash say, decides by the manifests before it alone and writes the same
again, so nothing is doubled, lost or seen half written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "day date, as_of long, hours int, complete boolean, constrained boolean, batch long"
FRONTIER = "batch long, newest timestamp, on_time long, late long, backlog long"
RECEIPT = "publication string, inputs array<string>, rows long, missing long, digest string, status string"


def _prepared(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The manifests below ``root``, none at first."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/manifest/of=none")
    return spark.read.schema(schema).parquet(f"{root}/manifest").select(*(c.split()[0] for c in schema.split(", ")))


def current_days(manifests: DataFrame) -> DataFrame:
    """Of each day the publication that counts: that of the last batch."""
    return manifests.groupBy("day").agg(F.max_by(F.struct("as_of", "hours", "complete", "constrained", "batch"), "batch").alias("m")).select("day", "m.*")


def extend_days(root: str, needed: int = 24) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: publish candidates (day, as_of, hour, constrained, fields) of days that grow hour by hour.

    A candidate is all rows of a day and ``as_of``; its hours must run from 0 without a gap. Of a batch's candidates the
    constrained, then the longest, then the latest is taken. It replaces the day's publication unless that has more hours,
    or is constrained where the candidate isn't. A day is complete with ``needed`` hours. Rows without a day, hour or
    ``as_of`` count for no candidate.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = current_days(_prepared(spark, root, MANIFEST).where(F.col("batch") < number)).select("day", F.col("hours").alias("_hours"), F.col("constrained").alias("_held"))
        rows = batch.where("day is not null and hour is not null and as_of is not null")
        each = rows.groupBy("day", "as_of").agg(
            F.count_distinct("hour").cast("int").alias("hours"), F.max("hour").alias("last"), F.min("hour").alias("first"), F.bool_and(F.coalesce("constrained", F.lit(False))).alias("constrained")
        ).where("first = 0 and last = hours - 1")
        best = each.groupBy("day").agg(F.max(F.struct("constrained", "hours", "as_of")).alias("b")).select("day", "b.*")
        taken = best.join(old, "day", "left").where("_hours is null or (hours >= _hours and (constrained or not _held))")
        taken = taken.select("day", "as_of", "hours", (F.col("hours") == needed).alias("complete"), "constrained", F.lit(number).cast("long").alias("batch"))
        chosen = f"{root}/chosen/of={number}"
        taken.write.mode("overwrite").parquet(chosen)
        taken = spark.read.schema(MANIFEST).parquet(chosen)
        rows.join(taken.select("day", "as_of"), ["day", "as_of"], "left_semi").write.mode("overwrite").partitionBy("day").parquet(f"{root}/data/of={number}")
        taken.write.mode("overwrite").parquet(f"{root}/manifest/of={number}")

    return run


def published_days(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of each day's current publication, with ``batch`` and ``complete``."""
    data = spark.read.option("basePath", f"{root}/data").schema(f"{schema}, of long").parquet(f"{root}/data")
    now = current_days(_prepared(spark, root, MANIFEST)).select("day", F.col("batch").alias("of"), "complete")
    return data.join(now, ["day", "of"]).withColumnRenamed("of", "batch")


def route_late(root: str, stamp: str, lookback: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows as ``on_time`` (not older than any before), ``late`` (within the lookback) or ``backlog`` (older).

    The newest stamp of earlier batches less the lookback is the line, as for a watermark; rows without a stamp are backlog.
    Every row lands in the table of its kind; only those of the first two are for the job, the backlog is for a batch job.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # one row, as the manifests hold a row for each batch
        newest = _prepared(spark, root, FRONTIER).where(F.col("batch") < number).agg(F.max("newest").alias("_newest"))
        t, line = F.col(stamp), F.col("_newest") - F.expr(f"INTERVAL {lookback}")
        kind = F.when(t.isNull() | (t < line), "backlog").when(t < F.col("_newest"), "late").otherwise("on_time")
        routed = batch.withColumn("_one", F.lit(1)).join(F.broadcast(newest.withColumn("_one", F.lit(1))), "_one").withColumn("kind", kind).drop("_one", "_newest")
        seen = Observation()
        of = lambda k: F.count_if(F.col("kind") == k).alias(k)
        routed.observe(seen, F.max(stamp).alias("newest"), of("on_time"), of("late"), of("backlog")).write.mode("overwrite").partitionBy("kind").parquet(f"{root}/rows/of={number}")
        got = seen.get
        spark.createDataFrame([(number, got["newest"], got["on_time"], got["late"], got["backlog"])], FRONTIER).write.mode("overwrite").parquet(f"{root}/manifest/of={number}")

    return run


def routed_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.option("basePath", f"{root}/rows").schema(f"{schema}, of long, kind string").parquet(f"{root}/rows").withColumnRenamed("of", "batch")


def route_counts(spark: SparkSession, root: str) -> DataFrame:
    """(batch, newest, on_time, late, backlog), as counted by the writes."""
    return _prepared(spark, root, FRONTIER)


def row_digest(columns: list[str]) -> Column:
    """Sum over rows of the first 60 bits of an MD5 of their values, whatever their order; repeated rows count."""
    each = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))
    return F.sum(F.conv(F.substring(F.md5(each), 1, 15), 16, 10).cast("decimal(38,0)")).cast("string")


def publish(rows: DataFrame, root: str, name: str, inputs: list[str], columns: list[str], least_rows: int = 1) -> None:
    """Write ``rows`` as publication ``name`` and append its receipt; counts and digest come from the write itself.

    ``missing`` counts rows that lack one of ``columns``. A publication of less than ``least_rows`` rows is
    ``refused``, one with missing values ``incomplete``; the receipt says so, and ``accepted_rows`` gives neither.
    """
    spark, seen = rows.sparkSession, Observation()
    lacks = F.count_if(F.greatest(*(F.col(c).isNull().cast("int") for c in columns), F.lit(0)) > 0)
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), lacks.alias("missing"), row_digest(columns).alias("digest")).write.mode("overwrite").parquet(f"{root}/data/publication={name}")
    got = seen.get
    status = "refused" if got["rows"] < least_rows else "incomplete" if got["missing"] else "passed"
    spark.createDataFrame([(name, sorted(inputs), got["rows"], got["missing"], got["digest"] or "0", status)], RECEIPT).write.mode("overwrite").parquet(f"{root}/manifest/of={name}")


def receipts(spark: SparkSession, root: str) -> DataFrame:
    return _prepared(spark, root, RECEIPT)


def accepted_rows(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of all publications that passed."""
    data = spark.read.option("basePath", f"{root}/data").schema(f"{schema}, publication string").parquet(f"{root}/data")
    return data.join(receipts(spark, root).where("status = 'passed'").select("publication"), "publication", "left_semi")


def gathered(spark: SparkSession, root: str, arrivals: list[DataFrame], put: Callable[[DataFrame, int], None]) -> None:
    """Run ``put`` over each arrival as a scheduled refresh does: a restart of the same query over what is new."""
    for number, rows in enumerate(arrivals):
        rows.write.mode("overwrite").parquet(f"{root}/in/arrival={number}")
        stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
        query = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        query.awaitTermination()
