"""What may be published, and what was: day archives, final and accepted outputs, late revisions, static domains, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_archives(hours: DataFrame, by: list[str], stamp: str, position: str, schema: str) -> DataFrame:
    """Per day whether its records stack into one archive: 24 of one schema, at 00 to 23 UTC and in the order of ``position``.

    Days are those of ``stamp``. ``fault``: ``count``, ``schema``, ``hours`` (one missing or not on the hour) or ``order``.
    """
    day = F.to_date(stamp)
    before = F.lag(stamp).over(Window.partitionBy(*by, "day").orderBy(position))
    marked = hours.withColumn("day", day).withColumn("_back", F.coalesce(before >= F.col(stamp), F.lit(False)))
    exact = F.when(F.date_trunc("hour", stamp) == F.col(stamp), F.hour(stamp))
    found = marked.groupBy(*by, "day").agg(F.count("*").alias("records"), F.count_distinct(exact).alias("_hours"), F.min(schema).alias("_a"), F.max(schema).alias("_b"), F.count(schema).alias("_n"), F.bool_or("_back").alias("_back"))
    one = (F.col("_a") == F.col("_b")) & (F.col("_n") == F.col("records"))
    fault = F.when(F.col("records") != 24, "count").when(~F.coalesce(one, F.lit(False)), "schema").when(F.col("_hours") != 24, "hours").when(F.col("_back"), "order")
    return found.select(*by, "day", "records", fault.alias("fault"))


def final_audit(records: DataFrame, by: list[str], hour: Column, fields: list[str], active: Column, keep: Column, accepted: Column, constrained: Column, expected: int = 24) -> DataFrame:
    """Per day: holes at active cells, values outside the envelope, whether the hours are 0 to ``expected`` - 1, and whether it passes.

    A constrained day must have been accepted, too. Null, NaN and infinite values are none.
    """
    there = lambda f: F.col(f).isNotNull() & ~F.isnan(f) & (F.abs(f) < float("inf"))
    holes = sum((F.when(F.coalesce(active, F.lit(False)) & ~there(f), 1).otherwise(0) for f in fields), F.lit(0))
    strays = sum((F.when(~F.coalesce(keep, F.lit(False)) & there(f), 1).otherwise(0) for f in fields), F.lit(0))
    within = hour.between(0, expected - 1)
    found = records.groupBy(*by).agg(
        F.sum(holes).alias("holes"), F.sum(strays).alias("outside"), (F.bool_and(F.coalesce(within, F.lit(False))) & (F.count_distinct(hour) == expected)).alias("hours_exact"),
        F.bool_and(~constrained | F.coalesce(accepted, F.lit(False))).alias("accepted"),
    )
    return found.withColumn("passed", (F.col("holes") == 0) & (F.col("outside") == 0) & F.col("hours_exact") & F.col("accepted"))


def accepted_days(outputs: DataFrame) -> DataFrame:
    """``ok`` for outputs (stream, records, calendar_day, reconciled, revisions): whole calendar days of an accepted constraint.

    Retrospective ones need one revision at least and all of them stable.
    """
    stable = (F.size("revisions") > 0) & F.forall("revisions", lambda r: r == "stable")
    ok = (F.col("records") == 24) & F.col("calendar_day") & F.col("reconciled") & ((F.col("stream") != "retro") | stable)
    return outputs.withColumn("ok", F.coalesce(ok, F.lit(False)))


def accepted_months(days: DataFrame, by: list[str], day: str) -> DataFrame:
    """Months of which every calendar day is there and ``ok``."""
    first = F.trunc(day, "month")
    found = days.groupBy(*by, first.alias("month")).agg(F.count_distinct(F.when(F.col("ok"), F.col(day))).alias("accepted_days"), F.bool_and("ok").alias("_all"))
    return found.select(*by, "month", "accepted_days", (F.col("_all") & (F.col("accepted_days") == F.dayofmonth(F.last_day("month")))).alias("accepted"))


def late_revisions(files: DataFrame, snapshot: DataFrame, as_of: Column, youngest: int = 8, oldest: int = 10) -> DataFrame:
    """What became of each file (file, day, bytes, content) of these ages against the snapshot (file, bytes, content) kept earlier.

    ``bytes`` and ``content`` are digests of the file and of what it decodes to.
    """
    age = F.datediff(as_of, F.col("day"))
    old = snapshot.select("file", F.col("bytes").alias("_bytes"), F.col("content").alias("_content"), F.lit(True).alias("_kept"))
    result = F.when(F.col("_kept").isNull(), "no_reference").when(F.col("bytes").eqNullSafe(F.col("_bytes")), "identical_bytes").when(F.col("content").eqNullSafe(F.col("_content")), "encoding_only").otherwise("decoded_changed")
    return files.withColumn("age_days", age).where(F.col("age_days").between(youngest, oldest)).join(old, "file", "left").select("file", "age_days", result.alias("result"))


def domain_inventory(required: DataFrame, found: DataFrame, shapes: DataFrame) -> DataFrame:
    """A status for each static file: ``pending`` (not there), ``incompatible`` (lacks a variable, or its grid isn't the domain's), else ``compatible``.

    ``required`` (domain, file, variable), ``found`` (file, variable), ``shapes`` (file, shape); a domain's grid is that which most of its files have,
    of equally many the least.
    """
    held = found.select("file", "variable", F.lit(True).alias("_has")).distinct()
    needs = required.join(held, ["file", "variable"], "left").groupBy("domain", "file").agg(F.count_if(F.col("_has").isNull()).alias("lacking"))
    each = needs.join(shapes.groupBy("file").agg(F.min("shape").alias("shape")), "file", "left")
    usual = each.where("shape is not null").groupBy("domain", "shape").agg(F.count("*").alias("n")).groupBy("domain").agg(F.min_by("shape", F.struct(-F.col("n"), F.col("shape"))).alias("_usual"))
    status = F.when(F.col("shape").isNull(), "pending").when((F.col("lacking") > 0) | (F.col("shape") != F.col("_usual")), "incompatible").otherwise("compatible")
    return each.join(usual, "domain", "left").select("domain", "file", "lacking", status.alias("status"))


def status_report(sources: DataFrame, products: DataFrame, as_of: Column, most_hours: float) -> DataFrame:
    """Rows (kind, name, metric, value): ages of sources (name, latest), missing and partial periods of products (name, missing, partial), and the issues that follow."""
    hours = (F.unix_timestamp(as_of) - F.unix_timestamp("latest")) / 3600
    ages = sources.select(F.lit("source").alias("kind"), "name", F.lit("age_hours").alias("metric"), hours.alias("value"))
    counts = products.select("name", F.explode(F.create_map(F.lit("missing"), "missing", F.lit("partial"), "partial")).alias("metric", "value"))
    counts = counts.select(F.lit("product").alias("kind"), "name", "metric", F.col("value").cast("double").alias("value"))
    metrics = ages.unionByName(counts)
    wrong = F.when(F.col("kind") == "source", F.col("value").isNull() | (F.col("value") > most_hours)).otherwise(F.col("value") > 0)
    return metrics.unionByName(metrics.where(wrong).withColumn("kind", F.lit("issue")))
