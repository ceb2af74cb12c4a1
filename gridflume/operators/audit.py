"""Completeness, validation and revision audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Physical limits of the hourly fields.
LIMITS = {
    "t2d": (180.0, 340.0), "q2d": (0.0, 0.05), "psfc": (20000.0, 120000.0), "u2d": (-150.0, 150.0), "v2d": (-150.0, 150.0),
    "swdown": (0.0, 1400.0), "lwdown": (0.0, 1000.0), "rainrate": (0.0, 1.0),
}


def completeness(present: DataFrame, expected: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Expected, present and missing stamps per key and day."""
    seen = present.select(*keys, stamp).distinct().withColumn("_seen", F.lit(1))
    joined = expected.join(seen, [*keys, stamp], "left")
    return joined.groupBy(*keys, F.to_date(stamp).alias("day")).agg(F.count("*").alias("expected"), F.count("_seen").alias("present")).withColumn("missing", F.col("expected") - F.col("present"))


def limits_report(df: DataFrame, by: list[str], limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Per group and field: values, nulls, least, greatest, and how many break the limits."""
    long = df.unpivot(by, list(limits), "field", "value")
    low = F.coalesce(*[F.when(F.col("field") == f, F.lit(a)) for f, (a, _) in limits.items()])
    high = F.coalesce(*[F.when(F.col("field") == f, F.lit(b)) for f, (_, b) in limits.items()])
    v = F.col("value")
    return long.groupBy(*by, "field").agg(F.count(v).alias("finite"), F.count_if(v.isNull()).alias("missing"), F.min(v).alias("least"), F.max(v).alias("greatest"), F.count_if((v < low) | (v > high)).alias("violations"))


def revision_diff(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Per field: cells whose presence changed, cells whose value changed, and the largest difference."""
    a = left.select(*keys, *[F.col(f).alias(f"_l_{f}") for f in fields])
    b = right.select(*keys, *[F.col(f).alias(f"_r_{f}") for f in fields])
    both = a.join(b, keys, "full_outer")
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_l_{f}").cast("double").alias("l"), F.col(f"_r_{f}").cast("double").alias("r")) for f in fields])
    each = both.select(F.explode(parts).alias("p")).select("p.*")
    lone = F.col("l").isNull() != F.col("r").isNull()
    return each.groupBy("field").agg(F.count_if(lone).alias("mask_changed"), F.count_if(F.col("l") != F.col("r")).alias("value_changed"), F.coalesce(F.max(F.abs(F.col("l") - F.col("r"))), F.lit(0.0)).alias("largest_difference"))


def inventory(catalogue: DataFrame, by: list[str], period: str, size: str) -> DataFrame:
    """First and last period, distinct periods, duplicates and bytes."""
    n = F.count("*")
    return catalogue.groupBy(*by).agg(F.min(period).alias("first"), F.max(period).alias("last"), F.countDistinct(period).alias("unique"), (n - F.countDistinct(period)).alias("duplicates"), F.sum(size).alias("bytes"))


def availability_state(missing: Column, age_days: Column, recent: int = 2, risk: int = 6) -> Column:
    return F.when(missing == 0, "complete").when(age_days <= recent, "recent_pending").when(age_days <= risk, "incomplete").otherwise("at_risk")


def failed_checks(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Names of the checks that do not hold, and whether all do."""
    named = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()])
    return df.withColumn("failed", F.array_join(F.array_compact(named), ",")).withColumn("eligible", F.col("failed") == "")


def chained(segments: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Whether each segment starts where the one before it ends; the first one of a key does."""
    before = F.lag(end).over(Window.partitionBy(*keys).orderBy(start))
    return segments.withColumn("chained", before.isNull() | (before == F.col(start)))


def dataset_changes(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Keys whose rows are not exactly equal, nulls alike: which side lacks the row, or which fields differ."""
    a = left.select(*keys, F.struct(*fields).alias("_l"))
    b = right.select(*keys, F.struct(*fields).alias("_r"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"_l.{f}").eqNullSafe(F.col(f"_r.{f}")), F.lit(f)) for f in fields]))
    change = F.when(F.col("_l").isNull(), "added").when(F.col("_r").isNull(), "removed").otherwise(F.array_join(differs, ","))
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change")).where("change <> ''")


def state_inventory(states: DataFrame, by: list[str], value: str, low: Column, high: Column) -> DataFrame:
    """Per group: values, missing ones, range, mean, negatives, and those out of bounds."""
    v = F.col(value)
    return states.groupBy(*by).agg(F.count(v).alias("n"), F.count_if(v.isNull()).alias("missing"), F.min(v).alias("least"), F.max(v).alias("greatest"), F.avg(v).alias("mean"), F.count_if(v < 0).alias("negative"), F.count_if((v < low) | (v > high)).alias("out_of_bounds"))


def content(cells: DataFrame, by: list[str], field: str, inside: Column, land: Column) -> DataFrame:
    """Per group: values missing in the domain and on its land, values outside, and digests of both parts' values (column ``cell`` names a cell).

    A digest is the sum of the cells' hashes, so it is added up in parts and doesn't depend on order.
    """
    there, inside, land = F.col(field).isNotNull(), F.coalesce(inside, F.lit(False)), F.coalesce(land, F.lit(False))
    mark = F.crc32(F.concat_ws(":", F.col("cell").cast("string"), F.round(F.col(field) * 100).cast("long").cast("string")).cast("binary"))
    digest = lambda c: F.coalesce(F.sum(F.when(c & there, mark)), F.lit(0))
    return cells.groupBy(*by).agg(
        F.count_if(inside & ~there).alias("missing"), F.count_if(inside & land & ~there).alias("missing_on_land"), F.count_if(~inside & there).alias("outside"),
        digest(inside).alias("inside_digest"), digest(~inside).alias("outside_digest"),
    )


def scenario(hours: DataFrame, by: list[str], source: str, expected: Column, forbidden: Column, needed: int = 24) -> DataFrame:
    """Per group: its hours, those of the expected source alone, uses of the forbidden one, and whether it is as planned."""
    found = hours.groupBy(*by).agg(
        F.countDistinct("hour").alias("hours"), F.count_if(~F.coalesce(F.col(source) == expected, F.lit(False))).alias("unexpected"), F.count_if(F.coalesce(F.col(source) == forbidden, F.lit(False))).alias("forbidden")
    )
    return found.withColumn("valid", (F.col("hours") == needed) & (F.col("unexpected") == 0) & (F.col("forbidden") == 0))


def absent_hours(keys: DataFrame, catalogue: DataFrame, by: list[str], start: Column, stop: Column) -> DataFrame:
    """Hours of a period, the one at its end included, that a key's catalogue (by, stamp) lacks."""
    spine = keys.select(*by, F.explode(F.sequence(start, stop, F.expr("INTERVAL 1 HOUR"))).alias("stamp"))
    return spine.join(catalogue.select(*by, "stamp").distinct(), [*by, "stamp"], "left_anti")


def hourly_day(records: DataFrame, by: list[str], hour: str, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Per day of hours that come apart: hours there, missing values, values beyond their limits, the worst hour, and whether all 24 pass."""
    each = limits_report(records, [*by, hour], limits).groupBy(*by, hour).agg(F.sum("missing").alias("missing"), F.sum("violations").alias("violations"))
    worst = F.max_by(hour, F.struct(F.col("missing") + F.col("violations"), -F.col(hour)))
    day = each.groupBy(*by).agg(F.count_if(F.col(hour).between(0, 23)).alias("hours"), F.count("*").alias("_n"), F.sum("missing").alias("missing"), F.sum("violations").alias("violations"), worst.alias("worst_hour"))
    return day.withColumn("passed", (F.col("hours") == 24) & (F.col("_n") == 24) & (F.col("missing") == 0) & (F.col("violations") == 0)).drop("_n")


def daily_stream(records: DataFrame, by: list[str], day: str, stamp: str, limits: dict[str, tuple[float, float]], cells: int, masks: tuple[str, str] | None = None, revision: tuple[str, str] | None = None, accepted: str | None = None) -> DataFrame:
    """A row per day of a stream: hours, first and last of them, per field its finite values and range, its ``issues``, and whether it has none.

    A record is a cell at a stamp. ``issues``: ``grid`` (an hour has not ``cells`` rows), ``hours`` (not 24), ``spacing`` (24, but not hourly), ``revision`` (of (column, expected): any other),
    ``reconciliation`` (``accepted`` is not true somewhere), ``<field>_empty`` (no finite value), ``<field>_range``, ``masks`` (the two fields of ``masks`` are there in different cells).
    Values that are not finite count as absent. Hours are summed before days, so a day's cells never meet in one task; rows without stamp or day have their own.
    """
    finite = lambda f: F.when(~F.isnan(f) & (F.abs(F.col(f).cast("double")) < float("inf")), F.col(f).cast("double"))
    aggs = [F.count("*").alias("_cells")]
    for f in limits:
        aggs += [F.count(finite(f)).alias(f"_n_{f}"), F.min(finite(f)).alias(f"_a_{f}"), F.max(finite(f)).alias(f"_z_{f}")]
    aggs.append((F.count_if(F.col(masks[0]).isNull() != F.col(masks[1]).isNull()) if masks else F.lit(0)).alias("_masks"))
    aggs.append((F.count_if(~F.col(revision[0]).eqNullSafe(F.lit(revision[1]))) if revision else F.lit(0)).alias("_revision"))
    aggs.append((F.count_if(~F.coalesce(F.col(accepted), F.lit(False))) if accepted else F.lit(0)).alias("_refused"))
    hours = records.groupBy(*by, day, stamp).agg(*aggs)
    second = F.unix_timestamp(stamp)
    total = [F.sum(f"_n_{f}").alias(f"{f}_finite") for f in limits] + [F.min(f"_a_{f}").alias(f"{f}_least") for f in limits] + [F.max(f"_z_{f}").alias(f"{f}_greatest") for f in limits]
    whole = hours.groupBy(*by, day).agg(
        F.count(stamp).alias("hours"), F.min(stamp).alias("first"), F.max(stamp).alias("last"), F.min(F.pmod(second, F.lit(3600))).alias("_p"), F.max(F.pmod(second, F.lit(3600))).alias("_q"),
        F.count_if(F.col("_cells") != cells).alias("_grid"), F.sum("_masks").alias("_masks"), F.sum("_revision").alias("_revision"), F.sum("_refused").alias("_refused"), *total,
    )
    even = (F.unix_timestamp("last") - F.unix_timestamp("first") == 23 * 3600) & (F.col("_p") == F.col("_q"))
    found = [F.when(F.col("_grid") > 0, "grid"), F.when(F.col("hours") != 24, "hours").when(~even, "spacing"), F.when(F.col("_revision") > 0, "revision"), F.when(F.col("_refused") > 0, "reconciliation")]
    found += [F.when(F.col(f"{f}_finite") == 0, f"{f}_empty").when((F.col(f"{f}_least") < lo) | (F.col(f"{f}_greatest") > hi), f"{f}_range") for f, (lo, hi) in limits.items()]
    found.append(F.when(F.col("_masks") > 0, "masks"))
    out = whole.withColumn("issues", F.array_compact(F.array(*found))).withColumn("accepted", F.size("issues") == 0)
    return out.drop("_grid", "_masks", "_revision", "_refused", "_p", "_q")


def validation_gate(reports: DataFrame, by: list[str], issues: str) -> tuple[DataFrame, DataFrame]:
    """Reports (an array of issues each) as one gate per key, and how many reports of a key name each issue."""
    clean = F.coalesce(F.size(issues) == 0, F.lit(False))
    gate = reports.groupBy(*by).agg(F.count("*").alias("reports"), F.count_if(clean).alias("accepted_reports"), F.bool_and(clean).alias("gate"))
    reasons = reports.select(*by, F.explode(issues).alias("issue")).groupBy(*by, "issue").agg(F.count("*").alias("reports"))
    return gate, reasons


def production_inventory(files: DataFrame, by: list[str], period: str, size: str, partial: str, start: Column | None = None, end: Column | None = None, monthly: bool = False, shown: int = 20) -> DataFrame:
    """What a stream's files (by, period, size, partial) cover per key, between start and end (else its first and last period).

    ``period`` is a date, for monthly files any of the month. Partial files are counted, nothing else; so are files without period. ``missing`` counts absent periods,
    ``missing_shown`` gives the first ``shown``, ``missing_truncated`` whether that is not all; ``duplicates`` counts periods with several files; ``segments`` counts runs of periods.
    """
    step = "1 MONTH" if monthly else "1 DAY"
    floor = lambda c: F.trunc(c, "month") if monthly else F.to_date(c)
    p = floor(F.col(period))
    left_out = F.lit(False)
    if start is not None:
        left_out = left_out | (p < floor(start))
    if end is not None:
        left_out = left_out | (p > floor(end))
    whole = F.coalesce(~F.col(partial), F.lit(True)) & p.isNotNull() & ~F.coalesce(left_out, F.lit(False))
    marked = files.withColumn("_p", F.when(whole, p))
    partials = marked.groupBy(*by).agg(F.count_if(F.coalesce(F.col(partial), F.lit(False))).alias("partial_files"), F.count_if(F.col(period).isNull()).alias("undated_files"))
    periods = marked.where("_p is not null").groupBy(*by, "_p").agg(F.count("*").alias("_files"), F.sum(size).alias("_bytes"))
    before = F.lag("_p").over(Window.partitionBy(*by).orderBy("_p"))
    next_one = F.add_months(before, 1) if monthly else F.date_add(before, 1)
    runs = periods.withColumn("_new", F.coalesce(next_one != F.col("_p"), F.lit(True)))
    seen = runs.groupBy(*by).agg(F.min("_p").alias("first"), F.max("_p").alias("last"), F.count("*").alias("unique"), F.sum("_files").alias("files"), F.count_if(F.col("_files") > 1).alias("duplicates"), F.sum("_bytes").alias("bytes"), F.count_if("_new").alias("segments"))
    bounds = partials.join(seen, by, "left").withColumns({"_from": floor(start) if start is not None else F.col("first"), "_to": floor(end) if end is not None else F.col("last")})
    spine = bounds.where("_from <= _to").select(*by, F.explode(F.sequence(F.col("_from"), F.greatest("_from", "_to"), F.expr(f"INTERVAL {step}"))).alias("_p"))
    lacking = spine.join(periods.select(*by, "_p"), [*by, "_p"], "left_anti").withColumn("_k", F.row_number().over(Window.partitionBy(*by).orderBy("_p")))
    gaps = lacking.groupBy(*by).agg(F.count("*").alias("missing"), F.array_sort(F.collect_list(F.when(F.col("_k") <= shown, F.col("_p")))).alias("missing_shown"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("unique", "files", "duplicates", "bytes", "segments", "missing")}
    out = bounds.join(gaps, by, "left").withColumns(zero | {"missing_shown": F.coalesce("missing_shown", F.array().cast("array<date>"))})
    return out.withColumn("missing_truncated", F.col("missing") > shown).drop("_from", "_to")
