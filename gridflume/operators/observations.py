"""Station observations: summaries, spans, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def series_summary(records: DataFrame, by: list[str], stamp: str, value: str, flag: str) -> DataFrame:
    v = F.col(value)
    flags = F.array_join(F.sort_array(F.collect_set(F.when(F.trim(flag) != "", F.col(flag)))), ",")
    return records.groupBy(*by).agg(
        F.count("*").alias("rows"), F.count(v).alias("numeric"), F.count_if(v.isNull()).alias("missing"), F.count_if(v < 0).alias("negative"),
        F.min(stamp).alias("first"), F.max(stamp).alias("latest"), flags.alias("flags"),
    )


def span_metrics(days: DataFrame, by: list[str], day: str) -> DataFrame:
    """Days with a value between the first and the last of each key, completeness, and the longest gap inside."""
    d = days.select(*by, day).distinct()
    gap = F.datediff(F.col(day), F.lag(day).over(Window.partitionBy(*by).orderBy(day))) - 1
    out = d.withColumn("_gap", F.coalesce(gap, F.lit(0))).groupBy(*by).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("valid_days"), F.max("_gap").alias("longest_gap"))
    expected = F.datediff("last_day", "first_day") + 1
    return out.withColumn("expected_days", expected).withColumn("completeness", F.col("valid_days") / F.col("expected_days"))


def annual_completeness(days: DataFrame, by: list[str], day: str) -> DataFrame:
    """Valid over expected days of each calendar year, clipped to the observed span."""
    d = days.select(*by, day).distinct()
    span = d.groupBy(*by).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    years = d.groupBy(*by, F.year(day).alias("year")).agg(F.count("*").alias("valid_days")).join(span, by)
    first = F.greatest(F.make_date("year", F.lit(1), F.lit(1)), F.col("_a"))
    last = F.least(F.make_date("year", F.lit(12), F.lit(31)), F.col("_b"))
    expected = F.datediff(last, first) + 1
    return years.select(*by, "year", "valid_days", expected.alias("expected_days"), (F.col("valid_days") / expected).alias("completeness"))


def conflicting_days(records: DataFrame, by: list[str], value: str) -> DataFrame:
    """Days of a series with more than one value are left out; others keep theirs."""
    return records.groupBy(*by).agg(F.countDistinct(value).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")


def active_since(stations: DataFrame, series: DataFrame, key: str, end: str, cutoff) -> DataFrame:
    """Stations with a series that ends at or after the cutoff; ``unknown_end`` marks ones with an open series only."""
    known = series.groupBy(key).agg(F.bool_or(F.coalesce(F.col(end) >= cutoff, F.lit(False))).alias("_active"), F.bool_or(F.col(end).isNull()).alias("unknown_end"))
    return stations.join(known.where("_active or unknown_end"), key).withColumn("active", F.col("_active")).drop("_active")


def acquisition_tasks(series: DataFrame, station: str, start: str, stop: str) -> DataFrame:
    """Request windows from start to stop, split at year ends, with a stable id each."""
    first, last = F.col(start), F.col(stop)
    years = series.where(first <= last).withColumn("_year", F.explode(F.sequence(F.year(first), F.year(last))))
    split = years.select(station, F.greatest(first, F.make_date("_year", F.lit(1), F.lit(1))).alias("first_day"), F.least(last, F.make_date("_year", F.lit(12), F.lit(31))).alias("last_day"))
    return split.withColumn("request", F.sha2(F.concat_ws("|", F.col(station).cast("string"), F.col("first_day").cast("string"), F.col("last_day").cast("string")), 256))


def period_report(records: DataFrame, by: list[str], period: str, value: str, flag: str, first: Column, last: Column, step: str) -> DataFrame:
    """``series_summary`` with the periods of a calendar from first to last (dates; columns of ``by`` or literals), ``step`` apart, that a series lacks.

    ``period`` is a date, the first day of its period. ``absent`` counts the lacking ones, ``absent_first`` and ``absent_last`` bound them;
    ``absent_periods`` gives them all, a row each. ``latest_numeric`` is the last period with a value.
    """
    summary = series_summary(records, by, period, value, flag)
    latest = records.groupBy(*by).agg(F.max(F.when(F.col(value).isNotNull(), F.col(period))).alias("latest_numeric"))
    lacking = absent_periods(records, by, period, first, last, step).groupBy(*by).agg(F.count("*").alias("absent"), F.min(period).alias("absent_first"), F.max(period).alias("absent_last"))
    return summary.join(latest, by).join(lacking, by, "left").withColumn("absent", F.coalesce("absent", F.lit(0)))


def absent_periods(records: DataFrame, by: list[str], period: str, first: Column, last: Column, step: str) -> DataFrame:
    """Periods from first to last without any record, a row per key and period; a key whose first is after its last has none."""
    keys = records.select(*by).distinct().where(first <= last)
    spine = keys.select(*by, F.explode(F.sequence(first, F.greatest(first, last), F.expr(f"INTERVAL {step}"))).alias(period))
    return spine.join(records.select(*by, period).distinct(), [*by, period], "left_anti")


def padded_span(days: DataFrame, by: list[str], day: str, first: Column, last: Column) -> DataFrame:
    """Valid days of a stated period, its length, completeness, and the longest gap, the ends of the period included.

    ``first`` and ``last`` are dates over the columns ``by``. Keys without a day inside are not in the result; see ``discharge_report``.
    """
    d = days.select(*by, day).where(F.col(day).between(first, last)).distinct()
    before = F.coalesce(F.lag(day).over(Window.partitionBy(*by).orderBy(day)), F.date_sub(first, 1))
    each = d.withColumns({"_gap": F.datediff(F.col(day), before) - 1, "_first": first, "_last": last})
    out = each.groupBy(*by).agg(F.count("*").alias("valid_days"), F.max("_gap").alias("_inner"), F.max(day).alias("_z"), F.first("_first").alias("_first"), F.first("_last").alias("_last"))
    expected = F.datediff("_last", "_first") + 1
    return out.select(*by, expected.alias("expected_days"), "valid_days", (F.col("valid_days") / expected).alias("completeness"), F.greatest("_inner", F.datediff("_last", "_z")).alias("longest_gap"))


def discharge_days(records: DataFrame, series: DataFrame) -> DataFrame:
    """Days of each station: whether its values conflict, whether it is valid, approved, estimated.

    ``records``: station, series, day, discharge, approval, qualifier. ``series``: station, series, primary. Only primary series count where a station
    has one, else all of its known ones (``policy``). A day whose numbers differ is in conflict and neither valid nor approved nor estimated.
    """
    policy = series.groupBy("station").agg(F.bool_or(F.coalesce(F.col("primary"), F.lit(False))).alias("_any"))
    known = series.groupBy("station", "series").agg(F.bool_or(F.coalesce(F.col("primary"), F.lit(False))).alias("_primary")).join(policy, "station")
    used = known.where("_primary or not _any").select("station", "series", F.when(F.col("_any"), "primary_only").otherwise("nonprimary_no_primary_metadata").alias("policy"))
    number = F.col("discharge").isNotNull()
    estimated = F.upper("qualifier").contains("ESTIM") | (F.lower("qualifier") == "e")
    days = records.join(used, ["station", "series"]).groupBy("station", "policy", "day").agg(
        F.min("discharge").alias("_a"), F.max("discharge").alias("_z"), F.bool_or(number & F.coalesce(F.col("approval") == "Approved", F.lit(False))).alias("approved"), F.bool_or(number & F.coalesce(estimated, F.lit(False))).alias("estimated"),
    )
    conflict = F.coalesce(F.col("_a") != F.col("_z"), F.lit(False))
    valid = F.col("_a").isNotNull() & ~conflict
    return days.select("station", "policy", "day", conflict.alias("conflict"), valid.alias("valid"), (valid & F.col("approved")).alias("approved"), (valid & F.col("estimated")).alias("estimated"))


def discharge_report(records: DataFrame, series: DataFrame, start: Column, stop: Column, full: float = 0.9) -> DataFrame:
    """A row per station of ``series`` with what its discharge covers; inputs as of ``discharge_days``, start and stop are dates.

    Observed figures are of the span from the first valid day to the last and null without one; ``requested_*`` are of start to stop, where a station
    without valid days has a completeness of 0 and a gap of the whole period. ``full_years`` counts calendar years wholly inside the
    observed span with at least the share ``full`` of their days.
    """
    # records and series are dealt out once, by station; all that follows stays where it is
    yes = lambda ok: F.coalesce(ok, F.lit(False))
    number, estimated = F.col("discharge").isNotNull(), F.upper("qualifier").contains("ESTIM") | (F.lower("qualifier") == "e")
    told = series.select("station", "series", F.lit(True).alias("_known"), yes(F.col("primary")).alias("_primary"))
    given = records.where("station is not null").select(
        "station", "series", F.lit(False).alias("_known"), F.lit(False).alias("_primary"), "day", "discharge", (number & yes(F.col("approval") == "Approved")).alias("approved"), (number & yes(estimated)).alias("estimated")
    )
    each = given.unionByName(told, allowMissingColumns=True).repartition("station")
    of_series, station = Window.partitionBy("station", "series"), Window.partitionBy("station")
    each = each.withColumns({"_first": F.row_number().over(of_series.orderBy("_known")) == 1, "_asked": F.max("_known").over(of_series) & F.col("series").isNotNull(), "_main": F.max("_primary").over(of_series)})
    each = each.withColumns({"_any": F.max("_primary").over(station), "_there": F.max("_known").over(station)}).where("_there")
    record = ~F.col("_known")
    mine = lambda c: F.when(record & F.col("_asked") & (F.col("_main") | ~F.col("_any")), F.col(c))
    days = each.groupBy("station", "day").agg(
        F.max("_any").alias("_any"), F.count_if(record).alias("rows"), F.count_if(record & (F.col("discharge") < 0)).alias("negative_rows"), F.count_if(record & F.col("_first") & F.col("series").isNotNull()).alias("series_returned"),
        F.min(mine("discharge")).alias("_a"), F.max(mine("discharge")).alias("_z"), F.bool_or(mine("approved")).alias("approved"), F.bool_or(mine("estimated")).alias("estimated"),
    )
    conflict = yes(F.col("_a") != F.col("_z"))
    day = F.when(F.col("_a").isNotNull() & ~conflict, F.col("day"))
    before = F.last("_day", ignorenulls=True).over(station.orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumns({"conflict": conflict, "valid": F.col("_a").isNotNull() & ~conflict, "_day": day}).withColumns({"_before": before, "_asked": F.col("valid") & yes(F.col("day").between(start, stop))})
    inner = F.datediff("day", F.greatest(F.coalesce("_before", F.date_sub(start, 1)), F.date_sub(start, 1))) - 1
    years = days.groupBy("station", F.year("day").alias("_year")).agg(
        F.max("_any").alias("_any"), *(F.sum(c).alias(c) for c in ("rows", "negative_rows", "series_returned")), F.count_if("conflict").alias("conflicts"), F.count_if(F.col("valid") & F.col("approved")).alias("approved_days"),
        F.count_if(F.col("valid") & F.col("estimated")).alias("estimated_days"), F.min("_day").alias("first_day"), F.max("_day").alias("last_day"), F.count_if("valid").alias("_valid"),
        F.max(F.when(F.col("valid"), F.coalesce(F.datediff("day", "_before") - 1, F.lit(0)))).alias("_gap"), F.count_if("_asked").alias("requested_valid_days"), F.max(F.when(F.col("_asked"), inner)).alias("_inner"), F.max(F.when(F.col("_asked"), F.col("day"))).alias("_last"),
    )
    one, other = F.make_date("_year", F.lit(1), F.lit(1)), F.make_date("_year", F.lit(12), F.lit(31))
    years = years.withColumn("_full", (one >= F.min("first_day").over(station)) & (other <= F.max("last_day").over(station)) & (F.col("_valid") / (F.datediff(other, one) + 1) >= full))
    out = years.groupBy("station").agg(
        F.when(F.max("_any"), "primary_only").otherwise("nonprimary_no_primary_metadata").alias("policy"), *(F.sum(c).alias(c) for c in ("rows", "series_returned", "negative_rows", "conflicts", "approved_days", "estimated_days")),
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.sum("_valid").alias("_valid"), F.max("_gap").alias("observed_longest_gap"), F.sum("requested_valid_days").alias("requested_valid_days"),
        F.max("_inner").alias("_inner"), F.max("_last").alias("_last"), F.count_if(F.col("_valid") > 0).alias("years_with_data"), F.count_if("_full").alias("full_years"),
    )
    length = F.datediff(stop, start) + 1
    out = out.withColumns({"observed_expected_days": F.datediff("last_day", "first_day") + 1, "observed_valid_days": F.when(F.col("_valid") > 0, F.col("_valid")), "requested_expected_days": length})
    out = out.withColumns({
        "observed_completeness": F.col("observed_valid_days") / F.col("observed_expected_days"), "requested_longest_gap": F.coalesce(F.greatest("_inner", F.datediff(stop, F.col("_last"))), length),
        "requested_completeness": F.when(F.col("requested_valid_days") > 0, F.col("requested_valid_days") / length).otherwise(F.lit(0.0)),
    })
    spans = [f"{of}_{c}" for of in ("observed", "requested") for c in ("expected_days", "valid_days", "completeness", "longest_gap")]
    return out.select("station", "policy", "rows", "series_returned", "negative_rows", "conflicts", "approved_days", "estimated_days", "first_day", "last_day", *spans, "years_with_data", "full_years")


def histogram(records: DataFrame, by: list[str], *columns: str) -> DataFrame:
    """Rows per key, column and its value (as text, null for none): counts of qualifiers, statuses, sources."""
    long = records.select(*by, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))).alias("_c")).select(*by, "_c.*")
    return long.groupBy(*by, "column", "value").agg(F.count("*").alias("rows"))


def request_windows(series: DataFrame, by: list[str], today: Column, update: bool = False) -> DataFrame:
    """What to ask a provider for: windows (request_start, request_end) of each series, split at year ends for hourly and event ones, their id, and ``fault``.

    ``series``: by, duration_code, start, advertised_end (null: still open), checked_through (null: never). An update goes back 400 days for daily series and 7 for hourly and event
    ones, or to the day after the last checked one where that is earlier; monthly series are always asked whole. ``fault`` is ``no_backfill`` for
    an update of a series never checked. Series that start after their end give no row. Ordered by ``place``: long windows first, then by falling end.
    """
    split = F.col("duration_code").isin("H", "E")
    end = F.least(today, F.col("advertised_end"))
    begin = F.col("start")
    fault = F.lit(None).cast("string")
    if update:
        back = F.date_sub(today, F.when(F.col("duration_code") == "D", 400).otherwise(7))
        moved = F.greatest(begin, F.least(back, F.date_add("checked_through", 1)))
        monthly = F.col("duration_code").eqNullSafe(F.lit("M"))
        fault = F.when(~monthly & F.col("checked_through").isNull(), "no_backfill")
        begin = F.when(~monthly & F.col("checked_through").isNotNull(), moved).otherwise(begin)
    asked = series.withColumns({"_a": begin, "_z": end, "fault": fault}).where("_a <= _z")
    years = F.when(split, F.sequence(F.year("_a"), F.greatest(F.year("_a"), F.year("_z")))).otherwise(F.array(F.year("_a")))
    each = asked.withColumn("_y", F.explode(years))
    first = F.when(F.col("_y") == F.year("_a"), F.col("_a")).otherwise(F.make_date("_y", F.lit(1), F.lit(1)))
    last = F.when(split, F.least(F.col("_z"), F.make_date("_y", F.lit(12), F.lit(31)))).otherwise(F.col("_z"))
    windows = each.select(*by, "duration_code", first.alias("request_start"), last.alias("request_end"), "fault")
    parts = F.to_json(F.struct(*by, "duration_code", "request_start", "request_end"))
    return windows.withColumn("request_id", F.sha2(parts, 256)).withColumn("place", F.struct(split.alias("late"), (-F.unix_date("request_end")).alias("back"), F.col("request_id").alias("id")))


def gauge_crosswalk(mapping: DataFrame, stations: DataFrame, series: DataFrame, domains: DataFrame) -> DataFrame:
    """Stations with the reach their gauge maps to, how many series they have, the domains that report them, and what is wrong.

    ``mapping``: gauge, feature_id; only gauges of 8 to 15 digits count, as stations ``USGS-`` and the gauge. ``stations``: station. ``series``: station, series. ``domains``: domain, station. Stations that no
    gauge maps to are left out. ``fault``: ``mapping`` (several rows of a gauge; the least reach is shown), ``no_series``. A station counts once, however often it is listed.
    """
    gauge = F.trim("gauge")
    mapped = mapping.where(gauge.rlike("^[0-9]{8,15}$")).groupBy(F.concat(F.lit("USGS-"), gauge).alias("station")).agg(F.min(F.trim(F.col("feature_id").cast("string"))).alias("feature_id"), F.count("*").alias("_rows"))
    known = stations.select("station").distinct().join(mapped, "station")
    n = series.groupBy("station").agg(F.countDistinct("series").alias("series_count"))
    reported = domains.groupBy("station").agg(F.array_sort(F.collect_set("domain")).alias("domains"))
    out = known.join(n, "station", "left").join(reported, "station", "left")
    fault = F.when(F.col("_rows") > 1, "mapping").when(F.col("series_count").isNull(), "no_series")
    return out.select("station", "feature_id", F.coalesce("series_count", F.lit(0)).alias("series_count"), F.coalesce("domains", F.array().cast("array<string>")).alias("domains"), fault.alias("fault"))
