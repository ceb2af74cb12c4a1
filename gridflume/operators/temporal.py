"""Temporal reductions with strict treatment of missing hours.

A day's hours are its endpoints, from 01:00 to the next midnight, so an hour-ending stamp belongs to
the day of the hour before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REDUCERS = ("mean", "sum", "minimum", "maximum", "first", "last", "integral", "omit")


def endpoint_day(hour_end: Column) -> Column:
    return F.to_date(hour_end - F.expr("INTERVAL 1 HOUR"))


def reduced(value: str, stamp: str, how: str) -> Column:
    """One reducer over a group; ``integral`` is the sum of hourly rates in seconds."""
    v = F.col(value)
    return {
        "mean": F.avg(v), "sum": F.sum(v), "minimum": F.min(v), "maximum": F.max(v),
        "first": F.min_by(v, F.col(stamp)), "last": F.max_by(v, F.col(stamp)), "integral": F.sum(v) * 3600,
    }[how]


def interval_daily(hours: DataFrame, keys: list[str], stamp: str, reducers: dict[str, list[str]], expected: int = 24) -> DataFrame:
    """Daily reductions per key; values are null unless the day has all ``expected`` hours with a value.

    ``reducers`` maps a column to reducers; results are named ``column_reducer``. ``sample_count`` is the
    number of distinct hours; a repeated stamp makes its day incomplete.
    """
    per_day = hours.withColumn("day", endpoint_day(F.col(stamp))).groupBy(*keys, "day")
    aggs = [F.countDistinct(stamp).alias("sample_count"), F.count("*").alias("_rows")]
    aggs += [F.count(c).alias(f"_n_{c}") for c in reducers]
    aggs += [reduced(c, stamp, h).alias(f"_{c}_{h}") for c, hs in reducers.items() for h in hs if h != "omit"]
    out = per_day.agg(*aggs)
    full = lambda c: (F.col("sample_count") == expected) & (F.col("_rows") == expected) & (F.col(f"_n_{c}") == expected)
    values = [F.when(full(c), F.col(f"_{c}_{h}")).alias(f"{c}_{h}") for c, hs in reducers.items() for h in hs if h != "omit"]
    return out.select(*keys, "day", "sample_count", *values)


def monthly_from_daily(days: DataFrame, keys: list[str], day: str, total: str, hours: str) -> DataFrame:
    """Monthly means from daily sums: sum of sums over sum of hours, with the number of days."""
    return days.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(
        F.count("*").alias("day_count"), F.sum(hours).alias("sample_count"), F.try_divide(F.sum(total), F.sum(hours)).alias("mean_value")
    )


def monthly_mean_extrema(hours: DataFrame, keys: list[str], stamp: str, value: str) -> DataFrame:
    """Monthly mean of daily minima and maxima."""
    daily = hours.groupBy(*keys, endpoint_day(F.col(stamp)).alias("day")).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return daily.groupBy(*keys, F.trunc("day", "month").alias("month")).agg(F.avg("lo").alias("mean_minimum"), F.avg("hi").alias("mean_maximum"))


def spine(bounds: DataFrame, keys: list[str], first: str, last: str, step: str, name: str) -> DataFrame:
    """Every period between two columns of each key, both ends included."""
    return bounds.select(*keys, F.explode(F.sequence(F.col(first), F.col(last), F.expr(f"INTERVAL {step}"))).alias(name))


def missing_stamps(actual: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    return expected.join(actual.select(*on).distinct(), on, "left_anti")


def window_12z(stamp: Column) -> Column:
    """The label day of a climate window, which holds the stamps from noon of the day before to 11:00."""
    return F.to_date(stamp + F.expr("INTERVAL 12 HOURS"))


def counter_difference(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Increments of a running counter; after a reset (a smaller value) the value itself, for the first one null."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    v = F.col(value)
    return df.withColumn("increment", F.when(before.isNull(), None).when(v < before, v).otherwise(v - before))


def latest_record(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def runs(df: DataFrame, keys: list[str], order: str, same: str) -> DataFrame:
    """Contiguous runs of equal values in order: first, last and length of each."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.when(F.lag(same).over(w).eqNullSafe(F.col(same)), 0).otherwise(1)
    marked = df.withColumn("_new", changed).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(*keys, "run", same).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length"))


def segments(days: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Islands of consecutive days."""
    d = days.select(*keys, day).distinct()
    island = F.date_sub(F.col(day), F.row_number().over(Window.partitionBy(*keys).orderBy(day)))
    return d.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("_island")


def signature(df: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """Digest per key over the rows of ``parts``, whatever their order: their number and the sums of four 32-bit parts of each row's SHA-256.

    Sums are added up in parts, so no key's rows meet in one task. A null part is told apart from an empty one. It finds changes; it is no proof against rows made to deceive.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(p).cast("string").alias(f"c{k}") for k, p in enumerate(parts)])), 256)
    words = [F.sum(F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("decimal(20,0)")) for k in range(4)]
    return df.groupBy(*keys).agg(F.concat_ws(".", F.count("*").cast("string"), *(w.cast("string") for w in words)).alias("signature"))


def record_stack(records: DataFrame, by: list[str], day: str, stamp: str, place: str, static: list[str] = (), replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """Records of several inputs as one stack per key and day, and what forbids it.

    ``records``: by (one of them names a cell or reach), day (of the stack), stamp, ``place`` (the input's number). With ``replace`` the last input of an hour takes its place with all its rows, else
    an hour of two inputs is a fault. The second frame has a row per day: hours, complete (24), ``faults``: ``repeated``, ``outside`` (a stamp of another day or not a whole hour), ``gap``, ``static``
    (a field of ``static`` differs between records of one key). Hours are found from distinct stamps, so no day's rows meet in one task.
    """
    given = records.select(day, stamp, place).distinct()
    last = given.groupBy(day, stamp).agg(F.max(place).alias("_place"), F.count("*").alias("_inputs"))
    stack = records
    if replace:
        taken = last.select(F.col(day).alias("_day"), F.col(stamp).alias("_stamp"), "_place")
        stack = records.join(taken, F.col(day).eqNullSafe(F.col("_day")) & F.col(stamp).eqNullSafe(F.col("_stamp")) & F.col(place).eqNullSafe(F.col("_place")), "left_semi")
    t = F.col(stamp)
    whole = F.coalesce((F.to_date(t) == F.col(day)) & (F.date_trunc("hour", t) == t), F.lit(False))
    second = F.unix_timestamp(t)
    hours = last.groupBy(day).agg(
        F.count("*").alias("hours"), F.count_if(F.col("_inputs") > 1).alias("_repeated"), F.count_if(~whole).alias("_outside"), ((F.max(second) - F.min(second)) / 3600 + 1).alias("_span")
    )
    if static:
        said = F.struct(*static)
        moved = stack.groupBy(*by, day).agg(F.min(said).alias("_a"), F.max(said).alias("_z")).groupBy(day).agg(F.count_if(~F.col("_a").eqNullSafe(F.col("_z"))).alias("_moved"))
        hours = hours.join(moved, day, "left")
    else:
        hours = hours.withColumn("_moved", F.lit(0))
    faults = F.array_compact(F.array(
        F.when((F.col("_repeated") > 0) & F.lit(not replace), "repeated"), F.when(F.col("_outside") > 0, "outside"), F.when(~F.coalesce(F.col("_span") == F.col("hours"), F.lit(False)), "gap"), F.when(F.col("_moved") > 0, "static")
    ))
    return stack, hours.select(day, "hours", ((F.col("hours") == 24) & (F.size(faults) == 0)).alias("complete"), faults.alias("faults"))


def sequence_faults(records: DataFrame, by: list[str], stamp: str, value: str, first: Column, last: Column) -> DataFrame:
    """Per group how far its hours are from exactly those after ``first`` until ``last`` (over the columns ``by``), and whether they are.

    A record is a cell at a stamp. ``missing`` and ``unexpected`` count hours, ``empty`` hours without any finite value, ``not_finite`` values that are NaN or infinite (nulls are allowed,
    as a mask). Groups come from the records; one without is not in the result.
    """
    v = F.col(value).cast("double")
    bad = F.isnan(v) | (F.abs(v) == float("inf"))
    hours = records.groupBy(*by, stamp).agg(F.count(F.when(~bad, v)).alias("_n"), F.count_if(bad).alias("_bad"))
    due = hours.select(*by).distinct().where(first < last).select(*by, F.explode(F.sequence(first + F.expr("INTERVAL 1 HOUR"), F.greatest(first + F.expr("INTERVAL 1 HOUR"), last), F.expr("INTERVAL 1 HOUR"))).alias(stamp)).withColumn("_due", F.lit(True))
    both = hours.withColumn("_there", F.lit(True)).join(due, [*by, stamp], "full_outer")
    out = both.groupBy(*by).agg(
        F.count_if("_there").alias("hours"), F.count_if(F.col("_there").isNull()).alias("missing"), F.count_if(F.col("_due").isNull()).alias("unexpected"), F.count_if(F.col("_n") == 0).alias("empty"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("not_finite")
    )
    return out.withColumn("accepted", (F.col("missing") == 0) & (F.col("unexpected") == 0) & (F.col("empty") == 0) & (F.col("not_finite") == 0))


def latest_cycle(asked: DataFrame, available: DataFrame, hour: str, cycle: str, since: str, every: int = 6, longest: int = 12) -> DataFrame:
    """For each asked hour the newest forecast cycle that reaches it with a lead of 1 to ``longest`` hours and was there by then, or null.

    Hours, cycles and the hour ``since`` which a cycle is there are whole hours of one clock. Few
    cycles can reach an hour, so these are listed and looked up by key.
    """
    h = F.col(hour)
    newest = F.floor((h - 1) / every)
    listed = asked.select(hour).distinct().withColumn(cycle, F.explode(F.sequence(F.ceil((h - longest) / every), newest))).withColumn(cycle, F.col(cycle) * every)
    found = listed.join(available.select(cycle, since), cycle).where(F.col(since) <= h).groupBy(hour).agg(F.max(cycle).alias(cycle))
    return asked.join(found, hour, "left").withColumn("lead", h - F.col(cycle))
