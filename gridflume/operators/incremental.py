"""Planning of incremental refreshes as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ready_frontier(spine: DataFrame, ready: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Per key the stamps before the first gap: how many, and where the gap is."""
    seen = ready.select(*keys, stamp).distinct().withColumn("_seen", F.lit(1))
    joined = spine.join(seen, [*keys, stamp], "left")
    gap = joined.groupBy(*keys).agg(F.min(F.when(F.col("_seen").isNull(), F.col(stamp))).alias("gap"))
    return joined.join(gap, keys).groupBy(*keys, "gap").agg(F.count_if(F.col("gap").isNull() | (F.col(stamp) < F.col("gap"))).alias("ready_stamps"))


def work_for(changes: Column) -> Column:
    """Ordered tasks that a set of changes asks for; a change of the whole day covers the others."""
    has = lambda *names: F.arrays_overlap(changes, F.array(*map(F.lit, names)))
    parts = F.array_compact(F.array(F.when(has("precipitation"), F.lit("precipitation")), F.when(has("temperature"), F.lit("temperature")), F.when(has("precipitation", "temperature", "publication"), F.lit("publication"))))
    return F.when(has("full"), F.array(F.lit("full"), F.lit("publication"))).otherwise(parts)


def latency(requested: Column, started: Column, finished: Column, target: int = 1800, deadline: int = 3600) -> tuple[Column, Column]:
    total = F.unix_timestamp(finished) - F.unix_timestamp(requested)
    return total, F.when(total <= target, "within_target").when(total <= deadline, "over_target").otherwise("deadline_missed")


def window_days(days: DataFrame, day: str) -> DataFrame:
    """Each day with its neighbours, once."""
    return days.select(F.explode(F.array(*[F.date_add(day, k) for k in (-1, 0, 1)])).alias("day")).distinct()


def latest_before(asked: DataFrame, states: DataFrame, by: list[str], at: str, stamp: str) -> DataFrame:
    """As-of join: each request's latest state at or before its time, in one sort of both together."""
    a = asked.select(*by, F.col(at).alias("_t"), F.lit(1).alias("_ask"), F.lit(None).cast(states.schema[stamp].dataType).alias("_s"))
    s = states.select(*by, F.col(stamp).alias("_t"), F.lit(0).alias("_ask"), F.col(stamp).alias("_s"))
    w = Window.partitionBy(*by).orderBy("_t", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    return a.union(s).withColumn("latest", F.last("_s", ignorenulls=True).over(w)).where("_ask = 1").select(*by, F.col("_t").alias(at), "latest")


def checkpoint_before(asked: DataFrame, checkpoints: DataFrame, by: list[str], end: str, stamp: str, rewind: str, published: str | None = None) -> DataFrame:
    """For each request the latest checkpoint that is ``rewind`` before its end or earlier and not after what is published, or null.

    ``rewind`` is an interval as ``24 HOURS``. ``published`` is a column of the requests; null there means that nothing is, so no checkpoint will do.
    """
    bound = F.col(end) - F.expr(f"INTERVAL {rewind}")
    if published:
        bound = F.when(F.col(published).isNotNull(), F.least(bound, F.col(published)))
    held = asked.withColumn("_bound", bound)
    found = latest_before(held.where("_bound is not null").select(*by, "_bound").distinct(), checkpoints, by, "_bound", stamp)
    return held.join(found, [*by, "_bound"], "left").drop("_bound")


def expired(entries: DataFrame, by: list[str], stamp: str, now: Column, size: str, most_entries: int, most_bytes: int, most_days: int) -> DataFrame:
    """Entries to drop so that each key's newest stay within number, bytes and age; ``reason`` names the first limit broken.

    Age goes first, so an old entry takes no other's room. Entries of one stamp count in the order of their sizes; those without stamp are ``age``.
    """
    old = ~F.coalesce(F.col(stamp) >= now - F.make_interval(days=F.lit(most_days)), F.lit(False))
    w = Window.partitionBy(*by, "_old").orderBy(F.desc(stamp), size).rowsBetween(Window.unboundedPreceding, 0)
    marked = entries.withColumn("_old", old).withColumns({"_n": F.count("*").over(w), "_b": F.sum(size).over(w)})
    reason = F.when(F.col("_old"), "age").when(F.col("_n") > most_entries, "entries").when(F.col("_b") > most_bytes, "bytes")
    return marked.withColumn("reason", reason).where("reason is not null").drop("_old", "_n", "_b")


def evicted(entries: DataFrame, by: list[str], order: Column, size: str, most_entries: int, most_bytes: int) -> DataFrame:
    """Entries beyond the newest that fit the limits."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return entries.withColumns({"_n": F.count("*").over(w), "_b": F.sum(size).over(w)}).where((F.col("_n") > most_entries) | (F.col("_b") > most_bytes)).drop("_n", "_b")


def batches(days: DataFrame, day: str, same: str, most: int) -> DataFrame:
    """Runs of consecutive days with an equal revision, cut to at most ``most`` days."""
    run = F.date_sub(F.col(day), F.row_number().over(Window.partitionBy(same).orderBy(day)))
    marked = days.withColumn("_run", run)
    place = F.row_number().over(Window.partitionBy(same, "_run").orderBy(day)) - 1
    return marked.withColumn("_part", F.floor(place / most)).groupBy(same, "_run", "_part").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("_run", "_part")


def lost_history(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Published keys that the new data no longer has."""
    return old.select(*keys).join(new.select(*keys), keys, "left_anti")


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: rows of ``new`` replace those of ``old`` with equal keys."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"))


def fingerprints(inputs: DataFrame, by: list[str], identity: Column) -> DataFrame:
    """A digest of each group's distinct inputs, whatever their order."""
    return inputs.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(identity)), ";"), 256).alias("fingerprint"))


def needing_work(wanted: DataFrame, receipts: DataFrame, by: list[str]) -> DataFrame:
    """Groups without a receipt of the same fingerprint, and why."""
    held = receipts.select(*by, F.col("fingerprint").alias("_held"))
    why = F.when(F.col("_held").isNull(), "new").when(F.col("_held") != F.col("fingerprint"), "changed")
    return wanted.join(held, by, "left").withColumn("reason", why).where("reason is not null").drop("_held")


def revision_of(day: Column, today: Column, stable_after: int = 183) -> Column:
    """Early within the running month, stable after half a year, provisional between."""
    return F.when(F.trunc(day, "month") == F.trunc(today, "month"), "early").when(F.date_diff(today, day) >= stable_after, "stable").otherwise("provisional")


def accepted_prefix(segments: DataFrame, by: list[str], start: str, end: str, accepted: str) -> DataFrame:
    """Per key how many segments form the gap-free accepted chain from its first one, and where it ends (null: nowhere)."""
    w = Window.partitionBy(*by).orderBy(start, end)
    follows = F.coalesce(F.lag(end).over(w) == F.col(start), F.lag(end).over(w).isNull())
    marked = segments.withColumn("_links", (follows & F.coalesce(F.col(accepted), F.lit(False))).cast("int"))
    good = F.min("_links").over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1
    return marked.withColumn("_good", good).groupBy(*by).agg(F.count_if("_good").alias("segments"), F.max(F.when(F.col("_good"), F.col(end))).alias("resume"))


def calendar_eligibility(days: DataFrame, by: list[str], day: str, constrained: str) -> DataFrame:
    """Whether a day has its constraint and both neighbours, or what blocks it first."""
    w = Window.partitionBy(*by).orderBy(day)
    before = F.date_diff(F.col(day), F.lag(day).over(w)) == 1
    after = F.date_diff(F.lead(day).over(w), F.col(day)) == 1
    state = F.when(~F.coalesce(F.col(constrained), F.lit(False)), "no_constraint").when(~F.coalesce(before, F.lit(False)), "no_previous_day").when(~F.coalesce(after, F.lit(False)), "no_next_day").otherwise("eligible")
    return days.withColumn("state", state)


def lanes(events: DataFrame, as_of: Column, lane: str = "fast", recent_days: int = 4) -> DataFrame:
    """Events (stream, day, urgent, stable, tasks) as work, deferred with a lane, or unchanged; ``priority`` orders the work.

    In the fast lane urgent and recent events are work, in daily-nrt all of that stream, in daily-retro stable ones of the other.
    """
    soon = F.col("urgent") | (F.col("day") >= F.date_sub(as_of, recent_days - 1))
    if lane == "daily-retro":
        ours = (F.col("stream") == "retro") & F.coalesce("stable", F.lit(False))
    else:
        ours = (F.col("stream") == "nrt") & (F.lit(lane == "daily-nrt") | soon)
    to = F.when(F.col("stream") == "retro", "daily-retro").when(soon, "fast").otherwise("daily-nrt")
    outcome = F.when(F.size("tasks") == 0, "unchanged").when(ours, "work").otherwise("deferred")
    return events.withColumns({"outcome": outcome, "deferred_to": F.when(outcome == "deferred", to), "priority": F.when(outcome == "work", F.when(F.col("urgent"), 0).otherwise(1))})


def replacement_backlog(hours: DataFrame, available: DataFrame, by: list[str], day: str, before: Column) -> DataFrame:
    """Days before a date with an hour from a fallback whose preferred source has come since."""
    old = hours.where(F.col("fallback") & (F.col(day) < before))
    return old.join(available, [*by, day, "hour"], "left_semi").select(*by, day).distinct()


def scan_days(as_of: Column, back: Column, ahead: Column) -> Column:
    """The days of an inclusive window around a date."""
    return F.sequence(F.date_sub(as_of, back), F.date_add(as_of, ahead))


def stale_days(wanted: DataFrame, hours: DataFrame, outputs: DataFrame, by: list[str], day: str, needed: int = 24) -> DataFrame:
    """Wanted days with all their hours whose output is missing, older than an input, or of another revision."""
    inputs = hours.groupBy(*by, day).agg(F.countDistinct("hour").alias("_n"), F.max("stamp").alias("_newest")).where(F.col("_n") >= needed)
    done = outputs.select(*by, day, F.col("stamp").alias("_made"), F.col("revision").alias("_revision"))
    joined = wanted.join(inputs, [*by, day]).join(done, [*by, day], "left")
    why = F.when(F.col("_made").isNull(), "missing").when(F.col("_newest") > F.col("_made"), "older").when(~F.col("_revision").eqNullSafe(F.col("revision")), "revision")
    return joined.withColumn("reason", why).where("reason is not null").select(*by, day, "reason")


def missing_days(catalogue: DataFrame, by: list[str], day: str, floor: Column, until: Column) -> DataFrame:
    """Days from a floor up to, without, the window's start that a catalogue lacks; a key without any day is not in it."""
    keys = catalogue.select(*by).distinct()
    spine = keys.withColumn(day, F.explode(F.sequence(floor, F.date_sub(until, 1))))
    return spine.join(catalogue.select(*by, day).distinct(), [*by, day], "left_anti")


def refresh_start(incomplete: DataFrame, keys: DataFrame, by: list[str], day: str, normal: Column) -> DataFrame:
    """Where each key's refresh starts: at its earliest incomplete day, or at the normal start if that is earlier."""
    first = incomplete.groupBy(*by).agg(F.min(day).alias("_first"))
    return keys.join(first, by, "left").select(*by, F.least(F.coalesce("_first", normal), normal).alias("start"))


def inputs_of_days(inputs: DataFrame, days: DataFrame, day: str, stamp: str, before: int = 5, after: int = 24) -> DataFrame:
    """Inputs of each wanted day: those from ``before`` hours ahead of its start to ``after`` hours past it.

    Each input is dealt to the few days that its stamp can belong to and joined by day, not by range.
    """
    own, span = F.to_date(stamp), lambda h: -(-h // 24)
    near = inputs.withColumn(day, F.explode(F.sequence(F.date_sub(own, span(after)), F.date_add(own, span(before)))))
    start = F.col(day).cast("timestamp")
    fits = (F.col(stamp) >= start - F.make_dt_interval(hours=F.lit(before))) & (F.col(stamp) <= start + F.make_dt_interval(hours=F.lit(after)))
    return near.where(fits).join(days.select(day).distinct(), day, "left_semi")


def outdated(receipts: DataFrame, catalogue: DataFrame, archive: list[str], key: str, identity: list[str]) -> DataFrame:
    """Per archive: inputs, those gone or of another identity in the catalogue, and whether all still match."""
    now = catalogue.select(key, *(F.col(c).alias(f"_{c}") for c in identity), F.lit(True).alias("_there"))
    same = F.coalesce(F.col("_there"), F.lit(False))
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = receipts.join(now, key, "left").groupBy(*archive).agg(F.count("*").alias("inputs"), F.count_if(~same).alias("changed"))
    return found.withColumn("current", F.col("changed") == 0)
