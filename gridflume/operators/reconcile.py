"""Reconciliation of hourly fields with constraint totals and extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics
from . import evaluate, regrid


# Source id, confidence and flags of cells that a six-hour total constrains.
SIX_HOUR_SOURCE, SIX_HOUR_CONFIDENCE, CONSTRAINED, EVEN_TIMING = 7, 0.85, 128, 256


def six_hour(hours: DataFrame, keys: list[str], hour: str = "hour", depth: str = "depth", total: str = "total") -> DataFrame:
    """Scale the hours of blocks ending 00, 06, 12, 18 to the block's total.

    Wet blocks scale in proportion, dry blocks with a wet total get even sixths, a zero total gives zeros; a
    missing or negative total, and a block without all six hours, change nothing. The hour that ends the block
    takes the rounding residual, never less than zero; it has none where an hour before it is missing. Flags
    and source tell which hours were constrained; ``timing`` which kept their own pattern.
    """
    df = hours.withColumn("block", F.ceil(F.col(hour) / 6)).withColumn("_d", F.greatest(F.col(depth), F.lit(0.0)))
    df = df.withColumn("_d", F.when(F.col(depth).isNotNull(), F.col("_d")))
    w = Window.partitionBy(*keys, "block")
    last = F.col(hour) == 6 * F.col("block")
    df = df.withColumns({"_sum": F.coalesce(F.sum("_d").over(w), F.lit(0.0)), "_n": F.count(F.lit(1)).over(w)})
    held = F.coalesce((F.col(total) >= 0) & (F.col("_n") == 6), F.lit(False))
    even = held & (F.col(total) > 0) & (F.col("_sum") <= 0)
    share = F.when(F.col(total) == 0, 0.0).when(even, F.col(total) / 6).otherwise(F.col("_d") * F.try_divide(F.col(total), F.col("_sum")))
    df = df.withColumns({"_held": held, "_even": even, "_share": F.when(held, share).otherwise(F.col(depth))})
    missing = F.count_if(~last & F.col("_share").isNull()).over(w) > 0
    before = F.sum(F.when(~last, F.col("_share"))).over(w)
    rest = F.when(~missing, F.greatest(F.col(total) - before, F.lit(0.0)))
    return df.withColumns({
        "constrained": F.when(F.col("_held") & last, rest).otherwise(F.col("_share")),
        "flags": F.when(F.col("_held"), CONSTRAINED).otherwise(0) + F.when(F.col("_even"), EVEN_TIMING).otherwise(0),
        "source_id": F.when(F.col("_held"), SIX_HOUR_SOURCE), "confidence": F.when(F.col("_held"), SIX_HOUR_CONFIDENCE), "timing": ~F.col("_even"),
    }).drop("_d", "_sum", "_n", "_held", "_even", "_share")


def temperature_range(hours: DataFrame, keys: list[str], value: str, low: str, high: str, least_range: float = 0.5, bounds: tuple[float, float] = (0.25, 4.0)) -> DataFrame:
    """Shift and scale each group's curve to target extremes; only shift it where its own range is small."""
    w = Window.partitionBy(*keys)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    own, middle = hi - lo, (hi + lo) / 2
    scale = F.when(own < least_range, 1.0).otherwise(F.greatest(F.least(F.try_divide(F.col(high) - F.col(low), own), F.lit(bounds[1])), F.lit(bounds[0])))
    target = (F.col(low) + F.col(high)) / 2
    usable = F.col(low).isNotNull() & F.col(high).isNotNull() & (F.col(low) <= F.col(high))
    return hours.withColumn("adjusted", F.when(usable, target + scale * (F.col(value) - middle)).otherwise(F.col(value)))


# Flags of a day's temperature constraint.
NO_CONSTRAINT, MIDPOINT_ONLY, SCALE_CLIPPED = 1, 2, 4


def daily_temperature(hours: DataFrame, keys: list[str], hour: str, value: str, low: str, high: str, least_range: float = 0.5, bounds: tuple[float, float] = (0.25, 4.0)) -> DataFrame:
    """A day's curve moved to its extremes, with flags; days without 24 consecutive hours are not given.

    ``hour`` counts hours. Without extremes, or with a lowest above the highest, the curve stays as it is.
    """
    w = Window.partitionBy(*keys)
    lo, hi = F.min(value).over(w), F.max(value).over(w)
    span = F.max(hour).over(w) - F.min(hour).over(w)
    whole = (F.count(F.lit(1)).over(w) == 24) & (span == 23)
    df = hours.withColumns({"_lo": lo, "_hi": hi, "_whole": whole}).where("_whole")
    own = F.col("_hi") - F.col("_lo")
    usable = F.coalesce(F.col(low) <= F.col(high), F.lit(False))
    raw = F.try_divide(F.col(high) - F.col(low), own)
    scale = F.when(own < least_range, 1.0).otherwise(F.greatest(F.least(raw, F.lit(bounds[1])), F.lit(bounds[0])))
    bit = lambda c, k: F.when(F.coalesce(c, F.lit(False)), k).otherwise(0)
    return df.withColumns({
        "adjusted": F.when(usable, (F.col(low) + F.col(high)) / 2 + scale * (F.col(value) - (F.col("_hi") + F.col("_lo")) / 2)).otherwise(F.col(value)),
        "flags": bit(~usable, NO_CONSTRAINT) + bit(usable & (own < least_range), MIDPOINT_ONLY) + bit(usable & (own >= least_range) & ((raw < bounds[0]) | (raw > bounds[1])), SCALE_CLIPPED),
    }).drop("_lo", "_hi", "_whole")


def constraint_at_targets(extremes: DataFrame, links: DataFrame, targets: DataFrame, fields: list[str]) -> DataFrame:
    """Temperatures of source cells (src, z, fields) at target cells (dst, z): moved to sea level, remapped, moved up again."""
    sea = extremes.select("src", *(physics.temperature_at_elevation(F.col(f), F.col("z"), F.lit(0.0)).alias(f) for f in fields))
    on = regrid.remap(sea, links, fields).join(targets.select("dst", "z"), "dst")
    return on.select("dst", *(physics.temperature_at_elevation(F.col(f), F.lit(0.0), F.col("z")).alias(f) for f in fields))


def monthly_coefficients(hours: DataFrame, keys: list[str], day: str, value: str, targets: DataFrame, low: str, high: str, least_range: float = 0.5, bounds: tuple[float, float] = (0.25, 4.0)) -> DataFrame:
    """Per cell the affine change (scale, shift) that brings the means of daily extremes to the month's; none where a side is unusable."""
    daily = hours.groupBy(*keys, day).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    own = daily.groupBy(*keys).agg(F.avg("lo").alias("lo"), F.avg("hi").alias("hi")).join(targets.select(*keys, low, high), keys)
    span = F.col("hi") - F.col("lo")
    scale = F.when(span < least_range, 1.0).otherwise(F.greatest(F.least(F.try_divide(F.col(high) - F.col(low), span), F.lit(bounds[1])), F.lit(bounds[0])))
    usable = F.coalesce((F.col(low) <= F.col(high)) & (span >= 0), F.lit(False))
    out = own.where(usable).withColumn("scale", scale)
    return out.select(*keys, "scale", ((F.col(low) + F.col(high)) / 2 - F.col("scale") * (F.col("lo") + F.col("hi")) / 2).alias("shift"))


# Flags of a target, and the shares of constrained targets that may have them.
TARGET_MISSING, TARGET_DRY, BASE_DRY, SYNTHETIC, RATIO_CAPPED, NOT_CONVERGED = 1, 2, 4, 8, 16, 32
LIMITS = {"unconverged": 0.005, "unresolved": 0.005, "capped": 0.02, "unhandled_dry": 0.005, "synthetic": 0.01}


def acceptance(targets: DataFrame, tolerance: float = 1e-3, limits: dict[str, float] = LIMITS, by: list[str] = ()) -> DataFrame:
    """Per group the shares of constrained targets (total, residual, flags) that are off in each way, and whether all are within the limits."""
    has = lambda f: F.col("flags").bitwiseAND(F.lit(f)) != 0
    held = F.col("total").isNotNull() & ~has(TARGET_MISSING)
    off = F.coalesce(F.abs("residual") / F.greatest("total", F.lit(1.0)) > tolerance, F.lit(True))
    kinds = {"unconverged": has(NOT_CONVERGED), "unresolved": off, "capped": has(RATIO_CAPPED), "unhandled_dry": has(BASE_DRY) & ~has(SYNTHETIC), "synthetic": has(SYNTHETIC)}
    n = F.greatest(F.count_if(held), F.lit(1))
    shares = targets.groupBy(*by).agg(F.count_if(held).alias("constrained_cells"), *((F.count_if(held & c) / n).alias(k) for k, c in kinds.items()))
    good = F.lit(True)
    for k, most in limits.items():
        good = good & (F.col(k) <= most)
    return shares.withColumn("accepted", good)


def monthly_hours(rain: DataFrame, cells: DataFrame, cell: str) -> DataFrame:
    """Hours of a month (cell, hour, rate, fault) corrected by their cells' change (cell, baseline, corrected, donor).

    A dry cell that the month makes wet takes its donor's hours, scaled from the donor's depth to its own. Where it has no
    donor, or the donor no hours or no depth, it keeps its own hours (one without an hour or a rate if it has none), with ``fault`` ``no_donor``.
    """
    made_wet = (F.col("baseline") <= 1e-8) & (F.col("corrected") > 1e-8)
    factor = F.when(F.col("baseline") > 1e-8, F.col("corrected") / F.col("baseline")).otherwise(F.lit(1.0))
    change = cells.select(cell, F.col("baseline").alias("_base"), factor.alias("_factor"), F.coalesce(made_wet, F.lit(False)).alias("_made"), F.col("donor").alias("_donor"), "corrected")
    base = change.join(rain.select(F.col(cell).alias(cell)).distinct(), cell, "left_semi").where("_base > 0").select(F.col(cell).alias("_donor"), F.col("_base").alias("_donor_base"))
    change = change.join(base, "_donor", "left").withColumn("_lent", F.col("_made") & F.col("_donor_base").isNotNull())
    own = rain.join(change, cell, "left").where("not coalesce(_lent, false)")
    plain = own.select(cell, "hour", (F.col("rate") * F.coalesce("_factor", F.lit(1.0))).alias("rate"), F.when(F.col("_made"), "no_donor").alias("fault"))
    wanted = change.where("_lent").select(F.col(cell).alias("_cell"), F.col("_donor").alias(cell), (F.col("corrected") / F.col("_donor_base")).alias("_scale"))
    lent = rain.join(wanted, cell).select(F.col("_cell").alias(cell), "hour", (F.col("rate") * F.col("_scale")).alias("rate"), F.lit(None).cast("string").alias("fault"))
    lost = change.where("_made and not _lent").join(rain.select(cell).distinct(), cell, "left_anti")
    nothing = lost.select(cell, F.lit(None).cast(rain.schema["hour"].dataType).alias("hour"), F.lit(None).cast("double").alias("rate"), F.lit("no_donor").alias("fault"))
    return plain.unionByName(lent).unionByName(nothing)


def monthly_sums(hours: DataFrame, cell: str, day: str, depth: str, temperature: str, hours_in_month: int) -> DataFrame:
    """Per cell: depth, greatest hourly depth, means of daily extremes with the days counted, and the share of hours that are there."""
    daily = hours.groupBy(cell, day).agg(F.sum(depth).alias("d"), F.max(depth).alias("m"), F.min(temperature).alias("lo"), F.max(temperature).alias("hi"), F.count(depth).alias("n"))
    return daily.groupBy(cell).agg(
        F.sum("d").alias("depth"), F.max("m").alias("most_hourly"), F.avg("lo").alias("mean_low"), F.avg("hi").alias("mean_high"), F.count("lo").alias("days"),
        (F.sum("n") / hours_in_month).alias("share"),
    )


def publication_gate(accepted: DataFrame, corrected: DataFrame, most: float = 300.0) -> DataFrame:
    """One row: whether a month may go out, being accepted and without an hourly depth (column ``rate``) above ``most``."""
    return accepted.select("accepted").crossJoin(corrected.agg(F.max("rate").alias("most_hourly"))).select("most_hourly", (F.col("accepted") & (F.coalesce("most_hourly", F.lit(0.0)) <= most)).alias("publish"))


def assessed(result: DataFrame, targets: DataFrame, links: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Share of constrained targets whose remapped result is off by more than the tolerance."""
    estimate = regrid.remap(result.select("src", "corrected"), links, ["corrected"])
    off = F.abs(F.col("corrected") - F.col("total")) / F.greatest("total", F.lit(1.0)) > tolerance
    return targets.where("total is not null").join(estimate, "dst", "left").agg(F.count("*").alias("targets"), F.count_if(F.coalesce(off, F.lit(True))).alias("unconverged"))


def monthly_audit(hours: DataFrame, expected: DataFrame, cell: str, day: str, depth: str, temperature: str, most_depth: float = 0.05, most_kelvin: float = 0.02, most_hourly: float = 300.0) -> DataFrame:
    """One row: how far published hours are from what the month should give (cell, depth, mean_low, mean_high), and whether that passes.

    Cells that one side lacks count as ``unmatched`` and fail.
    """
    sums = monthly_sums(hours, cell, day, depth, temperature, 1).drop("share", "days")
    side = expected.select(cell, *(F.col(c).alias(f"_{c}") for c in ("depth", "mean_low", "mean_high")))
    both = sums.join(side, cell, "full_outer")
    error = lambda c: F.coalesce(F.max(F.abs(F.col(c) - F.col(f"_{c}"))), F.lit(0.0))
    found = both.agg(
        F.count_if(F.col("depth").isNull() | F.col("_depth").isNull()).alias("unmatched"), error("depth").alias("depth_error"), error("mean_low").alias("low_error"), error("mean_high").alias("high_error"),
        F.coalesce(F.max("most_hourly"), F.lit(0.0)).alias("most_hourly"),
    )
    good = (F.col("unmatched") == 0) & (F.col("depth_error") <= most_depth) & (F.greatest("low_error", "high_error") <= most_kelvin) & (F.col("most_hourly") <= most_hourly)
    return found.withColumn("passed", good)


def constraint_provenance(hours: DataFrame, targets: DataFrame, links: DataFrame, by: list[str], bits: dict[str, int], wet: float = 0.1) -> DataFrame:
    """What the hours (src, by, depth, qc) were made of, for source cells behind capped, base-dry and clean targets (dst, flags).

    A source cell counts for each kind that one of its targets has: cell-hours, wet ones, depth, hours with each
    of ``bits`` (name, bit) in ``qc``, and quantiles of depth.
    """
    has = lambda f: F.col("flags").bitwiseAND(F.lit(f)) != 0
    kinds = F.array_compact(F.array(F.when(has(RATIO_CAPPED), "capped"), F.when(has(BASE_DRY), "base_dry"), F.when(F.col("flags") == 0, "clean")))
    behind = regrid.usable_links(links).join(targets, "dst").select("src", F.explode(kinds).alias("kind")).distinct()
    flagged = [F.count_if(F.col("qc").bitwiseAND(F.lit(bit)) != 0).alias(f"qc_{name}") for name, bit in bits.items()]
    each = hours.join(behind, "src")
    found = each.groupBy("kind", *by).agg(F.count("*").alias("cell_hours"), F.count_if(F.col("depth") >= wet).alias("wet_cell_hours"), F.sum("depth").alias("depth"), *flagged)
    return evaluate.same_keys(found, evaluate.quantiles(each, ["kind", *by], "depth", {"p50": 0.5, "p95": 0.95}), ["kind", *by], "left")


def published_hours(hours: DataFrame, overrides: DataFrame, keys: list[str], accepted: DataFrame) -> DataFrame:
    """Hours (keys, corrected, temperature) as they go out: rain as a rate a second, temperatures where ``overrides`` (keys, temperature) has them.

    ``overrides`` has each key once; ``accepted`` is one row of that column, which is set on every hour.
    """
    side = overrides.select(*keys, F.col("temperature").alias("_t"))
    joined = hours.join(side, keys, "left").crossJoin(F.broadcast(accepted.select("accepted").limit(1)))
    out = {"rate": F.col("corrected") / 3600, "temperature": F.coalesce("_t", "temperature"), "overridden": F.col("_t").isNotNull()}
    return joined.select(*keys, *(v.alias(k) for k, v in out.items()), "accepted")
