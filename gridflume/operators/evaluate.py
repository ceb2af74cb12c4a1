"""Metrics, splits and fits as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import composite


def continuous_metrics(df: DataFrame, reference: str, candidate: str, by: list[str] = (), weight: str | None = None) -> DataFrame:
    """Count, bias, mean absolute and root mean square error, and correlation (null at zero variance).

    Moments are centred, so large values or tiny spreads lose no digits; weighted ones are summed about the group's means, in a second pass.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    ok = df.where(F.col(reference).isNotNull() & F.col(candidate).isNotNull() & (w > 0))
    r, c = F.col(reference), F.col(candidate)
    d, total = c - r, F.sum(w)
    if weight:
        means = ok.groupBy(*by).agg(F.try_divide(F.sum(w * r), total).alias("_mr"), F.try_divide(F.sum(w * c), total).alias("_mc"))
        ok = ok.join(means, list(by)) if by else ok.crossJoin(F.broadcast(means))  # one row
        x, y = r - F.col("_mr"), c - F.col("_mc")
        deviation = lambda v: F.sqrt(F.try_divide(F.sum(w * v * v), total))
        spread = lambda v, mean: F.when(deviation(v) > 1e-13 * F.max(F.abs(mean)), deviation(v))  # noqa: E731  # less is the mean's own rounding
        corr = F.try_divide(F.try_divide(F.sum(w * x * y), total), spread(x, F.col("_mr")) * spread(y, F.col("_mc")))
    else:
        corr = F.try_divide(F.covar_pop(r, c), F.stddev_pop(r) * F.stddev_pop(c))
    return ok.groupBy(*by).agg(
        F.count("*").alias("count"), F.try_divide(F.sum(w * d), total).alias("bias"), F.try_divide(F.sum(w * F.abs(d)), total).alias("mae"),
        F.sqrt(F.try_divide(F.sum(w * d * d), total)).alias("rmse"), corr.alias("correlation"),
    )


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows of equal keys, null keys alike; with no keys ``right`` is one row, which meets every row of ``left``."""
    if not keys:
        return left.crossJoin(F.broadcast(right))  # one row
    side = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = [left[k].eqNullSafe(side[f"_k_{k}"]) for k in keys]
    return left.join(side, on, how).drop(*(f"_k_{k}" for k in keys))


def quantiles(df: DataFrame, by: list[str], value: str, marks: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles (linear between ranks) per group, a column per mark; null and NaN values are left out, and groups without any other.

    A sketch bounds each quantile; values below its bounds are only counted, equal ones inside are counted together, so a group comes to about 8/``accuracy`` of its distinct
    values (all of a group with fewer values than ``accuracy``).
    """
    v = F.col(value).cast("double")
    ok = df.where(v.isNotNull() & ~F.isnan(v)).select(*by, v.alias("_v"))
    edges = [max(0.0, min(1.0, q + s * 4 / accuracy)) for q in marks.values() for s in (-1, 1)]
    bounds = ok.groupBy(*by).agg(F.count("*").alias("_n"), F.percentile_approx("_v", edges, accuracy).alias("_b"))
    small = F.col("_n") < accuracy
    each = F.array(*(
        F.struct(F.lit(name).alias("mark"), F.when(~small, F.col("_b")[2 * k]).alias("low"), F.when(~small, F.col("_b")[2 * k + 1]).alias("high"), (F.lit(q) * (F.col("_n") - 1)).alias("at"))
        for k, (name, q) in enumerate(marks.items())
    ))
    held = same_keys(ok, bounds.select(*by, each.alias("_m")), by).select(*by, "_v", F.explode("_m").alias("_m"))
    inside = held.where(F.col("_m.high").isNull() | (F.col("_v") <= F.col("_m.high")))
    counted = inside.groupBy(*by, F.col("_m.mark").alias("_mark"), F.col("_m.at").alias("_at"), F.when(F.col("_m.low").isNull() | (F.col("_v") >= F.col("_m.low")), F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*by, "_mark").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_v")))
    found = counted.withColumn("_upto", upto).groupBy(*by, "_mark", "_at").agg(at(F.floor("_at")).alias("_a"), at(F.ceil("_at")).alias("_z"))
    between = F.col("_a") + (F.col("_at") - F.floor("_at")) * (F.col("_z") - F.col("_a"))
    return found.groupBy(*by).agg(*(F.max(F.when(F.col("_mark") == name, between)).alias(name) for name in marks))


def categorical_metrics(df: DataFrame, reference: Column, candidate: Column, by: list[str] = ()) -> DataFrame:
    """Hits, misses, false alarms, and detection, false-alarm and success ratios of two conditions."""
    ok = df.where(reference.isNotNull() & candidate.isNotNull())
    out = ok.groupBy(*by).agg(F.count_if(reference & candidate).alias("hits"), F.count_if(reference & ~candidate).alias("misses"), F.count_if(~reference & candidate).alias("false_alarms"))
    h, m, f = F.col("hits"), F.col("misses"), F.col("false_alarms")
    return out.withColumns({"pod": F.try_divide(h, h + m), "far": F.try_divide(f, h + f), "csi": F.try_divide(h, h + m + f)})


def calibration_half(label: Column, fraction: float, salt: str) -> Column:
    """True for whole groups whose hash of ``salt:label`` lies in the first ``fraction`` of the unsigned 64-bit range."""
    head = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), label.cast("string")), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return head < F.lit(str(int(fraction * 2**64))).cast("decimal(20,0)")


def shrunk_slope(df: DataFrame, observed: str, base: str, anomaly: str, prior: Column, strength: Column, by: list[str] = ()) -> DataFrame:
    """Least squares weight of an anomaly, drawn to a prior as by ``strength`` samples of mean square anomaly, in 0 to 1."""
    a, r = F.col(anomaly), F.col(observed) - F.col(base)
    ok = df.where(a.isNotNull() & r.isNotNull())
    sums = ok.groupBy(*by).agg(F.count("*").alias("n"), F.sum(a * a).alias("aa"), F.sum(a * r).alias("ar"))
    ridge = strength * F.try_divide(F.col("aa"), F.col("n"))
    slope = F.try_divide(F.col("ar") + ridge * prior, F.col("aa") + ridge)
    return sums.withColumn("weight", F.greatest(F.least(slope, F.lit(1.0)), F.lit(0.0))).select(*by, "n", "weight")


def _overridden(samples: DataFrame, quality: Column, disagreement: Column) -> DataFrame:
    """Samples (reference, quality, pass2, archive) with ``override`` and the depth of the composite that it leads to."""
    differs = F.abs(F.col("archive") - F.col("pass2")) >= disagreement
    swap = F.coalesce(F.col("quality") < quality, F.lit(False)) | F.coalesce(differs, F.lit(False))
    none = F.lit(None).cast("double")
    given = samples.withColumns({"override": swap & F.col("archive").isNotNull(), "exclusion": F.lit(False)} | {p: none for p in ("pass1", "realtime", "land", "forecast")})
    return composite.composite(given, 0.5)


def _scores(wet: float = 0.1) -> list[Column]:
    """Errors and wet events of depth against reference, where both are there."""
    r, d = F.col("reference"), F.col("depth")
    error = d - r
    event = lambda c: F.coalesce(c & error.isNotNull(), F.lit(False))
    hits, misses, false = (F.count_if(event(c)) for c in ((r >= wet) & (d >= wet), (r >= wet) & (d < wet), (r < wet) & (d >= wet)))
    return [F.count(error).alias("n"), F.avg(error).alias("bias"), F.sqrt(F.avg(error * error)).alias("rmse"), F.try_divide(hits, hits + misses + false).alias("csi")]


def override_sweep(samples: DataFrame, by: list[str], qualities: list[float], disagreements: list[float]) -> DataFrame:
    """Scores per group for every pair of thresholds (q, d): where quality is below q, or the candidates differ by d or more, the archive overrides.

    ``samples``: by, reference, quality, pass2, archive. The depth is what ``composite.composite`` makes of it. Samples are summed
    for each pair as they are read, so only groups are shuffled. ``place`` numbers the pairs in their order.
    """
    pairs = [F.struct(F.lit(k).alias("place"), F.lit(float(q)).alias("q"), F.lit(float(d)).alias("d")) for k, (q, d) in enumerate((q, d) for q in qualities for d in disagreements)]
    tried = samples.select(*by, "reference", "quality", "pass2", "archive", F.explode(F.array(*pairs)).alias("_p")).select("*", "_p.*").drop("_p")
    return _overridden(tried, F.col("q"), F.col("d")).groupBy(*by, "place", "q", "d").agg(F.count_if("override").alias("overrides"), *_scores())


def calibrated_overrides(samples: DataFrame, by: list[str], group: str, qualities: list[float], disagreements: list[float], fraction: float = 0.7, salt: str = "split") -> DataFrame:
    """Per stratum the best pair of thresholds by the samples of calibration groups, and its scores on all others.

    Whole groups are withheld, see ``calibration_half``. The best pair has the least rmse, then the highest csi, then comes first.
    ``withheld_*`` are scores of samples that played no part in the choice; strata without a finite rmse have no rule and are not given.
    """
    marked = samples.withColumn("_fit", calibration_half(F.col(group), fraction, salt))
    tried = override_sweep(marked.where("_fit"), by, qualities, disagreements)
    order = F.struct(F.col("rmse"), -F.coalesce(F.col("csi"), F.lit(-1.0)), F.col("place"))
    rules = tried.where("rmse is not null and not isnan(rmse)").groupBy(*by).agg(F.min_by(F.struct("q", "d", "overrides", "n", "bias", "rmse", "csi"), order).alias("_best")).select(*by, "_best.*")
    tested = _overridden(marked.where("not _fit").join(rules.select(*by, "q", "d"), by), F.col("q"), F.col("d"))
    held = tested.groupBy(*by).agg(F.count("*").alias("withheld_samples"), *(s.alias(f"withheld_{k}") for k, s in zip(("n", "bias", "rmse", "csi"), _scores(), strict=True)))
    return rules.join(held, by, "left").withColumn("withheld_samples", F.coalesce("withheld_samples", F.lit(0)))


def best_rules(scores: DataFrame, strata: list[str], rule: str) -> DataFrame:
    """Per stratum the rule of least error (rmse), of equal ones that of the highest csi, then the smallest rule."""
    order = F.struct(F.col("rmse"), -F.coalesce(F.col("csi"), F.lit(-1.0)), F.col(rule))
    kept = scores.where(F.col("rmse").isNotNull())
    return kept.groupBy(*strata).agg(F.min_by(F.struct(rule, "rmse", "csi"), order).alias("_best")).select(*strata, "_best.*")
