"""Bounded multiplicative projection: depths of source cells until their remapped sums meet target totals.

The solve works on sums over a period; hours follow by their share of it. Any number of independent solves (days,
months, ratio bounds) run as one: they are told apart by key columns and stop on their own.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import staged, staged_counted
from . import blocks, reconcile, regrid


@dataclass(frozen=True)
class Bounds:
    """How far a solve may go. ``ratio`` bounds one round, ``cumulative`` all of them together."""

    tolerance: float = 1e-3
    rounds: int = 20
    ratio: tuple[float, float] = (0.1, 10.0)
    cumulative: tuple[float, float] = (0.0, 10.0)
    most_depth: float = 500.0
    damping: float = 1.0
    synthetic: bool = False
    dry: float = 1e-8

    def __post_init__(self) -> None:
        if not (0 < self.ratio[0] <= 1 <= self.ratio[1] and 0 <= self.cumulative[0] <= 1 <= self.cumulative[1]):
            raise ValueError("ratio bounds must be positive and, like the cumulative ones, have one between them")
        if self.most_depth <= 0 or not 0 < self.damping <= 1:
            raise ValueError("the greatest depth must be positive, damping above 0 and at most 1")


@dataclass(frozen=True)
class Solution:
    """``cells`` (by, src, base, corrected, factor), ``targets`` (by, dst, total, residual, flags), ``runs`` (by, iterations, converged)."""

    cells: DataFrame
    targets: DataFrame
    runs: DataFrame


def _known(value: str) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value))


def _not_negative(value: Column, what: str) -> Column:
    return F.when(value < 0, F.raise_error(F.lit(f"{what} must not be negative"))).otherwise(value)


#: Links and cells, or targets, of a block of the solver.
ROWS_A_BLOCK, LEAST_BLOCKS = 800_000, 8


def solve(base: DataFrame, targets: DataFrame, links: DataFrame, by: list[str] = (), bounds: Bounds = Bounds(), upper: str | None = None) -> Solution:
    """From depths (by, src, depth), totals (by, dst, total) and links (src, dst, weight).

    Each round remaps, divides total by estimate within bounds, takes the ratios back along the links and multiplies.
    A null depth counts as zero and stays zero; a null total constrains nothing. Totals beyond what the bounds allow,
    and wet ones over a dry base unless ``bounds.synthetic`` seeds them, take no part and are flagged. ``upper`` names a key
    column that replaces the upper bounds. Cells and links are dealt by ranges of sources, totals by targets, and packed once; rounds pass
    sums and ratios between these blocks, several rounds in a job (``blocks.rounds``).
    """
    by = list(by)
    usable, n_links = staged_counted(regrid.usable_links(links).where("src is not null").select("src", "dst", F.col("weight").cast("double").alias("weight")), "links")
    cells, n_cells = staged_counted(base.select(*by, "src", _not_negative(_known("depth"), "depths").cast("double").alias("base")), "cells")
    goals, n_goals = staged_counted(targets.select(*by, "dst", _not_negative(_known("total"), "totals").cast("double").alias("total")), "goals")
    n_sources, n_targets = (max(LEAST_BLOCKS, -(-n // ROWS_A_BLOCK)) for n in (n_links + n_cells, n_goals))
    # a target is met by its links under the type that a join would give both
    kind = usable.select("dst").union(targets.select("dst")).schema["dst"].dataType
    to = F.pmod(F.xxhash64(F.col("dst").cast(kind)), F.lit(n_targets)).cast("int")
    rows = usable.select(F.lit(blocks.LINK).alias("kind"), "src", F.col("dst").cast(kind).alias("dst"), F.col("weight").alias("value"), to.alias("to"))
    rows = rows.unionByName(cells.select(F.lit(blocks.CELL).alias("kind"), *by, "src", F.col("base").alias("value")), allowMissingColumns=True)
    goals = goals.select(*by, F.col("dst").cast(kind).alias("dst"), "total", to.alias("to"))
    streams, kept = blocks.rounds(rows.repartitionByRange(n_sources, "src"), goals.repartition(n_targets, "to"), by, (n_sources, n_targets), bounds, upper)
    streams = streams.persist()
    types = lambda df, *names: ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in names)
    of = lambda kind: streams.filter(lambda x: x[0] == kind).map(lambda x: x[1])
    solved = staged(blocks.unpacked(of("cells"), f"{types(rows, *by, 'src', 'value')}, corrected double", base), "cells")
    found = staged(blocks.unpacked(of("goals"), f"{types(goals, *by, 'dst', 'total', 'to')}, residual double, flags int, last int, unmet boolean", base), "solved_targets")
    for rdd in (streams, *kept):
        rdd.unpersist()
    same = lambda df, *names: [F.col(k).cast(df.schema[k].dataType).alias(k) for k in names]
    runs = found.groupBy(*same(targets, *by)).agg(F.least(F.max("last") + 1, F.lit(bounds.rounds)).alias("iterations"), (~F.bool_or("unmet")).alias("converged"))
    factor = F.when(F.col("value") > bounds.dry, F.col("corrected") / F.col("value"))
    return Solution(
        solved.select(*same(base, *by, "src"), F.col("value").alias("base"), "corrected", factor.alias("factor")),
        found.select(*same(targets, *by, "dst"), "total", "residual", "flags"), runs,
    )


def hourly(hours: DataFrame, cells: DataFrame, by: list[str] = (), hour: str = "hour", dry: float = 1e-8) -> DataFrame:
    """Hours (by, src, hour, depth) with ``corrected``: each hour keeps its share of its cell's sum.

    A dry cell that was made wet gets the share that the hour has of all cells' depth, or even shares if all are dry; hours
    that it has no row for are added, with a null depth.
    """
    by = list(by)
    # a row for each solve, with as many shares as its period has hours
    each = hours.groupBy(*by, hour).agg(F.sum(F.coalesce(_known("depth"), F.lit(0.0))).alias("s"))
    profile = each.groupBy(*by).agg(F.sum("s").alias("all"), F.count("*").alias("n"), F.collect_list(F.struct(F.col(hour).alias("hour"), "s")).alias("shares"))
    at = [F.lit(1).alias("_one"), *by]
    made = cells.where((F.col("base") <= dry) & (F.col("corrected") > dry)).select(*at, "src", "corrected")
    made = made.join(profile.select(*at, "all", "n", F.explode("shares").alias("h")), ["_one", *by])
    share = F.when(F.col("all") > 0, F.col("h.s") / F.col("all")).otherwise(1 / F.col("n"))
    made = made.select(*by, "src", F.col("h.hour").alias(hour), (share * F.col("corrected")).alias("made"))
    own = hours.select(*by, "src", hour, "depth").join(cells.select(*by, "src", "base", F.col("corrected").alias("_sum")), [*by, "src"])
    kept = F.when(F.col("base") > dry, F.coalesce(_known("depth"), F.lit(0.0)) / F.col("base") * F.col("_sum")).otherwise(0.0)
    both = own.withColumn("kept", kept).join(made, [*by, "src", hour], "full_outer")
    return both.select(*by, "src", hour, "depth", F.coalesce("made", "kept").alias("corrected"))


def _sums(hours: DataFrame, by: list[str]) -> DataFrame:
    return hours.groupBy(*by, "src").agg(F.sum(_not_negative(_known("depth"), "depths")).alias("depth"))


def reconcile_period(hours: DataFrame, targets: DataFrame, links: DataFrame, by: list[str] = (), bounds: Bounds = Bounds(), hour: str = "hour") -> tuple[DataFrame, Solution]:
    """Hours (by, src, hour, depth) with ``corrected``, and the solution behind them."""
    solution = solve(_sums(hours, list(by)), targets, links, by, bounds)
    return hourly(hours, solution.cells, by, hour, bounds.dry), solution


def reconcile_day(hours: DataFrame, targets: DataFrame, links: DataFrame, day: str = "day", bounds: Bounds = Bounds(), hour: str = "hour", most_unconverged: float = 0.005) -> tuple[DataFrame, Solution, DataFrame]:
    """All days (day, src, hour, depth) that have exactly 24 hours, solved side by side; others are left out.

    Gives the hours, the solution and a row per day: iterations, converged, the share of constrained targets that
    are not, and whether the day is accepted.
    """
    whole = hours.groupBy(day).agg(F.count_distinct(hour).alias("n")).where("n = 24").select(day)
    kept = hours.join(whole, day, "left_semi")
    corrected, solution = reconcile_period(kept, targets.join(whole, day, "left_semi"), links, [day], bounds, hour)
    has = lambda k: F.col("flags").bitwiseAND(F.lit(k)) != 0
    shares = solution.targets.groupBy(day).agg((F.count_if(has(reconcile.NOT_CONVERGED)) / F.greatest(F.count_if(~has(reconcile.TARGET_MISSING)), F.lit(1))).alias("unconverged"))
    verdict = solution.runs.join(shares, day).withColumn("accepted", F.col("converged") | (F.col("unconverged") <= most_unconverged))
    return corrected, solution, verdict


MONTH = Bounds(rounds=80, most_depth=4000.0)


def reconcile_month(depths: DataFrame, targets: DataFrame, links: DataFrame, by: list[str] = (), bounds: Bounds = MONTH) -> Solution:
    """A month's accumulated depths (by, src, depth); ``reconcile.monthly_hours`` applies the result to hours."""
    return solve(depths, targets, links, by, bounds)


def bounds_sweep(depths: DataFrame, targets: DataFrame, links: DataFrame, ratios: list[float], bounds: Bounds = MONTH, limits: dict[str, float] = reconcile.LIMITS, accuracy: int = 10_000) -> DataFrame:
    """A row per greatest ratio: how its solve ended, shares of targets, whether it is accepted, and quantiles of the factors.

    All ratios are solved as one. Quantiles come from mergeable sketches, off by at most 1 / ``accuracy`` in rank.
    """
    each = F.explode(F.array(*(F.lit(float(r)) for r in sorted(set(ratios))))).alias("bound")
    if min(ratios) < 1:
        raise ValueError("a greatest ratio must not be below one")
    s = solve(depths.select("src", "depth", each), targets.select("dst", "total", each), links, ["bound"], replace(bounds, ratio=(bounds.ratio[0], max(ratios)), cumulative=(0.0, max(ratios))), "bound")
    marks = {"minimum": 0.0, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999, "maximum": 1.0}
    sketch = s.cells.groupBy("bound").agg(F.percentile_approx("factor", [*marks.values()], accuracy).alias("q"), F.max("corrected").alias("most_depth"))
    quantiles = sketch.select("bound", "most_depth", *(F.col("q")[k].alias(name) for k, name in enumerate(marks)))
    return s.runs.join(reconcile.acceptance(s.targets, bounds.tolerance, limits, ["bound"]), "bound").join(quantiles, "bound")
