"""Queries of period, day and month reconciliation and of the sweep over ratio bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projection
from . import bindings as b
from .registry import register

c = F.col


def _solved(rounds: int, most_depth: float, by: str = "", upper: str = "10.0", synthetic: bool = False) -> str:
    """CTEs ``cells`` and ``goals_out`` from CTEs base (by, src, depth), totals (by, dst, total) and links, a set of them per round."""
    on = lambda *k: ", ".join([*by.split(), *k])
    est = lambda cells, f: f"SELECT {on('dst')}, sum(weight * {f}) / sum(weight) AS e FROM {cells} JOIN links USING (src) GROUP BY {on('dst')}"
    seed = f"LEFT JOIN (SELECT {on('src')}, sum(weight * total) / sum(weight) AS seed FROM goals0 JOIN links USING (dst) WHERE dry_base GROUP BY {on('src')}) USING ({on('src')})" if synthetic else ""
    seeded = "CASE WHEN coalesce(depth, 0) <= 1e-8 AND seed > 0 THEN seed ELSE coalesce(depth, 0) END" if synthetic else "coalesce(depth, 0)"
    out = [
        "width AS MATERIALIZED (SELECT src, sum(weight) AS w FROM links GROUP BY src)",
        f"est0 AS MATERIALIZED ({est('(SELECT *, coalesce(depth, 0) AS d0 FROM base)', 'd0')})",
        f"goals0 AS MATERIALIZED (SELECT totals.*, coalesce(total > 1e-8 AND (e IS NULL OR e <= 1e-8), false) AS dry_base FROM totals LEFT JOIN est0 USING ({on('dst')}))",
        f"seeded AS (SELECT base.*, {seeded} AS d FROM base {seed})",
        f"cells0 AS MATERIALIZED (SELECT seeded.*, CASE WHEN depth IS NULL THEN 0 ELSE least(greatest(depth, d) * {upper}, {most_depth}) END AS hi FROM seeded)",
        f"most AS MATERIALIZED ({est('cells0', 'hi')})",
        f"""goals AS MATERIALIZED (SELECT goals0.*, coalesce(total > 1e-8 AND (e IS NULL OR total > e * 1.001), false) AS beyond,
          total IS NOT NULL AND NOT coalesce(total > 1e-8 AND (e IS NULL OR total > e * 1.001), false){'' if synthetic else ' AND NOT dry_base'} AS eligible FROM goals0 LEFT JOIN most USING ({on('dst')}))""",
    ]
    ratio = f"CASE WHEN total <= 1e-8 THEN 0 WHEN e > 1e-8 THEN least(greatest(total / e, 0.1), {upper}) ELSE 1 END"
    for k in range(rounds):
        live = f"CASE WHEN ({by.split()[0]}) IN (SELECT {by.split()[0]} FROM rat{k}) THEN" if by else f"CASE WHEN EXISTS (FROM rat{k}) THEN"
        out += [
            f"rat{k} AS MATERIALIZED (SELECT {on('dst')}, {ratio} AS ratio, coalesce(total > 1e-8 AND e > 1e-8 AND (total / e < 0.1 OR total / e > {upper}), false) AS capped FROM goals JOIN ({est(f'cells{k}', 'd')}) USING ({on('dst')}) WHERE eligible AND abs(e - total) / greatest(total, 1.0) > 0.001)",
            f"cells{k + 1} AS MATERIALIZED (SELECT p.* REPLACE ({live} least(greatest(d * (1 + coalesce(x / w, 0)), 0), hi) ELSE d END AS d) FROM cells{k} p LEFT JOIN width USING (src) LEFT JOIN (SELECT {on('src')}, sum(weight * (ratio - 1)) AS x FROM rat{k} JOIN links USING (dst) GROUP BY {on('src')}) USING ({on('src')}))",
        ]
    caps = " UNION ".join(f"SELECT {on('dst')} FROM rat{k} WHERE capped" for k in range(rounds))
    left = " + ".join(f"(SELECT count(*) FROM rat{k} r{k} WHERE {'r%d.%s = g.%s' % (k, by, by) if by else 'true'} LIMIT 1 )::BOOLEAN::INT" for k in range(rounds))
    out += [
        f"cells AS MATERIALIZED (SELECT {on('src')}, depth AS base, d AS corrected, CASE WHEN depth > 1e-8 THEN d / depth END AS factor FROM cells{rounds})",
        f"caps AS MATERIALIZED ({caps})",
        f"""goals_out AS MATERIALIZED (SELECT {on('dst')}, total, e - total AS residual, coalesce(eligible AND abs(e - total) / greatest(total, 1.0) > 0.001, false) AS unmet,
          CASE WHEN total IS NULL THEN 1 ELSE 0 END | CASE WHEN total <= 1e-8 THEN 2 ELSE 0 END | CASE WHEN dry_base THEN {12 if synthetic else 4} ELSE 0 END | CASE WHEN beyond OR ({on('dst')}) IN (SELECT ({on('dst')}) FROM caps) THEN 16 ELSE 0 END
          | CASE WHEN eligible AND abs(e - total) / greatest(total, 1.0) > 0.001 THEN 32 ELSE 0 END AS flags FROM goals LEFT JOIN ({est('cells', 'corrected')}) USING ({on('dst')}))""",
        f"runs AS (SELECT {on('n') if by else 'n'}, least(n + 1, {rounds}) AS iterations FROM (SELECT {by + ',' if by else ''} {left} AS n FROM (SELECT {'DISTINCT ' + by if by else '1 AS one'} {'FROM totals' if by else ''}) g))",
    ]
    return ",\n".join(out)


def _hours(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").groupBy(c("l_partkey").alias("src"), c("l_linenumber").alias("hour"))
    # part 7 and its like are dry in all hours
    return li.agg((F.when(c("src") % 8 != 7, F.sum("l_quantity")).otherwise(0.0) / 50).alias("depth"))


def _totals(spark, sf_dir):
    k = c("s_suppkey")
    return b.table(spark, sf_dir, "supplier").select(k.alias("dst"), F.when(k % 5 == 4, None).when(k % 11 == 3, 0.0).when(k % 13 == 6, 400.0).otherwise(8.0 + k % 7).alias("total"))


_GIVEN = f"""links AS MATERIALIZED ({b.LINKS}), hours AS MATERIALIZED (SELECT l_partkey AS src, l_linenumber AS hour, CASE WHEN l_partkey % 8 <> 7 THEN sum(l_quantity) ELSE 0.0 END / 50 AS depth FROM lineitem GROUP BY 1, 2),
base AS MATERIALIZED (SELECT src, sum(depth) AS depth FROM hours GROUP BY 1),
totals AS MATERIALIZED (SELECT s_suppkey AS dst, CASE WHEN s_suppkey % 5 = 4 THEN NULL WHEN s_suppkey % 11 = 3 THEN 0.0 WHEN s_suppkey % 13 = 6 THEN 400.0 ELSE 8.0 + s_suppkey % 7 END::DOUBLE AS total FROM supplier)"""


@register("rec02_reconcile_period", f"""WITH {_GIVEN},
{_solved(20, 500.0)}
SELECT h.src, h.hour, round(CASE WHEN base > 1e-8 THEN coalesce(h.depth, 0) / base * corrected ELSE 0 END + 3.3e-9, 5) AS corrected FROM hours h JOIN cells USING (src)""")
def _(spark, sf_dir):
    out, _ = projection.reconcile_period(_hours(spark, sf_dir), _totals(spark, sf_dir), b.links(spark, sf_dir))
    return out.select("src", "hour", b.rounded("corrected", 5).alias("corrected"))


@register("rec02_target_flags", f"""WITH {_GIVEN},
{_solved(20, 500.0)}
SELECT dst, total, round(residual + 3.3e-9, 4) AS residual, flags FROM goals_out""")
def _(spark, sf_dir):
    _, s = projection.reconcile_period(_hours(spark, sf_dir), _totals(spark, sf_dir), b.links(spark, sf_dir))
    return s.targets.select("dst", "total", b.rounded("residual", 4).alias("residual"), "flags")


# a fine cell overlaps the coarse cells that it and the one two further lie in
_FINE_TO_COARSE = "SELECT {k} AS src, ({k} + CASE WHEN l_linenumber > 4 THEN 2 ELSE 0 END) // 20 AS dst, sum(l_quantity) AS weight FROM lineitem GROUP BY ALL"


def _fine_to_coarse(spark, sf_dir, key):
    dst = F.floor((c(key) + F.when(c("l_linenumber") > 4, 2).otherwise(0)) / 20)
    return b.table(spark, sf_dir, "lineitem").groupBy(c(key).alias("src"), dst.alias("dst")).agg(F.sum("l_quantity").alias("weight"))


_DAYS = f"""links AS MATERIALIZED ({_FINE_TO_COARSE.format(k='l_suppkey')}),
hours AS MATERIALIZED (SELECT l_returnflag AS day, l_suppkey AS src, l_orderkey % 24 AS hour, sum(CASE WHEN l_suppkey % 6 <> 1 THEN l_quantity ELSE 0.0 END) / 100 AS depth FROM lineitem WHERE l_returnflag <> 'A' OR l_orderkey % 24 <> 5 GROUP BY ALL),
whole AS (SELECT day FROM hours GROUP BY 1 HAVING count(DISTINCT hour) = 24), base AS MATERIALIZED (SELECT day, src, sum(depth) AS depth FROM hours JOIN whole USING (day) GROUP BY 1, 2),
totals AS MATERIALIZED (SELECT day, d AS dst, CASE WHEN d % 9 = 8 THEN NULL WHEN d % 9 = 7 THEN 0 WHEN day = 'R' THEN 20.0 + d % 3 ELSE 40.0 + d % 5 END::DOUBLE AS total FROM whole, (SELECT DISTINCT dst AS d FROM links))"""


@register("rec03_reconcile_day", f"""WITH {_DAYS},
{_solved(20, 500.0, 'day')}
SELECT day, iterations, NOT bool_or(unmet) AS converged, round(count(*) FILTER (WHERE unmet) / greatest(count(total), 1) + 3.3e-9, 6) AS unconverged, count(*) FILTER (WHERE unmet) <= 0.005 * greatest(count(total), 1) AS accepted,
round(sum(abs(residual)) + 3.3e-9, 2) AS residual FROM goals_out JOIN runs USING (day) GROUP BY day, iterations""")
def _(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").select(c("l_returnflag").alias("day"), c("l_suppkey").alias("src"), (c("l_orderkey") % 24).alias("hour"), c("l_quantity").alias("q"))
    links = _fine_to_coarse(spark, sf_dir, "l_suppkey")
    hours = li.where("day <> 'A' or hour <> 5").groupBy("day", "src", "hour").agg((F.sum(F.when(c("src") % 6 != 1, c("q")).otherwise(0.0)) / 100).alias("depth"))
    d = c("dst")
    # the days of the flags that lines may have, not of those they do
    goals = links.select("dst").distinct().select("dst", F.explode(F.array(*map(F.lit, "ANR"))).alias("day"))
    goals = goals.withColumn("total", F.when(d % 9 == 8, None).when(d % 9 == 7, 0.0).when(c("day") == "R", 20.0 + d % 3).otherwise(40.0 + d % 5))
    _, s, verdict = projection.reconcile_day(hours, goals, links)
    residual = s.targets.groupBy("day").agg(b.rounded(F.sum(F.abs("residual")), 2).alias("residual"))
    return verdict.join(residual, "day").withColumn("unconverged", b.rounded("unconverged"))


_MONTH = f"""links AS MATERIALIZED ({_FINE_TO_COARSE.format(k='l_partkey')}), base AS MATERIALIZED (SELECT l_partkey AS src, CASE WHEN l_partkey % 8 <> 7 THEN sum(l_quantity) ELSE 0.0 END / 10 AS depth FROM lineitem GROUP BY 1),
totals AS MATERIALIZED (SELECT s_suppkey AS dst, CASE WHEN s_suppkey % 5 = 4 THEN NULL WHEN s_suppkey % 11 = 3 THEN 0.0 ELSE 55.0 + s_suppkey % 7 * 4 END::DOUBLE AS total FROM supplier)"""


def _month(spark, sf_dir):
    base = b.table(spark, sf_dir, "lineitem").groupBy(c("l_partkey").alias("src")).agg((F.when(c("src") % 8 != 7, F.sum("l_quantity")).otherwise(0.0) / 10).alias("depth"))
    k = c("s_suppkey")
    totals = b.table(spark, sf_dir, "supplier").select(k.alias("dst"), F.when(k % 5 == 4, None).when(k % 11 == 3, 0.0).otherwise(55.0 + k % 7 * 4).alias("total"))
    return base, totals, _fine_to_coarse(spark, sf_dir, "l_partkey")


@register("rec08_reconcile_month", f"""WITH {_MONTH},
{_solved(80, 4000.0)}
SELECT src, round(base + 3.3e-9, 4) AS base, round(corrected + 3.3e-9, 4) AS corrected, round(factor + 3.3e-9, 5) AS factor FROM cells""")
def _(spark, sf_dir):
    s = projection.reconcile_month(*_month(spark, sf_dir))
    return s.cells.select("src", b.rounded("base", 4).alias("base"), b.rounded("corrected", 4).alias("corrected"), b.rounded("factor", 5).alias("factor"))


@register("rec14_monthly_bounds_sweep")
def _(spark, sf_dir):
    return projection.bounds_sweep(*_month(spark, sf_dir), ratios=[1.5, 2.0, 10.0])
