"""Queries of monthly audits, published hours, days of remapped fields and subset networks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..operators import audit, network, reconcile, regrid
from . import bindings as b
from .registry import register

c = F.col


@register("rec15_monthly_audit", """WITH d AS (SELECT l_suppkey AS cell, l_linenumber AS day, sum(l_quantity) AS d, max(l_quantity) AS m, min(l_tax) AS lo, max(l_tax) AS hi FROM lineitem GROUP BY 1, 2), s AS (SELECT cell, sum(d) AS depth, max(m) AS m, avg(lo) AS lo, avg(hi) AS hi FROM d GROUP BY 1),
e AS (SELECT s_suppkey AS cell, s_suppkey % 4 AS k FROM supplier WHERE s_suppkey % 7 <> 5), j AS (SELECT s.cell AS a, e.cell AS b, CASE WHEN k = 1 THEN 0.125 ELSE 0 END::DOUBLE AS off, m FROM s FULL OUTER JOIN e USING (cell))
SELECT count(*) FILTER (WHERE a IS NULL OR b IS NULL) AS unmatched, max(off) AS depth_error, 0.0::DOUBLE AS low_error, max(off) AS high_error, max(m) AS most_hourly, false AS passed FROM j""")
def _(spark, sf_dir):
    h = b.table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("cell"), c("l_linenumber").alias("day"), c("l_quantity").alias("depth"), c("l_tax").alias("t"))
    off = F.when(c("cell") % 4 == 1, 0.125).otherwise(0.0)
    sums = reconcile.monthly_sums(h, "cell", "day", "depth", "t", 1).join(b.table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("cell")), "cell").where("cell % 7 <> 5")
    expected = sums.withColumns({"depth": c("depth") + off, "mean_high": c("mean_high") + off})
    out = reconcile.monthly_audit(h, expected, "cell", "day", "depth", "t")
    return out.withColumns({k: b.rounded(k) for k in ("depth_error", "low_error", "high_error")})


@register("rec16_constraint_provenance", f"""WITH l AS ({b.LINKS}), t AS (SELECT s_suppkey AS dst, CASE s_suppkey % 4 WHEN 1 THEN 16 WHEN 2 THEN 4 WHEN 3 THEN 20 ELSE s_suppkey % 8 / 2 END::INTEGER AS flags FROM supplier), k AS (SELECT DISTINCT src, unnest(list_filter([CASE WHEN flags & 16 <> 0 THEN 'capped' END, CASE WHEN flags & 4 <> 0 THEN 'base_dry' END, CASE WHEN flags = 0 THEN 'clean' END], lambda x: x IS NOT NULL)) AS kind FROM l JOIN t USING (dst) WHERE weight > 0)
SELECT kind, l_returnflag AS region, l_linenumber AS source, count(*) AS cell_hours, count(*) FILTER (WHERE l_quantity >= 20) AS wet_cell_hours, sum(l_quantity) AS depth, count(*) FILTER (WHERE l_orderkey & 4 <> 0) AS qc_clipped, quantile_cont(l_quantity, 0.5) AS p50, round(quantile_cont(l_quantity, 0.95) + 3.3e-9, 6) AS p95 FROM lineitem JOIN k ON src = l_partkey GROUP BY ALL""")
def _(spark, sf_dir):
    h = b.table(spark, sf_dir, "lineitem").select(c("l_partkey").alias("src"), c("l_returnflag").alias("region"), c("l_linenumber").alias("source"), c("l_quantity").alias("depth"), c("l_orderkey").alias("qc"))
    t = b.table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("dst"), F.when(c("s_suppkey") % 4 == 1, 16).when(c("s_suppkey") % 4 == 2, 4).when(c("s_suppkey") % 4 == 3, 20).otherwise((c("s_suppkey") % 8 / 2).cast("int")).alias("flags"))
    return reconcile.constraint_provenance(h, t, b.links(spark, sf_dir), ["region", "source"], {"clipped": 4}, 20.0).withColumn("p95", b.rounded("p95"))


@register("rec17_reconcile_publish", """WITH h AS (SELECT l_orderkey AS k, l_linenumber AS n, sum(l_quantity) AS d, max(l_tax) + 270 AS t, max(l_discount) + 280 AS o FROM lineitem GROUP BY 1, 2)
SELECT k AS cell, n AS hour, round(d / 3600 + 3.3e-9, 8) AS rate, CASE WHEN k % 3 = 0 AND n < 4 THEN o ELSE t END AS temperature, k % 3 = 0 AND n < 4 AS overridden, (SELECT count(*) FILTER (WHERE s_acctbal < -1e9) * 200 <= count(*) FROM supplier) AS accepted FROM h""")
def _(spark, sf_dir):
    each = b.table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("cell"), c("l_linenumber").alias("hour"))
    li = each.agg(F.sum("l_quantity").alias("corrected"), (F.max("l_tax") + 270).alias("temperature"), (F.max("l_discount") + 280).alias("other"))
    overrides = li.where("cell % 3 = 0 and hour < 4").select("cell", "hour", c("other").alias("temperature"))
    bal = c("s_acctbal")
    targets = b.table(spark, sf_dir, "supplier").select(bal.alias("total"), F.lit(0.0).alias("residual"), F.when(bal < -1e9, reconcile.NOT_CONVERGED).otherwise(0).alias("flags"))
    return reconcile.published_hours(li, overrides, ["cell", "hour"], reconcile.acceptance(targets)).withColumn("rate", b.rounded("rate", 8))


@register("rgd09_batch_remap_day", """WITH h AS (SELECT l_partkey AS src, l_returnflag AS day, l_linenumber % 5 AS hour, sum(l_quantity) AS a, sum(l_tax) AS b FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linenumber % 5 = 4) GROUP BY ALL), w AS (SELECT day FROM h GROUP BY 1 HAVING count(DISTINCT hour) = 5), l AS (SELECT l_partkey AS src, l_suppkey AS dst, sum(l_quantity) - 30 AS weight FROM lineitem GROUP BY ALL)
SELECT day, hour, dst, round(sum(weight * a) / sum(weight) + 3.3e-9, 5) AS a, round(sum(weight * b) / sum(weight) + 3.3e-9, 5) AS b FROM h JOIN w USING (day) JOIN l USING (src) WHERE weight > 0 GROUP BY ALL""")
def _(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").select(c("l_partkey").alias("src"), c("l_returnflag").alias("day"), (c("l_linenumber") % 5).alias("hour"), c("l_quantity").alias("a"), c("l_tax").alias("b"))
    h = li.where("not (day = 'A' and hour = 4)").groupBy("src", "day", "hour").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    links = b.links(spark, sf_dir).withColumn("weight", c("weight") - 30)
    return regrid.remap_day(h, links, ["a", "b"], "day", "hour", 5).withColumns({k: b.rounded(k, 5) for k in "ab"})


@register("aud06_validate_hourly_day", """WITH r AS (SELECT event_type AS station, CAST(ts AS DATE) AS day, hour(ts)::INTEGER AS h, (event_id % 17 = 0)::INTEGER AS gone, (event_id % 17 <> 0 AND 240 + value / 2 > 340)::INTEGER + (value * 5 > 1400)::INTEGER AS bad FROM events), g AS (SELECT station, day, h, sum(gone)::BIGINT AS missing, sum(bad)::BIGINT AS violations FROM r GROUP BY ALL)
SELECT station, CAST(day AS VARCHAR) AS day, count(*) AS hours, sum(missing)::BIGINT AS missing, sum(violations)::BIGINT AS violations, arg_max(h, (missing + violations) * 100 - h)::INTEGER AS worst_hour, count(*) = 24 AND sum(missing) = 0 AND sum(violations) = 0 AS passed FROM g GROUP BY station, day""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select(c("event_type").alias("station"), F.to_date("ts").alias("day"), F.hour("ts").alias("h"), F.when(c("event_id") % 17 != 0, 240 + c("value") / 2).alias("t2d"), (c("value") * 5).alias("swdown"))
    return audit.hourly_day(e, ["station", "day"], "h", {k: audit.LIMITS[k] for k in ("t2d", "swdown")}).withColumn("day", b.text("day"))


@register("net09_subset_network", f"""WITH RECURSIVE r AS (SELECT *, 25 + link % 28 AS lat, -125 + link % 58 AS lon FROM ({b.REACHES})), w(link) AS (SELECT link FROM r WHERE lat BETWEEN 30 AND 36 AND lon BETWEEN -120 AND -90 UNION SELECT to_link FROM w JOIN r USING (link) WHERE to_link IN (SELECT link FROM r))
SELECT link, CASE WHEN to_link IN (SELECT link FROM w) THEN to_link ELSE 0 END AS to_link, kind, row_number() OVER (ORDER BY link) - 1 AS index FROM r WHERE link IN (SELECT link FROM w)""")
def _(spark, sf_dir):
    k = c("link")
    r = b.reaches(spark, sf_dir).withColumns({"lat": (25 + k % 28).cast("double"), "lon": (-125 + k % 58).cast("double")})
    return checkpointed(spark, lambda: network.subset_network(r, 30, 36, -120, -90)).select("link", "to_link", "kind", "index")
