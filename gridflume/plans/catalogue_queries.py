"""Queries of catalogues, manifests and static fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fill, regrid
from ..sources import catalogue
from . import bindings as b
from .registry import register

c = F.col


@register("src24_discover_candidates", """SELECT user_id, hour(ts) AS hour, event_type AS product, arg_min(event_id, (event_id % 2) * 1000000000 + event_id) AS path FROM events WHERE event_type <> 'purchase' OR hour(ts) % 6 = 0 GROUP BY ALL""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("user_id", F.hour(c("ts").cast("timestamp")).cast("long").alias("hour"), c("event_type").alias("product"), c("event_id").alias("path"))
    return catalogue.candidates(e, ["user_id", "hour"], "product", c("hour"), c("product") == "purchase", c("path") % 2)


@register("tmp14_resolve_window_hours", f"""WITH w AS (SELECT DISTINCT hour_end FROM ({b.HOURLY})), r AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end, event_id, event_type = 'view' AS daily FROM events WHERE event_type <> 'purchase' AND value > 60)
SELECT epoch(hour_end)::BIGINT AS stamp, path, path IS NULL AS missing FROM w LEFT JOIN (SELECT hour_end, arg_min(event_id, daily::BIGINT * 1000000000 + event_id) AS path FROM r GROUP BY 1) USING (hour_end)""")
def _(spark, sf_dir):
    end = F.date_trunc("hour", c("ts").cast("timestamp")) + F.expr("INTERVAL 1 HOUR")
    e = b.table(spark, sf_dir, "events").select(end.alias("hour_end"), "event_type", c("event_id").alias("path"), "value")
    found = catalogue.resolved_hours(e, e.where("event_type <> 'purchase' and value > 60"), ["hour_end"], (c("event_type") == "view").cast("int"))
    return found.select(b.seconds("hour_end").alias("stamp"), "path", "missing")


@register("src07_product_schema_check", "SELECT o_custkey AS product, o_orderkey AS variable, CASE WHEN o_orderkey % 7 = 2 THEN 'missing' ELSE 'units' END AS fault FROM orders WHERE o_orderkey % 7 = 2 OR o_totalprice > 200000")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").select(c("o_custkey").alias("product"), c("o_orderkey").alias("variable"), c("o_orderpriority").alias("units"), "o_totalprice")
    found = o.where("variable % 7 <> 2").select("product", "variable", F.when(c("o_totalprice") > 200000, "?").otherwise(c("units")).alias("units"))
    return catalogue.schema_faults(found, o.select("product", "variable", "units"), ["product"])


@register("rgd10_weight_manifest_check", """WITH w AS (SELECT o_orderkey AS weights, o_custkey, (o_orderkey % 200) + 1 AS part, o_orderkey % 11 = 0 AS s_off, o_orderkey % 13 = 0 AS t_off, o_orderstatus <> 'F' AS m_off, p_partkey IS NULL AS no_part, c_custkey IS NULL AS no_cust
FROM orders LEFT JOIN part ON p_partkey = (o_orderkey % 200) + 1 LEFT JOIN customer ON c_custkey = o_custkey)
SELECT weights, s_off OR no_cust AS source_differs, t_off OR no_part AS target_differs, m_off AS method_differs FROM w WHERE s_off OR no_cust OR t_off OR no_part OR m_off""")
def _(spark, sf_dir):
    k, part = c("o_orderkey"), c("o_orderkey") % 200 + 1
    w = b.table(spark, sf_dir, "orders").select(
        k.alias("weights"), (c("o_custkey") * 2).alias("source_grid"), F.when(k % 11 == 0, -1).otherwise(c("o_custkey")).alias("source_print"),
        (part * 2 + 1).alias("target_grid"), F.when(k % 13 == 0, -1).otherwise(part).alias("target_print"), c("o_orderstatus").alias("method"),
    )
    grids = b.table(spark, sf_dir, "customer").select((c("c_custkey") * 2).alias("grid"), c("c_custkey").alias("print")).unionByName(
        b.table(spark, sf_dir, "part").select((c("p_partkey") * 2 + 1).alias("grid"), c("p_partkey").alias("print"))
    )
    return catalogue.weight_mismatches(w, grids, "F")


@register("obs05_cohort_finalize", """WITH p AS (SELECT s_suppkey AS station, s_nationkey AS domain FROM supplier WHERE s_suppkey % 6 <> 1), r AS (SELECT l_suppkey AS station, count(*) AS n, sum(l_linenumber) AS records FROM lineitem WHERE l_quantity > 49 GROUP BY 1), f AS (SELECT p.station AS ps, domain, n, records FROM p FULL OUTER JOIN r ON r.station = p.station)
SELECT domain, count(ps) AS planned, count(*) FILTER (WHERE ps IS NOT NULL AND n = 1) AS once, count(*) FILTER (WHERE ps IS NOT NULL AND n IS NULL) AS absent, count(*) FILTER (WHERE ps IS NOT NULL AND n > 1) AS repeated, count(*) FILTER (WHERE ps IS NULL) AS unplanned, sum(CASE WHEN ps IS NOT NULL THEN records END)::BIGINT AS records FROM f GROUP BY 1""")
def _(spark, sf_dir):
    plan = b.table(spark, sf_dir, "supplier").where("s_suppkey % 6 <> 1").select(c("s_suppkey").alias("station"), c("s_nationkey").alias("domain"))
    results = b.table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(c("l_suppkey").alias("station"), c("l_linenumber").alias("records"))
    return catalogue.cohort(plan, results, "station", ["domain"], ["records"])


@register("rgd12_terrain_check", "SELECT count(*) AS cells, count(*) FILTER (WHERE p_size > 10 AND p_partkey % 9 = 0) AS uncovered, count(*) FILTER (WHERE p_partkey % 9 <> 0 AND p_retailprice * 6 NOT BETWEEN -500 AND 9000) AS out_of_range, count(*) > 0 AND count(*) FILTER (WHERE p_size > 10 AND p_partkey % 9 = 0) = 0 AND count(*) FILTER (WHERE p_partkey % 9 <> 0 AND p_retailprice * 6 NOT BETWEEN -500 AND 9000) = 0 AS valid FROM part")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir).select("size", F.when(c("cell") % 9 != 0, c("value") * 6).alias("height"))
    return regrid.terrain_report(g, c("size") > 10, "height")


@register("fil16_subset_forcing", f"SELECT cell, y - 2 AS y, x - 4 AS x, CASE WHEN cell % 8 <> 3 THEN value END AS value, size > 20 AND cell % 8 = 3 AS lacking FROM ({b.GRID}) WHERE y BETWEEN 2 AND 90 AND x BETWEEN 4 AND 15")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir).withColumn("value", F.when(c("cell") % 8 != 3, c("value")))
    return fill.cropped(g, 2, 90, 4, 15, c("size") > 20, ["value"]).select("cell", "y", "x", "value", "lacking")
