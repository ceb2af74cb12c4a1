"""Queries of domain selection, of a day's inputs and of the audits of what was published."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..operators import audit, incremental, network
from . import bindings as b
from .registry import register

c = F.col


@register("net02_refine_window", "SELECT p_partkey, p_size * 4 AS low, (p_size + p_partkey % 9 + 1) * 4 - 1 AS high FROM part")
def _(spark, sf_dir):
    low, high = network.refined_window(c("p_size"), c("p_size") + c("p_partkey") % 9, 4)
    return b.table(spark, sf_dir, "part").select("p_partkey", low.alias("low"), high.alias("high"))


@register("net03_route_candidates", f"SELECT cell, lat, lon FROM (SELECT cell, CASE WHEN cell % 7 <> 2 THEN lat END AS lat, lon FROM ({b.GRID})) WHERE lat BETWEEN 25.5 AND 40 AND lon BETWEEN -120 AND -80")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir).select("cell", F.when(c("cell") % 7 == 2, F.when(c("cell") % 2 == 0, F.lit(float("nan")))).otherwise(c("lat")).alias("lat"), "lon")
    return network.in_box(g, 25.5, 40, -120, -80)


@register("net05_select_spatial_weights", """WITH r AS (SELECT l_orderkey AS id, (l_suppkey % 40)::BIGINT AS i, (l_partkey % 30)::BIGINT AS j FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')), n AS (SELECT id, i - 5 AS i, j - 3 AS j FROM r WHERE j - 1 BETWEEN 3 AND 20 AND i - 1 BETWEEN 5 AND 30)
SELECT id, i, j, count(*) OVER (PARTITION BY id) AS "overlaps" FROM n""")
def _(spark, sf_dir):
    r = b.table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("id"), (c("l_suppkey") % 40).alias("i"), (c("l_partkey") % 30).alias("j"))
    wanted = b.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(c("o_orderkey").alias("id"))
    return network.spatial_weights(r, wanted, "id", 3, 20, 5, 30)


@register("net07_boundary_influence", f"""WITH RECURSIVE r AS ({b.REACHES}), k AS (SELECT * FROM r WHERE domain <> 7), s AS (SELECT to_link AS link FROM r WHERE domain = 7 UNION SELECT link FROM k WHERE domain = 3),
d(link) AS (SELECT link FROM s WHERE link IN (SELECT link FROM k) UNION SELECT k.to_link FROM d JOIN k ON k.link = d.link WHERE k.to_link IN (SELECT link FROM k)) SELECT link FROM d""")
def _(spark, sf_dir):
    r = b.reaches(spark, sf_dir)
    kept = r.where("domain <> 7")
    return checkpointed(spark, lambda: network.boundary_influence(r, kept, kept.where("domain = 3")))


@register("obs09_reach_gauge_mapping", "SELECT trim(s_name) AS gage, s_suppkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49) AND trim(s_name) <> ''")
def _(spark, sf_dir):
    s = b.table(spark, sf_dir, "supplier").select(F.concat(F.lit("  "), c("s_name"), F.lit(" ")).alias("gage"), "s_suppkey")
    kept = b.table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(c("l_suppkey").alias("s_suppkey")).join(s, "s_suppkey").select("gage")
    return network.selected_gauges(kept, s)


@register("inc07_baseline_inputs", "SELECT strftime(d, '%Y-%m-%d') AS day, event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM (SELECT DISTINCT ts::DATE AS d FROM events WHERE event_type <> 'view') JOIN events ON ts BETWEEN d - INTERVAL 5 HOUR AND d + INTERVAL 24 HOUR GROUP BY ALL")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("event_id", "event_type", c("ts").cast("timestamp").alias("ts"))
    found = incremental.inputs_of_days(e, e.where("event_type <> 'view'").select(F.to_date("ts").alias("day")), "day", "ts")
    return found.groupBy(b.text("day").alias("day"), "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@register("snk06_archive_is_current", """SELECT l_suppkey, count(*) AS inputs, count(*) FILTER (WHERE NOT coalesce(o_custkey % 50 <> 7 AND o_custkey % 100 = want, false)) AS changed, count(*) FILTER (WHERE NOT coalesce(o_custkey % 50 <> 7 AND o_custkey % 100 = want, false)) = 0 AS current
FROM (SELECT l_suppkey, l_orderkey, CASE WHEN l_partkey % 90 = 1 THEN -1 ELSE o_custkey % 100 END AS want, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("path"), "o_custkey")
    made = b.table(spark, sf_dir, "lineitem").select("l_suppkey", c("l_orderkey").alias("path"), "l_partkey").join(o, "path")
    receipts = made.select("l_suppkey", "path", F.when(c("l_partkey") % 90 == 1, F.lit(-1)).otherwise(c("o_custkey") % 100).alias("size"))
    return incremental.outdated(receipts, o.where("o_custkey % 50 <> 7").select("path", (c("o_custkey") % 100).alias("size")), ["l_suppkey"], "path", ["size"])


@register("aud12_content_completeness", """WITH v AS (SELECT l_suppkey % 5 AS g, l_orderkey * 10 + l_linenumber AS cell, CASE WHEN l_quantity > 8 THEN l_discount END AS v, l_tax > 0.02 AS a, l_returnflag = 'R' AS land FROM lineitem)
SELECT g, count(*) FILTER (WHERE a AND v IS NULL) AS missing, count(*) FILTER (WHERE a AND land AND v IS NULL) AS missing_on_land, count(*) FILTER (WHERE NOT a AND v IS NOT NULL) AS outside FROM v GROUP BY 1""")
def _(spark, sf_dir):
    v = b.table(spark, sf_dir, "lineitem").select((c("l_suppkey") % 5).alias("g"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("cell"), F.when(c("l_quantity") > 8, c("l_discount")).alias("v"), "l_tax", "l_returnflag")
    return audit.content(v, ["g"], "v", c("l_tax") > 0.02, c("l_returnflag") == "R").select("g", "missing", "missing_on_land", "outside")


@register("sel09_scenario_check", """WITH h AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, hour(ts) AS hour, event_type AS s FROM events), n AS (SELECT user_id, day, count(DISTINCT hour) AS hours, count(*) FILTER (WHERE s <> 'view') AS unexpected, count(*) FILTER (WHERE s = 'purchase') AS forbidden FROM h GROUP BY ALL)
SELECT *, hours = 1 AND unexpected = 0 AND forbidden = 0 AS valid FROM n""")
def _(spark, sf_dir):
    ts = c("ts").cast("timestamp")
    h = b.table(spark, sf_dir, "events").select("user_id", b.text(F.to_date(ts)).alias("day"), F.hour(ts).alias("hour"), "event_type")
    return audit.scenario(h, ["user_id", "day"], "event_type", F.lit("view"), F.lit("purchase"), needed=1)


@register("aud20_required_hours", f"""WITH h AS ({b.HOURLY}), p AS (SELECT min(hour_end) AS a, max(hour_end) AS z FROM h), k AS (SELECT DISTINCT station FROM h), s AS (SELECT station, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS t FROM k, p)
SELECT station, epoch(t)::BIGINT AS stamp FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.station = s.station AND h.hour_end = s.t AND n > 1)""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir).select("station", c("hour_end").alias("stamp"), "n")
    # one row, the period
    keys = h.select("station").distinct().crossJoin(h.agg(F.min("stamp").alias("a"), F.max("stamp").alias("z")))
    return audit.absent_hours(keys, h.where("n > 1"), ["station"], c("a"), c("z")).select("station", b.seconds("stamp").alias("stamp"))
