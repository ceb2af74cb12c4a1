"""Queries of coverage, overlap diagnostics and what may be published."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..operators import coverage, fill, publication
from . import bindings as b
from .registry import register

c = F.col


@register("fil04_fill_persistent_gaps", f"""WITH RECURSIVE g AS (SELECT y, x, CASE WHEN size % 4 = 0 OR x % 9 = 0 THEN value END AS v, size % 5 <> 1 AS land, size % 11 <> 2 AS allowed FROM ({b.GRID})),
d AS (SELECT y, x, v, land, allowed, CASE WHEN v IS NOT NULL THEN 0 ELSE (SELECT min(abs(k.y - t.y) + abs(k.x - t.x)) FROM g k WHERE k.v IS NOT NULL) END AS d FROM g t),
n AS (SELECT a.y, a.x, arg_min(b.y, r) AS ny, arg_min(b.x, r) AS nx FROM d a, (VALUES (0, 0, 1), (1, 0, -1), (2, 1, 0), (3, -1, 0)) o(r, dy, dx), d b WHERE b.y = a.y + dy AND b.x = a.x + dx AND b.d = a.d - 1 GROUP BY 1, 2),
w AS (SELECT y AS ty, x AS tx, y, x, d FROM d UNION ALL SELECT ty, tx, n.ny, n.nx, w.d - 1 FROM w JOIN n ON n.y = w.y AND n.x = w.x WHERE w.d > 0), e AS (SELECT w.ty, w.tx, d.v AS donor FROM w JOIN d ON d.y = w.y AND d.x = w.x WHERE w.d = 0),
f AS (SELECT d.*, donor, d.v IS NULL AND land AS target FROM d JOIN e ON ty = d.y AND tx = d.x)
SELECT y, x, CASE WHEN target AND allowed AND d <= 2 THEN donor ELSE v END AS value, CASE WHEN target AND allowed AND d <= 2 THEN d ELSE 0 END::INTEGER AS distance, CASE WHEN target AND NOT allowed THEN 'unapproved' WHEN target AND d > 2 THEN 'too_far' END AS fault FROM f""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    cells = g.select("y", "x", "size", F.when((c("size") % 4 == 0) | (c("x") % 9 == 0), c("value")).alias("v"))
    return checkpointed(spark, lambda: fill.propagated(cells, "v", c("size") % 5 != 1, c("size") % 11 != 2, 2))


@register("fil05_nearest_native", """WITH t AS (SELECT c_custkey AS dst, radians(30 + c_custkey % 37 * 0.5) AS a, radians(-120 + c_custkey % 41 * 0.75) AS b FROM customer), d AS (SELECT p_partkey AS src, radians(30 + p_partkey % 43 * 0.41) AS a, radians(-120 + p_partkey % 53 * 0.55) AS b FROM part),
x AS (SELECT dst, cos(a) * cos(b) AS x, cos(a) * sin(b) AS y, sin(a) AS z FROM t), v AS (SELECT src, cos(a) * cos(b) AS x, cos(a) * sin(b) AS y, sin(a) AS z FROM d),
k AS (SELECT dst, min(sqrt((x.x - v.x) ** 2 + (x.y - v.y) ** 2 + (x.z - v.z) ** 2)) AS chord FROM x, v GROUP BY 1)
SELECT dst, 6371 * 2 * asin(chord / 2) <= 25 AS near, CASE WHEN 6371 * 2 * asin(chord / 2) <= 25 THEN round(6371 * 2 * asin(chord / 2) + 3.3e-9, 4) END AS km FROM k""")
def _(spark, sf_dir):
    k, p = c("c_custkey"), c("p_partkey")
    targets = b.table(spark, sf_dir, "customer").select(k.alias("dst"), (30 + k % 37 * 0.5).alias("lat"), (-120 + k % 41 * 0.75).alias("lon"))
    donors = b.table(spark, sf_dir, "part").select(p.alias("src"), (30 + p % 43 * 0.41).alias("lat"), (-120 + p % 53 * 0.55).alias("lon"))
    return coverage.nearest_native(targets, donors).select("dst", c("src").isNotNull().alias("near"), b.rounded("km", 4).alias("km"))


@register("fil10_gap_categories", f"""WITH g AS (SELECT y, x, cell, size <= 40 AS land, CASE WHEN size % 3 <> 0 THEN value END AS a, CASE WHEN y % 9 > 2 OR x > 14 THEN value END AS b FROM ({b.GRID})),
da AS (SELECT t.cell, min(sqrt((t.y - s.y) ** 2 + (t.x - s.x) ** 2)) AS d FROM g t, g s WHERE t.a IS NULL AND s.a IS NOT NULL GROUP BY 1), db AS (SELECT t.cell, min(sqrt((t.y - s.y) ** 2 + (t.x - s.x) ** 2)) AS d FROM g t, g s WHERE t.b IS NULL AND s.b IS NOT NULL GROUP BY 1),
j AS (SELECT y, x, g.cell, land, ((a IS NULL)::INTEGER + (b IS NULL)::INTEGER)::INTEGER AS missing_fields, greatest(coalesce(da.d, 0), coalesce(db.d, 0))::DOUBLE AS distance FROM g LEFT JOIN da USING (cell) LEFT JOIN db USING (cell))
SELECT y, x, missing_fields, round(distance + 3.3e-9, 6) AS distance, CASE WHEN missing_fields = 0 THEN 0 WHEN NOT land THEN 1 WHEN distance <= 1.5 THEN 2 WHEN cell IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48) THEN 4 ELSE 3 END::INTEGER AS category FROM j""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    cells = g.select("y", "x", "size", F.when(c("size") % 3 != 0, c("value")).alias("a"), F.when((c("y") % 9 > 2) | (c("x") > 14), c("value")).alias("b"))
    mapped = b.table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.floor(c("l_partkey") / 20).alias("y"), (c("l_partkey") % 20).alias("x"))
    out = checkpointed(spark, lambda: coverage.gap_categories(cells, ["a", "b"], c("size") <= 40, mapped, 1.5))
    return out.withColumn("distance", b.rounded("distance"))


@register("fil17_coverage_patterns", """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id % 10 AS cell, max(value) > 60 AS ok FROM events GROUP BY ALL), r AS (SELECT event_type, day, count(*) FILTER (WHERE ok) AS n, string_agg(CASE WHEN ok THEN CAST(cell AS VARCHAR) END, ',' ORDER BY cell) AS p FROM s GROUP BY 1, 2),
k AS (SELECT event_type, count(*) AS records, count(DISTINCT coalesce(p, '')) AS patterns, min(n) AS least_valid, max(n) AS most_valid FROM r GROUP BY 1), t AS (SELECT event_type, cell, count(*) FILTER (WHERE ok) AS n FROM s GROUP BY 1, 2)
SELECT event_type, records, count(*) FILTER (WHERE n > 0) AS union_cells, count(*) FILTER (WHERE n = records) AS common_cells, patterns, least_valid, most_valid FROM t JOIN k USING (event_type) GROUP BY ALL""")
def _(spark, sf_dir):
    s = b.table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day"), (c("user_id") % 10).alias("cell")).agg((F.max("value") > 60).alias("ok"))
    return coverage.coverage_patterns(s, ["event_type"], "day", "cell", c("ok"))


@register("sel11_overlap_diagnostics", """WITH d AS (SELECT l_returnflag, month(l_shipdate)::INTEGER AS month, 'q' AS variable, l_quantity - CASE WHEN l_linenumber <> 3 THEN l_partkey % 50 END AS d FROM lineitem UNION ALL SELECT l_returnflag, month(l_shipdate), 't', l_tax - l_discount FROM lineitem)
SELECT l_returnflag, month, variable, count(*) AS requested, count(d) AS paired, round(avg(d) + 3.3e-9, 6) AS bias, round(sqrt(avg(d * d)) + 3.3e-9, 6) AS rmse, round(quantile_cont(abs(d), 0.95) + 3.3e-9, 6) AS p95 FROM d GROUP BY ALL""")
def _(spark, sf_dir):
    p = b.table(spark, sf_dir, "lineitem").select("l_returnflag", F.month("l_shipdate").alias("month"), c("l_quantity").alias("q"), F.when(c("l_linenumber") != 3, c("l_partkey") % 50).cast("double").alias("q_reference"), c("l_tax").alias("t"), c("l_discount").alias("t_reference"))
    return coverage.overlap_diagnostics(p, ["l_returnflag", "month"], ["q", "t"]).withColumns({k: b.rounded(k) for k in ("bias", "rmse", "p95")})


@register("rgd08_dem_sample", f"""WITH g AS (SELECT y, x, CASE WHEN size % 7 <> 0 THEN value END AS v FROM ({b.GRID})), n AS (SELECT max(y) + 1 AS rows FROM g), t AS (SELECT c_custkey AS dst, (c_custkey % 43) * 0.5 - 0.7 AS fx, (c_custkey % 61) * 0.4 - 0.9 AS fy FROM customer),
f AS (SELECT *, floor(fx)::BIGINT AS cx, floor(fy)::BIGINT AS cy FROM t, n), k AS (SELECT dst, cy + j AS y, cx + i AS x, (CASE WHEN i = 1 THEN fx - cx ELSE 1 - fx + cx END) * (CASE WHEN j = 1 THEN fy - cy ELSE 1 - fy + cy END) AS w FROM f, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j) WHERE cx >= 0 AND cy >= 0 AND cx + 1 < 20 AND cy + 1 < rows),
m AS (SELECT dst, sum(w * v) / nullif(sum(w), 0) AS h FROM k JOIN g USING (y, x) WHERE v IS NOT NULL GROUP BY 1) SELECT dst, round(h + 3.3e-9, 6) AS height FROM t LEFT JOIN m USING (dst)""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    raster = g.select(c("y").alias("row"), c("x").alias("col"), F.when(c("size") % 7 != 0, c("value")).alias("value"))
    rows = (g.agg(F.max("y")).head()[0] or 0) + 1  # the raster's height, as its header would say
    k = c("c_custkey")
    targets = b.table(spark, sf_dir, "customer").select(k.alias("dst"), ((k % 43) * 0.5 - 0.7 + 0.5).alias("lon"), (-((k % 61) * 0.4 - 0.9 + 0.5)).alias("lat"))
    return coverage.raster_sample(targets, raster, 0.0, 0.0, 1.0, 1.0, rows, 20).withColumn("height", b.rounded("height"))


@register("snk05_daily_archive", """WITH e AS (SELECT event_type AS k, date_trunc('hour', ts) + CASE WHEN event_id % 400 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 0 MINUTE END AS t, event_id FROM events), h AS (SELECT k, t, CAST(t AS DATE) AS day, min(event_id) AS p, CASE WHEN min(event_id) % 150 = 0 THEN 'b' ELSE 'a' END AS s FROM e GROUP BY k, t),
m AS (SELECT *, lag(t) OVER (PARTITION BY k, day ORDER BY p) >= t AS back FROM h)
SELECT k, CAST(day AS VARCHAR) AS day, count(*) AS records, CASE WHEN count(*) <> 24 THEN 'count' WHEN min(s) <> max(s) THEN 'schema' WHEN count(DISTINCT CASE WHEN date_trunc('hour', t) = t THEN hour(t) END) <> 24 THEN 'hours' WHEN bool_or(coalesce(back, false)) THEN 'order' END AS fault FROM m GROUP BY k, day""")
def _(spark, sf_dir):
    k = c("event_id")
    t = F.date_trunc("hour", c("ts").cast("timestamp")) + F.make_interval(mins=F.when(k % 400 == 0, 5).otherwise(0))
    h = b.table(spark, sf_dir, "events").groupBy(c("event_type").alias("k"), t.alias("t")).agg(F.min(k).alias("p")).withColumn("s", F.when(c("p") % 150 == 0, "b").otherwise("a"))
    return publication.day_archives(h, ["k"], "t", "p", "s").withColumn("day", b.text("day"))


@register("aud13_final_audit", """WITH r AS (SELECT l_suppkey % 25 AS day, l_orderkey % 24 AS h, l_partkey % 40 <> 0 AS keep, CASE WHEN l_partkey % 40 <> 0 AND l_orderkey % 97 <> 0 THEN l_quantity END AS a, CASE WHEN l_orderkey % 51 <> 0 THEN l_tax END AS b, l_partkey % 3 = 0 AS active, l_suppkey % 4 = 0 AS constrained, l_suppkey % 8 = 0 AS accepted FROM lineitem),
g AS (SELECT day, sum((active AND a IS NULL)::INTEGER + (active AND b IS NULL)::INTEGER)::BIGINT AS holes, sum((NOT keep AND a IS NOT NULL)::INTEGER + (NOT keep AND b IS NOT NULL)::INTEGER)::BIGINT AS outside, count(DISTINCT h) = 24 AS hours_exact, bool_and(NOT constrained OR accepted) AS accepted FROM r GROUP BY 1)
SELECT *, holes = 0 AND outside = 0 AND hours_exact AND accepted AS passed FROM g""")
def _(spark, sf_dir):
    k, p, s = c("l_orderkey"), c("l_partkey"), c("l_suppkey")
    r = b.table(spark, sf_dir, "lineitem").select(
        (s % 25).alias("day"), (k % 24).alias("h"), (p % 40 != 0).alias("keep"), F.when((p % 40 != 0) & (k % 97 != 0), c("l_quantity")).alias("a"), F.when(k % 51 != 0, c("l_tax")).alias("b"),
        (p % 3 == 0).alias("active"), (s % 4 == 0).alias("constrained"), (s % 8 == 0).alias("was_accepted"),
    )
    return publication.final_audit(r, ["day"], c("h"), ["a", "b"], c("active"), c("keep"), c("was_accepted"), c("constrained"))


_OUTPUTS = """o AS (SELECT o_orderpriority AS stream, CAST(o_orderdate AS DATE) AS day, o_orderkey % 50 = 0 AS short, o_orderstatus = 'P' AND o_orderkey % 3 = 0 AS open, o_orderkey % 7 = 0 AS early FROM orders), a AS (SELECT *, NOT short AND NOT open AND (stream NOT LIKE '1%' OR NOT early) AS ok FROM o)"""


@register("aud16_accepted_output", f"WITH {_OUTPUTS}, m AS (SELECT stream, date_trunc('month', day)::DATE AS m, count(DISTINCT day) FILTER (WHERE ok) AS accepted_days, bool_and(ok) AS whole FROM a GROUP BY 1, 2) SELECT stream, CAST(m AS VARCHAR) AS month, accepted_days, whole AND accepted_days = day(last_day(m)) AS accepted FROM m")
def _(spark, sf_dir):
    k, stream = c("o_orderkey"), c("o_orderpriority")
    o = b.table(spark, sf_dir, "orders").select(
        stream.alias("priority"), F.when(stream.startswith("1"), "retro").otherwise("nrt").alias("stream"), F.to_date("o_orderdate").alias("day"), F.when(k % 50 == 0, 23).otherwise(24).alias("records"), F.lit(True).alias("calendar_day"),
        (~((c("o_orderstatus") == "P") & (k % 3 == 0))).alias("reconciled"), F.when(k % 7 == 0, F.array(F.lit("stable"), F.lit("early"))).otherwise(F.array(F.lit("stable"))).alias("revisions"),
    )
    days = publication.accepted_days(o).drop("stream").withColumnRenamed("priority", "stream")
    return publication.accepted_months(days, ["stream"], "day").withColumn("month", b.text("month"))


@register("aud10_late_revision_monitor", """WITH l AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders) SELECT o_orderkey AS file, (d - CAST(o_orderdate AS DATE))::INTEGER AS age_days, CASE WHEN o_orderkey % 5 = 0 THEN 'no_reference' WHEN o_orderkey % 3 <> 0 THEN 'identical_bytes' WHEN o_orderkey % 2 = 0 THEN 'encoding_only' ELSE 'decoded_changed' END AS result FROM orders, l WHERE d - CAST(o_orderdate AS DATE) BETWEEN 30 AND 400""")
def _(spark, sf_dir):
    k = c("o_orderkey")
    o = b.table(spark, sf_dir, "orders").select(k.alias("file"), F.to_date("o_orderdate").alias("day"), F.lit("x").alias("bytes"), F.lit("x").alias("content"))
    old = o.where("file % 5 <> 0").withColumns({"bytes": F.when(c("file") % 3 == 0, "y").otherwise("x"), "content": F.when(c("file") % 2 == 0, "x").otherwise("y")})
    last = F.broadcast(o.agg(F.max("day").alias("as_of")))  # one row
    return publication.late_revisions(o.crossJoin(last), old, c("as_of"), 30, 400)


@register("aud18_domain_schema_inventory", """WITH r AS (SELECT DISTINCT c_nationkey AS domain, o_custkey AS file, o_orderkey AS v FROM orders JOIN customer ON c_custkey = o_custkey), n AS (SELECT domain, file, count(*) FILTER (WHERE v % 31 = 0) AS lacking FROM r GROUP BY 1, 2), s AS (SELECT c_custkey AS file, CASE WHEN c_custkey % 9 = 0 THEN 'b' ELSE 'a' END AS shape FROM customer WHERE c_custkey % 13 <> 0),
e AS (SELECT n.*, shape FROM n LEFT JOIN s USING (file)), u AS (SELECT domain, arg_min(shape, struct_pack(k := -n, s := shape)) AS usual FROM (SELECT domain, shape, count(*) AS n FROM e WHERE shape IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT e.domain, file, lacking, CASE WHEN shape IS NULL THEN 'pending' WHEN lacking > 0 OR shape <> usual THEN 'incompatible' ELSE 'compatible' END AS status FROM e LEFT JOIN u ON u.domain = e.domain""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").select(c("o_custkey").alias("file"), c("o_orderkey").alias("variable"))
    files = b.table(spark, sf_dir, "customer").select(c("c_custkey").alias("file"), c("c_nationkey").alias("domain"))
    shapes = files.where("file % 13 <> 0").select("file", F.when(c("file") % 9 == 0, "b").otherwise("a").alias("shape"))
    return publication.domain_inventory(o.join(files, "file"), o.where("variable % 31 <> 0"), shapes)


@register("aud04_status_report", """WITH s AS (SELECT event_type AS name, max(ts) FILTER (WHERE user_id % 3 <> 0 OR event_type <> 'click') AS latest FROM events WHERE event_type <> 'error' OR value < 50 GROUP BY 1), p AS (SELECT o_orderpriority AS name, count(*) FILTER (WHERE o_orderkey % 40 = 0) AS missing, count(*) FILTER (WHERE o_totalprice < 0) AS part FROM orders GROUP BY 1),
m AS (SELECT 'source' AS kind, name, 'age_hours' AS metric, floor(epoch(TIMESTAMP '2024-02-01' - latest)) / 3600 AS value FROM s UNION ALL SELECT 'product', name, 'missing', missing FROM p UNION ALL SELECT 'product', name, 'partial', part FROM p)
SELECT kind, name, metric, round(value + 3.3e-9, 2) AS value FROM m UNION ALL SELECT 'issue', name, metric, round(value + 3.3e-9, 2) FROM m WHERE CASE WHEN kind = 'source' THEN value > 48 ELSE value > 0 END""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").where("event_type <> 'error' or value < 50")
    sources = e.groupBy(c("event_type").alias("name")).agg(F.max(F.when((c("user_id") % 3 != 0) | (c("event_type") != "click"), F.date_trunc("second", c("ts").cast("timestamp")))).alias("latest"))
    products = b.table(spark, sf_dir, "orders").groupBy(c("o_orderpriority").alias("name")).agg(F.count_if(c("o_orderkey") % 40 == 0).alias("missing"), F.count_if(c("o_totalprice") < 0).alias("partial"))
    return publication.status_report(sources, products, F.lit("2024-02-01").cast("timestamp"), 48.0).withColumn("value", b.rounded("value", 2))
