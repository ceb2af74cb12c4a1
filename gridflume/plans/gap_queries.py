"""Queries of fallback merging, published masks and refresh planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gaps, incremental
from . import bindings as b
from .registry import register

c = F.col


@register("sel03_best_available", "SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN value END, CASE WHEN event_id % 4 <> 0 THEN value / 2 END) AS depth FROM events")
def _(spark, sf_dir):
    k, v = c("event_id"), c("value")
    return b.table(spark, sf_dir, "events").select(k, gaps.best_available(F.when(k % 3 != 0, v), F.when(k % 4 != 0, v / 2)).alias("depth"))


@register("sel05_precipitation_supported", "SELECT l_orderkey, l_linenumber, coalesce(l_linenumber + l_suppkey % 3 IN (1, 2, 3, 4, 5, 7) AND l_quantity - 5 >= 0 AND (l_partkey % 16) & 8 = 0, false) AS supported FROM lineitem")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", gaps.precipitation_supported(c("l_linenumber") + c("l_suppkey") % 3, c("l_quantity") - 5, c("l_partkey") % 16).alias("supported"))


_GAP = """p AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_quantity AS t, l_extendedprice AS q, CASE WHEN l_quantity > 9 THEN l_discount END AS rain, l_returnflag = 'A' AS preferred, l_partkey % 5 AS s FROM lineitem),
f AS (SELECT l_orderkey AS k, l_linenumber AS ln, l_tax AS t2, l_discount + 1 AS q2, l_tax / 2 AS r2 FROM lineitem WHERE l_suppkey % 2 = 0),
m AS (SELECT p.*, t2, q2, r2, f.k IS NOT NULL AND NOT preferred AS used, f.k IS NOT NULL AND NOT preferred AND NOT coalesce(s IN (1, 2, 3, 4) AND rain >= 0, false) AS rain_used FROM p LEFT JOIN f ON f.k = p.k AND f.ln = p.ln)"""


def _merged(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem")
    p = li.select(c("l_orderkey").alias("k"), c("l_linenumber").alias("ln"), c("l_quantity").alias("t"), c("l_extendedprice").alias("q"), F.when(c("l_quantity") > 9, c("l_discount")).alias("rain"), (c("l_returnflag") == "A").alias("preferred"), (c("l_partkey") % 5).alias("s"))
    f = li.where("l_suppkey % 2 = 0").select(c("l_orderkey").alias("k"), c("l_linenumber").alias("ln"), c("l_tax").alias("t"), (c("l_discount") + 1).alias("q"), (c("l_tax") / 2).alias("rain"))
    return gaps.merged(p, f, ["k", "ln"], ["t", "q"], "rain", gaps.precipitation_supported(c("s"), c("rain"), F.lit(0)), c("preferred"))


@register("sel06_merge_gap", f"WITH {_GAP} SELECT k, ln, CASE WHEN used THEN t2 ELSE t END AS t, CASE WHEN used THEN q2 ELSE q END AS q, CASE WHEN rain_used THEN r2 ELSE rain END AS rain, used, rain_used FROM m")
def _(spark, sf_dir):
    return _merged(spark, sf_dir).select("k", "ln", "t", "q", "rain", "used", "rain_used")


@register("sel07_gap_provenance_flags", f"""WITH {_GAP}, z AS (SELECT *, ln % 2 = 0 AS terrain, k % 3 = 0 AS clipped, k % 5 = 0 AS rounded, k % 7 = 0 AS repaired, k % 11 <> 0 AS keep FROM m)
SELECT k, ln, (CASE WHEN used THEN 1 ELSE 0 END + CASE WHEN rain_used THEN 2 ELSE 0 END + CASE WHEN used AND terrain THEN 4 ELSE 0 END + CASE WHEN used AND clipped THEN 8 ELSE 0 END + CASE WHEN used AND rounded THEN 16 ELSE 0 END + CASE WHEN repaired THEN 32 ELSE 0 END)::INTEGER AS usage,
CASE WHEN NOT keep THEN 0 WHEN used THEN 4 ELSE 1 END AS met_source, CASE WHEN used THEN 0 ELSE 64 END AS met_qc, CASE WHEN NOT keep THEN 0 WHEN rain_used THEN 8 ELSE s END AS rain_source, CASE WHEN rain_used THEN 4 ELSE 1 END AS rain_qc, CASE WHEN rain_used THEN 0.15 ELSE 0.8 END::DOUBLE AS confidence FROM z""")
def _(spark, sf_dir):
    k = c("k")
    m = _merged(spark, sf_dir).withColumns({
        "terrain": c("ln") % 2 == 0, "clipped": k % 3 == 0, "rounded": k % 5 == 0, "repaired": k % 7 == 0, "keep": k % 11 != 0,
        "met_source": F.lit(1), "met_qc": F.lit(64), "rain_source": c("s"), "rain_qc": F.lit(1), "confidence": F.lit(0.8),
    })
    return gaps.provenance(m).select("k", "ln", "usage", "met_source", "met_qc", "rain_source", "rain_qc", "confidence")


@register("sel12_no_downgrade_guard", """WITH o AS (SELECT user_id, event_id AS h, event_type AS p FROM events), n AS (SELECT user_id, event_id AS h, CASE WHEN event_id % 9 = 0 THEN 'view' ELSE event_type END AS p FROM events WHERE event_id % 13 <> 0)
SELECT o.user_id, o.h AS hour, CASE WHEN n.p IS NULL THEN 'lost' ELSE 'downgraded' END AS reason FROM o LEFT JOIN n ON n.user_id = o.user_id AND n.h = o.h WHERE n.p IS NULL OR (o.p = 'click' AND n.p <> 'click')""")
def _(spark, sf_dir):
    old = b.table(spark, sf_dir, "events").select("user_id", c("event_id").alias("hour"), c("event_type").alias("product"))
    new = old.where("hour % 13 <> 0").withColumn("product", F.when(c("hour") % 9 == 0, "view").otherwise(c("product")))
    return gaps.downgrades(old, new, ["user_id"], "hour", "product", "click")


@register("sel13_six_hour_collection", """WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts) AS h, event_id % 3 AS enc, event_id AS file FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, h ORDER BY enc DESC, file DESC) AS k FROM f WHERE h IN (0, 6, 12, 18)), b AS (SELECT *, count(*) OVER (PARTITION BY user_id, day) AS n FROM k WHERE k = 1)
SELECT user_id, CAST(day AS VARCHAR) AS day, h::INTEGER AS hour, file FROM b WHERE n = 4""")
def _(spark, sf_dir):
    f = b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("h"), (c("event_id") % 3).alias("enc"), c("event_id").alias("file"))
    return gaps.six_hour_collection(f, ["user_id", "day"], c("h"), c("enc")).withColumn("day", b.text("day"))


@register("fil12_mask_digest", f"""WITH g AS (SELECT cell, cell || ',' || (size > 10)::INTEGER AS r FROM ({b.GRID})), p AS (SELECT cell // 1000 AS part, sha256(string_agg(r, ';' ORDER BY cell)) AS d FROM g GROUP BY 1) SELECT sha256(string_agg(d, '' ORDER BY part)) AS mask_sha256 FROM p""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    return gaps.mask_digest(g, ["cell"], c("size") > 10, F.floor(c("cell") / 1000))


@register("fil15_apply_static_mask", f"WITH g AS ({b.GRID}) SELECT cell, value, false AS missing FROM g WHERE size > 10 AND cell % 6 <> 0 UNION ALL SELECT cell, NULL, true FROM g WHERE size > 30 AND cell % 6 = 0")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    fields = gaps.masked(g.where("cell % 6 <> 0"), g.where("size > 10"), ["cell"]).select("cell", "value")
    gone = gaps.incomplete(fields, g.where("size > 30"), ["cell"], ["value"])
    return fields.withColumn("missing", F.lit(False)).unionByName(gone.select("cell", F.lit(None).cast("double").alias("value"), F.lit(True).alias("missing")))


@register("fil18_restore_inactive", f"WITH g AS ({b.GRID}) SELECT cell, CASE WHEN cell % 4 = 0 AND cell % 3 <> 0 THEN size * 2.0::DOUBLE ELSE value END AS value FROM g")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    donor = g.where("cell % 3 <> 0").select("cell", (c("size") * 2.0).alias("value"))
    return gaps.restored(g.withColumn("active", c("cell") % 4 != 0), donor, ["cell"], "value", "active").select("cell", "value")


@register("fil19_deactivate_outside", f"WITH g AS ({b.GRID}), l AS (SELECT cell, lat BETWEEN 26 AND 45 AND lon BETWEEN -120 AND -80 AS inside, (1 + cell % 3)::INTEGER AS land FROM g) SELECT cell, CASE WHEN NOT inside THEN 2 ELSE land END AS land, NOT inside AND land <> 2 AS changed FROM l")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir).withColumn("land", (1 + c("cell") % 3).cast("int"))
    return gaps.deactivated(g, c("lat").between(26, 45) & c("lon").between(-120, -80), "land").select("cell", "land", "changed")


_EV = """e AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 4 = 0 THEN 'retro' ELSE 'nrt' END AS stream, o_orderkey % 5 = 0 AS urgent, o_orderkey % 3 = 0 AS stable, o_orderkey % 7 = 6 AS idle FROM orders), a AS (SELECT max(day) AS d FROM e)"""


@register("inc04_plan_events", f"""WITH {_EV}, s AS (SELECT *, urgent OR day >= d - 99 AS soon FROM e, a), t AS (SELECT *, CASE WHEN idle THEN 'unchanged' WHEN stream = 'nrt' AND soon THEN 'work' ELSE 'deferred' END AS outcome FROM s)
SELECT k, outcome, CASE WHEN outcome = 'deferred' THEN CASE WHEN stream = 'retro' THEN 'daily-retro' WHEN soon THEN 'fast' ELSE 'daily-nrt' END END AS deferred_to, CASE WHEN outcome = 'work' THEN CASE WHEN urgent THEN 0 ELSE 1 END END AS priority FROM t""")
def _(spark, sf_dir):
    k = c("o_orderkey")
    e = b.table(spark, sf_dir, "orders").select(
        k.alias("k"), F.to_date("o_orderdate").alias("day"), F.when(k % 4 == 0, "retro").otherwise("nrt").alias("stream"), (k % 5 == 0).alias("urgent"), (k % 3 == 0).alias("stable"),
        F.when(k % 7 == 6, F.array().cast("array<string>")).otherwise(F.array(F.lit("full"))).alias("tasks"),
    )
    last = F.broadcast(e.agg(F.max("day").alias("as_of")))  # one row
    return incremental.lanes(e.crossJoin(last), c("as_of"), "fast", 100).select("k", "outcome", "deferred_to", "priority")


_HOURS = "h AS (SELECT user_id, CAST(ts AS DATE) AS day, hour(ts)::INTEGER AS hour, event_type, ts, event_id FROM events)"


@register("inc09_replacement_backlog", f"WITH {_HOURS} SELECT DISTINCT user_id, CAST(day AS VARCHAR) AS day FROM h WHERE event_type IN ('view', 'error') AND day < DATE '2024-01-20' AND (user_id, day, hour) IN (SELECT (user_id, day, hour) FROM h WHERE event_type = 'click')")
def _(spark, sf_dir):
    h = b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), c("event_type").isin("view", "error").alias("fallback"), "event_type")
    return incremental.replacement_backlog(h, h.where("event_type = 'click'"), ["user_id"], "day", F.lit("2024-01-20").cast("date")).select("user_id", b.text("day").alias("day"))


@register("inc11_scan_window", "SELECT o_orderkey, CAST(d AS VARCHAR) AS day FROM (SELECT o_orderkey, unnest(generate_series(CAST(o_orderdate AS DATE) - (o_orderkey % 4)::INTEGER, CAST(o_orderdate AS DATE) + (o_orderkey % 3)::INTEGER, INTERVAL 1 DAY))::DATE AS d FROM orders)")
def _(spark, sf_dir):
    k = c("o_orderkey")
    days = incremental.scan_days(F.to_date("o_orderdate"), (k % 4).cast("int"), (k % 3).cast("int"))
    return b.table(spark, sf_dir, "orders").select("o_orderkey", F.explode(days).alias("day")).withColumn("day", b.text("day"))


@register("inc12_stale_days", f"""WITH h AS (SELECT event_type AS k, CAST(ts AS DATE) AS day, hour(ts) AS hour, max(event_id) AS stamp FROM events GROUP BY ALL), i AS (SELECT k, day, max(stamp) AS newest FROM h GROUP BY 1, 2 HAVING count(*) >= 2),
o AS (SELECT k, day, max(stamp) - max(stamp) % 2 AS made, max(stamp) % 3 AS revision FROM h GROUP BY 1, 2 HAVING max(stamp) % 5 <> 0), s AS (SELECT k, day, CASE WHEN made IS NULL THEN 'missing' WHEN newest > made THEN 'older' WHEN o.revision IS DISTINCT FROM 1 THEN 'revision' END AS reason FROM i LEFT JOIN o USING (k, day))
SELECT k, CAST(day AS VARCHAR) AS day, reason FROM s WHERE reason IS NOT NULL""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select(c("event_type").alias("k"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), c("event_id").alias("stamp"))
    h = e.groupBy("k", "day", "hour").agg(F.max("stamp").alias("stamp"))
    newest = h.groupBy("k", "day").agg(F.max("stamp").alias("s"))
    made = newest.where("s % 5 <> 0").select("k", "day", (c("s") - c("s") % 2).alias("stamp"), (c("s") % 3).alias("revision"))
    wanted = newest.select("k", "day", F.lit(1).cast("long").alias("revision"))
    return incremental.stale_days(wanted, h, made, ["k"], "day", 2).withColumn("day", b.text("day"))


@register("inc13_retro_backlog", "WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), s AS (SELECT user_id, unnest(generate_series(DATE '2024-01-01', DATE '2024-01-19', INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT user_id FROM d)) SELECT s.user_id, CAST(s.day AS VARCHAR) AS day FROM s ANTI JOIN d ON d.user_id = s.user_id AND d.day = s.day")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return incremental.missing_days(d, ["user_id"], "day", F.lit("2024-01-01").cast("date"), F.lit("2024-01-20").cast("date")).select("user_id", b.text("day").alias("day"))


@register("inc14_refresh_range", "WITH d AS (SELECT user_id, min(CAST(ts AS DATE)) FILTER (WHERE value > 150) AS first FROM events GROUP BY 1) SELECT user_id, CAST(least(coalesce(first, DATE '2024-01-05'), DATE '2024-01-05') AS VARCHAR) AS start FROM d")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "value")
    return incremental.refresh_start(d.where("value > 150"), d.select("user_id").distinct(), ["user_id"], "day", F.lit("2024-01-05").cast("date")).withColumn("start", b.text("start"))
