"""Queries that run a streaming job over all of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..checkpoints import new_path
from ..streaming import jobs, publishing
from . import bindings as b
from .registry import register


def _events(spark, sf_dir):
    schema = b.table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@register("inc21_stream_endpoint_day", """WITH t AS (SELECT *, ts - INTERVAL 1 MICROSECOND AS m FROM events), w AS (SELECT max(m) - INTERVAL 2 HOUR AS mark FROM t)
SELECT event_type, CAST(CAST(m AS DATE) AS VARCHAR) AS day, count(value) AS samples, round(sum(value) + 3.3e-9, 4) AS total, min(value) AS least, max(value) AS greatest FROM t, w GROUP BY event_type, CAST(m AS DATE), mark HAVING CAST(m AS DATE) + INTERVAL 1 DAY <= mark""")
def _(spark, sf_dir):
    out = jobs.finished(spark, jobs.endpoint_days(_events(spark, sf_dir), "event_type", "ts", "value"), "endpoint_days")
    return out.select("event_type", b.text("day").alias("day"), "samples", b.rounded("total", 4).alias("total"), "least", "greatest")


@register("inc20_stream_dedupe", "SELECT user_id, event_type, epoch(date_trunc('hour', ts))::BIGINT AS hour FROM events GROUP BY ALL")
def _(spark, sf_dir):
    hours = _events(spark, sf_dir).select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"))
    out = jobs.finished(spark, jobs.deduplicated(hours, ["user_id", "event_type", "hour"], "hour", "60 days"), "dedupe")
    return out.select("user_id", "event_type", b.seconds("hour").alias("hour"))


@register("inc20_stream_dedupe_latest", """WITH h AS (SELECT user_id, event_type, date_trunc('hour', ts) AS hour, event_id, value FROM events), w AS (SELECT max(hour) - INTERVAL 2 DAY AS mark FROM h)
SELECT user_id, event_type, epoch(hour)::BIGINT AS hour, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM h, w WHERE hour <= mark GROUP BY ALL""")
def _(spark, sf_dir):
    hours = _events(spark, sf_dir).select("user_id", "event_type", F.date_trunc("hour", "ts").alias("hour"), "event_id", "value")
    out = jobs.finished(spark, jobs.latest(hours, ["user_id", "event_type"], "hour", "event_id", ["value"], "2 days"), "latest")
    return out.select("user_id", "event_type", b.seconds("hour").alias("hour"), "event_id", "value")


@register("inc22_stream_six_hour_block", """WITH t AS (SELECT *, ts - INTERVAL 1 MICROSECOND AS m FROM events), w AS (SELECT least(max(m), max(time_bucket(INTERVAL 6 HOUR, m) + INTERVAL 6 HOUR - INTERVAL 1 MICROSECOND) FILTER (event_id % 40 = 0)) - INTERVAL 6 HOUR AS mark FROM t),
x AS (SELECT event_type, time_bucket(INTERVAL 6 HOUR, m) + INTERVAL 6 HOUR AS block_end, sum(value) AS total, count(value) AS samples FROM t GROUP BY 1, 2), k AS (SELECT event_type, time_bucket(INTERVAL 6 HOUR, m) + INTERVAL 6 HOUR AS block_end, event_id AS notice, value * 20 AS constraint_total FROM t WHERE event_id % 40 = 0)
SELECT event_type, epoch(block_end)::BIGINT AS block_end, round(total + 3.3e-9, 4) AS total, samples, notice, round(constraint_total + 3.3e-9, 4) AS constraint_total FROM x JOIN k USING (event_type, block_end), w WHERE block_end - INTERVAL 1 MICROSECOND < mark""")
def _(spark, sf_dir):
    end = F.window(F.col("ts") - F.expr("INTERVAL 1 MICROSECOND"), "6 hours")["end"]
    notices = _events(spark, sf_dir).where("event_id % 40 = 0").select("event_type", end.alias("block_end"), F.col("event_id").alias("notice"), (F.col("value") * 20).alias("constraint_total"))
    out = jobs.finished(spark, jobs.six_hour_blocks(_events(spark, sf_dir), notices, "event_type", "ts", "value"), "six_hour_blocks")
    return out.select("event_type", b.seconds("block_end").alias("block_end"), b.rounded("total", 4).alias("total"), "samples", "notice", b.rounded("constraint_total", 4).alias("constraint_total"))


@register("inc23_late_data_policy", """WITH n AS (SELECT *, event_id % 4 AS batch FROM events), f AS (SELECT batch, max(ts) AS newest FROM n GROUP BY 1), l AS (SELECT unnest([7, 215]) AS lookback), p AS (SELECT n.*, lookback, (SELECT max(newest) FROM f WHERE f.batch < n.batch) AS before FROM n, l)
SELECT lookback, batch, count(*) FILTER (before IS NULL OR ts >= before) AS on_time, count(*) FILTER (ts < before AND ts >= before - to_days(lookback)) AS late, count(*) FILTER (ts < before - to_days(lookback)) AS backlog,
round(coalesce(sum(value) FILTER (ts < before - to_days(lookback)), 0) + 3.3e-9, 3) AS backlog_value FROM p GROUP BY 1, 2""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    schema = "event_id long, ts timestamp, value double"

    def one(days: int):
        root = new_path(spark, "late_data")
        publishing.gathered(spark, root, [e.where(F.col("event_id") % 4 == k) for k in range(4)], publishing.route_late(root, "ts", f"{days} DAYS"))
        rows = publishing.routed_rows(spark, root, schema).where("kind = 'backlog'").groupBy("batch").agg(F.sum("value").alias("v"))
        counts = publishing.route_counts(spark, root).drop("newest").join(rows, "batch", "left")
        return counts.select(F.lit(days).alias("lookback"), "batch", "on_time", "late", "backlog", b.rounded(F.coalesce("v", F.lit(0.0)), 3).alias("backlog_value"))

    # realtime and climate lookbacks
    return one(7).unionByName(one(215))


@register("inc24_partial_day_extension", """WITH e AS (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, event_id, value, unnest(range(4)) AS as_of FROM events), r AS (SELECT * FROM e WHERE hour < (dayofyear(day) * 7 + as_of * 11) % 25 AND (as_of <> 2 OR dayofyear(day) % 3 > 0)),
k AS (SELECT day, as_of, count(DISTINCT hour) AS hours, max(hour) AS last, dayofyear(day) % 5 = 0 AND as_of = 1 AS constrained, count(*) AS rows, sum(value) AS total FROM r GROUP BY day, as_of), g AS (SELECT * FROM k WHERE last = hours - 1)
SELECT CAST(day AS VARCHAR) AS day, m.as_of AS as_of, m.hours AS hours, m.hours = 24 AS complete, m.constrained AS constrained, m.rows AS rows, round(m.total + 3.3e-9, 3) AS total FROM (SELECT day, list_reduce(list({'constrained': constrained, 'hours': hours, 'as_of': as_of, 'rows': rows, 'total': total} ORDER BY as_of), lambda old, new: CASE WHEN new.hours >= old.hours AND (new.constrained OR NOT old.constrained) THEN new ELSE old END) AS m FROM g GROUP BY day)""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), "event_id", "value")
    n = F.dayofyear("day")

    def arrival(k: int):
        rows = e.where(F.col("hour") < (n * 7 + k * 11) % 25)
        rows = rows.where(n % 3 > 0) if k == 2 else rows
        return rows.select("day", F.lit(k).cast("long").alias("as_of"), "hour", "event_id", "value", (n % 5 == 0).alias("constrained") if k == 1 else F.lit(False).alias("constrained"))

    root = new_path(spark, "days")
    publishing.gathered(spark, root, [arrival(k) for k in range(4)], publishing.extend_days(root))
    days = publishing.published_days(spark, root, "day date, as_of long, hour int, event_id long, value double, constrained boolean")
    out = days.groupBy("day", "as_of", "complete", "constrained").agg(F.count_distinct("hour").alias("hours"), F.count("*").alias("rows"), b.rounded(F.sum("value"), 3).alias("total"))
    return out.withColumn("day", b.text("day"))


@register("snk08_receipts", """WITH o AS (SELECT o_orderstatus AS publication, o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 5 > 0 THEN o_orderpriority END AS p FROM orders)
SELECT publication, publication || ',orders' AS inputs, count(*) AS rows, count(*) FILTER (p IS NULL) AS missing, sum(('0x' || md5(o_orderkey || '|' || o_custkey || '|' || coalesce(p, '~'))[1:15])::BIGINT)::VARCHAR AS digest,
CASE WHEN count(*) < 100 THEN 'refused' WHEN count(*) FILTER (p IS NULL) > 0 THEN 'incomplete' ELSE 'passed' END AS status FROM o GROUP BY publication""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    o = o.select("o_orderstatus", "o_orderkey", "o_custkey", F.when((F.col("o_orderstatus") != "P") | (F.col("o_orderkey") % 5 > 0), F.col("o_orderpriority")).alias("priority"))
    root = new_path(spark, "receipts")
    for status in "FOP":
        publishing.publish(o.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), root, status, ["orders", status], ["o_orderkey", "o_custkey", "priority"], 100)
    return publishing.receipts(spark, root).where("rows > 0").withColumn("inputs", F.array_join("inputs", ","))
