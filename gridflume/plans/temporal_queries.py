"""Queries of the temporal, completeness and observation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, observations, temporal
from . import bindings as b
from .registry import register

_DAILY = f"""h AS ({b.HOURLY}), d AS (SELECT *, CAST(hour_end - INTERVAL 1 HOUR AS DATE) AS day FROM h)"""


@register("tmp01_model_interval_daily", f"""WITH {_DAILY}
SELECT station, CAST(day AS VARCHAR) AS day, count(DISTINCT hour_end) AS sample_count,
 round(CASE WHEN count(*) = 24 THEN avg(value) END + 3.3e-9, 6) AS value_mean, round(CASE WHEN count(*) = 24 THEN min(value) END + 3.3e-9, 6) AS value_minimum,
 round(CASE WHEN count(*) = 24 THEN max(value) END + 3.3e-9, 6) AS value_maximum, round(CASE WHEN count(*) = 24 THEN arg_min(value, hour_end) END + 3.3e-9, 6) AS value_first,
 round(CASE WHEN count(*) = 24 THEN arg_max(value, hour_end) END + 3.3e-9, 6) AS value_last, round(CASE WHEN count(*) = 24 THEN sum(value) * 3600 END + 3.3e-9, 3) AS value_integral
FROM d GROUP BY station, day""")
def _(spark, sf_dir):
    how = ["mean", "minimum", "maximum", "first", "last", "integral"]
    out = temporal.interval_daily(b.hourly(spark, sf_dir), ["station"], "hour_end", {"value": how})
    return out.select("station", b.text("day").alias("day"), "sample_count", *[b.rounded(f"value_{h}", 3 if h == "integral" else 6).alias(f"value_{h}") for h in how])


@register("tmp02_monthly_from_daily", f"""WITH {_DAILY}, s AS (SELECT station, day, sum(value) AS total, count(*) AS hours FROM d GROUP BY ALL)
SELECT station, CAST(date_trunc('month', day) AS DATE)::VARCHAR AS month, count(*) AS day_count, sum(hours)::BIGINT AS sample_count, round(sum(total) / sum(hours) + 3.3e-9, 6) AS mean_value FROM s GROUP BY ALL""")
def _(spark, sf_dir):
    days = temporal_days(spark, sf_dir)
    out = temporal.monthly_from_daily(days, ["station"], "day", "total", "hours")
    return out.select("station", b.text("month").alias("month"), "day_count", "sample_count", b.rounded("mean_value").alias("mean_value"))


def temporal_days(spark, sf_dir):
    h = b.hourly(spark, sf_dir)
    return h.groupBy("station", temporal.endpoint_day(F.col("hour_end")).alias("day")).agg(F.sum("value").alias("total"), F.count("*").alias("hours"))


@register("tmp03_monthly_mean_of_daily_extrema", f"""WITH {_DAILY}, s AS (SELECT station, day, min(value) AS lo, max(value) AS hi FROM d GROUP BY ALL)
SELECT station, CAST(date_trunc('month', day) AS DATE)::VARCHAR AS month, round(avg(lo) + 3.3e-9, 6) AS mean_minimum, round(avg(hi) + 3.3e-9, 6) AS mean_maximum FROM s GROUP BY ALL""")
def _(spark, sf_dir):
    out = temporal.monthly_mean_extrema(b.hourly(spark, sf_dir), ["station"], "hour_end", "value")
    return out.select("station", b.text("month").alias("month"), b.rounded("mean_minimum").alias("mean_minimum"), b.rounded("mean_maximum").alias("mean_maximum"))


@register("tmp04_periods", """WITH s AS (SELECT c_mktsegment AS kind, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT kind, CAST(unnest(generate_series(CAST(date_trunc('month', a) AS DATE), CAST(date_trunc('month', z) AS DATE), INTERVAL 1 MONTH)) AS DATE)::VARCHAR AS period FROM s""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").join(b.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    s = o.groupBy(F.col("c_mktsegment").alias("kind")).agg(F.trunc(F.min("o_orderdate"), "month").alias("a"), F.trunc(F.max("o_orderdate"), "month").alias("z"))
    return temporal.spine(s, ["kind"], "a", "z", "1 MONTH", "period").select("kind", b.text("period").alias("period"))


@register("tmp05_expected_timestamps_check", f"""WITH h AS ({b.STATION_HOURS}), s AS (SELECT product, unnest(generate_series(min(hour_end), max(hour_end), INTERVAL 1 HOUR)) AS hour_end FROM h GROUP BY product)
SELECT product, epoch(hour_end)::BIGINT AS missing_hour FROM s ANTI JOIN h USING (product, hour_end)""")
def _(spark, sf_dir):
    h = b.station_hours(spark, sf_dir)
    s = temporal.spine(h.groupBy("product").agg(F.min("hour_end").alias("a"), F.max("hour_end").alias("z")), ["product"], "a", "z", "1 HOUR", "hour_end")
    return temporal.missing_stamps(h, s, ["product", "hour_end"]).select("product", b.seconds("hour_end").alias("missing_hour"))


@register("tmp06_summary_signature", f"""WITH h AS (SELECT l_suppkey AS station, sha256('{{"c0":"' || l_orderkey || '","c1":"' || l_linenumber || '"}}') AS h FROM lineitem)
SELECT station, {b.DIGEST} AS signature FROM h GROUP BY 1""")
def _(spark, sf_dir):
    return temporal.signature(b.table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"]).withColumnRenamed("l_suppkey", "station")


@register("tmp07_channel_daily", """SELECT l_suppkey AS feature_id, CAST(l_shipdate AS DATE)::VARCHAR AS day, count(*) AS records, round(avg(l_extendedprice) + 3.3e-9, 4) AS streamflow_mean, min(l_quantity) AS depth_minimum, max(l_quantity) AS depth_maximum,
 round(sum(l_tax) + 3.3e-9, 6) AS lateral_sum FROM lineitem GROUP BY ALL""")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("feature_id"), b.text(F.to_date("l_shipdate")).alias("day")).agg(
        F.count("*").alias("records"), b.rounded(temporal.reduced("l_extendedprice", "l_shipdate", "mean"), 4).alias("streamflow_mean"),
        temporal.reduced("l_quantity", "l_shipdate", "minimum").alias("depth_minimum"), temporal.reduced("l_quantity", "l_shipdate", "maximum").alias("depth_maximum"),
        b.rounded(temporal.reduced("l_tax", "l_shipdate", "sum")).alias("lateral_sum"),
    )


@register("tmp08_daily_vs_hourly_oracle", f"""WITH {_DAILY}, a AS (SELECT station, day, avg(value) AS m FROM d GROUP BY ALL), s AS (SELECT station, day, sum(value) AS t, count(*) AS n FROM d GROUP BY ALL)
SELECT station, count(*) AS days, sum(CASE WHEN abs(m - t / n) > 2e-5 THEN 1 ELSE 0 END)::BIGINT AS beyond_tolerance FROM a JOIN s USING (station, day) GROUP BY station""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir)
    a = h.groupBy("station", temporal.endpoint_day(F.col("hour_end")).alias("day")).agg(F.avg("value").alias("m"))
    both = a.join(temporal_days(spark, sf_dir), ["station", "day"])
    return both.groupBy("station").agg(F.count("*").alias("days"), F.count_if(F.abs(F.col("m") - F.col("total") / F.col("hours")) > 2e-5).alias("beyond_tolerance"))


@register("tmp09_record_stack", """SELECT user_id AS feature_id, epoch(date_trunc('hour', ts))::BIGINT AS hour, arg_max(value, event_id) AS value, count(*) AS inputs FROM events GROUP BY ALL""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").withColumn("hour", b.seconds(F.date_trunc("hour", F.col("ts").cast("timestamp"))))
    n = e.groupBy("user_id", "hour").agg(F.count("*").alias("inputs"))
    return temporal.latest_record(e, ["user_id", "hour"], [F.desc("event_id")]).join(n, ["user_id", "hour"]).select(F.col("user_id").alias("feature_id"), "hour", "value", "inputs")


@register("tmp10_calendar_rebucket", f"""WITH h AS ({b.HOURLY}) SELECT station, CAST(CAST(hour_end AS DATE) AS VARCHAR) AS day, count(*) AS hours, count(DISTINCT CAST(hour_end + INTERVAL 12 HOUR AS DATE)) AS windows,
 count(*) = 24 AND count(DISTINCT CAST(hour_end + INTERVAL 12 HOUR AS DATE)) = 2 AS accepted FROM h GROUP BY ALL""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir).withColumn("window", temporal.window_12z(F.col("hour_end")))
    out = h.groupBy("station", b.text(F.to_date("hour_end")).alias("day")).agg(F.count("*").alias("hours"), F.countDistinct("window").alias("windows"))
    return out.withColumn("accepted", (F.col("hours") == 24) & (F.col("windows") == 2))


@register("tmp11_window_assignment_12z", f"""WITH h AS ({b.HOURLY}) SELECT station, CAST(CAST(hour_end + INTERVAL 12 HOUR AS DATE) AS VARCHAR) AS window_day, count(*) AS hours, epoch(min(hour_end))::BIGINT AS first_hour, epoch(max(hour_end))::BIGINT AS last_hour FROM h GROUP BY ALL""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir)
    return h.groupBy("station", b.text(temporal.window_12z(F.col("hour_end"))).alias("window_day")).agg(F.count("*").alias("hours"), b.seconds(F.min("hour_end")).alias("first_hour"), b.seconds(F.max("hour_end")).alias("last_hour"))


@register("tmp12_running_accumulation_difference", """WITH s AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events)
SELECT user_id, event_id, round(CASE WHEN b IS NULL THEN NULL WHEN value < b THEN value ELSE value - b END + 3.3e-9, 6) AS increment FROM s""")
def _(spark, sf_dir):
    return temporal.counter_difference(b.table(spark, sf_dir, "events"), ["user_id"], "event_id", "value").select("user_id", "event_id", b.rounded("increment").alias("increment"))


@register("tmp13_hourly_record_validation", f"""WITH h AS ({b.STATION_HOURS}), w AS (SELECT *, hour_end - lag(hour_end) OVER (PARTITION BY product, station ORDER BY hour_end) AS g FROM h)
SELECT product, count(*) AS records, sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing, sum(CASE WHEN g > INTERVAL 1 HOUR THEN 1 ELSE 0 END)::BIGINT AS gaps FROM w GROUP BY product""")
def _(spark, sf_dir):
    from pyspark.sql import Window

    gap = b.seconds("hour_end") - F.lag(b.seconds("hour_end")).over(Window.partitionBy("product", "station").orderBy("hour_end"))
    h = b.station_hours(spark, sf_dir).withColumn("g", gap)
    return h.groupBy("product").agg(F.count("*").alias("records"), F.count_if(F.col("value").isNull()).alias("missing"), F.count_if(F.col("g") > 3600).alias("gaps"))


@register("aud01_completeness", f"""WITH h AS ({b.HOURLY}), s AS (SELECT station, unnest(generate_series(min(hour_end), max(hour_end), INTERVAL 1 HOUR)) AS hour_end FROM h GROUP BY station)
SELECT s.station, CAST(CAST(s.hour_end AS DATE) AS VARCHAR) AS day, count(*) AS expected, count(h.n) AS present, count(*) - count(h.n) AS missing FROM s LEFT JOIN h ON s.station = h.station AND s.hour_end = h.hour_end GROUP BY ALL""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir)
    s = temporal.spine(h.groupBy("station").agg(F.min("hour_end").alias("a"), F.max("hour_end").alias("z")), ["station"], "a", "z", "1 HOUR", "hour_end")
    return audit.completeness(h, s, ["station"], "hour_end").withColumn("day", b.text("day"))


@register("aud02_coverage_segments", """WITH d AS (SELECT DISTINCT user_id AS station, CAST(ts AS DATE) AS day FROM events), s AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY station ORDER BY day) AS INTEGER) AS i FROM d)
SELECT station, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS days FROM s GROUP BY station, i""")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "events").select(F.col("user_id").alias("station"), F.to_date("ts").alias("day"))
    return temporal.segments(d, ["station"], "day").select("station", b.text("first_day").alias("first_day"), b.text("last_day").alias("last_day"), "days")


@register("aud03_production_inventory", """SELECT source, min(lang) AS first, max(lang) AS last, count(DISTINCT lang) AS unique, count(*) - count(DISTINCT lang) AS duplicates, sum(n_chars)::BIGINT AS bytes FROM documents GROUP BY source""")
def _(spark, sf_dir):
    return audit.inventory(b.table(spark, sf_dir, "documents"), ["source"], "lang", "n_chars")


_FIELDS = "CASE WHEN event_id % 17 <> 0 THEN 240 + value / 4 END AS t2d, value / 8000 AS q2d, 70000 + value * 200 AS psfc, value * 4 AS swdown"


@register("aud05_validate_daily_stream", f"""WITH f AS (SELECT event_type AS station, {_FIELDS} FROM events), l AS (
 SELECT station, 't2d' AS field, t2d AS v, 180.0 AS lo, 340.0 AS hi FROM f UNION ALL SELECT station, 'q2d', q2d, 0, 0.05 FROM f UNION ALL SELECT station, 'psfc', psfc, 20000, 120000 FROM f UNION ALL SELECT station, 'swdown', swdown, 0, 1400 FROM f)
SELECT station, field, count(v) AS finite, count(*) - count(v) AS missing, round(min(v) + 3.3e-9, 6) AS least, round(max(v) + 3.3e-9, 6) AS greatest, sum(CASE WHEN v < lo OR v > hi THEN 1 ELSE 0 END)::BIGINT AS violations FROM l GROUP BY ALL""")
def _(spark, sf_dir):
    v = F.col("value")
    f = b.table(spark, sf_dir, "events").select(F.col("event_type").alias("station"), F.when(F.col("event_id") % 17 != 0, 240 + v / 4).alias("t2d"), (v / 8000).alias("q2d"), (70000 + v * 200).alias("psfc"), (v * 4).alias("swdown"))
    out = audit.limits_report(f, ["station"], {k: audit.LIMITS[k] for k in ("t2d", "q2d", "psfc", "swdown")})
    return out.withColumns({"least": b.rounded("least"), "greatest": b.rounded("greatest")})


@register("aud07_validation_ledger", f"""WITH {_DAILY}, r AS (SELECT station, day, count(*) = 24 AS accepted FROM d GROUP BY ALL)
SELECT station, count(*) AS days, sum(CASE WHEN accepted THEN 1 ELSE 0 END)::BIGINT AS accepted_days, bool_and(accepted) AS gate FROM r GROUP BY station""")
def _(spark, sf_dir):
    r = temporal_days(spark, sf_dir).withColumn("accepted", F.col("hours") == 24)
    return r.groupBy("station").agg(F.count("*").alias("days"), F.count_if("accepted").alias("accepted_days"), F.bool_and("accepted").alias("gate"))


_REVISED = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1.5 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 13 <> 0"


@register("aud09_revision_diff", f"""WITH r AS ({_REVISED}), j AS (SELECT o.o_totalprice AS l, r.o_totalprice AS r FROM orders o FULL JOIN r USING (o_orderkey))
SELECT 'o_totalprice' AS field, sum(CASE WHEN (l IS NULL) <> (r IS NULL) THEN 1 ELSE 0 END)::BIGINT AS mask_changed, sum(CASE WHEN l <> r THEN 1 ELSE 0 END)::BIGINT AS value_changed, round(coalesce(max(abs(l - r)), 0) + 3.3e-9, 6) AS largest_difference FROM j""")
def _(spark, sf_dir):
    o, k = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), F.col("o_orderkey")
    r = o.where(k % 13 != 0).withColumn("o_totalprice", F.when(k % 11 == 0, None).when(k % 7 == 0, F.col("o_totalprice") + 1.5).otherwise(F.col("o_totalprice")))
    return audit.revision_diff(o, r, ["o_orderkey"], ["o_totalprice"]).withColumn("largest_difference", b.rounded("largest_difference"))


@register("aud11_realtime_availability", """WITH d AS (SELECT user_id AS station, CAST(ts AS DATE) AS day, count(DISTINCT date_trunc('hour', ts)) AS n FROM events GROUP BY ALL), m AS (SELECT max(day) AS today FROM d)
SELECT station, day::VARCHAR AS day, 24 - n AS missing, CASE WHEN n = 24 THEN 'complete' WHEN today - day <= 2 THEN 'recent_pending' WHEN today - day <= 6 THEN 'incomplete' ELSE 'at_risk' END AS state FROM d, m""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events")
    d = e.groupBy(F.col("user_id").alias("station"), F.to_date("ts").alias("day")).agg(F.countDistinct(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("n"))
    today = F.broadcast(e.agg(F.to_date(F.max("ts")).alias("today")))  # one row
    missing = 24 - F.col("n")
    return d.crossJoin(today).select("station", b.text("day").alias("day"), missing.alias("missing"), audit.availability_state(missing, F.datediff("today", "day")).alias("state"))


@register("aud17_replacement_eligibility", """SELECT o_orderkey, array_to_string(list_filter([CASE WHEN NOT o_totalprice > 50000 THEN 'total' END, CASE WHEN NOT o_orderstatus = 'F' THEN 'status' END], lambda x: x IS NOT NULL), ',') AS failed,
 o_totalprice > 50000 AND o_orderstatus = 'F' AS eligible FROM orders""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    return audit.failed_checks(o, {"total": F.col("o_totalprice") > 50000, "status": F.col("o_orderstatus") == "F"}).select("o_orderkey", "failed", "eligible")


@register("aud19_archive_audit", """WITH s AS (SELECT conv_id, turn AS a, turn + 1 AS z FROM conversations), w AS (SELECT *, lag(z) OVER (PARTITION BY conv_id ORDER BY a) AS p FROM s)
SELECT conv_id, count(*) AS segments, sum(CASE WHEN p IS NULL OR p = a THEN 1 ELSE 0 END)::BIGINT AS chained FROM w GROUP BY conv_id""")
def _(spark, sf_dir):
    s = b.table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("a"), (F.col("turn") + 1).alias("z"))
    return audit.chained(s, ["conv_id"], "a", "z").groupBy("conv_id").agg(F.count("*").alias("segments"), F.count_if("chained").alias("chained"))


@register("obs01_series_summary", """WITH r AS (SELECT user_id AS station, ts, CASE WHEN event_id % 9 <> 0 THEN value - 50 END AS v, CASE WHEN event_id % 5 = 0 THEN event_type ELSE ' ' END AS flag FROM events)
SELECT station, count(*) AS rows, count(v) AS numeric, count(*) - count(v) AS missing, sum(CASE WHEN v < 0 THEN 1 ELSE 0 END)::BIGINT AS negative, epoch(date_trunc('second', min(ts)))::BIGINT AS first, epoch(date_trunc('second', max(ts)))::BIGINT AS latest,
 coalesce(array_to_string(list_sort(list_distinct(list(flag) FILTER (trim(flag) <> ''))), ','), '') AS flags FROM r GROUP BY station""")
def _(spark, sf_dir):
    k = F.col("event_id")
    r = b.table(spark, sf_dir, "events").select(F.col("user_id").alias("station"), F.col("ts").cast("timestamp").alias("ts"), F.when(k % 9 != 0, F.col("value") - 50).alias("v"), F.when(k % 5 == 0, F.col("event_type")).otherwise(" ").alias("flag"))
    return observations.series_summary(r, ["station"], "ts", "v", "flag").withColumns({"first": b.seconds("first"), "latest": b.seconds("latest")})


@register("obs02_span_metrics", """WITH d AS (SELECT DISTINCT user_id AS station, CAST(ts AS DATE) AS day FROM events), g AS (SELECT *, coalesce(day - lag(day) OVER (PARTITION BY station ORDER BY day) - 1, 0) AS g FROM d)
SELECT station, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS valid_days, max(g)::INTEGER AS longest_gap, (max(day) - min(day) + 1)::INTEGER AS expected_days, round(count(*) / (max(day) - min(day) + 1) + 3.3e-9, 6) AS completeness FROM g GROUP BY station""")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "events").select(F.col("user_id").alias("station"), F.to_date("ts").alias("day"))
    out = observations.span_metrics(d, ["station"], "day")
    return out.withColumns({"first_day": b.text("first_day"), "last_day": b.text("last_day"), "completeness": b.rounded("completeness")})


@register("obs03_discharge_diagnostics", """WITH d AS (SELECT o_custkey AS station, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_totalprice) AS k, min(o_totalprice) AS v, bool_or(o_orderstatus = 'F') AS approved FROM orders GROUP BY ALL)
SELECT station, count(*) AS days, sum(CASE WHEN k > 1 THEN 1 ELSE 0 END)::BIGINT AS conflicting, sum(CASE WHEN k = 1 AND approved THEN 1 ELSE 0 END)::BIGINT AS approved_days, count(DISTINCT CASE WHEN k = 1 THEN year(day) END) AS years FROM d GROUP BY station""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    d = o.groupBy(F.col("o_custkey").alias("station"), F.to_date("o_orderdate").alias("day")).agg(F.countDistinct("o_totalprice").alias("k"), F.bool_or(F.col("o_orderstatus") == "F").alias("approved"))
    one = F.col("k") == 1
    return d.groupBy("station").agg(F.count("*").alias("days"), F.count_if(~one).alias("conflicting"), F.count_if(one & F.col("approved")).alias("approved_days"), F.countDistinct(F.when(one, F.year("day"))).alias("years"))


@register("obs04_annual_completeness", """WITH d AS (SELECT DISTINCT o_custkey AS station, CAST(o_orderdate AS DATE) AS day FROM orders), s AS (SELECT station, min(day) AS a, max(day) AS z FROM d GROUP BY station),
y AS (SELECT station, year(day) AS year, count(*) AS valid_days FROM d GROUP BY ALL), e AS (SELECT *, (least(make_date(year, 12, 31), z) - greatest(make_date(year, 1, 1), a) + 1)::INTEGER AS expected_days FROM y JOIN s USING (station))
SELECT station, year::INTEGER AS year, valid_days, expected_days, round(valid_days / expected_days + 3.3e-9, 6) AS completeness FROM e""")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station"), F.to_date("o_orderdate").alias("day"))
    return observations.annual_completeness(d, ["station"], "day").withColumn("completeness", b.rounded("completeness"))


@register("obs06_record_period_filter", """WITH s AS (SELECT o_custkey AS station, bool_or(CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) >= DATE '2000-01-01' ELSE false END) AS active, bool_or(o_orderstatus = 'O') AS unknown_end FROM orders GROUP BY 1)
SELECT c_custkey AS station, active, unknown_end FROM customer JOIN s ON c_custkey = station WHERE active OR unknown_end""")
def _(spark, sf_dir):
    stations = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station"))
    series = b.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station"), F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate")).alias("end"))
    return observations.active_since(stations, series, "station", "end", F.lit("2000-01-01").cast("date")).select("station", "active", "unknown_end")


@register("obs08_raw_vs_published_audit", """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders), p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT 'raw' AS side, o_orderkey FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM p) UNION ALL SELECT 'published', o_orderkey FROM (SELECT * FROM p EXCEPT ALL SELECT * FROM a)""")
def _(spark, sf_dir):
    a = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    p = a.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 29 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    side = lambda x, y, name: x.exceptAll(y).select(F.lit(name).alias("side"), "o_orderkey")
    return side(a, p, "raw").unionByName(side(p, a, "published"))


@register("obs10_gauge_crosswalk", """SELECT c_custkey AS station, c_nationkey AS domain, count(o_orderkey) AS series FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE regexp_full_match(substr(c_name, 10), '[0-9]+') GROUP BY ALL HAVING count(o_orderkey) > 0""")
def _(spark, sf_dir):
    c = b.table(spark, sf_dir, "customer").where(F.substring("c_name", 10, 100).rlike("^[0-9]+$"))
    n = b.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("series"))
    return c.join(n, "c_custkey").select(F.col("c_custkey").alias("station"), F.col("c_nationkey").alias("domain"), "series")
