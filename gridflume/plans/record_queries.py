"""Queries of providers' records, station pages, stacks of records and acceptance of streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, incremental, observations, temporal
from ..sources import catalogue, normalize, stations
from . import bindings as b
from .registry import register

c = F.col


_FLOW_SQL = """e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_id % 3 = 0 AS monthly, user_id % 7 = 3 AS unasked, CASE WHEN event_id % 41 = 0 THEN 'x' ELSE '' END AS bad,
 CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN ' m ' WHEN event_id % 43 = 0 THEN '-9999' WHEN event_id % 47 = 0 THEN 'inf' WHEN event_id % 53 = 0 THEN '-2' ELSE CAST(user_id % 90 AS VARCHAR) END AS raw FROM events),
p AS (SELECT user_id AS station_id, CASE WHEN monthly THEN date_trunc('month', d)::DATE ELSE d END AS d, monthly, raw, CASE WHEN unasked OR bad = 'x' THEN 'identity' WHEN CASE WHEN monthly THEN date_trunc('month', d)::DATE ELSE d END NOT BETWEEN DATE '2024-01-01' AND DATE '2024-01-25' THEN 'outside' END AS fault, unasked FROM e),
g AS (SELECT station_id, monthly, d, fault, unasked, CASE WHEN count(*) = count(raw) THEN min(raw) END AS raw_value, count(DISTINCT coalesce(raw, '?')) > 1 AS differs FROM p GROUP BY ALL)"""


@register("src09_natural_flow", f"""WITH {_FLOW_SQL}
SELECT station_id, CASE WHEN monthly THEN 'M' ELSE 'D' END AS duration_code, epoch(d + INTERVAL 8 HOUR)::BIGINT AS stamp_utc, raw_value, CASE WHEN raw_value IN ('-9999', ' m ', 'inf') OR unasked THEN NULL ELSE round(raw_value::DOUBLE * CASE WHEN monthly THEN 1233.48183754752 ELSE 0.028316846592 END + 3.3e-9, 4) END AS value_si,
 CASE WHEN raw_value IS NULL OR raw_value = ' m ' THEN 'missing' WHEN raw_value = '-9999' THEN 'missing_sentinel_-9999' WHEN raw_value = 'inf' THEN 'nonnumeric' WHEN raw_value = '-2' THEN 'negative' ELSE 'numeric' END AS value_status,
 CASE WHEN monthly THEN strftime(d, '%Y-%m') ELSE strftime(d, '%Y-%m-%d') END AS period_label, coalesce(fault, CASE WHEN differs THEN 'conflict' END) AS fault FROM g""")
def _(spark, sf_dir):
    k, monthly = c("event_id"), c("event_id") % 3 == 0
    day = F.when(monthly, F.trunc("ts", "month")).otherwise(F.to_date("ts"))
    rows = b.table(spark, sf_dir, "events").select(
        c("user_id").cast("string").alias("station_id"), F.when(monthly, 65).otherwise(8).alias("sensor_number"), F.when(monthly, "M").otherwise("D").alias("duration_code"),
        F.when(k % 41 == 0, "TAF").when(monthly, "AF").otherwise("CFS").alias("units"), F.concat(day.cast("string"), F.lit(" 00:00")).alias("date"), F.lit(None).cast("string").alias("obs_date"),
        F.when(k % 31 == 0, None).when(k % 37 == 0, " m ").when(k % 43 == 0, "-9999").when(k % 47 == 0, "inf").when(k % 53 == 0, "-2").otherwise((c("user_id") % 90).cast("string")).alias("value"), F.lit(" ").alias("data_flag"),
    )
    tasks = rows.where("cast(station_id as int) % 7 <> 3").select("station_id").distinct().select("station_id", F.explode(F.array(F.lit("daily"), F.lit("monthly"))).alias("resolution"))
    tasks = tasks.withColumns({"request_start": F.lit("2024-01-01").cast("date"), "request_end": F.lit("2024-01-25").cast("date")})
    out = normalize.natural_flow(rows, tasks).withColumn("station_id", c("station_id").cast("long"))
    return out.select("station_id", "duration_code", b.seconds("stamp_utc").alias("stamp_utc"), "raw_value", b.rounded("value_si", 4).alias("value_si"), "value_status", "period_label", "fault")


def _pages(spark, sf_dir):
    """Orders as daily discharge, in pages of ten order keys; some pages and features are wrong."""
    def feature(o):
        k = o["k"]
        properties = F.struct(
            F.concat(F.lit("S-"), o["station"]).alias("monitoring_location_id"), F.concat(F.lit("T-"), o["station"], F.lit("-"), k % 2).alias("time_series_id"), F.when(k % 61 == 0, "00065").otherwise("00060").alias("parameter_code"),
            F.lit("00003").alias("statistic_id"), o["day"].cast("string").alias("time"), F.when(k % 23 == 0, "Ice").when(k % 29 == 0, "-5").otherwise((k % 500).cast("string")).alias("value"),
            F.lit("ft^3/s").alias("unit_of_measure"), F.when(o["status"] == "F", "Approved").otherwise("Provisional").alias("approval_status"),
            F.when(k % 19 == 0, F.array(F.lit("e"), F.lit("Rejected"))).when(k % 17 == 0, F.array(F.lit("ESTIMATED"))).alias("qualifier"), F.lit(None).cast("string").alias("last_modified"),
        )
        return F.struct(F.when(k % 71 == 0, "").when(k % 73 == 0, "same").otherwise(F.concat(F.lit("f"), k)).alias("id"), properties.alias("properties"))

    # pages gather what their features are made from, a tenth of the features themselves
    one = F.struct(c("o_orderkey").alias("k"), c("o_custkey").alias("station"), F.to_date("o_orderdate").alias("day"), c("o_orderstatus").alias("status"))
    pages = b.table(spark, sf_dir, "orders").groupBy(F.floor(c("o_orderkey") / 10).alias("page")).agg(F.collect_list(one).alias("_orders"))  # ten orders at most
    kind, said = F.when(c("page") % 13 == 0, "Error").otherwise("FeatureCollection").alias("type"), (F.size("_orders") + F.when(c("page") % 11 == 0, 1).otherwise(0)).alias("numberReturned")
    return pages.select("page", F.to_json(F.struct(kind, said, F.array_sort(F.transform("_orders", feature)).alias("features"))).alias("text"))


@register("src12_paged_feature_faults", """WITH p AS (SELECT o_orderkey // 10 AS page, o_orderkey AS k, CASE WHEN o_orderkey % 71 = 0 THEN '' WHEN o_orderkey % 73 = 0 THEN 'same' ELSE 'f' || o_orderkey END AS id FROM orders)
SELECT DISTINCT page, NULL::VARCHAR AS id, CASE WHEN page % 13 = 0 THEN 'invalid' ELSE 'count' END AS fault FROM p WHERE page % 13 = 0 OR page % 11 = 0
UNION ALL SELECT page, id, 'missing_id' FROM p WHERE id = '' UNION ALL SELECT NULL, id, 'repeated_id' FROM p WHERE id <> '' GROUP BY id HAVING count(*) > 1""")
def _(spark, sf_dir):
    return normalize.paged_features(_pages(spark, sf_dir), "page", "text")[1]


_DISCHARGE_SQL = """d AS (SELECT o_custkey AS station, 'S-' || o_custkey AS monitoring_location_id, 'T-' || o_custkey || '-' || o_orderkey % 2 AS time_series_id, CAST(o_orderdate AS DATE) AS day, o_orderkey AS k, o_orderkey % 19 = 0 AS withdrawn, o_orderkey % 19 <> 0 AND o_orderkey % 17 = 0 AS estimated, o_orderstatus = 'F' AS approved,
 CASE WHEN o_orderkey % 71 = 0 THEN '' WHEN o_orderkey % 73 = 0 THEN 'same' ELSE 'f' || o_orderkey END AS observation_id, CASE WHEN o_orderkey % 23 = 0 THEN 'Ice' WHEN o_orderkey % 29 = 0 THEN '-5' ELSE (o_orderkey % 500)::VARCHAR END AS raw,
 CASE WHEN o_custkey % 10 = 9 OR o_orderkey % 61 = 0 THEN 'identity' WHEN CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1995-06-01' AND DATE '2001-01-31' THEN 'outside' END AS f FROM orders),
n AS (SELECT *, CASE WHEN raw = 'Ice' OR withdrawn THEN NULL ELSE raw::DOUBLE END AS cfs, CASE WHEN raw = 'Ice' THEN 'missing_or_nonnumeric' WHEN withdrawn THEN 'explicit_invalid_qualifier' WHEN raw = '-5' THEN 'numeric_negative' ELSE 'numeric' END AS status FROM d),
r AS (SELECT any_value(station) AS station, monitoring_location_id, time_series_id, day, count(*) AS rows, f, min((observation_id, raw, k)) AS first FROM n GROUP BY monitoring_location_id, time_series_id, day, f),
s AS (SELECT r.station, r.monitoring_location_id, r.time_series_id, r.day, rows, n.cfs, n.status, n.approved, n.estimated, n.withdrawn, n.k, coalesce(r.f, CASE WHEN rows > 1 THEN 'repeated' END) AS fault FROM r JOIN n ON n.k = r.first[3])"""


def _discharge(spark, sf_dir):
    features, _ = normalize.paged_features(_pages(spark, sf_dir), "page", "text")
    o = b.table(spark, sf_dir, "orders").where("o_custkey % 10 <> 9")
    series = o.select(F.concat(F.lit("S-"), c("o_custkey")).alias("monitoring_location_id"), F.concat(F.lit("T-"), c("o_custkey"), F.lit("-"), c("o_orderkey") % 2).alias("time_series_id")).distinct()
    return normalize.daily_discharge(features, series, F.lit("1995-06-01").cast("date"), F.lit("2001-01-31").cast("date")), series


@register("src11_daily_discharge", f"WITH {_DISCHARGE_SQL} SELECT monitoring_location_id, time_series_id, day::VARCHAR AS day, rows, round(cfs * 0.028316846592 + 3.3e-9, 6) AS discharge_m3_s, status AS value_status, fault FROM s")
def _(spark, sf_dir):
    out, _ = _discharge(spark, sf_dir)
    return out.select("monitoring_location_id", "time_series_id", b.text("day").alias("day"), "rows", b.rounded("discharge_m3_s").alias("discharge_m3_s"), "value_status", "fault")


def _records(spark, sf_dir):
    """Discharge without faults, and its series; those of odd keys are primary where the station's number divides by 3."""
    out, series = _discharge(spark, sf_dir)
    records = out.where("fault is null").select(c("monitoring_location_id").alias("station"), c("time_series_id").alias("series"), "day", c("discharge_cfs").alias("discharge"), c("approval_status").alias("approval"), "qualifier", "value_status")
    number = F.split("monitoring_location_id", "-")[1].cast("int")
    known = series.select(c("monitoring_location_id").alias("station"), c("time_series_id").alias("series"), ((number % 3 == 0) & c("time_series_id").endswith("-1")).alias("primary"))
    return records, known


_REPORT_SQL = f"""{_DISCHARGE_SQL}, g AS (SELECT * FROM s WHERE fault IS NULL), k0 AS (SELECT DISTINCT station, monitoring_location_id, time_series_id FROM d WHERE station % 10 <> 9), k AS (SELECT *, station % 3 = 0 AND time_series_id LIKE '%-1' AS prim, bool_or(station % 3 = 0 AND time_series_id LIKE '%-1') OVER (PARTITION BY station) AS any_prim FROM k0),
y AS (SELECT g.station, day, count(DISTINCT cfs) > 1 AS conflict, count(DISTINCT cfs) = 1 AS valid, bool_or(cfs IS NOT NULL AND approved) AS approved, bool_or(cfs IS NOT NULL AND estimated) AS estimated FROM g JOIN k USING (station, time_series_id) WHERE prim OR NOT any_prim GROUP BY g.station, day),
v AS (SELECT *, lag(day) OVER (PARTITION BY station ORDER BY day) AS b FROM y WHERE valid), t AS (SELECT station, min(day) AS a, max(day) AS z, count(*) AS n, max(day - coalesce(b, DATE '1995-05-31') - 1) AS inner_gap, max(coalesce(day - b - 1, 0)) AS own_gap, count(DISTINCT year(day)) AS years FROM v GROUP BY 1),
a AS (SELECT station, year(day) AS year, count(*) AS n FROM v GROUP BY ALL), fy AS (SELECT a.station, count(*) AS full_years FROM a JOIN t USING (station) WHERE make_date(year, 1, 1) >= t.a AND make_date(year, 12, 31) <= t.z AND a.n >= 0.9 * (make_date(year, 12, 31) - make_date(year, 1, 1) + 1) GROUP BY 1)"""


@register("obs03_discharge_report", f"""WITH {_REPORT_SQL}, q AS (SELECT monitoring_location_id AS station, any_value(station) AS nr, bool_or(any_prim) AS p FROM k GROUP BY 1), rr AS (SELECT station, count(*) AS rows, count(DISTINCT time_series_id) AS sr, count(*) FILTER (WHERE cfs < 0) AS neg FROM g GROUP BY 1),
yy AS (SELECT station, count(*) FILTER (WHERE conflict) AS conflicts, count(*) FILTER (WHERE valid AND approved) AS ap, count(*) FILTER (WHERE valid AND estimated) AS es FROM y GROUP BY 1)
SELECT q.station, CASE WHEN p THEN 'primary_only' ELSE 'nonprimary_no_primary_metadata' END AS policy, coalesce(rows, 0) AS rows, coalesce(sr, 0) AS series_returned, coalesce(neg, 0) AS negative_rows, coalesce(conflicts, 0) AS conflicts, coalesce(ap, 0) AS approved_days, coalesce(es, 0) AS estimated_days, t.a::VARCHAR AS first_day, t.z::VARCHAR AS last_day,
 t.z - t.a + 1 AS observed_expected_days, t.n AS observed_valid_days, round(t.n / (t.z - t.a + 1) + 3.3e-9, 6) AS observed_completeness, t.own_gap AS observed_longest_gap, DATE '2001-01-31' - DATE '1995-06-01' + 1 AS requested_expected_days, coalesce(t.n, 0) AS requested_valid_days,
 round(coalesce(t.n, 0) / (DATE '2001-01-31' - DATE '1995-06-01' + 1) + 3.3e-9, 6) AS requested_completeness, coalesce(greatest(inner_gap, DATE '2001-01-31' - t.z), DATE '2001-01-31' - DATE '1995-06-01' + 1) AS requested_longest_gap, coalesce(t.years, 0) AS years_with_data, coalesce(full_years, 0) AS full_years
 FROM q LEFT JOIN rr ON rr.station = q.nr LEFT JOIN yy ON yy.station = q.nr LEFT JOIN t ON t.station = q.nr LEFT JOIN fy ON fy.station = q.nr""")
def _(spark, sf_dir):
    records, series = _records(spark, sf_dir)
    out = observations.discharge_report(records, series, F.lit("1995-06-01").cast("date"), F.lit("2001-01-31").cast("date"))
    return out.withColumns({"first_day": b.text("first_day"), "last_day": b.text("last_day"), "observed_completeness": b.rounded("observed_completeness"), "requested_completeness": b.rounded("requested_completeness")})


@register("obs03_discharge_histogram", f"""WITH {_DISCHARGE_SQL}, g AS (SELECT * FROM s WHERE fault IS NULL)
SELECT monitoring_location_id AS station, 'value_status' AS "column", status AS value, count(*) AS rows FROM g GROUP BY ALL UNION ALL SELECT monitoring_location_id, 'qualifier', CASE WHEN withdrawn THEN '["e","Rejected"]' WHEN estimated THEN '["ESTIMATED"]' END, count(*) FROM g GROUP BY ALL""")
def _(spark, sf_dir):
    return observations.histogram(_records(spark, sf_dir)[0], ["station"], "value_status", "qualifier")


@register("obs01_period_report", """WITH r AS (SELECT o_custkey AS station, date_trunc('month', o_orderdate)::DATE AS period, CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice - 90000 END AS v FROM orders), a AS (SELECT station, unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH))::DATE AS period FROM (SELECT DISTINCT station FROM r)),
l AS (SELECT station, count(*) AS absent, min(period) AS x, max(period) AS y FROM a ANTI JOIN r USING (station, period) GROUP BY 1)
SELECT r.station, count(*) AS rows, count(v) AS numeric, count(*) - count(v) AS missing, count(*) FILTER (WHERE v < 0) AS negative, min(period)::VARCHAR AS first, max(period)::VARCHAR AS latest, max(period) FILTER (WHERE v IS NOT NULL)::VARCHAR AS latest_numeric, coalesce(any_value(absent), 0) AS absent, any_value(x)::VARCHAR AS absent_first, any_value(y)::VARCHAR AS absent_last FROM r LEFT JOIN l USING (station) GROUP BY r.station""")
def _(spark, sf_dir):
    r = b.table(spark, sf_dir, "orders").select(c("o_custkey").alias("station"), F.trunc("o_orderdate", "month").alias("period"), F.when(c("o_orderkey") % 9 != 0, c("o_totalprice") - 90000).alias("v"), F.lit(" ").alias("flag"))
    out = observations.period_report(r, ["station"], "period", "v", "flag", F.lit("1995-01-01").cast("date"), F.lit("2001-12-01").cast("date"), "1 MONTH")
    return out.drop("flags").withColumns({k: b.text(k) for k in ("first", "latest", "latest_numeric", "absent_first", "absent_last")})


_PAGE_SQL = """k AS (SELECT c_custkey AS id, c_name, c_mktsegment, n_name, c_acctbal, c_custkey % 13 = 0 AS lost, c_custkey % 17 = 0 AS moved, c_custkey % 19 = 0 AS bald FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _stations(spark, sf_dir):
    """Customers as station pages with entities, nested tags and comments; sensors are their orders' priorities."""
    k = c("c_custkey")
    o = b.table(spark, sf_dir, "orders").groupBy("o_custkey", F.substring("o_orderpriority", 1, 1).alias("p")).agg(F.count("*").alias("n"))
    row = F.concat(F.lit("<TR class='s'><td><b>FULL NATURAL FLOW</b> &#35;"), "p", F.lit(", MEAN, cfs</td><td>"), "p", F.lit("</td><td>(daily)</td><td><a href='/plot?id=1&amp;sensor_no="), b.text("n"), F.lit("'>plot</a></td><td>sat &gt; web</td><td>01/02/2000 to\n present</td></TR>"))
    sensors = o.groupBy(c("o_custkey").alias("c_custkey")).agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("s"))  # five priorities at most
    n = b.table(spark, sf_dir, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    cell = lambda a, v: F.concat(F.lit("<tr><td>"), F.lit(a), F.lit("</td><td class=\"v\">"), v, F.lit("</td></tr>"))
    fields = F.concat(
        cell("Station <i>ID</i>", F.when(k % 17 == 0, F.lit("none")).otherwise(b.text(k))), cell("Operator", F.concat("c_mktsegment", F.lit(" &amp;amp; <br>"), "n_name")), cell("Latitude", F.concat(b.text(F.floor("c_acctbal") / 100), F.lit("&deg;"))),
        cell("Longitude", F.concat(b.text(F.floor("c_acctbal") / -100), F.lit("&#xB0;"))), cell("County", F.lit("old")), cell("County", F.lit("R&#233;al&nbsp;&nbsp;&#8364;"))
    )
    page = F.concat(
        F.lit("<html><h2>Other</h2><!-- <h3> --><h2 id=x>"), "c_name", F.lit("</h2>"), F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("<TABLE id='tableInfo'>"), fields, F.lit("</TABLE>"))),
        F.lit("<table><tr><th>Sensor Description</th><th>Sensor Number</th></tr>"), F.coalesce("s", F.lit("")), F.when(k % 19 == 0, "<tr><td>short</td></tr>").otherwise(""), F.lit("</table><table><tr><td>01/02/2003</td><td>moved &lt;up&gt;</td></tr><tr><td>note</td><td>none</td></tr></table></html>"),
    )
    return b.table(spark, sf_dir, "customer").join(n, "c_nationkey").join(sensors, "c_custkey", "left").select(k.alias("id"), page.alias("html"))


@register("src16_station_pages", f"""WITH {_PAGE_SQL}, v AS (SELECT *, floor(c_acctbal) / 100 AS lat, floor(c_acctbal) / -100 AS lon FROM k)
SELECT id AS station_id, CASE WHEN NOT lost THEN c_name END AS station_name, CASE WHEN NOT lost THEN c_mktsegment || ' &amp; ' || n_name END AS operator, CASE WHEN NOT lost THEN 'Réal €' END AS county, CASE WHEN NOT lost AND lat BETWEEN -90 AND 90 THEN lat END AS latitude, CASE WHEN NOT lost AND lon BETWEEN -180 AND 180 THEN lon END AS longitude,
 '01/02/2003 moved <up>' AS notes, array_to_string(list_filter([CASE WHEN lost THEN 'no_table' END, CASE WHEN moved AND NOT lost THEN 'identity' END, CASE WHEN lost OR NOT lat BETWEEN -90 AND 90 THEN 'latitude' END, CASE WHEN lost OR NOT lon BETWEEN -180 AND 180 THEN 'longitude' END, CASE WHEN bald THEN 'sensor_row' END], lambda x: x IS NOT NULL), ',') AS faults FROM v""")
def _(spark, sf_dir):
    out = stations.station_pages(_stations(spark, sf_dir), "id", "html")
    field = lambda name: F.try_element_at("fields", F.lit(name))
    notes = F.array_join(F.transform("notes", lambda n: F.concat(n["date_raw"], F.lit(" "), n["text"])), ";")
    return out.select("station_id", "station_name", field("Operator").alias("operator"), field("County").alias("county"), "latitude", "longitude", notes.alias("notes"), F.array_join("faults", ",").alias("faults"))


@register("src16_station_sensors", """SELECT o_custkey AS station_id, substr(o_orderpriority, 1, 1)::INTEGER AS sensor_number, 'FULL NATURAL FLOW #' || substr(o_orderpriority, 1, 1) || ', MEAN' AS description, 'cfs' AS units, 'D' AS duration_code, 'sat > web' AS data_collection, '01/02/2000 to present' AS advertised_availability, count(*)::VARCHAR AS plot_sensor_id, true AS is_full_natural_flow
 FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""")
def _(spark, sf_dir):
    out = stations.station_pages(_stations(spark, sf_dir), "id", "html").select("station_id", F.explode("sensors").alias("s")).select("station_id", "s.*")
    return out.drop("duration")


_ISSUES = """list_filter([CASE WHEN g > 0 THEN 'grid' END, CASE WHEN hours <> 24 THEN 'hours' END, CASE WHEN x > 0 THEN 'revision' END, CASE WHEN NOT (ta >= 180 AND tz <= 340) THEN 't2d_range' END, CASE WHEN NOT (qa >= 0 AND qz <= 0.05) THEN 'q2d_range' END,
 CASE WHEN NOT (ua >= -150 AND uz <= 150) THEN 'u2d_range' END, CASE WHEN vn = 0 THEN 'v2d_empty' WHEN NOT (va >= -150 AND vz <= 150) THEN 'v2d_range' END, CASE WHEN m > 0 THEN 'masks' END], lambda y: y IS NOT NULL)"""
_STREAM_SQL = f"""r AS (SELECT event_id % 2 AS cell, date_trunc('hour', ts) AS stamp, avg(value) AS w, bool_or(event_id % 997 = 0) AS masked, bool_or(event_id % 1499 = 0) AS old FROM events GROUP BY ALL),
f AS (SELECT stamp, CAST(stamp AS DATE) AS day, 220 + w * 1.5 AS t2d, w / 2000 AS q2d, w - 50 AS u2d, CASE WHEN NOT masked THEN 50 - w END AS v2d, old FROM r),
h AS (SELECT day, stamp, count(*) AS n, count(*) - count(v2d) AS m, count(*) FILTER (WHERE old) AS x, min(t2d) AS ta, max(t2d) AS tz, min(q2d) AS qa, max(q2d) AS qz, min(u2d) AS ua, max(u2d) AS uz, min(v2d) AS va, max(v2d) AS vz, count(v2d) AS vn FROM f GROUP BY ALL),
d AS (SELECT day, count(*) AS hours, min(stamp) AS a, max(stamp) AS z, count(*) FILTER (WHERE n <> 2) AS g, sum(m) AS m, sum(x) AS x, min(ta) AS ta, max(tz) AS tz, min(qa) AS qa, max(qz) AS qz, min(ua) AS ua, max(uz) AS uz, min(va) AS va, max(vz) AS vz, sum(vn) AS vn FROM h GROUP BY ALL), i AS (SELECT *, {_ISSUES} AS issues FROM d)"""


@register("aud05_stream_acceptance", f"""WITH {_STREAM_SQL} SELECT day::VARCHAR AS day, hours, epoch(a)::BIGINT AS first, epoch(z)::BIGINT AS last, round(tz + 3.3e-9, 6) AS t2d_greatest, vn::BIGINT AS v2d_finite, array_to_string(issues, ',') AS issues, len(issues) = 0 AS accepted FROM i""")
def _(spark, sf_dir):
    out = _acceptance(spark, sf_dir)
    return out.select(b.text("day").alias("day"), "hours", b.seconds("first").alias("first"), b.seconds("last").alias("last"), b.rounded("t2d_greatest").alias("t2d_greatest"), "v2d_finite", F.array_join("issues", ",").alias("issues"), "accepted")


def _acceptance(spark, sf_dir):
    """A grid of two cells; now and then a wind has a mask of its own, or a cell comes of an old revision."""
    hour, k, w = F.date_trunc("hour", c("ts").cast("timestamp")), c("event_id"), c("w")
    r = b.table(spark, sf_dir, "events").groupBy((k % 2).alias("cell"), hour.alias("stamp")).agg(F.avg("value").alias("w"), F.bool_or(k % 997 == 0).alias("masked"), F.bool_or(k % 1499 == 0).alias("old"))
    f = r.select(F.to_date("stamp").alias("day"), "stamp", (220 + w * 1.5).alias("t2d"), (w / 2000).alias("q2d"), (w - 50).alias("u2d"), F.when(~c("masked"), 50 - w).alias("v2d"), F.when(c("old"), "r1").otherwise("r2").alias("revision"))
    return audit.daily_stream(f, [], "day", "stamp", {x: audit.LIMITS[x] for x in ("t2d", "q2d", "u2d", "v2d")}, 2, ("u2d", "v2d"), ("revision", "r2"))


@register("aud07_gate_reasons", f"""WITH {_STREAM_SQL}, u AS (SELECT date_trunc('month', day)::DATE::VARCHAR AS month, unnest(issues) AS issue FROM i) SELECT month, issue, count(*) AS reports FROM u GROUP BY ALL""")
def _(spark, sf_dir):
    return audit.validation_gate(_acceptance(spark, sf_dir).withColumn("month", b.text(F.trunc("day", "month"))), ["month"], "issues")[1]


@register("aud03_stream_inventory", """WITH f AS (SELECT o_orderpriority AS stream, CAST(o_orderdate AS DATE) AS p, o_orderkey % 37 = 0 AS part, o_orderkey AS k, (o_orderkey % 1000)::BIGINT AS s FROM orders), p AS (SELECT stream, p, count(*) AS n, sum(s) AS s FROM f WHERE NOT part AND p BETWEEN DATE '1996-03-01' AND DATE '1999-02-28' GROUP BY ALL), l AS (SELECT *, lag(p) OVER (PARTITION BY stream ORDER BY p) AS b FROM p),
a AS (SELECT stream, unnest(generate_series(DATE '1996-03-01', DATE '1999-02-28', INTERVAL 1 DAY))::DATE AS p FROM (SELECT DISTINCT stream FROM f)), m AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY p) AS k FROM a ANTI JOIN p USING (stream, p)), g AS (SELECT stream, count(*) AS missing, string_agg(p::VARCHAR, ',' ORDER BY p) FILTER (WHERE k <= 20) AS shown FROM m GROUP BY 1),
t AS (SELECT stream, count(*) FILTER (WHERE part) AS partial_files FROM f GROUP BY 1), z AS (SELECT stream, min(p)::VARCHAR AS first, max(p)::VARCHAR AS last, count(*) AS "unique", sum(n)::BIGINT AS files, count(*) FILTER (WHERE n > 1) AS duplicates, sum(s)::BIGINT AS bytes, count(*) FILTER (WHERE b IS NULL OR b + 1 <> p) AS segments FROM l GROUP BY 1)
SELECT stream, partial_files, first, last, coalesce("unique", 0) AS "unique", coalesce(files, 0) AS files, coalesce(duplicates, 0) AS duplicates, coalesce(bytes, 0) AS bytes, coalesce(segments, 0) AS segments, coalesce(missing, 0) AS missing, coalesce(shown, '') AS missing_shown, coalesce(missing, 0) > 20 AS missing_truncated FROM t LEFT JOIN z USING (stream) LEFT JOIN g USING (stream)""")
def _(spark, sf_dir):
    f = b.table(spark, sf_dir, "orders").select(c("o_orderpriority").alias("stream"), F.to_date("o_orderdate").alias("period"), (c("o_orderkey") % 37 == 0).alias("partial"), (c("o_orderkey") % 1000).alias("size"))
    out = audit.production_inventory(f, ["stream"], "period", "size", "partial", F.lit("1996-03-01").cast("date"), F.lit("1999-02-28").cast("date")).drop("undated_files")
    return out.withColumns({"first": b.text("first"), "last": b.text("last"), "missing_shown": F.array_join("missing_shown", ",")})


_STACK_SQL = """e AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN event_id % 301 = 0 THEN date_trunc('hour', ts) + INTERVAL 1 DAY ELSE date_trunc('hour', ts) END AS stamp, event_id % 2 AS place, value, event_id FROM events)"""


def _stack_input(spark, sf_dir):
    hour = F.date_trunc("hour", c("ts").cast("timestamp"))
    return b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), F.when(c("event_id") % 301 == 0, hour + F.expr("INTERVAL 1 DAY")).otherwise(hour).alias("stamp"), (c("event_id") % 2).alias("place"), "value", "event_id", (c("event_id") % 503 == 0).alias("fixed"))


@register("tmp09_stack_days", f"""WITH {_STACK_SQL}, h AS (SELECT day, stamp, count(DISTINCT place) AS n FROM e GROUP BY ALL), x AS (SELECT day, bool_or(k > 1) AS moved FROM (SELECT user_id, day, count(DISTINCT event_id % 503 = 0) AS k FROM e GROUP BY ALL) GROUP BY 1),
d AS (SELECT day, count(*) AS hours, bool_or(n > 1) AS r, bool_or(CAST(stamp AS DATE) <> day) AS o, epoch(max(stamp) - min(stamp)) / 3600 + 1 <> count(*) AS g FROM h GROUP BY 1)
SELECT day::VARCHAR AS day, hours, hours = 24 AND NOT (r OR o OR g OR moved) AS complete, array_to_string(list_filter([CASE WHEN r THEN 'repeated' END, CASE WHEN o THEN 'outside' END, CASE WHEN g THEN 'gap' END, CASE WHEN moved THEN 'static' END], lambda y: y IS NOT NULL), ',') AS faults FROM d JOIN x USING (day)""")
def _(spark, sf_dir):
    _, days = temporal.record_stack(_stack_input(spark, sf_dir), ["user_id"], "day", "stamp", "place", ["fixed"])
    return days.withColumns({"day": b.text("day"), "faults": F.array_join("faults", ",")})


@register("tmp09_stack_replaced", f"WITH {_STACK_SQL}, l AS (SELECT day, stamp, max(place) AS place FROM e GROUP BY ALL) SELECT user_id, day::VARCHAR AS day, epoch(stamp)::BIGINT AS stamp, place, event_id FROM e JOIN l USING (day, stamp, place)")
def _(spark, sf_dir):
    stack, _ = temporal.record_stack(_stack_input(spark, sf_dir), ["user_id"], "day", "stamp", "place", replace=True)
    return stack.select("user_id", b.text("day").alias("day"), b.seconds("stamp").alias("stamp"), "place", "event_id")


@register("tmp13_sequence_faults", """WITH r AS (SELECT event_type AS stream, date_trunc('hour', ts) AS stamp, CASE WHEN event_id % 151 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 3 <> 0 THEN value END AS v FROM events), h AS (SELECT stream, stamp, count(v) FILTER (WHERE NOT isnan(v)) AS n, count(v) FILTER (WHERE isnan(v)) AS bad FROM r GROUP BY ALL),
s AS (SELECT stream, unnest(generate_series(TIMESTAMP '2024-01-02 01:00:00', TIMESTAMP '2024-01-29 00:00:00', INTERVAL 1 HOUR)) AS stamp, true AS due FROM (SELECT DISTINCT stream FROM h)), j AS (SELECT stream, n, bad, due, n IS NOT NULL AS there FROM h FULL JOIN s USING (stream, stamp))
SELECT stream, count(*) FILTER (WHERE there) AS hours, count(*) FILTER (WHERE NOT there) AS missing, count(*) FILTER (WHERE due IS NULL) AS unexpected, count(*) FILTER (WHERE n = 0) AS empty, coalesce(sum(bad), 0)::BIGINT AS not_finite, bool_and(there AND due IS NOT NULL AND n > 0 AND bad = 0) AS accepted FROM j GROUP BY 1""")
def _(spark, sf_dir):
    k = c("event_id")
    r = b.table(spark, sf_dir, "events").select(c("event_type").alias("stream"), F.date_trunc("hour", c("ts").cast("timestamp")).alias("stamp"), F.when(k % 151 == 0, float("nan")).when(k % 3 != 0, c("value")).alias("v"))
    return temporal.sequence_faults(r, ["stream"], "stamp", "v", F.lit("2024-01-02 00:00:00").cast("timestamp"), F.lit("2024-01-29 00:00:00").cast("timestamp"))


@register("src21_hourly_statistic_checked", """WITH g AS (SELECT l_suppkey AS cell, l_partkey % 7 AS cycle, (l_orderkey % 3) * 2 AS s, (l_orderkey % 3) * 2 + l_linenumber % 4 AS lead, l_partkey, l_orderkey, l_linenumber, l_quantity * l_linenumber AS v FROM lineitem),
r AS (SELECT cell, cycle, s, lead, count(*) AS same, max(v) AS v FROM g GROUP BY ALL), p AS (SELECT *, lead - s AS n, lag(lead) OVER w AS b, lag(v) OVER w AS was, lag(same) OVER w AS times FROM r WINDOW w AS (PARTITION BY cell, cycle, s ORDER BY lead)),
h AS (SELECT *, CASE WHEN n = 1 THEN v ELSE v * n - was * (n - 1) END AS hour FROM p), f AS (SELECT *, CASE WHEN n <= 0 THEN 'interval' WHEN same > 1 THEN 'repeated' WHEN n <> 1 AND (b IS NULL OR b <> lead - 1) THEN 'no_previous' WHEN n <> 1 AND times > 1 THEN 'repeated' WHEN hour < -40 THEN 'negative' END AS fault FROM h)
SELECT cell, cycle, s, lead, same, fault, CASE WHEN fault IS NULL THEN greatest(hour, 0) END AS hour_value, fault IS NULL AND hour < 0 AS clipped FROM f""")
def _(spark, sf_dir):
    s = c("l_orderkey") % 3 * 2
    g = b.table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("cell"), (c("l_partkey") % 7).alias("cycle"), s.alias("s"), (s + c("l_linenumber") % 4).alias("lead"), (c("l_quantity") * c("l_linenumber")).alias("v"))
    return normalize.hourly_leads(g, ["cycle", "cell"], "s", "lead", "v", True, 40.0).select("cell", "cycle", "s", "lead", "same", "fault", "hour_value", "clipped")


@register("src23_coverage_by_names", """WITH f AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'hourly' WHEN o_orderkey % 5 = 1 THEN 'daily' WHEN o_orderkey % 5 = 2 THEN 'bad' ELSE 'other' END AS kind, CAST(o_orderdate AS DATE) AS d, o_orderkey % 24 AS h FROM orders)
SELECT p.product, epoch(max(CASE kind WHEN 'hourly' THEN d + to_hours(h) WHEN 'daily' THEN d::TIMESTAMP END))::BIGINT AS latest, count(*) FILTER (WHERE kind IN ('hourly', 'daily')) AS files, count(*) FILTER (WHERE kind = 'bad') AS unread
 FROM (VALUES ('hourly'), ('daily'), ('none')) p(product) LEFT JOIN f ON f.kind = p.product OR (p.product = 'daily' AND f.kind = 'bad') GROUP BY 1""")
def _(spark, sf_dir):
    k, ymd = c("o_orderkey"), F.date_format("o_orderdate", "yyyyMMdd")
    name = F.when(k % 5 == 0, F.concat(F.lit("hour.A"), ymd, F.lit("."), F.lpad((k % 24).cast("string"), 2, "0"), F.lit("00.nc"))).when(k % 5 == 1, F.concat(F.lit("day_"), ymd, F.lit(".nc"))).when(k % 5 == 2, F.lit("day_20249999.nc")).otherwise(F.lit("readme"))
    files = b.table(spark, sf_dir, "orders").select(F.concat(F.lit("a/day_20990101.nc/"), name).alias("path"))
    out = catalogue.latest_coverage(files, "path", {"hourly": (r"[.]A([0-9]{8})[.]([0-9]{4})[.]", "yyyyMMddHHmm"), "daily": (r"^day_([0-9]{8})[.]nc$", "yyyyMMdd"), "none": (r"^never_([0-9]{4})$", "yyyy")})
    return out.withColumn("latest", b.seconds("latest"))


@register("obs07_request_windows", """WITH s AS (SELECT o_orderkey AS series, CASE o_orderkey % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'H' WHEN 2 THEN 'E' ELSE 'M' END AS duration_code, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) + (o_orderkey % 900)::INTEGER END AS e, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) + (o_orderkey % 1500)::INTEGER END AS k FROM orders),
w AS (SELECT series, duration_code, CASE WHEN duration_code = 'M' OR k IS NULL THEN a ELSE greatest(a, least(DATE '2001-06-30' - CASE WHEN duration_code = 'D' THEN 400 ELSE 7 END, k + 1)) END AS a, least(DATE '2001-06-30', coalesce(e, DATE '2001-06-30')) AS z, CASE WHEN duration_code <> 'M' AND k IS NULL THEN 'no_backfill' END AS fault FROM s),
y AS (SELECT *, unnest(CASE WHEN duration_code IN ('H', 'E') THEN generate_series(year(a), year(z)) ELSE [year(a)] END) AS y FROM w WHERE a <= z)
SELECT series, duration_code, (CASE WHEN y = year(a) THEN a ELSE make_date(y, 1, 1) END)::VARCHAR AS request_start, (CASE WHEN duration_code IN ('H', 'E') THEN least(z, make_date(y, 12, 31)) ELSE z END)::VARCHAR AS request_end, fault FROM y""")
def _(spark, sf_dir):
    k, d = c("o_orderkey"), F.to_date("o_orderdate")
    s = b.table(spark, sf_dir, "orders").select(
        k.alias("series"), F.when(k % 4 == 0, "D").when(k % 4 == 1, "H").when(k % 4 == 2, "E").otherwise("M").alias("duration_code"), d.alias("start"),
        F.when(k % 5 == 0, F.date_add(d, (k % 900).cast("int"))).alias("advertised_end"), F.when(k % 7 != 0, F.date_add(d, (k % 1500).cast("int"))).alias("checked_through"),
    )
    out = observations.request_windows(s, ["series"], F.lit("2001-06-30").cast("date"), update=True)
    return out.select("series", "duration_code", b.text("request_start").alias("request_start"), b.text("request_end").alias("request_end"), "fault")


@register("obs10_station_crosswalk", """WITH m AS (SELECT 10000000 + o_custkey AS g, o_custkey, min(o_orderkey)::VARCHAR AS f, count(*) AS n FROM orders WHERE o_orderkey % 40 < 2 AND o_orderkey % 11 <> 0 GROUP BY ALL), s AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_custkey % 13 <> 0 GROUP BY 1), d AS (SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS d FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
SELECT 'USGS-' || g AS station, CASE WHEN m.n > 1 THEN '' ELSE f END AS feature_id, coalesce(s.n, 0) AS series_count, coalesce(d, '') AS domains, CASE WHEN m.n > 1 THEN 'mapping' WHEN s.n IS NULL THEN 'no_series' END AS fault FROM customer JOIN m ON m.o_custkey = c_custkey LEFT JOIN s ON s.o_custkey = c_custkey LEFT JOIN d ON d.o_custkey = c_custkey""")
def _(spark, sf_dir):
    o, k, number = b.table(spark, sf_dir, "orders"), c("o_orderkey"), (c("o_custkey") + 10000000).cast("string")
    station = F.concat(F.lit("USGS-"), number)
    mapping = o.where("o_orderkey % 40 < 2").select(F.concat(F.when(k % 11 == 0, "X").otherwise(" "), number).alias("gauge"), k.alias("feature_id"))
    stations_ = b.table(spark, sf_dir, "customer").select(F.concat(F.lit("USGS-"), (c("c_custkey") + 10000000).cast("string")).alias("station"))
    out = observations.gauge_crosswalk(mapping, stations_, o.where("o_custkey % 13 <> 0").select(station.alias("station"), c("o_orderpriority").alias("series")), o.where("o_orderstatus <> 'O'").select(c("o_orderstatus").alias("domain"), station.alias("station")))
    return out.withColumns({"domains": F.array_join("domains", ","), "feature_id": F.when(c("fault").eqNullSafe(F.lit("mapping")), "").otherwise(c("feature_id"))})


@register("inc16_checkpoint_before", """WITH a AS (SELECT event_id, user_id, CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 4 = 0 THEN ts - INTERVAL 60 HOUR ELSE ts END AS p, ts FROM events WHERE event_type <> 'signup'), q AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(ts - INTERVAL 24 HOUR, p) END AS bound FROM a), k AS (SELECT user_id, ts AS stamp FROM events WHERE event_type = 'signup')
SELECT event_id, epoch(date_trunc('second', k.stamp))::BIGINT AS latest FROM q ASOF LEFT JOIN k ON q.user_id = k.user_id AND q.bound >= k.stamp""")
def _(spark, sf_dir):
    e, k = b.table(spark, sf_dir, "events").withColumn("ts", c("ts").cast("timestamp")), c("event_id")
    asked = e.where("event_type <> 'signup'").withColumn("p", F.when(k % 10 == 3, None).when(k % 4 == 0, c("ts") - F.expr("INTERVAL 60 HOURS")).otherwise(c("ts")))
    out = incremental.checkpoint_before(asked.select("event_id", "user_id", "ts", "p"), e.where("event_type = 'signup'").select("user_id", c("ts").alias("stamp")), ["user_id"], "ts", "stamp", "24 HOURS", "p")
    return out.select("event_id", b.seconds("latest").alias("latest"))


@register("inc18_expired_entries", """WITH e AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 5000 AS s FROM orders), m AS (SELECT *, d < DATE '1997-06-15' AS old FROM e), r AS (SELECT *, row_number() OVER w AS n, sum(s) OVER w AS b FROM m WINDOW w AS (PARTITION BY o_custkey, old ORDER BY d DESC, s ROWS UNBOUNDED PRECEDING))
SELECT o_orderkey, CASE WHEN old THEN 'age' WHEN n > 6 THEN 'entries' ELSE 'bytes' END AS reason FROM r WHERE old OR n > 6 OR b > 9000""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").cast("timestamp").alias("stamp"), (c("o_orderkey") % 5000).alias("size"))
    return incremental.expired(e, ["o_custkey"], "stamp", F.lit("2000-03-11").cast("timestamp"), "size", 6, 9000, 1000).select("o_orderkey", "reason")
