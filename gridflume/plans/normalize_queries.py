"""Queries of source normalising."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import normalize
from . import bindings as b
from .registry import register

c = F.col


@register("src01_normalize_forcing", """WITH r AS (SELECT l_orderkey AS cell, count(*) FILTER (WHERE l_linenumber % 3 = 1) AS matches, max(l_quantity) FILTER (WHERE l_linenumber % 3 = 1) AS t, max(l_tax) FILTER (WHERE l_linenumber % 3 = 1) AS q, max(l_extendedprice) FILTER (WHERE l_linenumber % 3 = 1) AS p FROM lineitem GROUP BY 1)
SELECT cell, matches, CASE WHEN matches = 1 THEN t END AS air_temperature, CASE WHEN matches = 1 THEN q END AS specific_humidity, CASE WHEN matches = 1 THEN p END AS precipitation_depth, 'grid_relative' AS wind_orientation FROM r""")
def _(spark, sf_dir):
    names = ["TMP_2maboveground", "SPFH_2maboveground", "PRES_surface", "DSWRF_surface", "DLWRF_surface", "UGRD_10maboveground", "VGRD_10maboveground", "APCP_surface"]
    given = ["l_quantity", "l_tax", "l_discount", "l_discount", "l_tax", "l_tax", "l_tax", "l_extendedprice"]
    stamp = F.timestamp_seconds(c("l_linenumber") % 3 * 3600)
    raw = b.table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("cell"), stamp.alias("time"), *(c(g).alias(n) for g, n in zip(given, names, strict=True)))
    out = normalize.forcing(raw, "hrrr", ["cell"], c("time"), F.timestamp_seconds(F.lit(3600)))
    return out.select("cell", "matches", "air_temperature", "specific_humidity", "precipitation_depth", "wind_orientation")


@register("src03_prism_daily_normalize", """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v, CASE o_orderkey % 5 WHEN 0 THEN 'ppt' WHEN 1 THEN 'tmin' WHEN 2 THEN 'tmax' WHEN 3 THEN 'tmean' ELSE 'vpd' END AS e FROM orders)
SELECT o_orderkey, CASE e WHEN 'ppt' THEN 'daily_precipitation_depth' WHEN 'tmin' THEN 'daily_minimum_temperature' WHEN 'tmax' THEN 'daily_maximum_temperature' WHEN 'tmean' THEN 'daily_midpoint_temperature' END AS name,
epoch(d + INTERVAL 12 HOUR)::BIGINT AS valid_time, epoch(d - INTERVAL 12 HOUR)::BIGINT AS period_start, epoch(d + INTERVAL 12 HOUR)::BIGINT AS period_end, CASE e WHEN 'ppt' THEN v WHEN 'vpd' THEN NULL ELSE v + 273.15 END AS value, CASE e WHEN 'ppt' THEN 'mm' WHEN 'vpd' THEN NULL ELSE 'K' END AS units FROM o""")
def _(spark, sf_dir):
    names = F.array(*(F.lit(x) for x in ("ppt", "tmin", "tmax", "tmean", "vpd")))
    o = b.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), names[(c("o_orderkey") % 5).cast("int")].alias("element"), "o_totalprice")
    out = normalize.daily_element(o, c("day"), c("element"), c("o_totalprice"))
    return out.select("o_orderkey", "name", *(b.seconds(t).alias(t) for t in ("valid_time", "period_start", "period_end")), "value", "units")


@register("src10_swe_normalize", """WITH e AS (SELECT user_id AS station_id, date_trunc('minute', ts) AS t, CASE WHEN event_id % 11 = 0 THEN '-9999' WHEN event_id % 13 = 0 THEN '--' WHEN event_id % 17 = 0 THEN '-2' ELSE CAST(event_id % 90 AS VARCHAR) END AS raw, CASE WHEN event_id % 23 = 0 THEN 'CFS' ELSE 'INCHES' END AS units FROM events),
k AS (SELECT *, station_id % 7 = 3 AS unasked FROM e), f AS (SELECT *, CASE WHEN unasked OR units <> 'INCHES' THEN 'identity' WHEN CAST(t AS DATE) NOT BETWEEN DATE '2024-01-03' AND DATE '2024-01-27' THEN 'outside' END AS fault FROM k),
s AS (SELECT * FROM f WHERE fault IS NOT NULL OR CAST(t AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25')
SELECT station_id, epoch(t + INTERVAL 8 HOUR)::BIGINT AS stamp_utc, min(raw) AS raw_value, coalesce(fault, CASE WHEN min(raw) <> max(raw) THEN 'conflict' END) AS fault,
CASE WHEN min(raw) IN ('-9999', '--') THEN NULL ELSE round(TRY_CAST(min(raw) AS DOUBLE) * 25.4 + 3.3e-9, 6) END AS swe_mm, CASE min(raw) WHEN '-9999' THEN 'missing_sentinel_-9999' WHEN '--' THEN 'missing_or_nonnumeric' WHEN '-2' THEN 'negative_swe' ELSE 'numeric' END AS value_status FROM s GROUP BY station_id, t, fault""")
def _(spark, sf_dir):
    k = c("event_id")
    e = b.table(spark, sf_dir, "events").select(
        c("user_id").alias("station_id"), F.lit(3).alias("sensor_number"), F.lit("H").alias("duration_code"), F.when(k % 23 == 0, "CFS").otherwise("INCHES").alias("units"),
        F.date_format(c("ts").cast("timestamp"), "yyyy-MM-dd HH:mm").alias("date"), F.lit(None).cast("string").alias("obs_date"),
        F.when(k % 11 == 0, "-9999").when(k % 13 == 0, "--").when(k % 17 == 0, "-2").otherwise((k % 90).cast("string")).alias("value"), F.lit(" ").alias("data_flag"),
    )
    tasks = e.where("station_id % 7 <> 3").select("station_id", "sensor_number", "duration_code").distinct()
    tasks = tasks.withColumns({"request_start": F.lit("2024-01-05").cast("date"), "request_end": F.lit("2024-01-25").cast("date")})
    return normalize.snow(e, tasks).select("station_id", b.seconds("stamp_utc").alias("stamp_utc"), "raw_value", b.rounded("swe_mm").alias("swe_mm"), "value_status", "fault")


@register("src13_usgs_inventory", """WITH o AS (SELECT *, 'USGS-' || o_custkey AS st FROM orders), s AS (SELECT o_orderkey AS id, st AS station, o_orderkey % 17 = 0 AS no_left, o_orderkey % 19 = 0 AS no_right, o_orderkey % 23 = 0 AS ignored, o_orderkey % 29 = 0 AS moved, o_orderstatus = 'P' AS other, o_orderpriority LIKE '1%' AS away FROM o)
SELECT id, CASE WHEN no_left AND moved THEN 'USGS-x' ELSE station END AS station, CASE WHEN no_right THEN 'combined_only' WHEN no_left THEN 'daily_only' WHEN ignored THEN 'filter_ignored' WHEN moved THEN 'mismatch' WHEN other THEN 'other_agency' WHEN away THEN 'outside' ELSE 'kept' END AS verdict FROM s WHERE NOT (no_left AND no_right)""")
def _(spark, sf_dir):
    k = c("o_orderkey")
    o = b.table(spark, sf_dir, "orders").select(
        k.alias("id"), F.concat(F.lit("USGS-"), c("o_custkey")).alias("station"), F.when(k % 23 == 0, "00065").otherwise("00060").alias("parameter"), F.lit("00003").alias("statistic"),
        F.lit("Daily values").alias("data_type"), F.when(c("o_orderstatus") == "P", "XX").otherwise("USGS").alias("agency"), F.lit("US").alias("country"), F.substring("o_orderpriority", 1, 1).alias("state"), F.lit("Daily").alias("period"),
    )
    daily = o.withColumn("station", F.when(c("id") % 29 == 0, "USGS-x").otherwise(c("station")))
    return normalize.discharge_inventory(o.where("id % 17 <> 0"), daily.where("id % 19 <> 0"), ["2", "3", "4", "5"])


@register("src13_gauge_stations", """WITH s AS (SELECT l_suppkey AS station, l_returnflag AS zone, CASE WHEN l_suppkey % 3 = 0 THEN 200.0 ELSE l_suppkey % 100 END::DOUBLE AS lon, (l_suppkey % 80)::DOUBLE AS lat FROM lineitem), g AS (SELECT station, min(zone) AS zone, min(zone) <> max(zone) AS conflict, any_value(lon) AS lon, any_value(lat) AS lat FROM s GROUP BY 1)
SELECT station, zone, conflict, CASE WHEN lon <= 180 THEN lon END AS longitude, CASE WHEN lon <= 180 THEN lat END AS latitude, lon > 180 AS coordinate_issue, zone <> 'A' AS time_zone_issue FROM g""")
def _(spark, sf_dir):
    k = c("l_suppkey")
    s = b.table(spark, sf_dir, "lineitem").select(k.alias("station"), c("l_returnflag").alias("zone"), F.when(k % 3 == 0, 200.0).otherwise((k % 100).cast("double")).alias("longitude"), (k % 80).cast("double").alias("latitude"))
    zones = s.where("zone = 'A'").select("zone", F.lit(-8).alias("offset"))
    return normalize.gauge_stations(s, zones).drop("offset")


_SENSORS = """s AS (SELECT o_custkey AS station_id, (CASE WHEN o_orderkey % 3 = 0 THEN 8 WHEN o_orderkey % 3 = 1 THEN 65 ELSE 3 END)::INTEGER AS sensor, CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'M' END AS duration, CASE WHEN o_orderkey % 10 = 7 THEN 'AF' WHEN o_orderkey % 3 = 2 THEN 'INCHES' ELSE 'CFS' END AS units, CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders)"""


def _stations(spark, sf_dir):
    k = c("o_orderkey")
    day = F.date_format("o_orderdate", "MM/dd/yyyy")
    s = b.table(spark, sf_dir, "orders").select(c("o_custkey").alias("station_id"), F.struct(
        F.when(k % 3 == 0, 8).when(k % 3 == 1, 65).otherwise(3).alias("sensor_number"), F.when(k % 2 == 0, "D").otherwise("M").alias("duration_code"),
        F.when(k % 10 == 7, "AF").when(k % 3 == 2, "INCHES").otherwise("CFS").alias("units"), F.concat(F.when(k % 5 == 0, "").otherwise(day), F.lit(" to present")).alias("advertised_availability"),
    ).alias("sensor"))
    return s.groupBy("station_id").agg(F.collect_list("sensor").alias("sensors"))


@register("src14_fnf_series_from_metadata", f"""WITH {_SENSORS}, p AS (SELECT * FROM (VALUES ('daily', 8, 'D'), ('monthly', 65, 'M')) v(resolution, sensor, duration)), w AS (SELECT * FROM (SELECT DISTINCT station_id FROM s), p), m AS (SELECT w.station_id, w.resolution, w.sensor, w.duration, count(s.station_id) AS n, min(units) AS units, min(CASE WHEN o_orderkey % 5 <> 0 THEN day END) AS day FROM w LEFT JOIN s ON s.station_id = w.station_id AND s.sensor = w.sensor AND s.duration = w.duration GROUP BY ALL)
SELECT station_id, resolution, sensor AS sensor_number, duration AS duration_code, CASE WHEN n = 1 THEN CAST(day AS VARCHAR) END AS start, CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'repeated' WHEN units <> 'CFS' THEN 'units' END AS fault FROM m WHERE NOT (n = 0 AND resolution = 'daily' AND station_id = 7)""")
def _(spark, sf_dir):
    out = normalize.flow_series(_stations(spark, sf_dir), [("daily", 8, "D", "CFS"), ("monthly", 65, "M", "CFS")], [(7, "daily")])
    return out.withColumn("start", b.text("start"))


@register("src15_swe_series_from_metadata", f"""WITH {_SENSORS}, x AS (SELECT *, count(*) OVER (PARTITION BY station_id, sensor, duration) AS n FROM s WHERE sensor IN (3, 82))
SELECT station_id, sensor AS sensor_number, duration AS duration_code, CASE WHEN duration = 'D' THEN 'daily' END AS resolution, CASE WHEN o_orderkey % 5 = 0 THEN '1800-01-01' ELSE CAST(day AS VARCHAR) END AS start, CASE WHEN o_orderkey % 5 = 0 THEN 'request_floor' ELSE 'provider' END AS start_source, CASE WHEN duration <> 'D' OR units <> 'INCHES' THEN 'unknown' WHEN n > 1 THEN 'repeated' END AS fault FROM x""")
def _(spark, sf_dir):
    return normalize.snow_series(_stations(spark, sf_dir), [3, 82], {"D": "daily"}).withColumn("start", b.text("start")).drop("advertised_end")


@register("src18_uscrn_hourly", """SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN CAST(l_suppkey AS VARCHAR) END AS station, CASE WHEN ok THEN epoch(CAST(l_shipdate AS DATE) + INTERVAL 1 HOUR * (l_linenumber % 24))::BIGINT END AS stamp, CASE WHEN ok AND l_quantity > 9 THEN l_quantity + 273.15 END AS temperature_k, CASE WHEN ok AND l_linenumber % 2 = 0 THEN l_partkey::DOUBLE END AS shortwave, CASE WHEN ok AND l_linenumber % 3 = 0 THEN l_quantity / 100 END AS relative_humidity, CASE WHEN NOT ok THEN 'columns' END AS fault FROM (SELECT *, l_orderkey % 16 <> 5 AS ok FROM lineitem)""")
def _(spark, sf_dir):
    n, q = c("l_linenumber"), c("l_quantity").cast("string")
    said = {0: b.text("l_suppkey"), 1: F.date_format("l_shipdate", "yyyyMMdd"), 2: (n % 24 * 100).cast("string"), 9: F.when(c("l_quantity") > 9, q).otherwise("-9999.0"), 13: b.text("l_partkey"), 14: (n % 2).cast("string"), 26: q, 27: (n % 3).cast("string")}
    line = F.concat(F.concat_ws("  ", *(said.get(k, F.lit("-1")) for k in range(37))), F.when(c("l_orderkey") % 16 != 5, "  U").otherwise(""))
    out = normalize.climate_station_hours(b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("value")))
    return out.select("l_orderkey", "l_linenumber", "station", b.seconds("stamp").alias("stamp"), "temperature_k", "shortwave", "relative_humidity", "fault")


@register("src26_granule_listing_check", """WITH o AS (SELECT o_orderkey // 2 * 2 + CASE WHEN o_orderkey % 40 = 1 THEN 0 ELSE o_orderkey % 2 END AS id, CAST(o_orderdate AS DATE) AS day, o_orderkey % 26 AS h, o_orderkey % 11 = 0 AS other, o_orderkey % 7 = 0 AS late, o_orderkey % 9 = 0 AS two, o_orderkey % 13 = 0 AS none FROM orders),
n AS (SELECT *, 'F.A' || strftime(day, '%Y%m%d') || '.' || lpad(CAST(h AS VARCHAR), 2, '0') || '00.nc' AS name FROM o), t AS (SELECT *, count(*) OVER (PARTITION BY id) AS ids, count(*) OVER (PARTITION BY name) AS names FROM n)
SELECT id, name, CASE WHEN h <= 23 THEN h END::INTEGER AS hour, CASE WHEN NOT none AND NOT two THEN 'https://data.example.org/a/' || name END AS address, CASE WHEN ids > 1 THEN 'repeated_id' WHEN other THEN 'collection' WHEN h > 23 THEN 'name' WHEN late THEN 'time' WHEN none OR two THEN 'address' WHEN names > 1 THEN 'repeated_name' END AS fault FROM t""")
def _(spark, sf_dir):
    k = c("o_orderkey")
    h, day = (k % 26).cast("int"), F.to_date("o_orderdate")
    name = F.concat(F.lit("F.A"), F.date_format(day, "yyyyMMdd"), F.lit("."), F.lpad(h.cast("string"), 2, "0"), F.lit("00.nc"))
    link = lambda folder, rel: F.struct(F.concat(F.lit(f"https://data.example.org/{folder}/"), name).alias("href"), F.lit(f"x/{rel}#").alias("rel"), F.lit(False).alias("inherited"))
    e = b.table(spark, sf_dir, "orders").select(
        (k - F.when(k % 40 == 1, 1).otherwise(0)).alias("id"), F.when(k % 11 == 0, "other").otherwise("ours").alias("collection"), name.alias("name"), day.alias("day"),
        (day.cast("timestamp") + F.make_interval(hours=h, mins=F.when(k % 7 == 0, 5).otherwise(0))).alias("time_start"),
        F.when(k % 13 == 0, F.array(link("a", "browse"))).when(k % 9 == 0, F.array(link("a", "data"), link("b", "data"))).otherwise(F.array(link("a", "data"), link("a", "data"), link("c", "browse"))).alias("links"),
    )
    return normalize.granules(e, c("day"), "F.A", ".nc", "ours", "data.example.org")
