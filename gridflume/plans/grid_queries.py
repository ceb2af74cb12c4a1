"""Queries of the physics, regridding, composition, reconciliation, evaluation, mask and network operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import physics as ph
from ..operators import composite, evaluate, fill, network, reconcile, regrid
from ..checkpoints import checkpointed
from . import bindings as b
from .registry import register

_ES = "CASE WHEN t >= 273.15 THEN 611.2 * exp(17.67 * (t - 273.15) / (t - 273.15 + 243.5)) ELSE 611.15 * exp(22.452 * (t - 273.15) / (t - 273.15 + 272.55)) END"
_EPS = "(287.05 / 461.5)"
_VP = f"(q * p / ({_EPS} + (1 - {_EPS}) * q))"
_EM = "1.08 * (1 - exp(-pow({q} * {p} / 62.2, {t} / 2016.0)))"


def _physics(name: str, sql: str, column, digits: int = 6):
    @register(name, f"WITH s AS ({b.STATE}) SELECT id, round({sql} + 3.3e-9, {digits}) AS result FROM s")
    def query(spark, sf_dir):
        return b.state(spark, sf_dir).select("id", b.rounded(column(), digits).alias("result"))

    return query


c = F.col
_physics("phy01_temperature_at_elevation", "t - 0.0065 * (z1 - z0)", lambda: ph.temperature_at_elevation(c("t"), c("z0"), c("z1")))
_physics("phy02_pressure_at_elevation", "p * pow((t - 0.0065 * (z1 - z0)) / t, -9.80665 / (287.05 * -0.0065))", lambda: ph.pressure_at_elevation(c("p"), c("t"), c("z0"), c("z1")), 4)
_physics("phy03_saturation_vapor_pressure", _ES, lambda: ph.saturation_vapor_pressure(c("t")))
_physics("phy04_vapor_pressure_from_q", _VP, lambda: ph.vapor_pressure(c("q"), c("p")))
_physics("phy05_q_from_vapor_pressure", f"{_EPS} * {_VP} / (p - (1 - {_EPS}) * {_VP})", lambda: ph.humidity_from_vapor_pressure(ph.vapor_pressure(c("q"), c("p")), c("p")))
_physics("phy06_rh_from_q", f"{_VP} / ({_ES})", lambda: ph.relative_humidity(c("q"), c("t"), c("p")))
_physics("phy07_q_from_rh", f"{_EPS} * (0.5 * {_ES}) / (p - (1 - {_EPS}) * (0.5 * {_ES}))".replace("0.5 * CASE", "0.5 * (CASE").replace("END)", "END))"), lambda: ph.humidity_from_relative(F.lit(0.5), c("t"), c("p")))
_physics("phy08_cosgrove_emissivity", _EM.format(q="q", p="p", t="t"), lambda: ph.emissivity(c("t"), c("q"), c("p")))
_physics("phy09_longwave_at_target", f"lw * ({_EM.format(q='q', p='p', t='(t + 5)')}) * pow(t + 5, 4) / (({_EM.format(q='q', p='p', t='t')}) * pow(t, 4))", lambda: ph.longwave_at_target(c("lw"), c("t"), c("q"), c("p"), c("t") + 5, c("q"), c("p")))
_physics("phy10_rotate_grid_to_earth", "u * cos(radians(lat)) - v * sin(radians(lat)) + 1000 * (u * sin(radians(lat)) + v * cos(radians(lat)))", lambda: ph.rotated_wind(c("u"), c("v"), F.radians("lat"))[0] + 1000 * ph.rotated_wind(c("u"), c("v"), F.radians("lat"))[1])
_physics("phy11_lambert_grid_x_angle", f"-{math.sin(math.radians(38.5))!r} * radians(lon + 97.5)", lambda: ph.lambert_x_angle(c("lon"), -97.5, 38.5))
_N = math.sin(math.radians(38.5))
_F = math.cos(math.radians(38.5)) * math.tan(math.pi / 4 + math.radians(38.5) / 2) ** _N / _N
_physics("phy13_lambert_coordinates", f"{_F!r} / pow(tan({math.pi / 4!r} + radians(lat) / 2), {_N!r}) * sin({_N!r} * radians(lon + 97.5))", lambda: ph.lambert_coordinates(c("lat"), c("lon"), -97.5, 38.5)[0])
_physics("phy14_unit_sphere_xyz", "cos(radians(lat)) * cos(radians(lon)) + 10 * cos(radians(lat)) * sin(radians(lon)) + 100 * sin(radians(lat))", lambda: (lambda v: v[0] + 10 * v[1] + 100 * v[2])(ph.unit_sphere(c("lat"), c("lon"))))
_physics("phy15_wind_speed", "sqrt(u * u + v * v)", lambda: ph.wind_speed(c("u"), c("v")))
_SUN = """(229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)))"""
_DEC = """(0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g))"""


@register("phy12_cosine_solar_zenith", f"""WITH s AS ({b.STATE}), h AS (SELECT *, hour(ts) + minute(ts) / 60.0::DOUBLE + second(ts) / 3600.0::DOUBLE AS uh FROM s),
g AS (SELECT *, 2 * pi() / (CASE WHEN (year(ts) % 4 = 0 AND year(ts) % 100 <> 0) OR year(ts) % 400 = 0 THEN 366 ELSE 365 END) * (dayofyear(ts) - 1 + (uh - 12) / 24) AS g FROM h),
a AS (SELECT *, uh * 60 + {_SUN} + 4 * lon AS m FROM g), z AS (SELECT *, radians((m - 1440 * floor(m / 1440)) / 4 - 180) AS ha FROM a)
SELECT id, round(sin(radians(lat)) * sin({_DEC}) + cos(radians(lat)) * cos({_DEC}) * cos(ha) + 3.3e-9, 6) AS result FROM z""")
def _(spark, sf_dir):
    return b.state(spark, sf_dir).select("id", b.rounded(ph.solar_zenith_cosine(c("ts"), c("lat"), c("lon"))).alias("result"))


@register("rgd01_remap_apply", f"""WITH l AS ({b.LINKS}), v AS (SELECT p_partkey AS src, CASE WHEN p_size > 5 THEN p_retailprice END AS value FROM part)
SELECT dst, round(sum(weight * value) / nullif(sum(CASE WHEN value IS NOT NULL THEN weight END), 0) + 3.3e-9, 6) AS value FROM v JOIN l USING (src) GROUP BY dst""")
def _(spark, sf_dir):
    v = b.table(spark, sf_dir, "part").select(c("p_partkey").alias("src"), F.when(c("p_size") > 5, c("p_retailprice")).alias("value"))
    return regrid.remap(v, b.links(spark, sf_dir), ["value"]).select("dst", b.rounded("value").alias("value"))


@register("rgd02_backproject_ratio", f"""WITH l AS ({b.LINKS}), r AS (SELECT s_suppkey AS dst, 1 + s_acctbal / 20000 AS ratio FROM supplier WHERE s_suppkey % 3 = 0), m AS (SELECT src, sum(weight * ratio) / sum(weight) AS ratio FROM l JOIN r USING (dst) GROUP BY src)
SELECT p_partkey AS src, round(coalesce(ratio, 1.0) + 3.3e-9, 6) AS ratio FROM part LEFT JOIN m ON p_partkey = src""")
def _(spark, sf_dir):
    r = b.table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(c("s_suppkey").alias("dst"), (1 + c("s_acctbal") / 20000).alias("ratio"))
    s = b.table(spark, sf_dir, "part").select(c("p_partkey").alias("src"))
    return regrid.backproject(r, b.links(spark, sf_dir), s).select("src", b.rounded("ratio").alias("ratio"))


@register("rgd03_inactive_link_count", f"WITH l AS ({b.LINKS}) SELECT count(*) AS inactive_links FROM l WHERE src NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def _(spark, sf_dir):
    return regrid.inactive_links(b.links(spark, sf_dir), b.table(spark, sf_dir, "part").where("p_size > 10").select(c("p_partkey").alias("src")))


@register("rgd06_conservative_apply", f"""WITH l AS ({b.LINKS}), n AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY dst) AS w FROM l) SELECT dst, round(sum(w * p_retailprice) + 3.3e-9, 6) AS depth FROM n JOIN part ON src = p_partkey GROUP BY dst""")
def _(spark, sf_dir):
    v = b.table(spark, sf_dir, "part").select(c("p_partkey").alias("src"), c("p_retailprice").alias("depth"))
    return v.join(regrid.normalised(b.links(spark, sf_dir)), "src").groupBy("dst").agg(b.rounded(F.sum(c("weight") * c("depth"))).alias("depth"))


@register("rgd07_conservation_check", f"""WITH l AS ({b.LINKS}), n AS (SELECT dst, sum(w) AS t FROM (SELECT dst, weight / sum(weight) OVER (PARTITION BY dst) AS w FROM l) GROUP BY dst) SELECT count(*) AS targets, max(abs(t - 1)) <= 1e-6 AS conserved FROM n""")
def _(spark, sf_dir):
    return regrid.weight_error(regrid.normalised(b.links(spark, sf_dir))).select("targets", (c("largest_error") <= 1e-6).alias("conserved"))


@register("rgd04_bilinear_weights", f"""WITH g AS ({b.GRID}), p AS (SELECT user_id AS dst, 25.1 + (user_id % 97) * 0.1::DOUBLE AS lat, -124.0 + (user_id % 53)::DOUBLE AS lon FROM (SELECT DISTINCT user_id FROM events)),
f AS (SELECT dst, (lat - 25) / 0.5 AS fy, (lon + 125) / 0.5 AS fx FROM p), i AS (SELECT *, least(floor(fy), 98)::BIGINT AS y, least(floor(fx), 198)::BIGINT AS x FROM f WHERE fy BETWEEN 0 AND 99 AND fx BETWEEN 0 AND 199),
k AS (SELECT * FROM i, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(dy, dx))
SELECT dst, y + dy AS y, x + dx AS x, round((CASE WHEN dy = 1 THEN fy - y ELSE 1 - (fy - y) END) * (CASE WHEN dx = 1 THEN fx - x ELSE 1 - (fx - x) END) + 3.3e-9, 6) AS weight FROM k""")
def _(spark, sf_dir):
    k = c("user_id")
    p = b.table(spark, sf_dir, "events").select("user_id").distinct().select(k.alias("dst"), (25.1 + (k % 97) * 0.1).alias("lat"), (-124.0 + (k % 53)).alias("lon"))
    return regrid.bilinear_links(p, 25, -125, 0.5, 100, 200).withColumn("weight", b.rounded("weight"))


@register("rgd13_block_downsample", f"WITH g AS ({b.GRID}) SELECT y // 4 AS block_y, x // 4 AS block_x, max(value) AS block_max, round(avg(value) + 3.3e-9, 6) AS block_mean, count(*) AS cells FROM g GROUP BY 1, 2 HAVING count(*) = 16")
def _(spark, sf_dir):
    return regrid.downsample(b.grid(spark, sf_dir), "value", 4).withColumn("block_mean", b.rounded("block_mean"))


_PREFERENCE = ["click", "view", "purchase", "signup", "error"]


@register("sel01_select_hourly_source", f"""WITH h AS ({b.STATION_HOURS}), r AS (SELECT *, list_position({_PREFERENCE}, product) AS k, value >= 60 AS ok FROM h), m AS (SELECT *, min(CASE WHEN ok THEN k END) OVER (PARTITION BY station, hour_end) AS best FROM r)
SELECT station, epoch(hour_end)::BIGINT AS hour, max(CASE WHEN k = best THEN product END) AS selected, coalesce(array_to_string(list_sort(list_distinct(list(product) FILTER (NOT ok AND k < coalesce(best, 1000)))), ','), '') AS rejected, coalesce(any_value(best) > 1, false) AS fallback_used FROM m GROUP BY station, hour_end""")
def _(spark, sf_dir):
    h = b.station_hours(spark, sf_dir).withColumn("ok", c("value") >= 60)
    out = composite.select_source(h, ["station", "hour_end"], "product", "ok", _PREFERENCE)
    return out.select("station", b.seconds("hour_end").alias("hour"), "selected", F.array_join("rejected", ",").alias("rejected"), "fallback_used")


_CELLS_SQL = """SELECT l_orderkey AS k, l_linenumber AS ln, CASE WHEN l_quantity > 10 THEN l_quantity END AS pass2, CASE WHEN l_quantity % 3 = 0 THEN l_quantity + 1 END AS pass1, CASE WHEN l_quantity % 4 = 0 THEN l_extendedprice / 200 END AS archive,
 CASE WHEN l_quantity % 5 = 0 THEN l_quantity END AS realtime, CASE WHEN l_quantity % 7 <> 0 THEN l_quantity / 2 END AS land, CASE WHEN l_quantity < 45 THEN 1.0::DOUBLE END AS forecast, CASE WHEN l_linenumber <> 2 THEN l_discount * 10 END AS quality, l_returnflag = 'R' AS o, l_linestatus = 'F' AS e FROM lineitem"""


def _cells(spark, sf_dir):
    q = c("l_quantity")
    return b.table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("k"), c("l_linenumber").alias("ln"), F.when(q > 10, q).alias("pass2"), F.when(q % 3 == 0, q + 1).alias("pass1"), F.when(q % 4 == 0, c("l_extendedprice") / 200).alias("archive"),
        F.when(q % 5 == 0, q).alias("realtime"), F.when(q % 7 != 0, q / 2).alias("land"), F.when(q < 45, F.lit(1.0)).alias("forecast"), F.when(c("l_linenumber") != 2, c("l_discount") * 10).alias("quality"),
        (c("l_returnflag") == "R").alias("override"), (c("l_linestatus") == "F").alias("exclusion"),
    )


_SELECTED = f"""c AS ({_CELLS_SQL}), s AS (SELECT *, CASE WHEN o AND NOT e AND archive >= 0 THEN 13 WHEN o AND NOT e AND realtime >= 0 THEN 14 WHEN quality >= 0.5 AND pass2 >= 0 THEN 1 WHEN quality >= 0.5 AND pass1 >= 0 THEN 2 WHEN NOT e AND archive >= 0 THEN 3 WHEN NOT e AND realtime >= 0 THEN 4
 WHEN land >= 0 THEN 5 WHEN forecast >= 0 THEN 6 ELSE 0 END AS w FROM c), d AS (SELECT *, CASE w WHEN 13 THEN 3 WHEN 14 THEN 4 ELSE w END AS source_id, CASE w WHEN 13 THEN archive WHEN 14 THEN realtime WHEN 1 THEN pass2 WHEN 2 THEN pass1 WHEN 3 THEN archive WHEN 4 THEN realtime WHEN 5 THEN land WHEN 6 THEN forecast END AS depth,
 CASE w WHEN 13 THEN 0.85 WHEN 14 THEN 0.75 WHEN 1 THEN quality WHEN 2 THEN quality * 0.9 WHEN 3 THEN 0.8 WHEN 4 THEN 0.7 WHEN 5 THEN 0.4 WHEN 6 THEN 0.2 ELSE 0 END AS confidence FROM s)"""


@register("sel02_composite_precipitation", f"""WITH {_SELECTED} SELECT k, ln, round(depth + 3.3e-9, 6) AS depth, source_id::INTEGER AS source_id, round(confidence::DOUBLE + 3.3e-9, 6) AS confidence,
 (CASE WHEN quality < 0.5 THEN 1 ELSE 0 END + CASE WHEN source_id IN (3, 4) AND o THEN 2 ELSE 0 END + CASE WHEN source_id BETWEEN 3 AND 6 THEN 4 ELSE 0 END + CASE WHEN source_id = 0 THEN 8 ELSE 0 END + CASE WHEN depth > 300 THEN 32 ELSE 0 END
 + CASE WHEN e AND (archive >= 0 OR realtime >= 0) THEN 64 ELSE 0 END)::INTEGER AS qc FROM d""")
def _(spark, sf_dir):
    out = composite.composite(_cells(spark, sf_dir))
    return out.select("k", "ln", b.rounded("depth").alias("depth"), "source_id", b.rounded("confidence").alias("confidence"), "qc")


@register("sel04_source_runs", """WITH s AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM s)
SELECT user_id, run::BIGINT AS run, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS length FROM r GROUP BY ALL""")
def _(spark, sf_dir):
    from ..operators import temporal

    return temporal.runs(b.table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type")


@register("sel08_classify_hour", f"""WITH {_SELECTED}, g AS (SELECT k, list_sort(list_distinct(list(CASE WHEN source_id > 3 THEN 3 ELSE source_id END))) AS ids FROM d GROUP BY k)
SELECT k, CASE WHEN ids = [1] THEN 'land' WHEN ids = [1, 3] THEN 'hybrid' WHEN ids = [2] THEN 'forecast' ELSE 'mixed' END AS kind FROM g""")
def _(spark, sf_dir):
    d = composite.composite(_cells(spark, sf_dir)).withColumn("s", F.least("source_id", F.lit(3)))
    return composite.classify_hours(d, "k", "s")


@register("eva06_threshold_sweep", f"""WITH t AS (SELECT unnest([0.25, 0.5, 0.75]) AS threshold), c AS ({_CELLS_SQL}), s AS (SELECT threshold, CASE WHEN quality >= threshold AND pass2 >= 0 THEN pass2 WHEN quality >= threshold AND pass1 >= 0 THEN pass1 ELSE land END AS d FROM c, t)
SELECT threshold::DOUBLE AS threshold, count(d) AS composed, round(avg(d) + 3.3e-9, 6) AS mean_depth FROM s GROUP BY threshold""")
def _(spark, sf_dir):
    cells = _cells(spark, sf_dir).select("quality", "pass2", "pass1", "land").withColumn("threshold", F.explode(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    good = c("quality") >= c("threshold")
    d = F.when(good & (c("pass2") >= 0), c("pass2")).when(good & (c("pass1") >= 0), c("pass1")).otherwise(c("land"))
    return cells.groupBy("threshold").agg(F.count(d).alias("composed"), b.rounded(F.avg(d)).alias("mean_depth"))


_SIX = """h AS (SELECT l_suppkey AS cell, l_returnflag AS day, 1 + l_orderkey % 24 AS hour, sum(l_quantity) FILTER (WHERE NOT ((l_suppkey % 4 = 0 AND l_orderkey % 24 = 17) OR (l_suppkey % 6 = 1 AND l_orderkey % 24 = 2) OR (l_suppkey % 5 = 2 AND l_orderkey % 24 < 6))) AS depth FROM lineitem GROUP BY ALL),
t AS (SELECT *, CASE WHEN cell % 3 = 0 AND hour < 13 THEN NULL WHEN cell % 7 = 0 THEN 0.0::DOUBLE WHEN cell % 11 = 5 THEN -5.0 ELSE 100.0 + cell END AS total FROM h)"""


@register("rec01_six_hour_reconcile", f"""WITH {_SIX}, g AS (SELECT *, ceil(hour / 6)::BIGINT AS block FROM t), s AS (SELECT *, coalesce(sum(depth) OVER w, 0) AS sums, count(*) OVER w = 6 AND coalesce(total >= 0, false) AS held, hour = 6 * block AS ends FROM g WINDOW w AS (PARTITION BY cell, day, block)),
e AS (SELECT *, held AND total > 0 AND sums <= 0 AS even FROM s), d AS (SELECT *, CASE WHEN NOT held THEN depth WHEN total = 0 THEN 0 WHEN even THEN total / 6 ELSE depth * total / sums END AS share FROM e),
r AS (SELECT *, sum(CASE WHEN NOT ends THEN share END) OVER w AS five, count(CASE WHEN NOT ends AND share IS NULL THEN 1 END) OVER w AS gone FROM d WINDOW w AS (PARTITION BY cell, day, block))
SELECT cell, day, hour, block, round(CASE WHEN held AND ends THEN CASE WHEN gone = 0 THEN greatest(total - five, 0) END ELSE share END + 3.3e-9, 5) AS constrained, CASE WHEN held THEN 128 ELSE 0 END + CASE WHEN even THEN 256 ELSE 0 END AS flags,
CASE WHEN held THEN 7 END AS source_id, CASE WHEN held THEN 0.85::DOUBLE END AS confidence, NOT even AS timing FROM r""")
def _(spark, sf_dir):
    k, o = c("l_suppkey"), c("l_orderkey") % 24
    gone = ((k % 4 == 0) & (o == 17)) | ((k % 6 == 1) & (o == 2)) | ((k % 5 == 2) & (o < 6))
    h = b.table(spark, sf_dir, "lineitem").groupBy(k.alias("cell"), c("l_returnflag").alias("day"), (1 + o).alias("hour")).agg(F.sum(F.when(~gone, c("l_quantity"))).alias("depth"))
    k = c("cell")
    h = h.withColumn("total", F.when((k % 3 == 0) & (c("hour") < 13), None).when(k % 7 == 0, 0.0).when(k % 11 == 5, -5.0).otherwise(100.0 + k))
    return reconcile.six_hour(h, ["cell", "day"]).select("cell", "day", "hour", "block", b.rounded("constrained", 5).alias("constrained"), "flags", "source_id", "confidence", "timing")


@register("rec04_adjust_temperature_range", f"""WITH h AS ({b.HOURLY}), d AS (SELECT *, CAST(hour_end + INTERVAL 12 HOUR AS DATE) AS day FROM h), w AS (SELECT *, min(value) OVER g AS lo, max(value) OVER g AS hi FROM d WINDOW g AS (PARTITION BY station, day))
SELECT station, epoch(hour_end)::BIGINT AS hour, round(40 + (CASE WHEN hi - lo < 0.5 THEN 1.0 ELSE greatest(least(60 / (hi - lo), 4.0), 0.25) END) * (value - (hi + lo) / 2) + 3.3e-9, 6) AS adjusted FROM w""")
def _(spark, sf_dir):
    from ..operators import temporal

    h = b.hourly(spark, sf_dir).withColumns({"day": temporal.window_12z(c("hour_end")), "lo": F.lit(10.0), "hi": F.lit(70.0)})
    return reconcile.temperature_range(h, ["station", "day"], "value", "lo", "hi").select("station", b.seconds("hour_end").alias("hour"), b.rounded("adjusted").alias("adjusted"))


@register("eva01_continuous_metrics", """WITH p AS (SELECT l_quantity * 1000 AS r, l_extendedprice AS c, l_discount AS w FROM lineitem WHERE l_discount > 0)
SELECT count(*) AS count, round(sum(w * (c - r)) / sum(w) + 3.3e-9, 4) AS bias, round(sum(w * abs(c - r)) / sum(w) + 3.3e-9, 4) AS mae, round(sqrt(sum(w * (c - r) * (c - r)) / sum(w)) + 3.3e-9, 4) AS rmse,
 round((sum(w) * sum(w * r * c) - sum(w * r) * sum(w * c)) / sqrt((sum(w) * sum(w * r * r) - sum(w * r) * sum(w * r)) * (sum(w) * sum(w * c * c) - sum(w * c) * sum(w * c))) + 3.3e-9, 6) AS correlation FROM p""")
def _(spark, sf_dir):
    p = b.table(spark, sf_dir, "lineitem").select((c("l_quantity") * 1000).alias("r"), c("l_extendedprice").alias("c"), c("l_discount").alias("w"))
    return _metric(evaluate.continuous_metrics(p, "r", "c", weight="w"))


def _metric(df):
    return df.withColumns({k: b.rounded(k, 4) for k in ("bias", "mae", "rmse")} | {"correlation": b.rounded("correlation")})


@register("eva02_stratified_metrics", """SELECT l_returnflag, count(*) AS count, round(avg(l_extendedprice - l_quantity * 1000) + 3.3e-9, 4) AS bias, round(avg(abs(l_extendedprice - l_quantity * 1000)) + 3.3e-9, 4) AS mae, round(sqrt(avg((l_extendedprice - l_quantity * 1000) * (l_extendedprice - l_quantity * 1000))) + 3.3e-9, 4) AS rmse,
 round(corr(l_quantity * 1000, l_extendedprice) + 3.3e-9, 6) AS correlation FROM lineitem GROUP BY 1""")
def _(spark, sf_dir):
    p = b.table(spark, sf_dir, "lineitem").select("l_returnflag", (c("l_quantity") * 1000).alias("r"), c("l_extendedprice").alias("c"))
    return _metric(evaluate.continuous_metrics(p, "r", "c", ["l_returnflag"]))


@register("eva03_categorical_metrics", """WITH s AS (SELECT sum((quality = 1 AND toxic = 1)::INT)::BIGINT AS hits, sum((quality = 1 AND toxic <> 1)::INT)::BIGINT AS misses, sum((quality <> 1 AND toxic = 1)::INT)::BIGINT AS false_alarms FROM labels)
SELECT *, round(hits / nullif(hits + misses, 0) + 3.3e-9, 6) AS pod, round(false_alarms / nullif(hits + false_alarms, 0) + 3.3e-9, 6) AS far, round(hits / nullif(hits + misses + false_alarms, 0) + 3.3e-9, 6) AS csi FROM s""")
def _(spark, sf_dir):
    out = evaluate.categorical_metrics(b.table(spark, sf_dir, "labels"), c("quality") == 1, c("toxic") == 1)
    return out.withColumns({k: b.rounded(k) for k in ("pod", "far", "csi")})


@register("eva04_group_split", f"""SELECT c_custkey, ('0x' || substr(sha256('salt:' || c_custkey), 1, 16))::UBIGINT < {int(0.7 * 2**64)}::UBIGINT AS calibration FROM customer""")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "customer").select("c_custkey", evaluate.calibration_half(c("c_custkey"), 0.7, "salt").alias("calibration"))


_FIT = "SELECT l_suppkey, l_extendedprice / 1000 - l_quantity AS r, l_discount * 100 - 5 AS a FROM lineitem"


@register("eva08_fit_anomaly_weight", f"""WITH f AS ({_FIT}), s AS (SELECT l_suppkey, count(*) AS n, sum(a * a) AS aa, sum(a * r) AS ar FROM f GROUP BY 1) SELECT l_suppkey, n, round(greatest(least((ar + 500 * aa / n * 0.5) / nullif(aa + 500 * aa / n, 0), 1.0), 0.0) + 3.3e-9, 6) AS weight FROM s""")
def _(spark, sf_dir):
    f = b.table(spark, sf_dir, "lineitem").select("l_suppkey", (c("l_extendedprice") / 1000).alias("o"), c("l_quantity").alias("base"), (c("l_discount") * 100 - 5).alias("a"))
    return evaluate.shrunk_slope(f, "o", "base", "a", F.lit(0.5), F.lit(500.0), ["l_suppkey"]).withColumn("weight", b.rounded("weight"))


_HUE = f"""f AS (SELECT f.r, f.a, n_nationkey, n_regionkey FROM ({_FIT}) f JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey), g AS (SELECT sum(a * r) / sum(a * a) AS w FROM f),
p AS (SELECT n_regionkey, greatest(least((sum(a * r) + 500 * sum(a * a) / count(*) * (SELECT greatest(least(w, 1), 0) FROM g)) / (sum(a * a) + 500 * sum(a * a) / count(*)), 1.0), 0.0) AS parent FROM f GROUP BY 1)"""


@register("eva10_hierarchical_weights", f"""WITH {_HUE} SELECT f.n_regionkey, n_nationkey, count(*) AS n, round(any_value(parent) + 3.3e-9, 6) AS parent_weight, round(greatest(least((sum(a * r) + 2000 * sum(a * a) / count(*) * any_value(parent)) / (sum(a * a) + 2000 * sum(a * a) / count(*)), 1.0), 0.0) + 3.3e-9, 6) AS weight FROM f JOIN p ON f.n_regionkey = p.n_regionkey GROUP BY 1, 2""")
def _(spark, sf_dir):
    n = b.table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    s = b.table(spark, sf_dir, "supplier").join(n, c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_nationkey", "n_regionkey")
    f = b.table(spark, sf_dir, "lineitem").join(s, c("l_suppkey") == c("s_suppkey")).select("n_nationkey", "n_regionkey", (c("l_extendedprice") / 1000 - c("l_quantity")).alias("r"), (c("l_discount") * 100 - 5).alias("a"))
    sums = f.groupBy("n_regionkey", "n_nationkey").agg(F.count("*").alias("n"), F.sum(c("a") * c("a")).alias("aa"), F.sum(c("a") * c("r")).alias("ar"))
    bound = lambda x: F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0))
    total = sums.agg(bound(F.try_divide(F.sum("ar"), F.sum("aa"))).alias("top"))
    parents = sums.groupBy("n_regionkey").agg(F.sum("n").alias("pn"), F.sum("aa").alias("paa"), F.sum("ar").alias("par")).crossJoin(F.broadcast(total))
    ridge = lambda k, aa, n: k * F.try_divide(aa, n)
    rp = ridge(500, c("paa"), c("pn"))
    parents = parents.select("n_regionkey", bound(F.try_divide(c("par") + rp * c("top"), c("paa") + rp)).alias("parent_weight"))
    rc = ridge(2000, c("aa"), c("n"))
    out = sums.join(parents, "n_regionkey").withColumn("weight", bound(F.try_divide(c("ar") + rc * c("parent_weight"), c("aa") + rc)))
    return out.select("n_regionkey", "n_nationkey", "n", b.rounded("parent_weight").alias("parent_weight"), b.rounded("weight").alias("weight"))


@register("fil01_geographic_domain_mask", f"WITH g AS ({b.GRID}) SELECT cell, lat BETWEEN 25 AND 53 AND lon BETWEEN -125 AND -67 AS inside FROM g")
def _(spark, sf_dir):
    return b.grid(spark, sf_dir).select("cell", fill.domain_mask(c("lat"), c("lon")).alias("inside"))


@register("fil02_persistent_gap_mask", "SELECT user_id AS cell, bool_and(CASE WHEN event_type = 'click' THEN value END IS NULL) OR bool_and(CASE WHEN value > 20 THEN value END IS NULL) AS persistent_gap FROM events GROUP BY 1")
def _(spark, sf_dir):
    v = b.table(spark, sf_dir, "events").select(c("user_id").alias("cell"), F.when(c("event_type") == "click", c("value")).alias("a"), F.when(c("value") > 20, c("value")).alias("b"))
    return fill.persistent_gaps(v, ["cell"], ["a", "b"])


@register("fil03_fill_domain_gaps", f"""WITH g AS ({b.GRID}), m AS (SELECT y, x FROM g WHERE size <= 10), d AS (SELECT y, x, value FROM g WHERE size > 10),
r AS (SELECT m.y, m.x, d.y AS dy, d.x AS dx, d.value, row_number() OVER (PARTITION BY m.y, m.x ORDER BY (m.y - d.y) * (m.y - d.y) + (m.x - d.x) * (m.x - d.x), d.y, d.x) AS k FROM m, d WHERE abs(m.y - d.y) <= 12)
SELECT y, x, dy AS donor_y, dx AS donor_x, round(sqrt((y - dy) * (y - dy) + (x - dx) * (x - dx)) + 3.3e-9, 6) AS distance, value FROM r WHERE k = 1""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    d = g.where("size > 10")
    found = checkpointed(spark, lambda: fill.nearest_donor(g.where("size <= 10"), d))
    return found.join(d.select(c("y").alias("donor_y"), c("x").alias("donor_x"), "value"), ["donor_y", "donor_x"]).withColumn("distance", b.rounded("distance"))


@register("fil11_derive_masks", "SELECT sum((p_size > 10 AND p_partkey % 3 <> 0)::INT)::BIGINT AS model_cells, sum((p_size > 10 AND p_partkey % 7 <> 0)::INT)::BIGINT AS forcing_cells, sum((p_size > 10 AND p_partkey % 3 <> 0 AND p_partkey % 7 = 0)::INT)::BIGINT AS uncovered FROM part")
def _(spark, sf_dir):
    k = c("p_partkey")
    return fill.derived_masks(b.table(spark, sf_dir, "part").select((c("p_size") > 10).alias("boundary"), (k % 3 != 0).alias("active"), (k % 7 != 0).alias("keep")))


@register("fil13_mask_changes", "WITH a AS (SELECT p_partkey AS k FROM part WHERE p_size > 10), z AS (SELECT p_partkey AS k FROM part WHERE p_size < 40) SELECT count(a.k) AS old_cells, count(z.k) AS new_cells, count(*) - count(a.k) AS added, count(*) - count(z.k) AS removed FROM a FULL JOIN z USING (k)")
def _(spark, sf_dir):
    p = b.table(spark, sf_dir, "part")
    return fill.mask_changes(p.where("p_size > 10"), p.where("p_size < 40"), ["p_partkey"])


_RING = [(-120.0, 26.0), (-80.0, 27.0), (-75.0, 45.0), (-100.0, 30.5), (-118.0, 46.0)]


@register("fil14_points_in_polygon", f"""WITH g AS ({b.GRID}), e(x1, y1, x2, y2) AS (VALUES {', '.join(str((*p, *q)) for p, q in zip(_RING, _RING[1:] + _RING[:1], strict=True))})
SELECT cell AS id FROM g, e WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY cell HAVING count(*) % 2 = 1""")
def _(spark, sf_dir):
    edges = spark.createDataFrame([(*p, *q) for p, q in zip(_RING, _RING[1:] + _RING[:1], strict=True)], "x1 double, y1 double, x2 double, y2 double")
    return fill.in_polygon(b.grid(spark, sf_dir).select(c("cell").alias("id"), "lon", "lat"), edges)


@register("hyb01_masked_box_smooth", f"""WITH g AS ({b.GRID}), e AS (SELECT min(y) AS y0, max(y) AS y1 FROM g), v AS (SELECT y, x, CASE WHEN size > 10 THEN value END AS v FROM g), o AS (SELECT unnest([-2, -1, 0, 1]) AS d),
m AS (SELECT v.y, v.x, CASE WHEN v.y + p.d < y0 THEN 2 * y0 - v.y - p.d WHEN v.y + p.d > y1 THEN 2 * y1 - v.y - p.d ELSE v.y + p.d END AS ry, CASE WHEN v.x + q.d < 0 THEN -v.x - q.d WHEN v.x + q.d > 19 THEN 38 - v.x - q.d ELSE v.x + q.d END AS rx FROM v, e, o p, o q)
SELECT m.y, m.x, round(avg(n.v) + 3.3e-9, 6) AS smooth FROM m LEFT JOIN v n ON n.y = ry AND n.x = rx GROUP BY 1, 2""")
def _(spark, sf_dir):
    g = b.grid(spark, sf_dir)
    rows = tuple(g.agg(F.min("y"), F.max("y")).head())
    return fill.box_smooth(g.select("y", "x", F.when(c("size") > 10, c("value")).alias("v")), ["v"], 4, rows, (0, 19)).select("y", "x", b.rounded("v_smooth").alias("smooth"))


@register("net01_window_from_bbox", f"WITH g AS ({b.GRID}) SELECT greatest(min(y) - 2, 0) AS y_min, least(max(y) + 2, 4999) AS y_max, greatest(min(x) - 2, 0) AS x_min, least(max(x) + 2, 19) AS x_max FROM g WHERE lat BETWEEN 26 AND 40 AND lon BETWEEN -110 AND -80")
def _(spark, sf_dir):
    return network.bbox_window(b.grid(spark, sf_dir), 26, 40, -110, -80, 2, 5000, 20)


@register("net04_localize_indices", "SELECT l_orderkey, l_linenumber, l_partkey - 50 AS i, l_suppkey - 2 AS j FROM lineitem WHERE l_suppkey - 1 BETWEEN 2 AND 60 AND l_partkey - 1 BETWEEN 50 AND 900")
def _(spark, sf_dir):
    t = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_partkey").alias("i"), c("l_suppkey").alias("j"))
    return network.localized(t, 2, 60, 50, 900)


@register("net06_downstream_closure", f"""WITH RECURSIVE r AS ({b.REACHES}), d(link) AS (SELECT link FROM r WHERE kind = 'FURNITURE' UNION SELECT r.to_link FROM d JOIN r ON r.link = d.link WHERE r.to_link IN (SELECT link FROM r)) SELECT link FROM d""")
def _(spark, sf_dir):
    r = b.reaches(spark, sf_dir)
    return checkpointed(spark, lambda: network.downstream(r.where("kind = 'FURNITURE'"), r))


@register("net08_incomplete_catchments", """WITH a AS (SELECT l_suppkey AS k, count(*) AS "overlaps", count(*) FILTER (WHERE l_quantity > 2) AS kept FROM lineitem GROUP BY 1) SELECT k AS l_suppkey, "overlaps", kept FROM a WHERE kept > 0 AND "overlaps" > kept""")
def _(spark, sf_dir):
    li = b.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    return network.incomplete_catchments(li, li.where("l_quantity > 2"), "l_suppkey")


@register("net11_validate_topology", f"""WITH r AS (SELECT link, CASE WHEN link % 50 = 3 THEN link WHEN link % 70 = 9 THEN link + 1000000 ELSE to_link END AS to_link, CASE WHEN link % 90 = 7 THEN 5 ELSE row_number() OVER (ORDER BY link) - 1 END AS index FROM ({b.REACHES})),
p AS (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS place, CASE WHEN s_suppkey % 40 = 0 THEN -s_suppkey ELSE s_suppkey END AS polyid, 1 + s_suppkey % 3 AS n_over FROM supplier), l AS (SELECT polyid, unnest(range(n_over + CASE WHEN polyid % 33 = 5 THEN 1 ELSE 0 END)) AS n, place AS pat FROM p),
w AS (SELECT row_number() OVER (ORDER BY CASE WHEN pat % 25 = 4 THEN pat + 1.5 ELSE pat END, n, pat) - 1 AS place, polyid, 1 + (polyid * 7 + n) % 41 AS i, 1 + (polyid + n) % 19 AS j FROM l), s AS (SELECT *, sum(n_over) OVER (ORDER BY place) AS e FROM p), g AS (SELECT place, CASE WHEN place % 30 = 2 THEN polyid + 1 ELSE polyid END AS polyid, place + CASE WHEN place % 45 = 6 THEN 2 ELSE 1 END AS basin FROM p WHERE place <> 11)
SELECT 'repeated_link' AS "check", count(*) AS errors FROM (SELECT link FROM r GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'unresolved_downstream', count(*) FROM r WHERE to_link <> 0 AND to_link NOT IN (SELECT link FROM r) UNION ALL SELECT 'self_loop', count(*) FROM r WHERE to_link = link
UNION ALL SELECT 'index_not_a_permutation', CASE WHEN count(DISTINCT index) = count(*) AND min(index) = 0 AND max(index) = count(*) - 1 THEN 0 ELSE greatest(count(*) - count(DISTINCT index), 1) END FROM r
UNION ALL SELECT 'overlap_sum', abs((SELECT sum(n_over) FROM p) - (SELECT count(*) FROM w))::BIGINT UNION ALL SELECT 'unknown_polygon', count(*) FROM p WHERE polyid NOT IN (SELECT link FROM r)
UNION ALL SELECT 'weight_order', count(*) FROM w JOIN s USING (polyid) WHERE NOT (w.place >= e - n_over AND w.place < e) UNION ALL SELECT 'outside_grid', count(*) FROM w WHERE NOT (i BETWEEN 1 AND 40 AND j BETWEEN 1 AND 18)
UNION ALL SELECT 'bucket_order', count(*) FROM p FULL JOIN g USING (place) WHERE p.polyid IS DISTINCT FROM g.polyid UNION ALL SELECT 'basin_order', count(*) FROM g WHERE basin <> place + 1""")
def _(spark, sf_dir):
    k, n = c("link"), c("n")
    numbered = lambda df, *order: network.running(df.withColumn("_k", F.struct(*order)).withColumn("_w", F.lit(1)), "_k", "_w").withColumn("place", c("through") - 1).drop("_k", "_w", "through")
    r = b.reaches(spark, sf_dir).withColumn("to_link", F.when(k % 50 == 3, k).when(k % 70 == 9, k + 1000000).otherwise(c("to_link")))
    r = numbered(r, "link").withColumn("index", F.when(k % 90 == 7, 5).otherwise(c("place"))).drop("place")
    s = c("s_suppkey")
    p = numbered(b.table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey").select("place", F.when(s % 40 == 0, -s).otherwise(s).alias("polyid"), (1 + s % 3).alias("overlaps"))
    poly = c("polyid")
    w = p.select("polyid", c("place").alias("at"), F.explode(F.sequence(F.lit(0), (c("overlaps") - 1 + F.when(poly % 33 == 5, 1).otherwise(0)).cast("int"))).alias("n"))
    w = numbered(w, F.when(c("at") % 25 == 4, c("at") + 1.5).otherwise(c("at").cast("double")), n, "at").select("place", "polyid", (1 + (poly * 7 + n) % 41).alias("i"), (1 + (poly + n) % 19).alias("j"))
    at = c("place")
    g = p.where("place <> 11").select("place", F.when(at % 30 == 2, poly + 1).otherwise(poly).alias("polyid"), (at + F.when(at % 45 == 6, 2).otherwise(1)).alias("basin"))
    return network.topology_errors(r, w, p, g, (18, 40)).select("check", "errors")
