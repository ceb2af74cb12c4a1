"""Queries of repairs, of the check before a run, of the fallback at gaps and of whole hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import complete, repair
from . import bindings as b
from .bundle_queries import _ESW, _EXP, _NATIVE, _Q, _RADIATION
from .grid_queries import _EM, _F, _N, _VP
from .registry import register

c = F.col


def _records(spark, sf_dir):
    """Six hours of two fields on the grid, which lack cells by three masks."""
    g = b.grid(spark, sf_dir).withColumn("hour", F.explode(F.array(*map(F.lit, range(1, 7)))))
    k, h = c("cell"), c("hour")
    return g.select("hour", "y", "x", F.when((c("size") * 7 + k + h % 3 * 13) % 5 != 0, c("value") + h).alias("a"), F.when((c("size") * 3 + k + (h + 1) % 3 * 7) % 4 != 0, c("value") - h).alias("b"))


_RECORDS = f"rec AS MATERIALIZED (SELECT hour, y, x, cell, size, CASE WHEN (size * 7 + cell + hour % 3 * 13) % 5 <> 0 THEN value + hour END AS a, CASE WHEN (size * 3 + cell + (hour + 1) % 3 * 7) % 4 <> 0 THEN value - hour END AS b FROM ({b.GRID}), range(1, 7) t(hour))"


def _nearest(field: str, target: str, donor: str) -> str:
    """The nearest donor of each target in its hour, by looking at all within some rows."""
    return f"""(SELECT t.hour, t.y, t.x, d.{field} AS v, sqrt((t.y - d.y) ** 2 + (t.x - d.x) ** 2) AS distance FROM rec t JOIN rec d ON t.hour = d.hour AND abs(t.y - d.y) <= 15 WHERE t.{field} IS NULL AND ({target}) AND d.{field} IS NOT NULL AND ({donor})
      QUALIFY row_number() OVER (PARTITION BY t.hour, t.y, t.x ORDER BY (t.y - d.y) ** 2 + (t.x - d.x) ** 2, d.y, d.x) = 1)"""


@register("fil07_fill_active_holes", f"""WITH {_RECORDS}, n AS {_nearest('a', 't.size > 12 AND t.cell % 17 <> 0', 'd.size > 5 AND d.cell % 17 <> 0')}
SELECT hour, y, x, coalesce(a, v) AS a, v IS NOT NULL AS a_filled, round(distance + 3.3e-9, 6) AS a_distance, CASE WHEN a IS NULL AND size > 12 AND cell % 17 <> 0 AND v IS NULL THEN 'no_donor' END AS a_fault FROM rec LEFT JOIN n USING (hour, y, x)""")
def _(spark, sf_dir):
    cells = b.grid(spark, sf_dir).select("y", "x", (c("size") > 12).alias("active"), (c("size") > 5).alias("keep"), (c("cell") % 17 == 0).alias("gap"))
    return repair.fill_active_holes(_records(spark, sf_dir).drop("b"), ["hour"], ["a"], cells).withColumn("a_distance", b.rounded("a_distance"))


_IN, _LAND = "cell % 11 <> 3", "cell % 11 <> 3 AND size > 25"


def _repaired(f: str) -> str:
    return f"""r_{f} AS (SELECT '{f}' AS field, {_IN} AS inside, {_LAND} AS land, {f} AS v0, CASE WHEN {_IN} THEN coalesce({f}, v) END AS v1, v IS NOT NULL AS filled, distance FROM rec LEFT JOIN {_nearest(f, 't.cell % 11 <> 3 AND t.size > 25', 'd.cell % 11 <> 3')} USING (hour, y, x))"""


@register("fil08_domain_repair", f"""WITH {_RECORDS}, {_repaired('a')}, {_repaired('b')}, p AS (SELECT field, count(*) FILTER (filled) AS filled, round(coalesce(max(distance), 0) + 3.3e-9, 6) AS most_distance, count(*) FILTER (NOT inside AND v0 IS NOT NULL) AS masked, count(*) FILTER (land AND v1 IS NULL) AS missing_land,
count(*) FILTER (NOT inside AND v1 IS NOT NULL) AS valid_outside, bool_and(v0 IS NOT DISTINCT FROM v1) FILTER (inside AND NOT land) AS inactive_same, bool_and(v0 = v1) FILTER (land AND v0 IS NOT NULL) AS active_same, round(sum(v1), 3) AS total FROM (FROM r_a UNION ALL FROM r_b) GROUP BY field)
SELECT *, missing_land = 0 AND valid_outside = 0 AND inactive_same AND active_same AS complete FROM p""")
def _(spark, sf_dir):
    k = c("cell") % 11 != 3
    cells = b.grid(spark, sf_dir).select("y", "x", k.alias("domain"), (k & (c("size") > 25)).alias("land"))
    fixed, report = repair.domain_repair(_records(spark, sf_dir), ["hour"], ["a", "b"], cells)
    sums = fixed.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).select(F.explode(F.create_map(F.lit("a"), c("a"), F.lit("b"), c("b"))).alias("field", "total"))
    return report.join(sums, "field").withColumns({"most_distance": b.rounded("most_distance"), "total": F.round("total", 3)})


@register("fil09_forcing_preflight", f"""WITH r AS (SELECT cell, size, hour, CASE WHEN cell % 29 <> 0 AND (cell + hour) % 31 <> 0 THEN value END AS a, CASE WHEN cell % 37 <> 5 THEN value END AS b FROM ({b.GRID}), range(1, 7) t(hour) WHERE hour <> 4), l AS (SELECT * FROM r WHERE size > 20),
p AS (SELECT cell, count(a) = 0 OR count(b) = 0 AS persistent FROM l GROUP BY cell), u AS (SELECT cell, 'a' AS field, a IS NULL AS gone FROM l UNION ALL SELECT cell, 'b', b IS NULL FROM l)
SELECT field, count(*) FILTER (gone) AS missing, count(*) FILTER (gone AND NOT persistent) AS transient, (SELECT count(*) FROM p WHERE persistent) AS persistent_cells, (SELECT count(DISTINCT hour) FROM r) AS hours, (SELECT max(hour) - min(hour) + 1 = count(DISTINCT hour) FROM r) AS continuous,
concat_ws(',', CASE WHEN (SELECT max(hour) - min(hour) + 1 <> count(DISTINCT hour) FROM r) THEN 'not_hourly' END, CASE WHEN count(*) FILTER (gone AND NOT persistent) > 0 THEN 'transient_gaps' END) AS issues FROM u JOIN p USING (cell) GROUP BY field""")
def _(spark, sf_dir):
    k, h = c("cell"), c("hour")
    g = b.grid(spark, sf_dir)
    r = g.withColumn("hour", F.explode(F.array(*(F.lit(x) for x in (1, 2, 3, 5, 6)))))
    r = r.select(F.timestamp_seconds(h * 3600).alias("t"), "y", "x", F.when((k % 29 != 0) & ((k + h) % 31 != 0), c("value")).alias("a"), F.when(k % 37 != 5, c("value")).alias("b"))
    report, _ = repair.preflight(r, "t", ["a", "b"], g.select("y", "x", (c("size") > 20).alias("land")))
    return report.withColumn("issues", F.array_join("issues", ","))


_NATIVE_CELLS = f"""nat0 AS (SELECT p_partkey AS src, 30 + p_partkey % 43 * 0.41::DOUBLE AS lat, -120 + p_partkey % 53 * 0.55::DOUBLE AS lon, p_partkey % 7 * 200.0::DOUBLE AS z0, 275.0::DOUBLE + p_partkey % 19 AS t, 0.002::DOUBLE + p_partkey % 5 * 0.001::DOUBLE AS q, 85000.0::DOUBLE + p_partkey % 11 * 500 AS p,
CASE WHEN p_partkey % 12 <> 5 THEN 250.0::DOUBLE + p_partkey % 29 END AS lw, p_partkey % 9 - 4.0::DOUBLE AS u, CASE WHEN p_partkey % 10 <> 3 THEN 3.0::DOUBLE - p_partkey % 6 END AS v, p_partkey % 13 * 50.0::DOUBLE - 20 AS sw, CASE WHEN p_partkey % 6 > 0 THEN p_partkey % 17 * 0.0001::DOUBLE END AS rain FROM part),
nat1 AS (SELECT *, {_VP} / {_ESW.format(t='t')} AS rh0, lw / ({_EM.format(q='q', p='p', t='t')} * pow(t, 4)) AS f FROM nat0),
nat AS MATERIALIZED (SELECT *, t + 0.0065 * z0 AS t_ref, p * pow((t + 0.0065 * z0) / t, {_EXP}) AS p_ref, least(rh0, 1.0) AS rh, rh0 > 1 AS clip, cos(radians(lat)) * cos(radians(lon)) AS cx, cos(radians(lat)) * sin(radians(lon)) AS cy, sin(radians(lat)) AS cz FROM nat1)"""


def _native_cells(spark, sf_dir):
    k = c("p_partkey")
    return b.table(spark, sf_dir, "part").select(
        k.alias("src"), (30 + k % 43 * 0.41).alias("lat"), (-120 + k % 53 * 0.55).alias("lon"), (k % 7 * 200.0).alias("z0"), (275.0 + k % 19).alias("t"), (0.002 + k % 5 * 0.001).alias("q"), (85000.0 + k % 11 * 500).alias("p"),
        F.when(k % 12 != 5, 250.0 + k % 29).alias("lw"), (k % 9 - 4.0).alias("u"), F.when(k % 10 != 3, 3.0 - k % 6).alias("v"), (k % 13 * 50.0 - 20).alias("sw"), F.when(k % 6 > 0, k % 17 * 0.0001).alias("rain"),
    )


def _donor(bit: int, lacks: str, whole: str) -> str:
    return f"""d{bit} AS MATERIALIZED (SELECT dst, arg_min(src, chord) AS s{bit}, 6371 * 2 * asin(min(chord) / 2) AS k{bit} FROM (SELECT dst, src, sqrt((pri.cx - nat.cx) ** 2 + (pri.cy - nat.cy) ** 2 + (pri.cz - nat.cz) ** 2) AS chord FROM pri, nat WHERE active AND ({lacks}) AND ({whole}))
      GROUP BY dst HAVING 6371 * 2 * asin(min(chord) / 2) <= 40)"""


@register("fil06_native_repair", f"""WITH {_NATIVE_CELLS},
pri0 AS (SELECT c_custkey AS dst, 30 + c_custkey % 37 * 0.5::DOUBLE AS lat, -120 + c_custkey % 41 * 0.75::DOUBLE AS lon, CASE WHEN c_custkey % 8 <> 1 THEN c_custkey % 5 * 300.0::DOUBLE END AS z, CASE WHEN c_custkey % 16 <> 1 THEN 450.0::DOUBLE END AS mz, c_custkey % 7 <> 0 AS active, CASE WHEN c_custkey % 2 > 0 THEN 280.0::DOUBLE END AS t,
0.004::DOUBLE AS q, CASE WHEN c_custkey % 9 <> 1 THEN 88000.0::DOUBLE END AS p, 290.0::DOUBLE AS lw, CASE WHEN c_custkey % 3 > 0 THEN 2.0::DOUBLE END AS u, 1.0::DOUBLE AS v, CASE WHEN c_custkey % 5 > 0 THEN 300.0::DOUBLE END AS sw, CASE WHEN c_custkey % 4 <> 1 THEN 0.0002::DOUBLE END AS rain FROM customer),
pri AS MATERIALIZED (SELECT *, coalesce(z, mz) AS z1, cos(radians(lat)) * cos(radians(lon)) AS cx, cos(radians(lat)) * sin(radians(lon)) AS cy, sin(radians(lat)) AS cz FROM pri0),
{_donor(1, 'pri.t IS NULL OR pri.p IS NULL', 'nat.lw IS NOT NULL')}, {_donor(2, 'pri.u IS NULL', 'nat.v IS NOT NULL')}, {_donor(4, 'pri.sw IS NULL', 'nat.sw >= 0')}, {_donor(8, 'pri.rain IS NULL', 'nat.rain >= 0')},
m0 AS (SELECT pri.*, k1, k2, k4, k8, n1.rh AS rh1, n1.f AS f1, n1.clip AS clip1, n1.t_ref - 0.0065 * z1 AS t1, n1.p_ref * pow((n1.t_ref - 0.0065 * z1) / n1.t_ref, {_EXP}) AS p1, n2.u AS u2, n2.v AS v2, n4.sw AS sw4, n8.rain AS rain8, k1 IS NOT NULL AND z1 IS NOT NULL AS one FROM pri
 LEFT JOIN d1 USING (dst) LEFT JOIN nat n1 ON n1.src = s1 LEFT JOIN d2 USING (dst) LEFT JOIN nat n2 ON n2.src = s2 LEFT JOIN d4 USING (dst) LEFT JOIN nat n4 ON n4.src = s4 LEFT JOIN d8 USING (dst) LEFT JOIN nat n8 ON n8.src = s8),
m1 AS (SELECT *, {_Q.format(rh='rh1', t='t1', p='p1')} AS q1 FROM m0), m AS (SELECT *, f1 * {_EM.format(q='q1', p='p1', t='t1')} * pow(t1, 4) AS lw1 FROM m1)
SELECT dst, round(CASE WHEN one THEN t1 ELSE t END + 3.3e-9, 6) AS t, round(CASE WHEN one THEN q1 ELSE q END + 3.3e-9, 8) AS q, round(CASE WHEN one THEN p1 ELSE p END + 3.3e-9, 4) AS p, round(CASE WHEN one THEN lw1 ELSE lw END + 3.3e-9, 4) AS lw, coalesce(u2, u) AS u, CASE WHEN k2 IS NULL THEN v ELSE v2 END AS v, coalesce(sw4, sw) AS sw, coalesce(rain8, rain) AS rain,
(CASE WHEN one THEN 1 + CASE WHEN clip1 THEN 32 ELSE 0 END + CASE WHEN z IS NULL THEN 16 ELSE 0 END ELSE 0 END + CASE WHEN k2 IS NULL THEN 0 ELSE 2 END + CASE WHEN k4 IS NULL THEN 0 ELSE 4 END + CASE WHEN k8 IS NULL THEN 0 ELSE 8 END)::INTEGER AS flags,
round(greatest(CASE WHEN one THEN k1 ELSE 0 END, coalesce(k2, 0), coalesce(k4, 0), coalesce(k8, 0)) + 3.3e-9, 4) AS km,
CASE WHEN NOT active THEN NULL WHEN (t IS NULL OR p IS NULL) AND z1 IS NULL THEN 'no_elevation' WHEN ((t IS NULL OR p IS NULL) AND k1 IS NULL) OR (u IS NULL AND k2 IS NULL) OR (sw IS NULL AND k4 IS NULL) OR (rain IS NULL AND k8 IS NULL) THEN 'no_donor' END AS fault FROM m""")
def _(spark, sf_dir):
    k = c("c_custkey")
    primary = b.table(spark, sf_dir, "customer").select(
        k.alias("dst"), (30 + k % 37 * 0.5).alias("lat"), (-120 + k % 41 * 0.75).alias("lon"), F.when(k % 8 != 1, k % 5 * 300.0).alias("z"), F.when(k % 16 != 1, 450.0).alias("model_z"), (k % 7 != 0).alias("active"), F.when(k % 2 > 0, 280.0).alias("t"),
        F.lit(0.004).alias("q"), F.when(k % 9 != 1, 88000.0).alias("p"), F.lit(290.0).alias("lw"), F.when(k % 3 > 0, 2.0).alias("u"), F.lit(1.0).alias("v"), F.when(k % 5 > 0, 300.0).alias("sw"), F.when(k % 4 != 1, 0.0002).alias("rain"),
    )
    out = repair.native_repair(primary, _native_cells(spark, sf_dir), 40.0)
    digits = {"t": 6, "q": 8, "p": 4, "lw": 4, "km": 4}
    return out.withColumns({f: b.rounded(f, d) for f, d in digits.items()})


_GAPS = f"""tg AS (SELECT c_custkey AS dst, 25 + c_custkey % 59 * 0.5::DOUBLE AS lat, -125 + c_custkey % 61 * 0.95::DOUBLE AS lon, c_custkey % 6 <> 0 AS keep, c_custkey % 5 <> 0 AND c_custkey % 6 <> 0 AS active, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 9 * 150.0::DOUBLE END AS e, CASE WHEN c_custkey % 8 > 0 THEN c_custkey % 13 * 1000.0::DOUBLE END AS me FROM customer),
xy0 AS (SELECT *, {_F!r} * pow(tan(pi() / 4 + radians(lat) / 2), -{_N!r}) AS r, {_N!r} * radians(lon + 97.5) AS th FROM tg), xy AS (SELECT *, (r * sin(th) + 0.3) / 0.005 AS ix, (-r * cos(th) + 1.45) / 0.005 AS iy FROM xy0),
gaps AS MATERIALIZED (SELECT dst, active, CASE WHEN e IS NULL AND active AND me > -500 AND me < 9000 THEN me ELSE e END AS z1, coalesce(e IS NULL AND active AND me > -500 AND me < 9000, false) AS from_model, round(ix + 3.3e-9, 6) AS index_x, round(iy + 3.3e-9, 6) AS index_y FROM xy WHERE keep AND NOT (ix BETWEEN 0 AND 119 AND iy BETWEEN 0 AND 89))"""


def _gaps(spark, sf_dir):
    k = c("c_custkey")
    keep = k % 6 != 0
    t = b.table(spark, sf_dir, "customer").select(
        k.alias("dst"), (25 + k % 59 * 0.5).alias("lat"), (-125 + k % 61 * 0.95).alias("lon"), keep.alias("keep"), (keep & (k % 5 != 0)).alias("active"),
        F.when(k % 4 > 0, k % 9 * 150.0).alias("elevation"), F.when(k % 8 > 0, k % 13 * 1000.0).alias("model_elevation"),
    )
    return repair.gap_geometry(t, (-0.3, -1.45), (0.005, 0.005), (120, 90))


@register("rgd11_gap_geometry", f"WITH {_GAPS} SELECT *, NOT active AND z1 IS NULL AS excluded, CASE WHEN active AND z1 IS NULL THEN 'no_elevation' END AS fault FROM gaps")
def _(spark, sf_dir):
    return _gaps(spark, sf_dir).drop("lat", "lon").withColumns({"index_x": b.rounded("index_x"), "index_y": b.rounded("index_y")})


@register("rgd05_remap_hour", f"""WITH {_NATIVE_CELLS}, {_GAPS}, n AS (SELECT count(*) AS n FROM part), lk AS (SELECT dst, (dst * 3 + k) % n AS src, CASE k WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 ELSE 0.125 END::DOUBLE AS weight FROM gaps, range(4) t(k), n WHERE z1 IS NOT NULL),
ok AS (SELECT *, lw IS NOT NULL AND rh0 <= 1.2 AS good FROM nat), sm AS (SELECT dst, count(*) AS links, count(CASE WHEN good THEN 1 END) AS st, sum(weight * t_ref) AS t_ref, sum(weight * p_ref) AS p_ref, sum(weight * rh) AS rh, sum(weight * f) AS f, sum(weight * sw) AS sw, sum(weight * u) AS u, sum(weight * v) AS v, count(v) AS nv, sum(weight * rain) AS rain, count(rain) AS nr, bool_or(coalesce(clip, false)) AS clip FROM lk JOIN ok USING (src) GROUP BY dst),
a AS (SELECT dst, sm.*, z1, st = links AS one, t_ref - 0.0065 * z1 AS t1, p_ref * pow((t_ref - 0.0065 * z1) / t_ref, {_EXP}) AS p1 FROM sm JOIN gaps USING (dst)), q AS (SELECT *, {_Q.format(rh='rh', t='t1', p='p1')} AS q1 FROM a), o AS (SELECT *, f * {_EM.format(q='q1', p='p1', t='t1')} * pow(t1, 4) AS lw1 FROM q)
SELECT dst, round(CASE WHEN one THEN t1 END + 3.3e-9, 6) AS t, round(CASE WHEN one THEN p1 END + 3.3e-9, 4) AS p, round(CASE WHEN one THEN q1 END + 3.3e-9, 8) AS q, round(CASE WHEN one THEN lw1 END + 3.3e-9, 4) AS lw, round(sw + 3.3e-9, 4) AS sw, round(u + 3.3e-9, 6) AS u, round(CASE WHEN nv = links THEN v END + 3.3e-9, 6) AS v, round(CASE WHEN nr = links THEN rain END + 3.3e-9, 8) AS rain, clip AS clipped,
CASE WHEN NOT one OR nv < links OR nr < links THEN 'incomplete ' || concat_ws(' ', CASE WHEN NOT one THEN 't p q lw' END, CASE WHEN nv < links THEN 'v' END, CASE WHEN nr < links THEN 'rain' END) END AS fault FROM o""")
def _(spark, sf_dir):
    cells = b.table(spark, sf_dir, "part")
    # one row
    n = F.broadcast(cells.agg(F.count("*").alias("n")).withColumn("_one", F.lit(1)))
    geometry = _gaps(spark, sf_dir).where("z1 is not null")
    corners = geometry.select("dst", F.lit(1).alias("_one"), F.explode(F.array(*map(F.lit, range(4)))).alias("k")).join(n, "_one")
    links = corners.select("dst", ((c("dst") * 3 + c("k")) % c("n")).alias("src"), F.when(c("k") == 0, 0.5).when(c("k") == 1, 0.25).otherwise(0.125).alias("weight"))
    source = _native_cells(spark, sf_dir).withColumn("depth", c("rain") * 3600).drop("rain")
    digits = {"t": 6, "p": 4, "q": 8, "lw": 4, "sw": 4, "u": 6, "v": 6, "rain": 8}
    return repair.remap_hour(source, geometry, links).withColumns({f: b.rounded(f, d) for f, d in digits.items()})


_SOURCES = {"purchase": 1, "view": 2, "click": 3}
_E = "(SELECT *, date_trunc('day', ts) + INTERVAL 1 HOUR * (hour(ts) // 6 * 6) AS slot FROM events)"
_ORDER = "['purchase', 'view', 'click']"
_AFTER_NATIVE = _RADIATION[len(_NATIVE) + 2:].replace("> 300 THEN 8", "> 1400 THEN 8")

_WHOLE = f"""cand AS (SELECT slot AS ts, event_type AS product, count(*) % 3 > 0 AS valid FROM {_E} GROUP BY 1, 2 HAVING day(slot) % 4 > 0),
ch AS MATERIALIZED (SELECT ts, arg_min(product, list_position({_ORDER}, product)) AS product, min(list_position({_ORDER}, product)) > 1 AS fallback_used FROM cand WHERE valid AND list_position({_ORDER}, product) > 0 GROUP BY ts),
s AS (SELECT slot AS ts, event_type AS product, user_id % 8 AS src, user_id % 8 * 100.0::DOUBLE AS z0, avg(270 + value / 6) AS t, avg(CASE WHEN event_id % 11 > 0 THEN 0.001 + value / 50000 END) AS q, avg(80000 + value * 50) AS p, avg(200 + value / 4) AS lw, avg(value * 10 - 60) AS sw, avg(value / 10 - 5) AS u, CASE WHEN user_id % 8 <> 5 THEN avg(5 - value / 20) END AS v FROM {_E} GROUP BY 1, 2, user_id % 8),
s1 AS (SELECT s.*, fallback_used, {_VP} / {_ESW.format(t='t')} AS rh0, lw / ({_EM.format(q='q', p='p', t='t')} * pow(t, 4)) AS f FROM s JOIN ch USING (ts, product)), s2 AS (SELECT *, q IS NOT NULL AND NOT coalesce(rh0 > 1.05, false) AS ok FROM s1),
rf AS (SELECT ts, product, fallback_used, src, CASE WHEN ok THEN t + 0.0065 * z0 END AS t_ref, CASE WHEN ok THEN p * pow((t + 0.0065 * z0) / t, {_EXP}) END AS p_ref, CASE WHEN ok THEN least(rh0, 1.0) END AS rh, CASE WHEN ok THEN f END AS lf, greatest(sw, 0) AS sw, (sw < 0)::INTEGER AS neg, CASE WHEN v IS NOT NULL THEN u END AS e, v AS n FROM s2),
tgt AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM (SELECT ts, product, fallback_used, src // 2 AS dst, sum(w * t_ref) / sum(w) FILTER (t_ref IS NOT NULL) AS t_ref, sum(w * p_ref) / sum(w) FILTER (p_ref IS NOT NULL) AS p_ref, sum(w * rh) / sum(w) FILTER (rh IS NOT NULL) AS rh, sum(w * lf) / sum(w) FILTER (lf IS NOT NULL) AS lw_factor, sum(w * sw) / sum(w) AS shortwave0, sum(w * neg) > 0 AS negative,
 sum(w * e) / sum(w) FILTER (e IS NOT NULL) AS east, sum(w * n) / sum(w) FILTER (n IS NOT NULL) AS north FROM (SELECT *, 1.0::DOUBLE + src % 2 AS w FROM rf) GROUP BY 1, 2, 3, 4)),
native AS (SELECT id, ts, 30 + dst * 4.0::DOUBLE AS lat, -120 + dst * 15.0::DOUBLE AS lon, shortwave0, shortwave0 AS sw, negative, east, north FROM tgt), {_AFTER_NATIVE},
g0 AS (SELECT *, 250.0::DOUBLE * dst AS z1, t_ref - 0.0065 * (250.0 * dst) AS temperature, p_ref * pow((t_ref - 0.0065 * (250.0 * dst)) / t_ref, {_EXP}) AS pressure FROM tgt), g1 AS (SELECT *, {_Q.format(rh='rh', t='temperature', p='pressure')} AS humidity FROM g0),
g2 AS (SELECT g1.* EXCLUDE (east, north), r.shortwave, r.east, r.north, radiation_qc, lw_factor * {_EM.format(q='humidity', p='pressure', t='temperature')} * pow(temperature, 4) AS longwave FROM g1 JOIN radiation r USING (id)),
g3 AS (SELECT *, temperature + pressure + humidity + longwave + shortwave + east + north IS NOT NULL AS whole FROM g2),
rn AS (SELECT slot AS ts, user_id % 4 AS dst, avg(value) FILTER (event_id % 3 = 0) AS pass2, avg(value) FILTER (event_id % 2 = 0) AS land, avg(value) / 100 AS quality FROM {_E} WHERE user_id % 4 <> 3 OR hour(ts) >= 6 GROUP BY 1, 2),
rd AS (SELECT ts, dst, CASE WHEN quality >= 0.5 AND pass2 >= 0 THEN pass2 WHEN land >= 0 THEN land END AS depth, CASE WHEN quality >= 0.5 AND pass2 >= 0 THEN 1 WHEN land >= 0 THEN 5 ELSE 0 END AS precip_source_id FROM rn),
hours AS (SELECT g3.ts, g3.dst, product, fallback_used, temperature, pressure, humidity, longwave, shortwave, east, north, (CASE WHEN t_ref IS NULL THEN 4 ELSE 0 END)::BIGINT | (radiation_qc::BIGINT << 16) | CASE WHEN g3.dst <> 2 AND NOT whole THEN 2147483648::BIGINT ELSE 0 END AS qc, CASE WHEN whole THEN list_position({_ORDER}, product) ELSE 0 END AS source_id, depth / 3600 AS rainrate, precip_source_id FROM g3 LEFT JOIN rd USING (ts, dst))"""


def _whole(spark, sf_dir):
    ts = c("ts").cast("timestamp")
    slot = F.date_trunc("day", ts) + F.make_dt_interval(hours=F.floor(F.hour(ts) / 6).cast("int") * 6)
    e = b.table(spark, sf_dir, "events").withColumn("slot", slot)
    k, v = c("user_id"), c("value")
    candidates = e.groupBy(c("slot").alias("ts"), c("event_type").alias("product")).agg((F.count("*") % 3 > 0).alias("valid"))
    native = e.groupBy(c("slot").alias("ts"), c("event_type").alias("product"), (k % 8).alias("src")).agg(
        F.avg(270 + v / 6).alias("t"), F.avg(F.when(c("event_id") % 11 > 0, 0.001 + v / 50000)).alias("q"), F.avg(80000 + v * 50).alias("p"), F.avg(200 + v / 4).alias("lw"), F.avg(v * 10 - 60).alias("sw"), F.avg(v / 10 - 5).alias("u"), F.avg(5 - v / 20).alias("v")
    ).withColumns({"z0": c("src") * 100.0, "v": F.when(c("src") != 5, c("v"))})
    links = native.select("product", "src").distinct().select("product", "src", F.floor(c("src") / 2).alias("dst"), (1.0 + c("src") % 2).alias("weight"))
    d = c("dst")
    targets = links.select("dst").distinct().select("dst", (d * 250.0).alias("z1"), (30 + d * 4.0).alias("lat"), (-120 + d * 15.0).alias("lon"), (d != 2).alias("active"))
    none = F.lit(None).cast("double")
    rain = e.where((k % 4 != 3) | (F.hour("ts") >= 6)).groupBy(c("slot").alias("ts"), (k % 4).alias("dst")).agg(F.avg(F.when(c("event_id") % 3 == 0, v)).alias("pass2"), F.avg(F.when(c("event_id") % 2 == 0, v)).alias("land"), (F.avg(v) / 100).alias("quality"))
    rain = rain.withColumns({p: none for p in ("pass1", "archive", "realtime", "forecast")} | {"override": F.lit(False), "exclusion": F.lit(False)})
    done = e.select(c("slot").alias("ts")).where(F.dayofmonth("ts") % 4 == 0)
    return complete.complete_hours(candidates, native, links, targets, rain, done, _SOURCES)


@register("bun10_complete_hour", f"""WITH {_WHOLE}
SELECT epoch(ts)::BIGINT AS ts, dst, product, fallback_used, round(temperature + 3.3e-9, 5) AS temperature, round(pressure + 3.3e-9, 3) AS pressure, round(humidity + 3.3e-9, 8) AS humidity, round(longwave + 3.3e-9, 4) AS longwave, round(shortwave + 3.3e-9, 4) AS shortwave, round(east + 3.3e-9, 6) AS east, round(north + 3.3e-9, 6) AS north, qc, source_id, round(rainrate + 3.3e-9, 8) AS rainrate, precip_source_id FROM hours""")
def _(spark, sf_dir):
    digits = {"temperature": 5, "pressure": 3, "humidity": 8, "longwave": 4, "shortwave": 4, "east": 6, "north": 6, "rainrate": 8}
    return _whole(spark, sf_dir).withColumns({f: b.rounded(f, n) for f, n in digits.items()} | {"ts": b.seconds("ts")})


@register("bun10_hour_summary", f"""WITH {_WHOLE}, cnt AS (SELECT ts, product, fallback_used, coalesce(precip_source_id, 0) AS id, count(*) AS n, count(*) FILTER (source_id = 0) AS partial FROM hours GROUP BY ALL)
SELECT epoch(ts)::BIGINT AS ts, product, fallback_used, sum(n)::BIGINT AS cells, sum(partial)::BIGINT AS partial_cells, string_agg(id || ':' || n, ',' ORDER BY id) AS precipitation_sources FROM cnt GROUP BY ALL""")
def _(spark, sf_dir):
    out = complete.hour_summary(_whole(spark, sf_dir)).withColumn("ts", b.seconds("ts"))
    return out.withColumn("precipitation_sources", F.expr("array_join(transform(map_entries(precipitation_sources), x -> concat(x.key, ':', x.value)), ',')"))
