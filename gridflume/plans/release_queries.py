"""Queries of releases, receipts, exact comparison and eligibility."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import audit, evaluate, incremental, observations, temporal
from . import bindings as b
from .registry import register

c = F.col


def _orders(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


@register("src04_monthly_normalize", "SELECT o_orderkey, epoch(date_trunc('month', o_orderdate)::TIMESTAMP)::BIGINT AS period_start, epoch(date_trunc('month', o_orderdate)::TIMESTAMP + INTERVAL 1 MONTH)::BIGINT AS period_end FROM orders")
def _(spark, sf_dir):
    start = F.date_trunc("month", "o_orderdate")
    return b.table(spark, sf_dir, "orders").select("o_orderkey", b.seconds(start).alias("period_start"), b.seconds(start + F.expr("INTERVAL 1 MONTH")).alias("period_end"))


@register("src12_paged_features", "SELECT l_partkey AS feature, count(DISTINCT l_orderkey) AS pages, count(*) AS times, count(*) > 1 AS repeated FROM lineitem GROUP BY l_partkey")
def _(spark, sf_dir):
    n = F.count("*")
    return b.table(spark, sf_dir, "lineitem").groupBy(c("l_partkey").alias("feature")).agg(F.count_distinct("l_orderkey").alias("pages"), n.alias("times"), (n > 1).alias("repeated"))


@register("src20_select_window", "SELECT l_orderkey, l_linenumber, epoch(l_shipdate)::BIGINT AS start FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber) = 1")
def _(spark, sf_dir):
    # the shortest window has the latest start; on ties the first message counts
    best = F.min_by(F.struct("l_linenumber", "l_shipdate"), F.struct((-b.seconds("l_shipdate")).alias("a"), "l_linenumber"))
    return b.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best.alias("x")).select("l_orderkey", c("x.l_linenumber").alias("l_linenumber"), b.seconds("x.l_shipdate").alias("start"))


@register("src25_release_changed", "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0 OR (o_orderkey % 11 = 0 AND o_orderpriority IS DISTINCT FROM '1-URGENT')")
def _(spark, sf_dir):
    offered = _orders(spark, sf_dir).select("o_orderkey", "day", "o_orderpriority")
    held = offered.where("o_orderkey % 7 <> 0").withColumn("o_orderpriority", F.when(c("o_orderkey") % 11 == 0, "1-URGENT").otherwise(c("o_orderpriority")))
    same = [c(f"o.{k}").eqNullSafe(c(f"h.{k}")) for k in ("o_orderkey", "day", "o_orderpriority")]
    return offered.alias("o").join(held.alias("h"), same, "left_anti").select("o_orderkey")


@register("aud08_compare_datasets", """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS p, CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 5 <> 0)
SELECT * FROM (SELECT o.o_orderkey, CASE WHEN r.o_orderkey IS NULL THEN 'removed' ELSE concat_ws(',', CASE WHEN p IS DISTINCT FROM o_totalprice THEN 'o_totalprice' END, CASE WHEN s IS DISTINCT FROM o_orderstatus THEN 'o_orderstatus' END) END AS change FROM orders o LEFT JOIN r USING (o_orderkey)) WHERE change <> ''""")
def _(spark, sf_dir):
    k, left = c("o_orderkey"), _orders(spark, sf_dir)
    right = left.where(k % 5 != 0).select(k, F.when(k % 13 != 0, c("o_totalprice")).alias("o_totalprice"), F.when(k % 17 == 0, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus"))
    return audit.dataset_changes(left, right, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


@register("aud14_state_inventory", "SELECT l_returnflag AS variable, year(l_shipdate) AS year, count(v) AS n, count(*) FILTER (v IS NULL) AS missing, round(min(v) + 3.3e-9, 6) AS least, round(max(v) + 3.3e-9, 6) AS greatest, round(avg(v) + 3.3e-9, 6) AS mean, count(*) FILTER (v < 0) AS negative, count(*) FILTER (v < -10 OR v > 20) AS out_of_bounds FROM (SELECT *, CASE WHEN l_linenumber <> 7 THEN l_quantity - 25 END AS v FROM lineitem) GROUP BY ALL")
def _(spark, sf_dir):
    s = b.table(spark, sf_dir, "lineitem").select(c("l_returnflag").alias("variable"), F.year("l_shipdate").alias("year"), F.when(c("l_linenumber") != 7, c("l_quantity") - 25).alias("v"))
    found = audit.state_inventory(s, ["variable", "year"], "v", F.lit(-10), F.lit(20))
    return found.withColumns({k: b.rounded(k) for k in ("least", "greatest", "mean")})


_PRINTS = "SELECT o_custkey, sha256(string_agg(DISTINCT o_orderkey || '|' || o_orderstatus, ';' ORDER BY o_orderkey || '|' || o_orderstatus)) AS fingerprint FROM {} GROUP BY o_custkey"


@register("inc06_fingerprint_changed", f"WITH w AS ({_PRINTS.format('orders')}), h AS ({_PRINTS.format('(SELECT * FROM orders WHERE o_orderkey % 10 <> 0)')}) SELECT w.o_custkey, w.fingerprint, CASE WHEN h.o_custkey IS NULL THEN 'new' ELSE 'changed' END AS reason FROM w LEFT JOIN h USING (o_custkey) WHERE h.fingerprint IS DISTINCT FROM w.fingerprint")
def _(spark, sf_dir):
    o, identity = _orders(spark, sf_dir), F.concat_ws("|", b.text("o_orderkey"), "o_orderstatus")
    held = incremental.fingerprints(o.where("o_orderkey % 10 <> 0"), ["o_custkey"], identity)
    return incremental.needing_work(incremental.fingerprints(o, ["o_custkey"], identity), held, ["o_custkey"])


@register("inc10_revision_for_day", "SELECT o_orderkey, CASE WHEN date_trunc('month', d) = DATE '1998-08-01' THEN 'early' WHEN DATE '1998-08-02' - d >= 183 THEN 'stable' ELSE 'provisional' END AS revision FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)")
def _(spark, sf_dir):
    return _orders(spark, sf_dir).select("o_orderkey", incremental.revision_of(c("day"), F.lit("1998-08-02").cast("date")).alias("revision"))


@register("inc26_accepted_prefix", """WITH s AS (SELECT conv_id, turn, turn + CASE WHEN length(text) % 9 = 0 THEN 2 ELSE 1 END AS stop, length(text) % 5 <> 0 AS ok FROM conversations),
f AS (SELECT *, coalesce(lag(stop) OVER w = turn, lag(stop) OVER w IS NULL) AND coalesce(ok, false) AS good FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn, stop)),
g AS (SELECT *, min(good::INT) OVER (PARTITION BY conv_id ORDER BY turn, stop ROWS UNBOUNDED PRECEDING) = 1 AS kept FROM f)
SELECT conv_id, count(*) FILTER (kept) AS segments, max(stop) FILTER (kept) AS resume FROM g GROUP BY conv_id""")
def _(spark, sf_dir):
    n = F.length("text")
    s = b.table(spark, sf_dir, "conversations").select("conv_id", "turn", (c("turn") + F.when(n % 9 == 0, 2).otherwise(1)).alias("stop"), (n % 5 != 0).alias("ok"))
    return incremental.accepted_prefix(s, ["conv_id"], "turn", "stop", "ok")


@register("inc28_calendar_eligibility", """WITH d AS (SELECT o_orderstatus AS stream, o_orderdate::DATE AS day, bool_or(o_totalprice > 100000) AS ok FROM orders GROUP BY ALL)
SELECT stream, epoch(day::TIMESTAMP)::BIGINT AS day, CASE WHEN NOT coalesce(ok, false) THEN 'no_constraint' WHEN coalesce(day - lag(day) OVER w, 0) <> 1 THEN 'no_previous_day' WHEN coalesce(lead(day) OVER w - day, 0) <> 1 THEN 'no_next_day' ELSE 'eligible' END AS state FROM d WINDOW w AS (PARTITION BY stream ORDER BY day)""")
def _(spark, sf_dir):
    days = _orders(spark, sf_dir).groupBy(c("o_orderstatus").alias("stream"), "day").agg(F.bool_or(c("o_totalprice") > 100000).alias("ok"))
    return incremental.calendar_eligibility(days, ["stream"], "day", "ok").select("stream", b.seconds(c("day").cast("timestamp")).alias("day"), "state")


@register("net12_reach_alignment", "WITH p AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS position FROM customer) SELECT o_orderkey, position FROM orders LEFT JOIN p ON o_custkey = c_custkey")
def _(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    parents = b.table(spark, sf_dir, "customer").select(c("c_custkey").alias("o_custkey"), place.cast("long").alias("position"))
    return b.table(spark, sf_dir, "orders").join(parents, "o_custkey", "left").select("o_orderkey", "position")


_SWEEP = "SELECT event_type AS stratum, user_id, value / 10 AS reference, CASE WHEN event_id % 13 > 0 THEN value * 0.09 + 0.5 END AS pass2, CASE WHEN event_id % 7 > 0 THEN value * 0.11 - 0.5 END AS archive, CASE WHEN event_id % 17 > 0 THEN (user_id % 100) / 100.0::DOUBLE END AS quality FROM events"
_TRIED = """*, coalesce(quality < q, false) OR coalesce(abs(archive - pass2) >= d, false) AS swap"""
_DEPTH = "*, swap AND archive IS NOT NULL AS override, CASE WHEN swap AND archive >= 0 THEN archive WHEN quality >= 0.5 AND pass2 >= 0 THEN pass2 WHEN archive >= 0 THEN archive END - reference AS err, CASE WHEN swap AND archive >= 0 THEN archive WHEN quality >= 0.5 AND pass2 >= 0 THEN pass2 WHEN archive >= 0 THEN archive END AS depth"
_SCORED = """count(err) AS n, avg(err) AS bias, sqrt(avg(err * err)) AS rmse, count(*) FILTER (reference >= 0.1 AND depth >= 0.1) / nullif(count(*) FILTER (err IS NOT NULL AND (reference >= 0.1 OR depth >= 0.1)), 0) AS csi"""
_PAIRS = "(SELECT unnest([0.25, 0.5, 0.755]::DOUBLE[]) AS q), (SELECT unnest([0.155, 0.385]::DOUBLE[]) AS d)"


def _samples(spark, sf_dir):
    v, k = c("value"), c("event_id")
    return b.table(spark, sf_dir, "events").select(
        c("event_type").alias("stratum"), "user_id", (v / 10).alias("reference"), F.when(k % 13 > 0, v * 0.09 + 0.5).alias("pass2"), F.when(k % 7 > 0, v * 0.11 - 0.5).alias("archive"), F.when(k % 17 > 0, c("user_id") % 100 / 100).alias("quality")
    )


@register("eva05_override_sweep", f"""WITH s AS (SELECT {_TRIED} FROM ({_SWEEP}), {_PAIRS}), e AS (SELECT {_DEPTH} FROM s), r AS (SELECT stratum, q, d, count(*) FILTER (override) AS overrides, {_SCORED} FROM e GROUP BY ALL)
SELECT stratum, q, d, overrides, n, round(bias + 3.3e-9, 6) AS bias, round(rmse + 3.3e-9, 6) AS rmse, round(csi + 3.3e-9, 6) AS csi FROM r""")
def _(spark, sf_dir):
    found = evaluate.override_sweep(_samples(spark, sf_dir), ["stratum"], [0.25, 0.5, 0.755], [0.155, 0.385]).drop("place")
    return found.withColumns({k: b.rounded(k) for k in ("bias", "rmse", "csi")})


@register("eva07_calibrate_overrides", f"""WITH m AS (SELECT *, ('0x' || substr(sha256('split:' || user_id), 1, 16))::UBIGINT < {int(0.7 * 2**64)}::UBIGINT AS fit FROM ({_SWEEP})), s AS (SELECT {_TRIED} FROM (FROM m WHERE fit), {_PAIRS}), e AS (SELECT {_DEPTH} FROM s),
r AS (SELECT stratum, q, d, count(*) FILTER (override) AS overrides, {_SCORED} FROM e GROUP BY stratum, q, d QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY rmse, -csi, q, d) = 1),
w AS (SELECT {_DEPTH} FROM (SELECT {_TRIED} FROM m JOIN (SELECT stratum, q, d FROM r) USING (stratum) WHERE NOT fit)), h AS (SELECT stratum, count(*) AS withheld_samples, {_SCORED} FROM w GROUP BY stratum)
SELECT r.stratum, q, d, overrides, r.n, round(r.bias + 3.3e-9, 6) AS bias, round(r.rmse + 3.3e-9, 6) AS rmse, round(r.csi + 3.3e-9, 6) AS csi, withheld_samples, h.n AS withheld_n, round(h.bias + 3.3e-9, 6) AS withheld_bias, round(h.rmse + 3.3e-9, 6) AS withheld_rmse, round(h.csi + 3.3e-9, 6) AS withheld_csi FROM r JOIN h USING (stratum)""")
def _(spark, sf_dir):
    out = evaluate.calibrated_overrides(_samples(spark, sf_dir), ["stratum"], "user_id", [0.25, 0.5, 0.755], [0.155, 0.385])
    return out.withColumns({p + k: b.rounded(p + k) for p in ("", "withheld_") for k in ("bias", "rmse", "csi")})


@register("obs07_acquisition_tasks", """WITH s AS (SELECT l_suppkey AS station, min(l_shipdate)::DATE AS a, max(l_shipdate)::DATE AS z FROM lineitem GROUP BY l_suppkey), y AS (SELECT *, unnest(generate_series(year(a), year(z))) AS yr FROM s),
w AS (SELECT station, greatest(a, make_date(yr::INT, 1, 1)) AS f, least(z, make_date(yr::INT, 12, 31)) AS l FROM y)
SELECT station, epoch(f::TIMESTAMP)::BIGINT AS first_day, epoch(l::TIMESTAMP)::BIGINT AS last_day, sha256(station || '|' || f || '|' || l) AS request FROM w""")
def _(spark, sf_dir):
    day = F.to_date("l_shipdate")
    s = b.table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("station")).agg(F.min(day).alias("a"), F.max(day).alias("z"))
    found = observations.acquisition_tasks(s, "station", "a", "z")
    return found.withColumns({k: b.seconds(c(k).cast("timestamp")) for k in ("first_day", "last_day")})


_HOURS = "SELECT event_id, floor(epoch(ts) / 3600)::BIGINT AS hour FROM events"


@register("src22_cycle_candidates", f"""WITH h AS ({_HOURS}), a AS (SELECT hour // 6 * 6 AS cycle, min(hour) + 4 AS since FROM h GROUP BY 1),
f AS (SELECT e.hour, max(cycle) AS cycle FROM (SELECT DISTINCT hour FROM h) e JOIN a ON e.hour - cycle BETWEEN 1 AND 12 AND since <= e.hour GROUP BY e.hour)
SELECT event_id, h.hour, cycle, h.hour - cycle AS lead FROM h LEFT JOIN f ON h.hour = f.hour""")
def _(spark, sf_dir):
    h = b.table(spark, sf_dir, "events").select("event_id", F.floor(b.seconds(c("ts").cast("timestamp")) / 3600).alias("hour"))
    available = h.groupBy((F.floor(c("hour") / 6) * 6).alias("cycle")).agg((F.min("hour") + 4).alias("since"))
    return temporal.latest_cycle(h, available, "hour", "cycle", "since").select("event_id", "hour", "cycle", "lead")


@register("aud15_pair_check", "SELECT l_suppkey AS model, l_shipdate::DATE::VARCHAR AS stamp, bool_or(l_linestatus = 'O') AND bool_or(l_linestatus = 'F') AS paired, count(*) FILTER (l_tax IS NULL OR l_tax = 0) AS unusable FROM lineitem GROUP BY ALL")
def _(spark, sf_dir):
    kind = c("l_linestatus")
    both = F.bool_or(kind == "O") & F.bool_or(kind == "F")
    return b.table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("model"), b.text(F.to_date("l_shipdate")).alias("stamp")).agg(both.alias("paired"), F.count_if(c("l_tax").isNull() | (c("l_tax") == 0)).alias("unusable"))


@register("inc02_publication_order", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus = 'F', CASE WHEN o_orderstatus = 'F' THEN -epoch(o_orderdate) ELSE epoch(o_orderdate) END, o_orderkey) AS place FROM orders")
def _(spark, sf_dir):
    accepted, at = c("o_orderstatus") == "F", b.seconds("o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy(accepted, F.when(accepted, -at).otherwise(at), "o_orderkey")
    return b.table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).alias("place"))


@register("net10_routing_validity", "SELECT l_suppkey AS i, l_linenumber AS j, bool_or(l_returnflag = 'R') AS affected, bool_or(l_returnflag = 'N') AND NOT bool_or(l_returnflag = 'R') AS complete FROM lineitem GROUP BY ALL")
def _(spark, sf_dir):
    hit, whole = F.bool_or(c("l_returnflag") == "R"), F.bool_or(c("l_returnflag") == "N")
    return b.table(spark, sf_dir, "lineitem").groupBy(c("l_suppkey").alias("i"), c("l_linenumber").alias("j")).agg(hit.alias("affected"), (whole & ~hit).alias("complete"))
