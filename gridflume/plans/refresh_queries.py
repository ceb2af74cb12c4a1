"""Queries of sources, sinks and incremental refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental, temporal
from ..sources import catalogue
from . import bindings as b
from .registry import register

c = F.col


@register("src02_normalize_longitude", "SELECT event_id, ((user_id * 7 % 360 + 180) % 360) - 180 AS lon FROM events")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", (F.pmod(c("user_id") * 7 % 360 + 180, F.lit(360)) - 180).alias("lon"))


@register("src05_precip_candidate", f"WITH h AS ({b.STATION_HOURS}) SELECT station, product, epoch(hour_end)::BIGINT AS hour, round(CASE WHEN value - 30 >= 0 THEN value - 30 END + 3.3e-9, 6) AS depth, CASE WHEN value / 100 BETWEEN 0 AND 1 THEN round(value / 100 + 3.3e-9, 6) END AS quality, epoch(hour_end - CASE WHEN product = 'view' THEN INTERVAL 6 HOUR ELSE INTERVAL 1 HOUR END)::BIGINT AS interval_start FROM h")
def _(spark, sf_dir):
    v = c("value")
    start = F.when(c("product") == "view", c("hour_end") - F.expr("INTERVAL 6 HOURS")).otherwise(c("hour_end") - F.expr("INTERVAL 1 HOUR"))
    return b.station_hours(spark, sf_dir).select("station", "product", b.seconds("hour_end").alias("hour"), b.rounded(F.when(v - 30 >= 0, v - 30)).alias("depth"), b.rounded(F.when((v / 100).between(0, 1), v / 100)).alias("quality"), b.seconds(start).alias("interval_start"))


@register("src06_read_remap_links", "SELECT l_orderkey, l_linenumber, l_partkey - 1 AS src, l_suppkey - 1 AS dst, l_discount AS weight FROM lineitem WHERE l_discount > 0 AND l_partkey >= 1 AND l_suppkey >= 1")
def _(spark, sf_dir):
    from ..operators import regrid

    t = b.table(spark, sf_dir, "lineitem").where("l_partkey >= 1 and l_suppkey >= 1")
    return regrid.usable_links(t.select("l_orderkey", "l_linenumber", (c("l_partkey") - 1).alias("src"), (c("l_suppkey") - 1).alias("dst"), c("l_discount").alias("weight")))


@register("src08_grid_fingerprint", f"WITH g AS ({b.GRID}), r AS (SELECT y, sha256(string_agg(cell || '|' || size, ';' ORDER BY cell)) AS h FROM g GROUP BY y) SELECT sha256(string_agg(h, ';' ORDER BY y)) AS fingerprint FROM r")
def _(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("cell", F.concat_ws("|", b.text("cell"), b.text("size")).alias("s"))))
    per_row = b.grid(spark, sf_dir).groupBy("y").agg(F.sha2(F.concat_ws(";", F.transform(rows, lambda s: s["s"])), 256).alias("h"))
    # one digest per grid row, in order
    return per_row.agg(F.sha2(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("y", "h"))), lambda s: s["h"])), 256).alias("fingerprint"))


@register("src09_fnf_normalize", """SELECT event_id, user_id AS station, epoch(date_trunc('second', ts) + INTERVAL 8 HOUR)::BIGINT AS utc, CASE WHEN event_id % 13 = 0 THEN NULL ELSE round(value * 0.028316846592 + 3.3e-9, 6) END AS value_si, CASE WHEN event_id % 13 = 0 THEN 'missing' ELSE 'valid' END AS status FROM events""")
def _(spark, sf_dir):
    raw = F.when(c("event_id") % 13 == 0, F.lit("-9999")).otherwise(b.text("value"))
    e = b.table(spark, sf_dir, "events").withColumn("parsed", F.nullif(raw.try_cast("double"), F.lit(-9999.0)))
    utc = c("ts").cast("timestamp") + F.expr("INTERVAL 8 HOURS")
    return e.select("event_id", c("user_id").alias("station"), b.seconds(utc).alias("utc"), b.rounded(c("parsed") * 0.028316846592).alias("value_si"), F.when(c("parsed").isNull(), "missing").otherwise("valid").alias("status"))


@register("src11_json_fields", """SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events""")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@register("src16_station_html_extract", r"""SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS name, len(regexp_extract_all(html, '(?s)<p>')) AS paragraphs, len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS links FROM pages""")
def _(spark, sf_dir):
    n = lambda p, g: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(g)))
    return b.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("name"), n("<p>", 0).cast("long").alias("paragraphs"), n('href="([^"]*)"', 1).cast("long").alias("links"))


@register("src17_station_id_discovery", r"""SELECT link, count(*) AS pages FROM (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS link FROM pages) GROUP BY link""")
def _(spark, sf_dir):
    found = b.table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("link")).distinct()
    return found.groupBy("link").agg(F.count("*").alias("pages"))


_INDEX_SQL = """lines AS (SELECT conv_id AS file, turn AS place, CASE WHEN turn % 7 = 5 THEN 'x' ELSE (turn + 1)::VARCHAR END || ':' || (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) - length(text))::BIGINT || ':d=20240101:' || upper(role) || ':' || CASE WHEN turn % 3 = 1 THEN 'surface' ELSE '2 m' END || CASE WHEN turn % 11 = 10 THEN '' ELSE ':' || (length(text) % 2 + 1) || ' hour fcst:' END AS line FROM conversations),
parts AS (SELECT file, place, string_split(line, ':') AS p FROM lines), records AS (SELECT file, place, p[1]::BIGINT AS number, p[2]::BIGINT AS first_byte, p[4] AS variable, p[5] AS level, p[6] AS timing, lead(p[2]::BIGINT) OVER (PARTITION BY file ORDER BY place) - 1 AS last_byte FROM parts WHERE len(p) >= 6 AND p[1] <> 'x')"""


def _index(spark, sf_dir):
    from pyspark.sql import Window

    t, n = c("turn"), F.length("text")
    offset = F.sum(n).over(Window.partitionBy("conv_id").orderBy("turn")) - n
    line = F.concat(
        F.when(t % 7 == 5, "x").otherwise((t + 1).cast("string")), F.lit(":"), offset.cast("string"), F.lit(":d=20240101:"), F.upper("role"), F.lit(":"), F.when(t % 3 == 1, "surface").otherwise("2 m"),
        F.when(t % 11 == 10, "").otherwise(F.concat(F.lit(":"), (n % 2 + 1).cast("string"), F.lit(" hour fcst:"))),
    )
    lines = b.table(spark, sf_dir, "conversations").select(c("conv_id").alias("file"), t.alias("place"), line.alias("line"))
    return catalogue.index_ranges(lines, "file", "place", "line")


@register("src19_grib_index_ranges", f"WITH {_INDEX_SQL} SELECT * FROM records")
def _(spark, sf_dir):
    return _index(spark, sf_dir)


@register("src19_selected_ranges", f"""WITH {_INDEX_SQL}, w AS (SELECT * FROM (VALUES ('USER', '2 m', '1 hour fcst'), ('ASSISTANT', 'surface', '2 hour fcst'), ('SYSTEM', 'surface', '1 hour fcst')) v(variable, level, timing)), h AS (SELECT file, variable, level, timing, count(*) AS n, min(first_byte) AS a, min(last_byte) AS z FROM records GROUP BY ALL)
SELECT f.file, w.variable, w.level, w.timing, CASE WHEN n = 1 AND z IS NOT NULL THEN a END AS first_byte, CASE WHEN n = 1 THEN z END AS last_byte, CASE WHEN n IS NULL THEN 'absent' WHEN n > 1 THEN 'repeated' WHEN z IS NULL THEN 'no_end' END AS fault FROM (SELECT DISTINCT file FROM records) f CROSS JOIN w LEFT JOIN h ON h.file = f.file AND (h.variable, h.level, h.timing) = (w.variable, w.level, w.timing)""")
def _(spark, sf_dir):
    wanted = [("USER", "2 m", "1 hour fcst"), ("ASSISTANT", "surface", "2 hour fcst"), ("SYSTEM", "surface", "1 hour fcst")]
    return catalogue.selected_ranges(_index(spark, sf_dir), "file", wanted)


@register("src21_hourly_statistic", """WITH s AS (SELECT user_id, event_id, value, row_number() OVER w AS n, lag(value) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT user_id, event_id, round(greatest(CASE WHEN n = 1 THEN value ELSE value * n - p * (n - 1) END, 0) + 3.3e-9, 5) AS hour_value FROM s""")
def _(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    n, p = F.row_number().over(w), F.lag("value").over(w)
    return b.table(spark, sf_dir, "events").select("user_id", "event_id", b.rounded(F.greatest(F.when(n == 1, c("value")).otherwise(c("value") * n - p * (n - 1)), F.lit(0.0)), 5).alias("hour_value"))


@register("src23_latest_coverage", "SELECT lang AS product, max(doc_id) AS latest, count(*) AS files FROM documents GROUP BY 1")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").groupBy(c("lang").alias("product")).agg(F.max("doc_id").alias("latest"), F.count("*").alias("files"))


@register("snk02_publish_if_changed", f"""WITH v AS (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders), r AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS k, unnest([o_orderstatus, s]) AS s, unnest([0, 1]) AS side FROM v),
h AS (SELECT day, side, sha256('{{"c0":"' || k || '","c1":"' || s || '"}}') AS h FROM r), g AS (SELECT day, side, {b.DIGEST} AS signature FROM h GROUP BY ALL)
SELECT z.day::VARCHAR AS day, z.signature FROM g z JOIN g a ON z.day = a.day AND z.side = 1 AND a.side = 0 WHERE a.signature <> z.signature""")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    new = o.withColumn("o_orderstatus", F.when(c("o_orderkey") % 97 == 0, "X").otherwise(c("o_orderstatus")))
    sign = lambda df: temporal.signature(df, ["day"], ["o_orderkey", "o_orderstatus"])
    old = sign(o).withColumnRenamed("signature", "old")
    return sign(new).join(old, "day").where("signature <> old").select(b.text("day").alias("day"), "signature")


@register("snk03_history_loss_guard", "SELECT o_orderkey FROM orders WHERE o_orderkey % 41 = 0")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders")
    return incremental.lost_history(o, o.where("o_orderkey % 41 <> 0"), ["o_orderkey"])


@register("snk04_merge_incoming", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'new' ELSE o_orderstatus END AS status FROM orders")
def _(spark, sf_dir):
    o = b.table(spark, sf_dir, "orders").select("o_orderkey", c("o_orderstatus").alias("status"))
    return incremental.merged(o, o.where("o_orderkey % 5 = 0").withColumn("status", F.lit("new")), ["o_orderkey"])


@register("snk09_domain_exports", "SELECT n_regionkey AS domain, count(*) AS stations, sum(n)::BIGINT AS series FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1")
def _(spark, sf_dir):
    n = b.table(spark, sf_dir, "orders").groupBy(c("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    d = b.table(spark, sf_dir, "nation").select(c("n_nationkey").alias("c_nationkey"), c("n_regionkey").alias("domain"))
    return b.table(spark, sf_dir, "customer").join(n, "c_custkey").join(d, "c_nationkey").groupBy("domain").agg(F.count("*").alias("stations"), F.sum("n").alias("series"))


@register("inc01_ready_frontier", f"""WITH h AS ({b.HOURLY}), s AS (SELECT station, unnest(generate_series(min(hour_end), max(hour_end), INTERVAL 1 HOUR)) AS t FROM h GROUP BY 1), j AS (SELECT s.station, t, h.n FROM s LEFT JOIN h ON s.station = h.station AND t = hour_end), g AS (SELECT station, min(CASE WHEN n IS NULL THEN t END) AS gap FROM j GROUP BY 1)
SELECT j.station, epoch(any_value(gap))::BIGINT AS gap, sum((gap IS NULL OR t < gap)::INT)::BIGINT AS ready_stamps FROM j JOIN g ON j.station = g.station GROUP BY 1""")
def _(spark, sf_dir):
    h = b.hourly(spark, sf_dir)
    s = temporal.spine(h.groupBy("station").agg(F.min("hour_end").alias("a"), F.max("hour_end").alias("z")), ["station"], "a", "z", "1 HOUR", "hour_end")
    return incremental.ready_frontier(s, h, ["station"], "hour_end").withColumn("gap", b.seconds("gap"))


@register("inc03_work_for", """WITH s AS (SELECT o_custkey, list_distinct(list(CASE o_orderstatus WHEN 'F' THEN 'precipitation' WHEN 'O' THEN 'temperature' ELSE 'full' END)) AS s FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN list_contains(s, 'full') THEN 'full,publication' WHEN list_contains(s, 'precipitation') AND list_contains(s, 'temperature') THEN 'precipitation,temperature,publication' WHEN list_contains(s, 'precipitation') THEN 'precipitation,publication' ELSE 'temperature,publication' END AS work FROM s""")
def _(spark, sf_dir):
    kind = F.when(c("o_orderstatus") == "F", "precipitation").when(c("o_orderstatus") == "O", "temperature").otherwise("full")
    s = b.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(kind).alias("s"))
    return s.select("o_custkey", F.array_join(incremental.work_for(c("s")), ",").alias("work"))


@register("inc05_latency", """WITH s AS (SELECT event_id, date_trunc('second', ts) AS a, date_trunc('second', lead(ts) OVER (PARTITION BY user_id ORDER BY event_id)) AS z FROM events) SELECT event_id, epoch(z - a)::BIGINT AS total_seconds, CASE WHEN epoch(z - a) <= 1800 THEN 'within_target' WHEN epoch(z - a) <= 3600 THEN 'over_target' ELSE 'deadline_missed' END AS state FROM s WHERE z IS NOT NULL""")
def _(spark, sf_dir):
    from pyspark.sql import Window

    s = b.table(spark, sf_dir, "events").withColumn("a", c("ts").cast("timestamp")).withColumn("z", F.lead("a").over(Window.partitionBy("user_id").orderBy("event_id"))).where("z is not null")
    total, kind = incremental.latency(c("a"), c("a"), c("z"))
    return s.select("event_id", total.alias("total_seconds"), kind.alias("state"))


@register("inc08_window_dependencies", "WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT DISTINCT (d + k)::VARCHAR AS day FROM d, (VALUES (-1), (0), (1)) t(k)")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return incremental.window_days(d, "d").select(b.text("day").alias("day"))


@register("inc16_checkpoint_asof", """SELECT e.event_id, epoch(date_trunc('second', max(k.ts)))::BIGINT AS latest FROM events e LEFT JOIN events k ON k.user_id = e.user_id AND k.event_type = 'signup' AND k.ts <= e.ts WHERE e.event_type = 'error' GROUP BY e.event_id""")
def _(spark, sf_dir):
    e = b.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", c("ts").cast("timestamp").alias("ts"))
    asked, states = e.where("event_type = 'error'"), e.where("event_type = 'signup'")
    found = incremental.latest_before(asked, states, ["user_id"], "ts", "ts").distinct()
    return asked.join(found, ["user_id", "ts"]).select("event_id", b.seconds("latest").alias("latest"))


@register("inc17_retention_candidates", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1999-01-01' AND day(o_orderdate) <> 1")
def _(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").where((F.to_date("o_orderdate") < F.lit("1999-01-01").cast("date")) & (F.dayofmonth("o_orderdate") != 1)).select("o_orderkey")


@register("inc18_cache_retention", "WITH r AS (SELECT doc_id, source, row_number() OVER w AS n, sum(n_chars) OVER w AS s FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id DESC)) SELECT source, doc_id FROM r WHERE n > 20 OR s > 50000")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return incremental.evicted(d, ["source"], F.desc("doc_id"), "n_chars", 20, 50000).select("source", "doc_id")


@register("inc27_contiguous_batches", """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), r AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS g FROM d), p AS (SELECT *, (row_number() OVER (PARTITION BY user_id, g ORDER BY day) - 1) // 3 AS k FROM r)
SELECT user_id, min(day)::VARCHAR AS first_day, max(day)::VARCHAR AS last_day, count(*) AS days FROM p GROUP BY user_id, g, k""")
def _(spark, sf_dir):
    d = b.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    out = incremental.batches(d, "day", "user_id", 3)
    return out.withColumns({"first_day": b.text("first_day"), "last_day": b.text("last_day")})
