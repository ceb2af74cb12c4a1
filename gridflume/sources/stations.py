"""Station pages: fields, coordinates, sensors and notes read from HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The named entities that pages hold; the ampersand is decoded last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&deg;": "°"}
# Codes of the durations.
DURATIONS = {"daily": "D", "monthly": "M", "hourly": "H", "event": "E"}


def decoded(text: Column) -> Column:
    """Text with its entities decoded once: named ones of ENTITIES (a no-break space as a blank) and numeric ones; others stay as they are."""
    text = F.regexp_replace(text, r"&#(?:0*38|[xX]0*26);", "&amp;")
    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    numeric = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), F.lit(0)))
    digits = lambda e: F.regexp_replace(e, "[&#xX;]", "")
    code = lambda e: F.when(F.lower(e).contains("x"), F.conv(digits(e), 16, 10)).otherwise(digits(e)).cast("int")
    real = F.filter(numeric, lambda e: ((code(e) > 0) & (code(e) < 0xD800)) | code(e).between(0xE000, 0x10FFFF))
    sign = lambda e: F.decode(F.unhex(F.lpad(F.hex(code(e)), 8, "0")), "UTF-32")
    return F.replace(F.aggregate(real, text, lambda done, e: F.replace(done, e, sign(e))), F.lit("&amp;"), F.lit("&"))


def clean(html: Column) -> Column:
    """The text between tags, its entities decoded, runs of white space as one blank."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(decoded(bare), r"[\s\x{A0}]+", " "))


def _cells(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), clean)


def _rows(table: Column) -> Column:
    return F.regexp_extract_all(table, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))


def station_pages(pages: DataFrame, station: str, html: str) -> DataFrame:
    """One row per page: station, name, provider fields, coordinates, sensors, dated notes, and ``faults``.

    Fields come from the pairs of cells of the table ``tableInfo`` (of one name the last counts), the name from the last h2 before it, sensors from
    the one table with sensor numbers and descriptions, notes from rows of two cells, the first a date, of all other tables. ``faults`` (an array, empty if
    the page is right): ``no_table`` (null and empty pages too), ``odd_cells``, ``identity`` (another station than asked), ``no_name``, ``latitude``, ``longitude`` (absent, no number
    or out of bounds; null then), ``sensor_table`` (none or several), ``sensor_row`` (not six cells, no number, or no units; such rows are left out).
    """
    page = F.coalesce(F.col(html), F.lit(""))
    read = pages.select(F.col(station).alias("station_id"), page.alias("_html")).withColumn("_tables", F.regexp_extract_all("_html", F.lit(r"(?is)<table\b[^>]*>.*?</table>"), F.lit(0)))
    is_info = lambda t: t.rlike("id=[\"']tableInfo[\"']")
    has_sensors = lambda t: t.contains("Sensor Description") & t.contains("Sensor Number")
    read = read.withColumns({"_info": F.get(F.filter("_tables", is_info), F.lit(0)), "_sensor_tables": F.filter("_tables", has_sensors)})
    read = read.withColumns({"_cells": F.coalesce(_cells(F.col("_info")), F.array().cast("array<string>")), "_before": F.expr("substring(_html, 1, locate(_info, _html) - 1)")})
    halves = F.floor(F.size("_cells") / 2)
    pairs = F.when(halves > 0, F.transform(F.sequence(F.lit(0), (halves - 1).cast("int")), lambda k: F.struct(F.get("_cells", k * 2).alias("key"), F.get("_cells", k * 2 + 1).alias("value"))))
    read = read.withColumn("_pairs", F.coalesce(pairs, F.array().cast("array<struct<key:string,value:string>>")))
    keys = F.transform("_pairs", lambda p: p["key"])
    last = lambda p, k: k == F.size("_pairs") - F.array_position(F.reverse(keys), p["key"])
    read = read.withColumn("fields", F.map_from_entries(F.filter("_pairs", last)))
    headings = F.regexp_extract_all("_before", F.lit(r"(?is)<h2\b[^>]*>(.*?)</h2>"), F.lit(1))
    degrees = lambda name: F.replace(F.try_element_at("fields", F.lit(name)), F.lit("°"), F.lit("")).try_cast("double")
    within = lambda v, bound: F.when(v.between(-bound, bound), v)
    sensor_rows = F.filter(F.flatten(F.transform("_sensor_tables", _rows)), lambda r: r.rlike(r"(?i)<td\b"))
    cells = F.transform(sensor_rows, lambda r: F.struct(_cells(r).alias("c"), r.alias("html")))
    read = read.withColumns({"station_name": clean(F.element_at(F.when(F.size(headings) > 0, headings), -1)), "latitude": within(degrees("Latitude"), 90), "longitude": within(degrees("Longitude"), 180), "_rows": F.when(F.size("_sensor_tables") == 1, cells)})

    def sensor(r: Column) -> Column:
        at = lambda k: F.get(r["c"], F.lit(k))
        text = at(0)
        duration = F.lower(F.trim(F.regexp_replace(at(2), r"[()]", " ")))
        code = F.create_map(*(F.lit(x) for kv in DURATIONS.items() for x in kv))
        units = F.substring_index(text, ",", -1)
        description = F.trim(F.substring(text, F.lit(1), F.length(text) - F.length(units) - 1))
        plot = F.regexp_extract(decoded(r["html"]), r"""(?i)href=["'][^"']*[?&]sensor_no=([^"'&]*)""", 1)
        return F.struct(
            at(1).try_cast("int").alias("sensor_number"), description.alias("description"), F.trim(units).alias("units"), duration.alias("duration"), F.try_element_at(code, duration).alias("duration_code"),
            at(4).alias("data_collection"), at(5).alias("advertised_availability"), F.nullif(plot, F.lit("")).alias("plot_sensor_id"), F.upper(description).contains("FULL NATURAL").alias("is_full_natural_flow"),
        )

    fits = lambda r: (F.size(r["c"]) == 6) & F.get(r["c"], F.lit(1)).try_cast("int").isNotNull() & F.get(r["c"], F.lit(0)).contains(",")
    others = F.filter("_tables", lambda t: ~(is_info(t) | has_sensors(t)))
    dated = F.filter(F.transform(F.flatten(F.transform(others, _rows)), _cells), lambda c: (F.size(c) == 2) & F.get(c, F.lit(0)).rlike(r"^\d{2}/\d{2}/\d{4}$"))
    notes = F.transform(dated, lambda c: F.struct(F.get(c, F.lit(0)).alias("date_raw"), F.get(c, F.lit(1)).alias("text")))
    said = F.try_element_at("fields", F.lit("Station ID"))
    faults = F.array_compact(F.array(
        F.when(F.col("_info").isNull(), "no_table"), F.when(F.size("_cells") % 2 != 0, "odd_cells"), F.when(F.col("_info").isNotNull() & ~said.eqNullSafe(F.col("station_id").cast("string")), "identity"),
        F.when(F.col("_info").isNotNull() & F.col("station_name").isNull(), "no_name"), F.when(F.col("latitude").isNull(), "latitude"), F.when(F.col("longitude").isNull(), "longitude"),
        F.when(F.size("_sensor_tables") != 1, "sensor_table"), F.when(F.exists("_rows", lambda r: ~F.coalesce(fits(r), F.lit(False))), "sensor_row"),
    ))
    sensors = F.transform(F.filter(F.coalesce("_rows", F.filter(cells, lambda r: F.lit(False))), lambda r: F.coalesce(fits(r), F.lit(False))), sensor)
    return read.select("station_id", "station_name", "fields", "latitude", "longitude", sensors.alias("sensors"), notes.alias("notes"), faults.alias("faults"))
