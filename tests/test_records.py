"""Small literal cases of records, station pages, stacks and acceptance; nulls, repeats and empty input among them."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridflume.operators import audit, evaluate, observations, temporal
from gridflume.sources import normalize, stations


def day(text):
    return F.lit(text).cast("date")


def test_natural_flow(spark):
    def row(value, d="2024-01-05 00:00", station="A", units="CFS", sensor=8, duration="D"):
        return station, sensor, duration, units, d, "2024-01-05 12:00", value, " "

    given = [
        row("10"), row("10"), row("1", "2024-01-06 00:00"), row("2", "2024-01-06 00:00"), row(None, "2024-01-07 00:00"), row("---", "2024-01-08 00:00"), row("1d", "2024-01-09 00:00"), row("-9999", "2024-01-10 00:00"), row("-3", "2024-01-11 00:00"),
        row("Infinity", "2024-01-12 00:00"), row("1", "2025-01-01 00:00"), row("1", "no date"), row("1", units="AF"), row("1", station="B"), row("1", station=None), row("2", "2024-01-01 00:00", units="AF", sensor=65, duration="M"),
    ]
    schema = "station_id string, sensor_number int, duration_code string, units string, date string, obs_date string, value string, data_flag string"
    tasks = spark.createDataFrame([("A", r, date(2024, 1, 1), date(2024, 1, 31)) for r in ("daily", "daily", "monthly", "weekly")], "station_id string, resolution string, request_start date, request_end date")
    rows = spark.createDataFrame(given, schema)
    out = normalize.natural_flow(rows, tasks).collect()
    assert sorted(r["fault"] for r in out if r["fault"]) == ["conflict", "identity", "identity", "identity", "outside", "outside"]
    kept = {(r["duration_code"], r["period_label"]): (r["value_status"], r["value"]) for r in out if not r["fault"]}
    assert kept == {
        ("D", "2024-01-05"): ("numeric", 10.0), ("D", "2024-01-07"): ("missing", None), ("D", "2024-01-08"): ("missing", None), ("D", "2024-01-09"): ("nonnumeric", None), ("D", "2024-01-10"): ("missing_sentinel_-9999", None),
        ("D", "2024-01-11"): ("negative", -3.0), ("D", "2024-01-12"): ("nonnumeric", None), ("M", "2024-01"): ("numeric", 2.0),
    }
    first = next(r for r in out if r["period_label"] == "2024-01-05" and not r["fault"])
    assert (first["value_si"], first["stamp_utc"], first["observed_utc"]) == (10 * 0.028316846592, datetime(2024, 1, 5, 8), datetime(2024, 1, 5, 20))
    month = next(r for r in out if r["duration_code"] == "M")
    assert (month["value_si"], month["units_si"]) == (2 * 1233.48183754752, "m3")
    assert normalize.natural_flow(rows.limit(0), tasks).count() == 0


def feature(id, time="2024-01-01", value="10", series="T", **other):
    base = {"monitoring_location_id": "S", "time_series_id": series, "parameter_code": "00060", "statistic_id": "00003", "time": time, "value": value, "unit_of_measure": "ft^3/s", "approval_status": "Approved", "qualifier": None, "last_modified": None}
    return {"id": id, "properties": base | other}


def test_pages_and_daily_discharge(spark):
    good = [feature("a"), feature("b", "2024-01-02", None), feature("c", "2024-01-03", 7.5, qualifier=["e", "Rejected"]), feature("d", "2024-01-04", "-1", qualifier="invalid?"), feature("e", "2024-01-05", "2", qualifier="MISSING")]
    bad = [feature("f", "2024-01-06", unit_of_measure="m3/s"), feature("g", "2023-12-31"), feature("h", "2024-01-07"), feature("i", "2024-01-07"), feature("j", "2024-01-08", series="U"), feature("k", None)]
    page = lambda features, n=None, kind="FeatureCollection": json.dumps({"type": kind, "features": features} | ({"numberReturned": n} if n is not None else {}))
    pages = spark.createDataFrame([(1, page(good, 5)), (2, page(bad)), (3, page([], 1)), (4, "no json"), (5, None), (6, page([feature("a"), feature("")], 2, "Other"))], "page int, text string")
    features, faults = normalize.paged_features(pages, "page", "text")
    assert sorted(map(tuple, faults.collect()), key=str) == sorted([(3, None, "count"), (4, None, "invalid"), (5, None, "invalid"), (6, None, "invalid"), (6, "", "missing_id"), (None, "a", "repeated_id")], key=str)
    series = spark.createDataFrame([("S", "T"), ("S", "T")], "monitoring_location_id string, time_series_id string")
    out = normalize.daily_discharge(features.where("page < 3"), series, day("2024-01-01"), day("2024-01-31")).collect()
    assert sorted(r["fault"] for r in out if r["fault"]) == ["identity", "identity", "outside", "outside", "repeated"]
    assert {r["observation_id"]: (r["value_status"], r["discharge_cfs"]) for r in out if not r["fault"]} == {
        "a": ("numeric", 10.0), "b": ("missing_or_nonnumeric", None), "c": ("explicit_invalid_qualifier", None), "d": ("numeric_negative", -1.0), "e": ("explicit_invalid_qualifier", None),
    }
    assert next(r for r in out if r["fault"] == "repeated")["rows"] == 2


def test_entities_are_decoded_once(spark):
    texts = ["a &amp;lt; b", "&#38;amp;", "&#x26;lt;", "&#233;&#xE9;&#8364;&#128512;", "&lt;&gt;&quot;&apos;", "&#0;&#55296;&#9999999;&unknown;", None, ""]
    out = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(stations.decoded(F.col("t"))).collect()]
    assert out == ["a &lt; b", "&amp;", "&lt;", "éé€😀", "<>\"'", "&#0;&#55296;&#9999999;&unknown;", None, ""]
    assert spark.range(1).select(stations.clean(F.lit("<b>a</b>&nbsp;<br>&#160; b<!-- <i> -->\n c"))).head()[0] == "a b c"


def test_station_pages(spark):
    info = "<table id='tableInfo'><tr><td>Station ID</td><td>A</td><td>Latitude</td><td>38.5&deg;</td></tr><tr><td>Longitude</td><td>-200</td></tr></table>"
    sensor = "<tr><td>FLOW, FULL NATURAL, CFS</td><td>8</td><td>(daily)</td><td><a href='x?a=1&amp;sensor_no=77'>p</a></td><td>sat</td><td>01/01/2000 to present</td></tr>"
    sensors = lambda rows: f"<table><tr><th>Sensor Description</th><th>Sensor Number</th></tr>{rows}</table>"
    note = "<table><tr><td>01/02/2003</td><td>moved</td></tr><tr><td>x</td><td>y</td></tr></table>"
    right = info.replace("-200", "-120.25")
    pages = [
        ("A", f"<h2>Wrong</h2><h2>Right &amp; <i>good</i></h2>{right}<h2>After</h2>{sensors(sensor)}{note}"), ("B", f"<h2>N</h2>{info}{sensors(sensor + '<tr><td>1</td></tr>')}"), ("A", right.replace("<tr><td>Longitude", "<tr><td>odd</td><td>Longitude")),
        ("C", None), ("D", ""),
    ]
    out = [r.asDict(True) for r in stations.station_pages(spark.createDataFrame(pages, "id string, html string"), "id", "html").collect()]
    assert (out[0]["station_name"], out[0]["latitude"], out[0]["longitude"], out[0]["faults"]) == ("Right & good", 38.5, -120.25, [])
    assert out[0]["notes"] == [{"date_raw": "01/02/2003", "text": "moved"}]
    s = out[0]["sensors"][0]
    assert (s["sensor_number"], s["description"], s["units"], s["duration_code"], s["plot_sensor_id"], s["is_full_natural_flow"]) == (8, "FLOW, FULL NATURAL", "CFS", "D", "77", True)
    assert out[1]["faults"] == ["identity", "longitude", "sensor_row"] and len(out[1]["sensors"]) == 1
    assert "odd_cells" in out[2]["faults"] and "no_name" in out[2]["faults"] and "sensor_table" in out[2]["faults"]
    assert out[3]["faults"] == out[4]["faults"] == ["no_table", "latitude", "longitude", "sensor_table"] and out[3]["fields"] == {} and out[3]["sensors"] == []


def test_discharge_report(spark):
    d0 = date(2020, 1, 1)
    record = lambda k, v, series="p", approval="Approved", qualifier=None, station="A": (station, series, d0 + timedelta(days=k), v, approval, qualifier)
    rows = [record(k, 1.0) for k in range(366) if k not in (10, 11, 12)] + [record(370, 5.0), record(370, 6.0), record(371, None), record(400, -1.0, approval="Provisional", qualifier="e"), record(20, 9.0, series="q")]
    rows += [record(0, 2.0, series="n", station="B"), record(1, None, series="n", station="B"), record(0, 3.0, series="u", station="B")]
    records = spark.createDataFrame(rows, "station string, series string, day date, discharge double, approval string, qualifier string")
    series = spark.createDataFrame([("A", "p", True), ("A", "q", False), ("A", "p", True), ("B", "n", None), ("C", "x", True)], "station string, series string, primary boolean")
    out = {r["station"]: r for r in observations.discharge_report(records, series, day("2019-12-30"), day("2021-12-31")).collect()}
    a, b, c = out["A"], out["B"], out["C"]
    assert (a["policy"], a["rows"], a["series_returned"], a["conflicts"], a["negative_rows"], a["approved_days"], a["estimated_days"]) == ("primary_only", 368, 2, 1, 1, 363, 1)
    assert (a["observed_expected_days"], a["observed_valid_days"], a["observed_longest_gap"], a["years_with_data"], a["full_years"]) == (401, 364, 34, 2, 1)
    assert (a["requested_expected_days"], a["requested_longest_gap"]) == (733, 330)
    assert (b["policy"], b["observed_valid_days"], b["requested_longest_gap"]) == ("nonprimary_no_primary_metadata", 1, 730)
    assert (c["rows"], c["observed_valid_days"], c["requested_valid_days"], c["requested_completeness"], c["requested_longest_gap"]) == (0, None, 0, 0.0, 733)


def test_absent_periods(spark):
    rows = [("A", date(2024, 1, 1), 1.0, "x"), ("A", date(2024, 3, 1), None, " "), ("B", date(2024, 2, 1), None, None)]
    df = spark.createDataFrame(rows, "s string, p date, v double, f string")
    out = {r["s"]: r for r in observations.period_report(df, ["s"], "p", "v", "f", day("2024-01-01"), day("2024-04-01"), "1 MONTH").collect()}
    assert (out["A"]["absent"], out["A"]["absent_first"], out["A"]["absent_last"], out["A"]["latest_numeric"], out["A"]["flags"]) == (2, date(2024, 2, 1), date(2024, 4, 1), date(2024, 1, 1), "x")
    assert (out["B"]["absent"], out["B"]["latest_numeric"]) == (3, None)
    assert observations.absent_periods(df, ["s"], "p", day("2024-05-01"), day("2024-04-01"), "1 MONTH").count() == 0


def hours(n, first=0):
    return [datetime(2024, 1, 1) + timedelta(hours=first + k) for k in range(n)]


def test_daily_stream(spark):
    def whole(d, change=lambda k, t, r: r, n=24):
        return [change(k, t, (d, t, cell, 280.0, 1.0, 1.0, "r", True)) for k, t in enumerate(hours(n)) for cell in (0, 1)]

    put = lambda at, **kw: lambda k, t, r: tuple(kw.get(n, v) for n, v in zip(("d", "t", "cell", "t2d", "u2d", "v2d", "rev", "ok"), r)) if k == at else r
    rows = whole("good") + whole("short", n=23) + whole("hot", put(3, t2d=400.0)) + whole("mask", put(3, u2d=None)) + whole("old", put(3, rev=None)) + whole("refused", put(3, ok=None))
    rows += whole("empty", lambda k, t, r: (*r[:3], float("nan"), *r[4:])) + whole("uneven", lambda k, t, r: (r[0], t + timedelta(minutes=30), *r[2:]) if k == 5 else r) + whole("cells")[1:]
    df = spark.createDataFrame(rows, "day string, t timestamp, cell int, t2d double, u2d double, v2d double, rev string, ok boolean")
    run = lambda df: audit.daily_stream(df, [], "day", "t", {f: audit.LIMITS[f] for f in ("t2d", "u2d", "v2d")}, 2, ("u2d", "v2d"), ("rev", "r"), "ok")
    out = {r["day"]: r for r in run(df).collect()}
    assert {d: r["issues"] for d, r in out.items()} == {
        "good": [], "short": ["hours"], "hot": ["t2d_range"], "mask": ["masks"], "old": ["revision"], "refused": ["reconciliation"], "empty": ["t2d_empty"], "uneven": ["spacing"], "cells": ["grid"],
    }
    assert (out["good"]["t2d_finite"], out["empty"]["t2d_finite"], out["hot"]["t2d_greatest"]) == (48, 0, 400.0)
    assert run(df.limit(0)).count() == 0
    gate, reasons = audit.validation_gate(run(df).withColumn("all", F.lit(1)), ["all"], "issues")
    assert tuple(gate.head())[1:] == (9, 1, False) and reasons.count() == 8


def test_production_inventory(spark):
    rows = [("a", date(2024, 1, k), 10, False) for k in (1, 2, 2, 5, 9)] + [("a", date(2024, 1, 3), 1, True), ("a", None, 7, False), ("b", date(2024, 1, 4), 1, True)]
    df = spark.createDataFrame(rows, "s string, p date, size long, part boolean")
    out = {r["s"]: r for r in audit.production_inventory(df, ["s"], "p", "size", "part", shown=2).collect()}
    a, b = out["a"], out["b"]
    assert (a["unique"], a["files"], a["duplicates"], a["bytes"], a["segments"], a["partial_files"], a["undated_files"]) == (4, 5, 1, 50, 3, 1, 1)
    assert (a["missing"], a["missing_shown"], a["missing_truncated"]) == (5, [date(2024, 1, 3), date(2024, 1, 4)], True)
    assert (b["unique"], b["missing"], b["missing_shown"], b["partial_files"], b["first"]) == (0, 0, [], 1, None)
    held = {r["s"]: r["missing"] for r in audit.production_inventory(df, ["s"], "p", "size", "part", day("2024-01-02"), day("2024-01-06")).collect()}
    assert held == {"a": 3, "b": 5}
    months = spark.createDataFrame([("m", date(2023, 12, 5), 1, False), ("m", date(2024, 3, 9), 1, None)], "s string, p date, size long, part boolean")
    m = audit.production_inventory(months, ["s"], "p", "size", "part", monthly=True).head()
    assert (m["missing"], m["missing_shown"], m["segments"], m["first"]) == (2, [date(2024, 1, 1), date(2024, 2, 1)], 2, date(2023, 12, 1))


def test_record_stack(spark):
    d = date(2024, 1, 1)
    rows = [("f", d, t, 0, 1.0, 5) for t in hours(24)] + [("g", d, t, 0, 1.0, 6) for t in hours(24)]
    schema = "reach string, day date, t timestamp, input int, v double, order int"
    run = lambda rows, **kw: temporal.record_stack(spark.createDataFrame(rows, schema), ["reach"], "day", "t", "input", ["order"], **kw)
    assert tuple(run(rows)[1].head())[1:] == (24, True, [])
    overlap = [*rows, ("f", d, hours(1)[0], 1, 2.0, 5)]
    assert run(overlap)[1].head()["faults"] == ["repeated"]
    stack, days = run(overlap, replace=True)
    assert days.head()["faults"] == [] and sorted((r["reach"], r["v"]) for r in stack.where(F.hour("t") == 0).collect()) == [("f", 2.0)]
    moved = [*rows[:-1], ("g", d, hours(24)[23], 0, 1.0, 7)]
    assert run(moved)[1].head()["faults"] == ["static"]
    assert run(rows[:5] + rows[6:10])[1].head()["faults"] == ["gap"]
    assert run([*rows, ("f", d, datetime(2024, 1, 2), 0, 1.0, 5)])[1].head()["faults"] == ["outside"]


def test_sequence_faults(spark):
    rows = [("ok", t, 1.0) for t in hours(24, 1)] + [("ok", hours(1, 1)[0], None)] + [("bad", t, None if k == 0 else float("inf") if k == 1 else 1.0) for k, t in enumerate(hours(24, 2))]
    df = spark.createDataFrame(rows, "s string, t timestamp, v double")
    at = lambda k: F.lit(hours(1, k)[0])
    out = {r["s"]: tuple(r)[1:] for r in temporal.sequence_faults(df, ["s"], "t", "v", at(0), at(24)).collect()}
    assert out == {"ok": (24, 0, 0, 0, 0, True), "bad": (24, 1, 1, 2, 1, False)}


def test_signature_tells_order_free_changes(spark):
    sign = lambda rows: {r["k"]: r["signature"] for r in temporal.signature(spark.createDataFrame(rows, "k int, a string, b string"), ["k"], ["a", "b"]).collect()}
    one = sign([(1, "x", "y"), (1, "z", None), (2, "x", "y")])
    assert one[1] == sign([(1, "z", None), (1, "x", "y")])[1] and one[1] != one[2]
    assert len({sign([(1, a, b)])[1] for a, b in ((None, ""), ("", None), ("", ""), ("x|", "y"), ("x", "|y"))}) == 5
    assert sign([(1, "x", "y"), (1, "x", "y")])[1] != one[2]


@pytest.mark.parametrize("weight", [None, "w"])
def test_correlation_keeps_its_digits(spark, weight):
    rows = [("p", 90000 + k * 1e-3, 90000 + (k % 3) * 1e-3, 2.0) for k in range(6)] + [("r", k * 1e-7, k * 2e-7, 2.0) for k in range(4)] + [("c", 0.1, k * 1.0, 2.0) for k in range(3)]
    df = spark.createDataFrame(rows, "g string, r double, c double, w double")
    out = {r["g"]: r["correlation"] for r in evaluate.continuous_metrics(df, "r", "c", ["g"], weight=weight).collect()}
    assert abs(out["p"] - 0.4780914437) < 1e-6 and abs(out["r"] - 1) < 1e-9
    assert out["c"] is None
