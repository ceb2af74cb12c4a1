"""Small literal cases of quantiles, statistics by lead, coverage by names, requests, crosswalk, checkpoints and retention."""

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflume.operators import evaluate, incremental, observations
from gridflume.sources import catalogue, normalize


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_are_exact(spark, accuracy):
    rng = np.random.default_rng(3)
    groups = {"ties": [0.0] * 700 + list(rng.random(300)), "smooth": list(rng.normal(size=2000)), "two": [1.0, 2.0], "one": [5.0], None: list(rng.integers(0, 9, 500) * 1.0)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("none", float("nan")), ("two", None)]
    marks = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    out = {r["g"]: [r[m] for m in marks] for r in evaluate.quantiles(df, ["g"], "v", marks, accuracy).collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(out[g], np.quantile(vs, list(marks.values())), rtol=0, atol=1e-12)
    whole = evaluate.quantiles(df, [], "v", marks, accuracy).head()
    assert np.allclose(list(whole), np.quantile([v for vs in groups.values() for v in vs], list(marks.values())), rtol=0, atol=1e-12)
    assert evaluate.quantiles(df.limit(0), ["g"], "v", marks, accuracy).count() == 0


def test_hourly_statistic(spark):
    rows = [("a", 0, 1, 10.0), ("a", 0, 2, 8.0), ("a", 0, 4, 8.0), ("a", 6, 7, 3.0), ("a", 6, 8, 1.45), ("a", 6, 9, 0.5), ("b", 0, 0, 1.0), ("b", 0, 1, None), ("b", 0, 2, 1.0), ("c", 0, 1, 1.0), ("c", 0, 1, 2.0), ("c", 0, 2, 2.0)]
    df = spark.createDataFrame(rows, "k string, s int, lead int, v double")
    out = {(r["k"], r["s"], r["lead"]): (r["hour_value"], r["clipped"], r["fault"]) for r in normalize.hourly_statistic(df, ["k"], "s", "lead", "v", True, 0.2).collect()}
    assert out["a", 0, 1] == (10.0, False, None) and out["a", 0, 2] == (6.0, False, None) and out["a", 0, 4] == (None, False, "no_previous")
    assert out["a", 6, 8] == (0.0, True, None) and out["a", 6, 9] == (None, False, "negative")
    assert [out["b", 0, k][2] for k in (0, 1, 2)] == ["interval", "missing", "missing"] and [out["c", 0, k][2] for k in (1, 2)] == ["repeated", "repeated"]
    sums = {r["lead"]: r["hour_value"] for r in normalize.hourly_statistic(df.where("k = 'a' and s = 6"), ["k"], "s", "lead", "v", False, 2.0).collect()}
    assert sums == {7: 3.0, 8: 0.0, 9: 0.0}


def test_latest_coverage(spark):
    names = ["x/h.A20240102.0300.nc", "h.A20240101.2300.nc", "h.A20249999.0000.nc", "day_20230101.nc", "other", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    out = {r["product"]: tuple(r)[1:] for r in catalogue.latest_coverage(df, "path", {"h": (r"\.A(\d{8})\.(\d{4})\.", "yyyyMMddHHmm"), "d": (r"^day_(\d{8})\.nc$", "yyyyMMdd"), "n": (r"^never(\d{8})$", "yyyyMMdd")}).collect()}
    assert out == {"h": (datetime(2024, 1, 2, 3), 2, 1), "d": (datetime(2023, 1, 1), 1, 0), "n": (None, 0, 0)}


def test_request_windows(spark):
    rows = [("d", "D", date(2010, 1, 1), None, date(2024, 6, 1)), ("h", "H", date(2022, 3, 1), None, date(2023, 12, 30)), ("m", "M", date(2000, 1, 1), date(2001, 1, 1), None), ("n", "E", date(2024, 1, 1), None, None), ("late", "D", date(2025, 1, 1), None, date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "s string, duration_code string, start date, advertised_end date, checked_through date")
    today = F.lit("2024-06-02").cast("date")
    run = lambda update: [(r["s"], r["request_start"], r["request_end"], r["fault"]) for r in observations.request_windows(df, ["s"], today, update).orderBy("place").collect()]
    assert sorted(run(True), key=str) == sorted([
        ("d", date(2023, 4, 29), date(2024, 6, 2), None), ("h", date(2023, 12, 31), date(2023, 12, 31), None), ("h", date(2024, 1, 1), date(2024, 6, 2), None), ("m", date(2000, 1, 1), date(2001, 1, 1), None), ("n", date(2024, 1, 1), date(2024, 6, 2), "no_backfill"),
    ], key=str)
    full = run(False)
    assert [r[0] for r in full[:2]] == ["d", "m"] and [r[1] for r in full if r[0] == "h"] == [date(2024, 1, 1), date(2023, 1, 1), date(2022, 3, 1)] and not any(r[3] for r in full)
    ids = observations.request_windows(df, ["s"], today)
    assert ids.select("request_id").distinct().count() == ids.count() == len(full)


def test_gauge_crosswalk(spark):
    mapping = spark.createDataFrame([(" 12345678", "7"), ("12345678901", "8"), ("12345678901", "9"), ("1234567", "1"), ("AB345678", "2"), ("99999999", "3"), (None, "4")], "gauge string, feature_id string")
    stations = spark.createDataFrame([("USGS-12345678",), ("USGS-12345678",), ("USGS-12345678901",), ("USGS-1234567",), ("USGS-99999999",), (None,)], "station string")
    series = spark.createDataFrame([("USGS-12345678", "a"), ("USGS-12345678", "a"), ("USGS-12345678901", "b")], "station string, series string")
    domains = spark.createDataFrame([("z", "USGS-12345678"), ("a", "USGS-12345678"), ("a", "USGS-0")], "domain string, station string")
    out = {r["station"]: tuple(r)[1:] for r in observations.gauge_crosswalk(mapping, stations, series, domains).collect()}
    assert out == {"USGS-12345678": ("7", 1, ["a", "z"], None), "USGS-12345678901": ("8", 1, [], "mapping"), "USGS-99999999": ("3", 0, [], "no_series")}


def test_checkpoints_and_retention(spark):
    at = lambda d, h=0: datetime(2024, 1, d, h)
    checkpoints = spark.createDataFrame([("a", at(1)), ("a", at(3)), ("a", at(5))], "k string, stamp timestamp")
    asked = spark.createDataFrame([(1, "a", at(6), at(9)), (2, "a", at(6), at(4)), (3, "a", at(6), None), (4, "a", at(1, 12), at(9)), (5, "b", at(6), at(9))], "id int, k string, e timestamp, p timestamp")
    out = {r["id"]: r["latest"] for r in incremental.checkpoint_before(asked, checkpoints, ["k"], "e", "stamp", "24 HOURS", "p").collect()}
    assert out == {1: at(5), 2: at(3), 3: None, 4: None, 5: None}
    rows = [("a", at(10), 5), ("a", at(9), 5), ("a", at(8), 5), ("a", at(1), 5), ("a", None, 5), ("b", at(10), 50), ("b", at(10), 60)]
    df = spark.createDataFrame(rows, "k string, t timestamp, n int")
    gone = incremental.expired(df, ["k"], "t", F.lit("2024-01-10").cast("timestamp"), "n", 2, 100, 5).collect()
    assert sorted((r["k"], str(r["t"])[:10], r["reason"]) for r in gone) == [("a", "2024-01-01", "age"), ("a", "2024-01-08", "entries"), ("a", "None", "age"), ("b", "2024-01-10", "bytes")]
