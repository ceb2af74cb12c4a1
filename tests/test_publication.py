"""Small literal cases of coverage and publication checks, null and empty input among them."""

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridflume.checkpoints import checkpointed
from gridflume.operators import coverage, fill, publication


def test_nearest_native_crosses_the_date_line_and_the_pole(spark):
    schema = "k string, lat double, lon double"
    donors = spark.createDataFrame([("w", 10.0, 179.95), ("p", 89.95, 0.0), ("far", 40.0, 0.0), ("none", None, 1.0)], schema).withColumnRenamed("k", "src")
    targets = spark.createDataFrame([("a", 10.0, -179.95), ("b", 89.95, 180.0), ("c", 0.0, 0.0), ("d", None, None)], schema).withColumnRenamed("k", "dst")
    out = {r["dst"]: (r["src"], r["km"]) for r in coverage.nearest_native(targets, donors).collect()}
    assert out["a"][0] == "w" and abs(out["a"][1] - 6371 * math.radians(0.1) * math.cos(math.radians(10))) < 1e-3
    assert out["b"][0] == "p" and abs(out["b"][1] - 6371 * math.radians(0.1)) < 1e-3
    assert out["c"] == out["d"] == (None, None)
    assert coverage.nearest_native(targets, donors.limit(0)).where("src is not null").count() == 0
    with pytest.raises(ValueError):
        coverage.nearest_native(targets, donors, 0)


def test_gap_categories(spark):
    cells = spark.createDataFrame([(0, x, x != 4, None if x in (1, 4, 5, 6) else 1.0) for x in range(8)], "y long, x long, land boolean, v double")
    mapped = spark.createDataFrame([(0, 6)], "y long, x long")
    out = checkpointed(spark, lambda: coverage.gap_categories(cells, ["v"], F.col("land"), mapped, 1.0))
    assert [r["category"] for r in out.orderBy("x").collect()] == [0, 2, 0, 0, 1, 3, 2, 0]
    alone = checkpointed(spark, lambda: coverage.gap_categories(cells.withColumn("v", F.lit(None).cast("double")), ["v"], F.lit(True), mapped, 1.0))
    assert [r["category"] for r in alone.orderBy("x").collect()] == [3, 3, 3, 3, 3, 3, 4, 3]


def test_raster_sample_makes_up_for_absent_cells(spark):
    raster = spark.createDataFrame([(0, 0, 1.0), (0, 1, None), (1, 0, 3.0), (1, 1, 5.0)], "row long, col long, value double")
    targets = spark.createDataFrame([("mid", 1.0, -1.0), ("corner", 0.5, -0.5), ("out", 0.4, -1.0), ("null", None, -1.0)], "dst string, lon double, lat double")
    out = {r["dst"]: r["height"] for r in coverage.raster_sample(targets, raster, 0.0, 0.0, 1.0, 1.0, 2, 2).collect()}
    assert out == {"mid": 3.0, "corner": 1.0, "out": None, "null": None}


def test_day_archives(spark):
    at = lambda d, h, m=0: datetime(2024, 1, d) + timedelta(hours=h, minutes=m)
    rows = [(at(1, h), h, "a") for h in range(24)] + [(at(2, h), h, "a") for h in range(23)] + [(at(3, h), -h, "a") for h in range(24)] + [(at(4, h), h, "b" if h == 3 else "a") for h in range(24)] + [(at(5, h, 1), h, "a") for h in range(24)] + [(at(6, h), h, None) for h in range(24)]
    out = publication.day_archives(spark.createDataFrame([("k", *r) for r in rows], "k string, t timestamp, p int, s string"), ["k"], "t", "p", "s")
    assert [r["fault"] for r in out.orderBy("day").collect()] == [None, "count", "order", "schema", "hours", "schema"]


def test_accepted_months_and_final_audit(spark):
    schema = "stream string, day date, records int, calendar_day boolean, reconciled boolean, revisions array<string>"
    whole = [("retro", date(2024, 2, d), 24, True, True, ["stable"]) for d in range(1, 30)]
    odd = [("retro", date(2024, 3, 1), 24, True, True, []), ("nrt", date(2024, 3, 1), 24, True, None, None), ("nrt", date(2024, 4, 1), 24, True, True, None)]
    days = publication.accepted_days(spark.createDataFrame(whole + odd, schema))
    assert [r["ok"] for r in days.where("day >= '2024-03-01'").orderBy("day", "stream").collect()] == [False, False, True]
    assert [(r["month"], r["accepted"]) for r in publication.accepted_months(days, ["stream"], "day").where("accepted").collect()] == [(date(2024, 2, 1), True)]
    hours = spark.createDataFrame([(h, 1.0 if h else float("nan"), True) for h in range(24)], "h int, v double, on boolean")
    audit = lambda df: publication.final_audit(df, [], F.col("h"), ["v"], F.col("on"), F.lit(True), F.lit(None).cast("boolean"), F.lit(False)).head()
    assert (audit(hours)["holes"], audit(hours)["passed"]) == (1, False)
    assert audit(hours.withColumn("v", F.lit(1.0)))["passed"] and not audit(hours.where("h < 23").withColumn("v", F.lit(1.0)))["hours_exact"]


def test_propagated_crosses_water_but_changes_approved_land_only(spark):
    nan = float("nan")
    row = [(0, 0, 1.0, True, True), (0, 1, None, False, True), (0, 2, nan, True, True), (0, 3, None, True, False), (0, 4, None, True, True), (0, 5, 9.0, True, True), (5, 5, None, True, True)]
    cells = spark.createDataFrame(row, "y long, x long, v double, land boolean, ok boolean")
    out = checkpointed(spark, lambda: fill.propagated(cells, "v", F.col("land"), F.col("ok"), 4))
    got = [(r["value"], r["distance"], r["fault"]) for r in out.orderBy("y", "x").collect()]
    assert got == [(1.0, 0, None), (None, 0, None), (1.0, 2, None), (None, 0, "unapproved"), (9.0, 1, None), (9.0, 0, None), (None, 0, "too_far")]
    alone = checkpointed(spark, lambda: fill.propagated(cells, "v", F.lit(False), F.lit(True), 4))
    assert alone.where("fault is not null or distance > 0").count() == 0 and checkpointed(spark, lambda: fill.propagated(cells.limit(0), "v", F.col("land"), F.col("ok"), 4)).count() == 0
