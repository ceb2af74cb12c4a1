"""Small literal cases of source normalising, null and empty input among them."""

from datetime import date, datetime

from pyspark.sql import functions as F

from gridflume.sources import normalize


def test_forcing_takes_one_exact_time(spark):
    names = list(normalize.FORCING_NAMES["nldas2"])
    at = datetime(2024, 1, 1, 6)
    given = [(1, at, 1.0), (1, datetime(2024, 1, 1, 7), 2.0), (2, at, 3.0), (2, at, 4.0), (3, None, 5.0)]
    df = spark.createDataFrame([(k, t, *[v] * 8) for k, t, v in given], "cell int, time timestamp, " + ", ".join(f"`{n}` double" for n in names))
    out = {r["cell"]: r for r in normalize.forcing(df, "nldas2", ["cell"], F.col("time"), F.lit(at)).collect()}
    assert [(out[k]["matches"], out[k]["air_temperature"]) for k in (1, 2, 3)] == [(1, 1.0), (2, None), (0, None)]
    assert out[1]["wind_orientation"] == "earth_relative"
    assert normalize.forcing(df.limit(0), "nldas2", ["cell"], F.col("time"), F.lit(at)).count() == 0


def test_snow_crops_pads_and_finds_conflicts(spark):
    rows = [
        ("A", 3, "D", "INCHES", d, None, v, " ")
        for d, v in [("2024-01-02 00:00", "2"), ("2024-01-04 00:00", "1"), ("2024-01-05 00:00", "10"), ("2024-01-05 00:00", "10"), ("2024-01-06 00:00", "1"), ("2024-01-06 00:00", "2"), ("2024-01-07 00:00", None), (None, "3")]
    ]
    df = spark.createDataFrame([*rows, ("B", 3, "D", "INCHES", "2024-01-05 00:00", None, "1", None)], "station_id string, sensor_number int, duration_code string, units string, date string, obs_date string, value string, data_flag string")
    tasks = spark.createDataFrame([("A", 3, "D", date(2024, 1, 5), date(2024, 1, 9))], "station_id string, sensor_number int, duration_code string, request_start date, request_end date")
    out = {(r["station_id"], r["provider_date"]): r for r in normalize.snow(df, tasks).collect()}
    assert {k: r["fault"] for k, r in out.items()} == {
        ("A", "2024-01-02 00:00"): "outside", ("A", "2024-01-05 00:00"): None, ("A", "2024-01-06 00:00"): "conflict", ("A", "2024-01-07 00:00"): None, ("A", None): "outside", ("B", "2024-01-05 00:00"): "identity",
    }
    day = out["A", "2024-01-05 00:00"]
    assert (day["swe_mm"], day["stamp_utc"]) == (254.0, datetime(2024, 1, 5, 8)) and out["A", "2024-01-07 00:00"]["value_status"] == "missing_or_nonnumeric"


def test_series_of_stations(spark):
    sensor = "struct<sensor_number: int, duration_code: string, units: string, advertised_availability: string>"
    rows = [("A", [(8, "D", "CFS", "01/02/2000 to present"), (3, "D", "INCHES", " to 03/04/2010"), (3, "M", "INCHES", "none")]), ("B", None), ("C", [(8, "D", "AF", "x"), (82, "D", "INCHES", "01/01/2001 to present"), (82, "D", "INCHES", "01/01/2001 to present")])]
    df = spark.createDataFrame(rows, f"station_id string, sensors array<{sensor}>")
    flow = {r["station_id"]: (r["start"], r["fault"]) for r in normalize.flow_series(df, [("daily", 8, "D", "CFS")]).collect()}
    assert flow == {"A": (date(2000, 1, 2), None), "B": (None, "missing"), "C": (None, "units")}
    assert {r["station_id"] for r in normalize.flow_series(df, [("daily", 8, "D", "CFS")], [("B", "daily")]).collect()} == {"A", "C"}
    snow = [(r["station_id"], r["start"], r["advertised_end"], r["fault"]) for r in normalize.snow_series(df, [3, 82], {"D": "daily", "M": "monthly"}).collect()]
    assert sorted(snow, key=str) == sorted([("A", date(1800, 1, 1), date(2010, 3, 4), None), ("A", None, None, "availability"), ("C", date(2001, 1, 1), None, "repeated"), ("C", date(2001, 1, 1), None, "repeated")], key=str)


def test_climate_station_lines(spark):
    f = ["7", "20240101", "100", *["0"] * 3, "-120.5", "38.5", "0", "2.7", *["0"] * 3, "500", "3", *["0"] * 11, "45", "0", *["0"] * 10]
    cold = [*f[:9], "-9999.0", *f[10:]]
    out = [tuple(r) for r in normalize.climate_station_hours(spark.createDataFrame([(" ".join(f),), ("  " + "   ".join(cold),), ("1 2 3",), (None,)], "value string")).drop("value").collect()]
    assert len(f) == 38 and out[0] == ("7", datetime(2024, 1, 1, 1), -120.5, 38.5, 2.7 + 273.15, None, 0.45, None)
    assert out[1][4] is None and [r[-1] for r in out[2:]] == ["columns", "columns"]


def test_index_lines_that_cannot_be_read_are_left_out(spark):
    from gridflume.sources import catalogue

    text = ["1:0:d=2024:TMP:2 m:anl:", "2:100:d=2024:TMP:2 m:1 hour fcst:", "no line", "x:150:d=2024:A:B:C", "3:1e3:d=2024:A:B:C", " 4 :+300:d=2024:RH:2 m:anl", "5:400:d=2024:RH:2 m:anl:more:fields", None, "6:500:d:U"]
    lines = spark.createDataFrame([("f", k, x) for k, x in enumerate(text)] + [("g", 0, "1:7:d:TMP:2 m:anl")], "file string, place int, line string")
    found = catalogue.index_ranges(lines, "file", "place", "line")
    assert sorted((r["file"], r["number"], r["first_byte"], r["last_byte"]) for r in found.where("last_byte is not null").collect()) == [("f", 1, 0, 99), ("f", 2, 100, 299), ("f", 4, 300, 399)]
    got = {(r["file"], r["variable"]): (r["first_byte"], r["last_byte"], r["fault"]) for r in catalogue.selected_ranges(found, "file", [("TMP", "2 m", "anl"), ("RH", "2 m", "anl"), ("A", "B", "C")]).collect()}
    assert got == {("f", "TMP"): (0, 99, None), ("f", "RH"): (None, None, "repeated"), ("f", "A"): (None, None, "absent"), ("g", "TMP"): (None, None, "no_end"), ("g", "RH"): (None, None, "absent"), ("g", "A"): (None, None, "absent")}
