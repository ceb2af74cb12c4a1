"""Small literal cases of monthly audits, published hours, whole days and subset networks, null and empty input among them."""

from gridflume.checkpoints import checkpointed
from gridflume.operators import audit, network, reconcile, regrid


def test_monthly_audit(spark):
    hours = spark.createDataFrame([("a", d, float(h), 280.0 + h) for d in (1, 2) for h in range(3)], "cell string, day int, depth double, t double")
    want = spark.createDataFrame([("a", 6.0, 280.0, 282.0)], "cell string, depth double, mean_low double, mean_high double")
    check = lambda h, w, **k: reconcile.monthly_audit(h, w, "cell", "day", "depth", "t", **k).head()
    assert check(hours, want)["passed"] and not check(hours, want, most_hourly=1.5)["passed"]
    off = want.withColumn("depth", want["depth"] + 0.1)
    assert abs(check(hours, off)["depth_error"] - 0.1) < 1e-9 and not check(hours, off)["passed"]
    assert (check(hours.limit(0), want)["unmatched"], check(hours.limit(0), want)["passed"]) == (1, False)


def test_constraint_provenance_and_published_hours(spark):
    hours = spark.createDataFrame([(1, "r", 0.5, 4), (1, "r", 0.0, 0), (2, "r", 1.0, None), (3, "r", None, 0)], "src long, region string, depth double, qc int")
    targets = spark.createDataFrame([(10, 16), (11, 0), (12, 20)], "dst long, flags int")
    links = spark.createDataFrame([(1, 10, 1.0), (1, 12, 1.0), (2, 11, 1.0), (3, 11, 0.0), (3, 99, 1.0)], "src long, dst long, weight double")
    out = {r["kind"]: (r["cell_hours"], r["wet_cell_hours"], r["qc_clip"]) for r in reconcile.constraint_provenance(hours, targets, links, ["region"], {"clip": 4}).collect()}
    assert out == {"capped": (2, 1, 1), "base_dry": (2, 1, 1), "clean": (1, 1, 0)}
    given = spark.createDataFrame([(1, 0, 7200.0, 280.0), (1, 1, None, None)], "cell long, hour int, corrected double, temperature double")
    over = spark.createDataFrame([(1, 1, 290.0)], "cell long, hour int, temperature double")
    sent = reconcile.published_hours(given, over, ["cell", "hour"], spark.createDataFrame([(False,)], "accepted boolean"))
    assert [tuple(r) for r in sent.orderBy("hour").collect()] == [(1, 0, 2.0, 280.0, False, False), (1, 1, None, 290.0, True, False)]


def test_whole_days_only(spark):
    hours = spark.createDataFrame([(1, "a", h, 1.0) for h in range(24)] + [(1, "b", h, 1.0) for h in range(23)], "src long, day string, hour int, v double")
    links = spark.createDataFrame([(1, 5, 2.0), (1, 6, None), (1, 7, -1.0)], "src long, dst long, weight double")
    out = regrid.remap_day(hours, links, ["v"], "day", "hour").collect()
    assert len(out) == 24 and {(r["day"], r["dst"], r["v"]) for r in out} == {("a", 5, 1.0)}
    checked = {r["day"]: r["passed"] for r in audit.hourly_day(hours, ["day"], "hour", {"v": (0.0, 2.0)}).collect()}
    assert checked == {"a": True, "b": False}


def test_subset_network(spark):
    rows = [(50, 0, 30.0, -100.0), (10, 30, 30.0, -100.0), (20, 30, 60.0, -100.0), (30, 40, 60.0, -100.0), (40, 99, None, None), (60, 60, float("nan"), -100.0)]
    reaches = spark.createDataFrame(rows, "link long, to_link long, lat double, lon double")
    out = checkpointed(spark, lambda: network.subset_network(reaches, 25, 35, -110, -90))
    assert [(r["link"], r["to_link"], r["index"]) for r in out.orderBy("link").collect()] == [(10, 30, 0), (30, 40, 1), (40, 0, 2), (50, 0, 3)]
    assert checkpointed(spark, lambda: network.subset_network(reaches.limit(0), 25, 35, -110, -90)).count() == 0


def test_quality_bits_are_the_fixed_ones(spark):
    from gridflume.operators import bundle

    names = ("TARGET_MISSING", "TARGET_DRY", "BASE_DRY", "SYNTHETIC", "RATIO_CAPPED", "NOT_CONVERGED")
    assert [getattr(reconcile, n) for n in names] == [1, 2, 4, 8, 16, 32]
    df = spark.createDataFrame([(1, 1500.0, 1.0), (2, None, 1.0), (3, 20.0, None), (4, 20.0, 1.0)], "id int, shortwave double, east double")
    noon = df.selectExpr("*", "timestamp'2024-06-21 19:00:00' AS ts", "35.0D AS lat", "-105.0D AS lon", "1.0D AS north", "id = 4 AS negative")
    assert {r["id"]: r["radiation_qc"] for r in bundle.target_radiation(noon).collect()} == {1: 8, 2: 4, 3: 4, 4: 1}


def test_targets_of_each_flag_count_once(spark):
    targets = spark.createDataFrame([(1.0, 0.0, f) for f in (0, 1, 2, 4, 8, 16, 32, 12)], "total double, residual double, flags int")
    r = reconcile.acceptance(targets).head()
    assert (r["constrained_cells"], r["capped"] * 7, r["unconverged"] * 7, r["unhandled_dry"] * 7, r["synthetic"] * 7) == (7, 1, 1, 1, 2)
