"""Repairs against brute force, and that their proofs fail where they should."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflume.operators import fill, repair


def nearest(cell, donors):
    return min(donors, key=lambda d: ((d[0] - cell[0]) ** 2 + (d[1] - cell[1]) ** 2, d))


def grid_case(rng, side=9, hours=12, kinds=3):
    cells = [(y, x, bool(rng.random() < 0.6), bool(rng.random() < 0.9), bool(rng.random() < 0.1)) for y in range(side) for x in range(side)]
    masks = [rng.random((side, side)) < 0.3 for _ in range(kinds)]
    rows = [(h, y, x, None if masks[h % kinds][y, x] else float(h * 100 + y * 10 + x), None if masks[(h + 1) % kinds][y, x] else float(h)) for h in range(hours) for y, x, *_ in cells]
    return cells, rows


def test_holes_are_filled_by_one_search_a_mask(spark, monkeypatch):
    cells, rows = grid_case(np.random.default_rng(21))
    searched = []
    real = fill.nearest_donor
    monkeypatch.setattr(fill, "nearest_donor", lambda g, d, **k: searched.append((g.select("mask").distinct().count(), g.count())) or real(g, d, **k))
    df, at = spark.createDataFrame(rows, "hour int, y long, x long, a double, b double"), spark.createDataFrame(cells, "y long, x long, active boolean, keep boolean, gap boolean")
    got = {(r["hour"], r["y"], r["x"]): r for r in repair.fill_active_holes(df, ["hour"], ["a", "b"], at).collect()}
    holes = 0
    for k, f in ((3, "a"), (4, "b")):
        for h in range(12):
            value = {(r[1], r[2]): r[k] for r in rows if r[0] == h}
            donors = [(y, x) for y, x, _, keep, gap in cells if value[y, x] is not None and keep and not gap]
            for y, x, active, _, gap in cells:
                hole = value[y, x] is None and active and not gap
                holes += hole
                want = value[nearest((y, x), donors)] if hole else value[y, x]
                r = got[h, y, x]
                assert (r[f], r[f"{f}_filled"], r[f"{f}_fault"]) == (want, hole, None)
    # 12 hours of two fields, three masks
    assert len(searched) == 1 and searched[0][0] == 3 and searched[0][1] * 8 == holes


def test_a_record_without_donors_says_so(spark):
    df = spark.createDataFrame([(1, 0, 0, None), (1, 0, 1, None), (2, 0, 0, None), (2, 0, 1, 5.0)], "hour int, y long, x long, a double")
    at = spark.createDataFrame([(0, 0, True, True, False), (0, 1, False, True, False)], "y long, x long, active boolean, keep boolean, gap boolean")
    got = sorted((r["hour"], r["x"], r["a"], r["a_filled"], r["a_fault"]) for r in repair.fill_active_holes(df, ["hour"], ["a"], at).collect())
    assert got == [(1, 0, None, False, "no_donor"), (1, 1, None, False, None), (2, 0, 5.0, True, None), (2, 1, 5.0, False, None)]


def test_domain_repair_proves_that_nothing_else_changed(spark):
    rng = np.random.default_rng(22)
    _, rows = grid_case(rng, hours=4)
    cells = [(y, x, 1 <= y < 8, 1 <= y < 8 and rng.random() < 0.5) for y in range(9) for x in range(9)]
    df = spark.createDataFrame(rows, "hour int, y long, x long, a double, b double")
    at = spark.createDataFrame([(y, x, bool(d), bool(land)) for y, x, d, land in cells], "y long, x long, domain boolean, land boolean")
    fixed, report = repair.domain_repair(df, ["hour"], ["a", "b"], at)
    got = {(r["hour"], r["y"], r["x"]): r for r in fixed.collect()}
    told = {r["field"]: r for r in report.collect()}
    for k, f in ((3, "a"), (4, "b")):
        filled = masked = 0
        for h in range(4):
            value = {(r[1], r[2]): r[k] for r in rows if r[0] == h}
            donors = [(y, x) for y, x, d, _ in cells if d and value[y, x] is not None]
            for y, x, d, land in cells:
                hole = land and value[y, x] is None
                filled, masked = filled + bool(hole), masked + (not d and value[y, x] is not None)
                assert got[h, y, x][f] == (None if not d else value[nearest((y, x), donors)] if hole else value[y, x])
        assert (told[f]["filled"], told[f]["masked"], told[f]["complete"]) == (filled, masked, True)
    # changed by hand: off land, on land that was there, land that still lacks, a value outside
    def verdict(where, to):
        changed = fixed.withColumn("a", F.when(F.expr(where), to).otherwise(F.col("a")))
        r = {x["field"]: x for x in repair.proof(df, changed, ["hour"], ["a", "b"], at).collect()}
        assert r["b"]["complete"]
        return [k for k in ("inactive_same", "active_same") if not r["a"][k]] + [k for k in ("missing_land", "valid_outside") if r["a"][k]]

    off = next((y, x) for y, x, d, land in cells if d and not land and any(r[0] == 1 and (r[1], r[2]) == (y, x) and r[3] is not None for r in rows))
    on = next((y, x) for y, x, d, land in cells if land and any(r[0] == 1 and (r[1], r[2]) == (y, x) and r[3] is not None for r in rows))
    where = lambda c: f"hour = 1 and y = {c[0]} and x = {c[1]}"
    assert verdict(where(off), F.col("a") + 1e-9) == ["inactive_same"] and verdict(where(on), F.col("a") + 1e-9) == ["active_same"]
    assert verdict(where(on), F.lit(None)) == ["active_same", "missing_land"] and verdict("hour = 1 and y = 0 and x = 0", F.lit(1.0)) == ["valid_outside"]
    with pytest.raises(Exception, match="beyond the domain"):
        repair.domain_repair(df, ["hour"], ["a"], at.withColumn("land", F.lit(True)))[0].count()


def test_preflight_tells_transient_from_persistent_gaps(spark):
    t = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    rows = [(t(h), 0, x, None if x == 1 or (x == 2 and h == 1) else 1.0, None if x == 3 else 2.0) for h in range(4) for x in range(4)]
    cells = spark.createDataFrame([(0, 0, True), (0, 1, True), (0, 2, True), (0, 3, False), (0, 9, True)], "y long, x long, land boolean")
    df = spark.createDataFrame(rows, "t timestamp, y long, x long, a double, b double")
    check = lambda d: [(r["field"], r["missing"], r["transient"], r["persistent_cells"], r["hours"], r["continuous"], r["issues"]) for r in repair.preflight(d, "t", ["a", "b"], cells)[0].orderBy("field").collect()]
    # cell 9 has no row at all
    assert check(df) == [("a", 9, 1, 2, 4, True, ["transient_gaps"]), ("b", 4, 0, 2, 4, True, [])]
    assert sorted(tuple(r) for r in repair.preflight(df, "t", ["a", "b"], cells)[1].collect()) == [(0, 1), (0, 9)]
    gone = check(df.where(F.col("t") != F.lit(t(2))))
    assert gone == [("a", 7, 1, 2, 3, False, ["not_hourly", "transient_gaps"]), ("b", 3, 0, 2, 3, False, ["not_hourly"])]


FIELDS = "t double, q double, p double, lw double, u double, v double, sw double, rain double"
GOOD = (285.0, 0.006, 90000.0, 300.0, 3.0, -2.0, 400.0, 0.001)


def test_native_repair_keeps_the_state_consistent(spark):
    native = [(1, 40.0, -100.0, 500.0, *GOOD), (2, 40.05, -100.0, 500.0, *GOOD[:6], -5.0, None), (3, 40.3, -100.0, 800.0, *GOOD)]
    none = (None,) * 8
    primary = [
        (1, 40.04, -100.0, 500.0, None, True, *none), (2, 40.04, -100.0, None, 700.0, True, None, *GOOD[1:]), (3, 40.04, -100.0, None, None, True, *none[:4], *GOOD[4:]),
        (4, 45.0, -100.0, 0.0, None, True, *GOOD[:7], None), (5, 40.0, -100.0, 0.0, None, False, *none), (6, 40.0, -100.0, 0.0, None, True, *GOOD), (7, 40.0, -100.0, 0.0, None, True, *GOOD[:4], float("nan"), *GOOD[5:]),
    ]
    n = spark.createDataFrame(native, f"src long, lat double, lon double, z0 double, {FIELDS}")
    p = spark.createDataFrame(primary, f"dst long, lat double, lon double, z double, model_z double, active boolean, {FIELDS}")
    got = {r["dst"]: r for r in repair.native_repair(p, n).collect()}
    assert {k: (r["flags"], r["fault"]) for k, r in got.items()} == {1: (15, None), 2: (17, None), 3: (0, "no_elevation"), 4: (0, "no_donor"), 5: (0, None), 6: (0, None), 7: (2, None)}
    # at the donor's own elevation the state comes back as it was
    assert np.allclose([got[1][f] for f in ("t", "q", "p", "lw")], GOOD[:4], rtol=1e-9)
    # shortwave and rain come from a cell that has them, farther off than the first choice for wind
    assert got[1]["sw"] == 400.0 and got[1]["rain"] == 0.001 and got[1]["km"] == pytest.approx(6371 * np.radians(0.04), rel=1e-6)
    assert got[2]["t"] == pytest.approx(285.0 - 0.0065 * 200, abs=0.01) and got[2]["p"] < 90000 and got[2]["u"] == 3.0
    assert (got[7]["u"], got[7]["v"], got[7]["km"]) == (3.0, -2.0, 0.0)


def test_gaps_outside_the_native_grid_and_their_hour(spark):
    rows = [(1, 38.5, -97.5, True, True, 100.0, None), (2, 60.0, -97.5, True, True, None, 250.0), (3, 60.0, -97.5, True, False, None, 250.0), (4, 60.0, -97.5, True, True, None, 9500.0), (5, 60.0, -97.5, False, True, 5.0, None), (6, None, -97.5, True, True, 5.0, None)]
    t = spark.createDataFrame(rows, "dst long, lat double, lon double, keep boolean, active boolean, elevation double, model_elevation double")
    place = t.where("dst = 1").select(*(c.alias(n) for n, c in zip("xy", repair.physics.lambert_coordinates(F.col("lat"), F.col("lon"), -97.5, 38.5), strict=True))).head()
    found = repair.gap_geometry(t, (place["x"] - 0.05, place["y"] - 0.05), (0.01, 0.01), (11, 11))
    got = {r["dst"]: (r["z1"], r["from_model"], r["excluded"], r["fault"]) for r in found.collect()}
    assert got == {2: (250.0, True, False, None), 3: (None, False, True, None), 4: (None, False, False, "no_elevation"), 6: (5.0, False, False, None)}
    source = spark.createDataFrame([(k, *GOOD[:4], 500.0, GOOD[6], GOOD[4], GOOD[5], 3.6 * k) for k in (1, 2)] + [(3, *GOOD[:4], 500.0, None, 1.0, 1.0, 1.0)], "src long, t double, q double, p double, lw double, z0 double, sw double, u double, v double, depth double")
    links = spark.createDataFrame([(1, 10, 0.25), (2, 10, 0.75), (1, 11, 0.5), (3, 11, 0.5), (1, 12, 0.5), (9, 12, 0.5)], "src long, dst long, weight double")
    at = spark.createDataFrame([(10, 500.0), (11, 500.0), (12, 500.0), (13, 500.0)], "dst long, z1 double")
    hour = {r["dst"]: r for r in repair.remap_hour(source, at, links).collect()}
    assert np.allclose([hour[10][f] for f in ("t", "q", "p", "lw", "sw", "u", "v", "rain")], [*GOOD[:4], 400.0, 3.0, -2.0, (0.25 * 3.6 + 0.75 * 7.2) / 3600], rtol=1e-9)
    assert {k: r["fault"] for k, r in hour.items()} == {10: None, 11: "incomplete sw", 12: "incomplete t p q lw sw u v rain", 13: "incomplete t p q lw sw u v rain"}
    only_rain = spark.createDataFrame([(1, 10, 1.0)], "src long, dst long, weight double")
    assert repair.remap_hour(source, at.where("dst = 10"), links, only_rain).head()["rain"] == pytest.approx(0.001)


def test_complete_hours_read_no_hour_that_is_done(spark):
    from gridflume.operators import complete

    t = lambda h: datetime(2024, 6, 1, h)
    native = [(t(h), p, s, *GOOD[:4], 100.0 * s, 400.0, 3.0, -2.0) for h in (18, 19, 20) for p in ("fine", "coarse") for s in (1, 2)]
    n = spark.createDataFrame(native, "ts timestamp, product string, src long, t double, q double, p double, lw double, z0 double, sw double, u double, v double")
    cand = spark.createDataFrame([(t(18), "fine", True), (t(18), "coarse", True), (t(19), "fine", False), (t(19), "coarse", True), (t(20), "fine", True), (t(21), "fine", True), (t(22), "fine", False)], "ts timestamp, product string, valid boolean")
    links = spark.createDataFrame([(p, s, 10, 0.5) for p in ("fine", "coarse") for s in (1, 2)], "product string, src long, dst long, weight double")
    targets = spark.createDataFrame([(10, 150.0, 40.0, -100.0, True), (11, 0.0, 40.0, -100.0, True)], "dst long, z1 double, lat double, lon double, active boolean")
    rain = spark.createDataFrame([(t(h), 10, None, None, None, None, 3.6, None, None, False, False) for h in (18, 20)], "ts timestamp, dst long, pass2 double, pass1 double, archive double, realtime double, land double, forecast double, quality double, override boolean, exclusion boolean")
    done = spark.createDataFrame([(t(20),)], "ts timestamp")
    out = complete.complete_hours(cand, n, links, targets, rain, done, {"fine": 2, "coarse": 1})
    got = {(r["ts"].hour, r["dst"]): r for r in out.collect()}
    # hour 20 is done, 21 has no cells, 22 no source; cell 11 no links
    assert {k: (r["product"], r["fallback_used"], r["source_id"], r["qc"]) for k, r in got.items()} == {(18, 10): ("fine", False, 2, 0), (19, 10): ("coarse", True, 1, 0)}
    assert got[18, 10]["rainrate"] == pytest.approx(0.001) and got[18, 10]["precip_source_id"] == 5 and got[19, 10]["rainrate"] is None
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # hours that are done go before their cells are read, and cells are read once
    lines = plan.splitlines()
    assert sum("LogicalRDD" in x and "z0#" in x for x in lines) == 1 and any("LeftAnti" in x for x in lines)
    summary = {r["ts"].hour: (r["product"], r["cells"], r["partial_cells"], r["precipitation_sources"]) for r in complete.hour_summary(out).collect()}
    assert summary == {18: ("fine", 1, 0, {5: 1}), 19: ("coarse", 1, 0, {0: 1})}
