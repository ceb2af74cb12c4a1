"""Small literal cases of single operators, null and empty input among them."""

import hashlib
import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflume.checkpoints import checkpointed
from gridflume.functions import physics
from gridflume.operators import audit, composite, evaluate, fill, incremental, network, observations, reconcile, regrid, temporal


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_day_needs_all_hours(spark):
    hours = [("a", datetime(2024, 1, 1) + timedelta(hours=k), float(k)) for k in range(1, 25)]
    df = spark.createDataFrame(hours + [("b", datetime(2024, 1, 1, 1), 1.0)], "k string, t timestamp, v double")
    out = {r["k"]: r for r in temporal.interval_daily(df, ["k"], "t", {"v": ["mean", "last", "integral"]}).collect()}
    assert out["a"]["v_mean"] == 12.5 and out["a"]["v_last"] == 24 and out["a"]["v_integral"] == 300 * 3600
    assert out["b"]["v_mean"] is None and out["b"]["sample_count"] == 1


def test_repeated_and_null_hours_make_a_day_incomplete(spark):
    hours = [("a", datetime(2024, 1, 1) + timedelta(hours=k), float(k)) for k in range(1, 25)]
    for extra in ([hours[3]], []):
        df = spark.createDataFrame((hours + extra) if extra else hours[:-1] + [("a", hours[-1][1], None)], "k string, t timestamp, v double")
        assert temporal.interval_daily(df, ["k"], "t", {"v": ["mean"]}).head()["v_mean"] is None


def test_noon_window(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12),), (datetime(2024, 1, 2, 11),), (datetime(2024, 1, 2, 12),)], "t timestamp")
    assert [r[0] for r in df.select(temporal.window_12z(F.col("t"))).collect()] == [date(2024, 1, 2), date(2024, 1, 2), date(2024, 1, 3)]


def test_remap_skips_missing_and_nulls_empty(spark):
    links = spark.createDataFrame([(1, 9, 1.0), (2, 9, 3.0), (3, 8, 1.0)], "src int, dst int, weight double")
    values = spark.createDataFrame([(1, 4.0), (2, None), (3, None)], "src int, v double")
    assert sorted(rows(regrid.remap(values, links, ["v"]))) == [(8, None), (9, 4.0)]


def test_composite_order_and_bits(spark):
    schema = "pass2 double, pass1 double, archive double, realtime double, land double, forecast double, quality double, override boolean, exclusion boolean"
    cells = [(1.0, 2.0, 3.0, None, None, None, 0.9, True, False), (1.0, 2.0, 3.0, None, None, None, 0.6, False, False), (1.0, None, None, None, 5.0, None, 0.1, None, None), (None,) * 9, (None, None, 400.0, None, None, 1.0, None, True, True)]
    got = composite.composite(spark.createDataFrame(cells, schema)).select("depth", "source_id", "confidence", "qc").collect()
    assert [tuple(r) for r in got] == [(3.0, 3, 0.85, 6), (1.0, 1, 0.6, 0), (5.0, 5, 0.4, 5), (None, 0, 0.0, 8), (1.0, 6, 0.2, 68)]


def test_six_hour_total_is_conserved(spark):
    hours = [(h, d, t) for t, ds in ((12.0, [1, 2, 3, 0, 0, 0]), (6.0, [0] * 6), (0.0, [1] * 6)) for h, d in enumerate(map(float, ds), 1)]
    df = spark.createDataFrame([(t, *x) for x in hours for t in [x[2]]], "k double, hour int, depth double, total double")
    got = reconcile.six_hour(df, ["k"]).groupBy("k").agg(F.sum("constrained")).collect()
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in got)


def test_temperature_range_meets_targets(spark):
    df = spark.createDataFrame([("a", 280.0, 275.0, 285.0), ("a", 284.0, 275.0, 285.0), ("b", 280.0, None, 285.0)], "k string, v double, lo double, hi double")
    assert sorted(r["adjusted"] for r in reconcile.temperature_range(df, ["k"], "v", "lo", "hi").collect()) == [275.0, 280.0, 285.0]


@pytest.mark.parametrize("tile", [2, 8])
def test_nearest_donor_against_brute_force(spark, tile):
    rng = np.random.default_rng(1)
    cells = lambda n, far: [tuple(int(v) for v in p) for p in rng.integers(-far, far, (n, 2))]
    gaps, donors = [(0, 0), (5, 5), (40, 40), (-70_000, 90_000), *cells(40, 300)], [(0, 3), (3, 0), (9, 9), (30, 30), *cells(60, 200)]
    df = lambda x: spark.createDataFrame(x, "y long, x long")
    got = {(r["y"], r["x"]): (r["donor_y"], r["donor_x"]) for r in checkpointed(spark, lambda: fill.nearest_donor(df(gaps), df(donors), tile)).collect()}
    assert got == {g: min(donors, key=lambda d: ((d[0] - g[0]) ** 2 + (d[1] - g[1]) ** 2, d)) for g in gaps}


def test_downstream_stops_at_cycles(spark):
    reach = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5), (5, 0), (9, 4)], "link int, to_link int")
    closed = lambda *s: sorted(r[0] for r in checkpointed(spark, lambda: network.downstream(spark.createDataFrame([(x,) for x in s], "link int"), reach)).collect())
    assert closed(1) == [1, 2, 3] and closed(9) == [4, 5, 9] and closed(77) == []


def test_long_chain(spark):
    reach = spark.range(1, 200).select(F.col("id").alias("link"), (F.col("id") + 1).alias("to_link"))
    seeds = spark.createDataFrame([(150,), (3,)], "link long")
    assert checkpointed(spark, lambda: network.downstream(seeds, reach)).count() == 197


def test_metrics_of_constant_series(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 1.0)], "r double, c double")
    got = evaluate.continuous_metrics(df, "r", "c").head()
    assert (got["count"], got["bias"], got["correlation"]) == (2, 2.0, None)


def test_latest_before_ties_and_none(spark):
    asked = spark.createDataFrame([("a", 5), ("a", 1), ("b", 3)], "k string, t int")
    states = spark.createDataFrame([("a", 5), ("a", 2)], "k string, s int")
    assert sorted(rows(incremental.latest_before(asked, states, ["k"], "t", "s")), key=str) == sorted([("a", 5, 5), ("a", 1, None), ("b", 3, None)], key=str)


def test_physics_round_trips(spark):
    df = spark.createDataFrame([(290.0, 0.01, 95000.0)], "t double, q double, p double")
    t, q, p = map(F.col, "tqp")
    back = physics.humidity_from_relative(physics.relative_humidity(q, t, p), t, p)
    down = physics.temperature_at_elevation(physics.temperature_at_elevation(t, F.lit(0.0), F.lit(900.0)), F.lit(900.0), F.lit(0.0))
    a, b, bad = df.select(back, down, physics.emissivity(-t, q, p)).head()
    assert math.isclose(a, 0.01, rel_tol=1e-12) and math.isclose(b, 290.0) and bad is None


def test_dataset_changes_treats_nulls_alike(spark):
    left = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "a"), (3, None, "b")], "k int, v double, s string")
    right = spark.createDataFrame([(1, 1.0, None), (2, None, "c"), (4, 0.0, "d")], "k int, v double, s string")
    got = {r["k"]: r["change"] for r in audit.dataset_changes(left, right, ["k"], ["v", "s"]).collect()}
    assert got == {2: "v,s", 3: "removed", 4: "added"}


def test_accepted_prefix_ends_at_gap_or_refusal(spark):
    rows = [("a", 0, 1, True), ("a", 1, 2, True), ("a", 3, 4, True), ("b", 0, 1, True), ("b", 1, 2, None), ("b", 2, 3, True), ("c", 0, 1, False)]
    found = incremental.accepted_prefix(spark.createDataFrame(rows, "k string, s int, e int, ok boolean"), ["k"], "s", "e", "ok")
    assert {r["k"]: (r["segments"], r["resume"]) for r in found.collect()} == {"a": (2, 2), "b": (1, 1), "c": (0, None)}


def test_fingerprints_ignore_order_and_copies(spark):
    one = spark.createDataFrame([("x", "p"), ("x", "q"), ("x", "q"), ("y", "p"), ("z", "n")], "k string, i string")
    two = spark.createDataFrame([("x", "q"), ("x", "p"), ("y", "r")], "k string, i string")
    held = incremental.fingerprints(two, ["k"], F.col("i"))
    need = incremental.needing_work(incremental.fingerprints(one, ["k"], F.col("i")), held, ["k"])
    assert {r["k"]: r["reason"] for r in need.collect()} == {"y": "changed", "z": "new"}


def test_latest_cycle_waits_until_it_is_there(spark):
    asked = spark.createDataFrame([(12,), (17,), (30,), (40,)], "h long")
    cycles = spark.createDataFrame([(0, 4), (6, 13), (12, 16), (18, 22)], "c long, since long")
    found = temporal.latest_cycle(asked, cycles, "h", "c", "since").collect()
    assert {r["h"]: (r["c"], r["lead"]) for r in found} == {12: (0, 12), 17: (12, 5), 30: (18, 12), 40: (None, None)}


def test_acquisition_tasks_split_at_year_ends(spark):
    s = spark.sql("select 'a' as st, date'2020-12-30' as f, date'2022-01-02' as l union all select 'b', date'2021-02-02', date'2021-02-01'")
    got = sorted((r["st"], str(r["first_day"]), str(r["last_day"])) for r in observations.acquisition_tasks(s, "st", "f", "l").collect())
    assert got == [("a", "2020-12-30", "2020-12-31"), ("a", "2021-01-01", "2021-12-31"), ("a", "2022-01-01", "2022-01-02")]


def test_calendar_eligibility_names_what_blocks(spark):
    days = spark.sql("select 's' as k, d, ok from values (date'2020-01-01', true), (date'2020-01-02', true), (date'2020-01-03', null), (date'2020-01-05', true) as t(d, ok)")
    got = {str(r["d"]): r["state"] for r in incremental.calendar_eligibility(days, ["k"], "d", "ok").collect()}
    assert got == {"2020-01-01": "no_previous_day", "2020-01-02": "eligible", "2020-01-03": "no_constraint", "2020-01-05": "no_previous_day"}



def test_content_digests_and_empty_input(spark):
    rows = [(1, 1.0, True), (2, 2.0, False), (3, None, True), (4, None, None)]
    df = spark.createDataFrame(rows, "cell long, v double, a boolean").withColumn("g", F.lit(1))
    one = lambda d: audit.content(d, ["g"], "v", F.col("a"), F.lit(True)).collect()
    before, outside, inside = one(df)[0], one(df.withColumn("v", F.when(F.col("cell") == 2, 9.0).otherwise(F.col("v"))))[0], one(df.withColumn("v", F.col("v") + (F.col("cell") == 1).cast("int")))[0]
    assert (before.missing, before.missing_on_land, before.outside) == (1, 1, 1)
    assert before.inside_digest == outside.inside_digest and before.outside_digest != outside.outside_digest
    assert before.inside_digest != inside.inside_digest and before.outside_digest == inside.outside_digest
    assert one(df.where("false")) == []


def test_best_rules_ties_and_inputs_of_days(spark):
    scores = spark.createDataFrame([("a", 1, 0.5, 0.2), ("a", 2, 0.5, 0.3), ("a", 3, None, 0.9), ("b", 5, 0.1, None), ("b", 4, 0.1, None)], "s string, rule int, rmse double, csi double")
    assert {r.s: r.rule for r in evaluate.best_rules(scores, ["s"], "rule").collect()} == {"a": 2, "b": 4}
    stamps = spark.createDataFrame([("2020-01-01 18:59:59",), ("2020-01-01 19:00:00",), ("2020-01-03 00:00:00",), ("2020-01-03 00:00:01",), (None,)], "t string").select(F.col("t").cast("timestamp").alias("ts"))
    days = spark.createDataFrame([("2020-01-02",), ("2020-01-02",)], "d string").select(F.to_date("d").alias("day"))
    assert sorted(str(r.ts) for r in incremental.inputs_of_days(stamps, days, "day", "ts").collect()) == ["2020-01-01 19:00:00", "2020-01-03 00:00:00"]


def test_overrides_are_chosen_without_the_withheld_groups(spark):
    rng = np.random.default_rng(31)
    rows = [(s, g, float(rng.gamma(1, 2)), *(None if rng.random() < 0.1 else float(v) for v in (rng.random(), rng.gamma(1, 2), rng.gamma(1, 2)))) for s in "ab" for g in range(30) for _ in range(8)]
    df = spark.createDataFrame(rows, "stratum string, station int, reference double, quality double, pass2 double, archive double")
    got = {r["stratum"]: r for r in evaluate.calibrated_overrides(df, ["stratum"], "station", [0.3, 0.6], [1.0, 2.0]).collect()}

    def depth(q, p, a, qb, db):
        if ((q is not None and q < qb) or (a is not None and p is not None and abs(a - p) >= db)) and a is not None:
            return a
        return p if q is not None and q >= 0.5 and p is not None else a

    fit = lambda g: int(hashlib.sha256(f"split:{g}".encode()).hexdigest()[:16], 16) < int(0.7 * 2**64)
    for s in "ab":
        def rmse(qb, db, fitted, s=s):
            e = [depth(q, p, a, qb, db) - ref for k, g, ref, q, p, a in rows if k == s and fit(g) == fitted and depth(q, p, a, qb, db) is not None]
            return math.sqrt(sum(x * x for x in e) / len(e))

        best = min(((qb, db) for qb in (0.3, 0.6) for db in (1.0, 2.0)), key=lambda r: rmse(*r, True))
        r = got[s]
        assert (r["q"], r["d"]) == best and math.isclose(r["rmse"], rmse(*best, True)) and math.isclose(r["withheld_rmse"], rmse(*best, False))
        assert r["withheld_samples"] == sum(k == s and not fit(g) for k, g, *_ in rows)


def test_a_sound_network_has_no_errors_and_each_fault_is_counted(spark):
    reach = spark.createDataFrame([(1, 2, 2), (2, 3, 0), (3, 0, 1)], "link long, to_link long, index long")
    polygons = spark.createDataFrame([(0, 2, 2), (1, 1, 0), (2, 3, 3)], "place long, polyid long, overlaps long")
    rows = [(0, 2, 1, 1), (1, 2, 2, 1), (2, 3, 4, 3), (3, 3, 4, 1), (4, 3, 1, 3)]
    weights = lambda r: spark.createDataFrame(r, "place long, polyid long, i long, j long")
    buckets = lambda r: spark.createDataFrame(r, "place long, polyid long, basin long")
    good = [(0, 2, 1), (1, 1, 2), (2, 3, 3)]
    wrong = lambda *a, **k: {r["check"]: r["errors"] for r in network.topology_errors(*a, **k).collect() if r["errors"]}
    assert wrong(reach, weights(rows), polygons, buckets(good), (3, 4)) == {}
    assert wrong(reach.withColumn("index", F.least("index", F.lit(1)))) == {"index_not_a_permutation": 1}
    swapped = [(0, 2, 1, 1), (1, 3, 2, 1), (2, 2, 4, 3), (3, 3, 5, 1), (4, 3, None, 0)]
    assert wrong(reach, weights(swapped), polygons, buckets(good), (3, 4)) == {"weight_order": 2, "outside_grid": 2}
    assert wrong(reach, weights(rows[:4]), polygons, buckets([(0, 1, 1), (1, 2, 2), (2, 3, 4), (3, 9, 4)]), (3, 4)) == {"overlap_sum": 1, "bucket_order": 3, "basin_order": 1}


def test_running_sums_cross_partitions(spark):
    df = spark.createDataFrame([(k, k * k % 7) for k in range(500)], "k long, v long").repartition(7)
    want = np.cumsum([k * k % 7 for k in range(500)])
    assert all(r["through"] == want[r["k"]] for r in network.running(df, "k", "v").collect())
