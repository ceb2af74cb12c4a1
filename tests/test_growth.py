"""What grows with the tables: rows that joins make, and what Spark may send through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflume.operators import coverage, fill, hybrid, projection, repair


def nodes(df: DataFrame) -> list:
    """The nodes of the plan as it was run."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        found.append((kind, node))
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            children = node.children()
            left += [children.apply(k) for k in range(children.size())]
    return found


def broadcasts(df: DataFrame) -> list[str]:
    return [kind for kind, _ in nodes(df) if kind.startswith("Broadcast")]


def _cells(spark, n: int, key: str, **fields) -> DataFrame:
    return spark.range(n).select(F.col("id").alias(key), *(F.expr(v).cast("double").alias(k) for k, v in fields.items()))


def test_native_repair_sends_no_side_to_the_driver(spark):
    state = {"q": "0.004", "p": "90000", "lw": "300", "u": "1", "v": "2", "sw": "5", "rain": "0"}
    primary = _cells(spark, 40, "dst", lat="30 + id % 5", lon="-100", z="10", model_z="10", t="if(id % 2 = 0, null, 280)", **state).withColumn("active", F.lit(True))
    native = _cells(spark, 60, "src", lat="30 + id % 5", lon="-100", z0="0", t="270 + id", **state)
    out = repair.native_repair(primary, native)
    got = {r["dst"]: (round(r["t"], 3), r["flags"] & repair.COUPLED) for r in out.collect()}
    assert got == {k: (round(270 + k % 5 - 0.065, 3), 1) if k % 2 == 0 else (280.0, 0) for k in range(40)}
    assert not broadcasts(out)


def most_rows(df: DataFrame) -> int:
    """The most rows that a join of the plan made."""
    return max((int(node.metrics().apply("numOutputRows").value()) for kind, node in nodes(df) if "Join" in kind), default=0)


def test_nearest_native_searches_places_once(spark):
    targets = _cells(spark, 600, "dst", lat="30 + id % 3", lon="-100")
    donors = _cells(spark, 500, "src", lat="30.1 + id % 2", lon="-100")
    out = coverage.nearest_native(targets, donors)
    got = {r["dst"]: (r["src"], r["km"] and round(r["km"], 3)) for r in out.collect()}
    assert got == {k: (k % 3, 11.119) if k % 3 < 2 else (None, None) for k in range(600)}
    assert most_rows(out) <= 600


def planned_broadcasts(spark, job) -> int:
    """Broadcasts in the plans of all that a job runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    job()
    runs = store.executionsList()
    return sum("BroadcastExchange" in runs.apply(k).physicalPlanDescription() for k in range(int(before), runs.size()))


def test_no_round_of_a_solve_broadcasts(spark):
    base = _cells(spark, 40, "src", depth="1 + id % 3")
    targets = _cells(spark, 10, "dst", total="10 + id")
    links = spark.range(40).selectExpr("id as src", "id % 10 as dst", "1.0D as weight")
    assert planned_broadcasts(spark, lambda: projection.solve(base, targets, links, bounds=projection.Bounds(rounds=2)).targets.collect()) == 0


def test_nearest_donor_joins_tiles_not_donors(spark):
    cells = spark.range(40 * 40).selectExpr("id div 40 as y", "id % 40 as x")
    gaps, donors = cells.where("(y + x) % 7 = 0"), cells.where("(y + x) % 7 <> 0")
    store = spark._jsparkSession.sharedState().statusStore()
    before = int(store.executionsCount())
    got = {(r["y"], r["x"]): (r["donor_y"], r["donor_x"], r["distance"]) for r in fill.nearest_donor(gaps, donors).collect()}
    # above, or to the left in the first row, or to the right in its first cell
    assert got == {(y, x): (y - 1, x, 1.0) if y else (0, x - 1, 1.0) if x else (0, 1, 1.0) for y, x in ((r["y"], r["x"]) for r in gaps.collect())}
    runs = store.executionsList()
    plans = [runs.apply(k).physicalPlanDescription() for k in range(before, runs.size())]
    last = [p for p in plans if "donor_y" in p and "min(" in p]
    assert last and all("array_min" in p for p in last)


def test_rounds_of_a_solve_share_jobs(spark):
    """Rounds are many and small: a job for each of their steps is most of their time."""
    base = _cells(spark, 60, "src", depth="1 + id % 3")
    targets = _cells(spark, 20, "dst", total="if(id = 7, 0, 2 + id % 5)")
    links = spark.range(180).selectExpr("id % 60 as src", "(id * 7 + id div 60) % 20 as dst", "1.0D + id % 4 as weight")
    sc = spark.sparkContext
    sc.setJobGroup("rounds", "rounds")
    try:
        out = projection.solve(base, targets, links, bounds=projection.Bounds(rounds=20, tolerance=1e-12))
        assert out.runs.head()["iterations"] == 20
        jobs = len(sc.statusTracker().getJobIdsForGroup("rounds"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 40, jobs


def test_hybrid_components_join_once_and_broadcast_nothing(spark):
    names = ["t", "p", "rh", "q", "lw", "sw", "u", "v"]
    cells = spark.range(72).selectExpr("id div 36 as ts", "id % 36 div 6 as y", "id % 6 as x", "id").where("id not in (5, 40)")
    value = {"t": "280 + {k}", "p": "90000 + 40 * {k}", "rh": "0.4 + {k} / 20", "q": "0.004 + {k} / 5000", "lw": "300 + {k}", "sw": "90 + {k}", "u": "{k} - 3", "v": "4 - {k}", "sun": "{k} / 8 - 0.2"}
    side = lambda k: {n: F.expr(v.format(k=k)).cast("double") for n, v in value.items()}
    base = cells.withColumns({**side("(id % 7)"), "thermo_qc": F.lit(3), "radiation_qc": F.lit(1)}).drop("id")
    # a whole hour and some cells of the other one have no fine side
    fine = cells.where("ts = 1 and id % 11 <> 4").withColumns(side("(id * 5 % 8)")).drop("id")
    weights, caps = {"t": 0.5, "p": 0.3, "rh": 0.4, "lw": 0.2, "sw": 0.5, "u": 0.25, "v": 0.75}, {"t": 1.5, "p": 0.002, "rh": 0.1, "lw": 0.02, "sw": 0.1, "wind": 2.0}
    box = (3, (0, 5), (0, 5))
    out = hybrid.components(base, fine, weights, caps, *box)
    got = {(r["ts"], r["y"], r["x"]): r for r in out.collect()}
    # cells without a fine side stay in the grid: a box counts what has a value beside them
    given = fine.select("ts", "y", "x", *(F.col(n).alias(f"fine_{n}") for n in value))
    matched = base.where("ts = 1").join(given, ["ts", "y", "x"], "left")
    there = {(r["ts"], r["y"], r["x"]) for r in fine.collect()}
    warm = hybrid.thermodynamics(matched, {k: weights[k] for k in ("t", "p", "rh", "lw")}, caps, *box, ["ts"]).collect()
    bright = hybrid.radiation_wind(matched, {k: weights[k] for k in ("sw", "u", "v")}, caps, *box, ["ts"]).collect()
    want = {(r["ts"], r["y"], r["x"]): {**{n: r[n] for n in names}, "thermo_qc": 3, "radiation_qc": 1, "hybrid": False} for r in base.collect()}
    for rows, qc, bits in ((warm, "thermo_qc", 3), (bright, "radiation_qc", 1)):
        for r in (r for r in rows if (r["ts"], r["y"], r["x"]) in there):
            want[r["ts"], r["y"], r["x"]] |= {k[4:]: v for k, v in r.asDict().items() if k.startswith("new_")} | {qc: r["qc"] | bits, "hybrid": True}
    assert len(there) == 31 and {k: {n: r[n] for n in want[k]} for k, r in got.items()} == want
    kinds = [kind for kind, _ in nodes(out)]
    assert sum("Join" in kind for kind in kinds) == 1 and not broadcasts(out)


def test_targets_have_blocks_of_their_own_number(spark, monkeypatch):
    """Blocks of both sides pass something to each other, so few targets must not be dealt over as many blocks as links are."""
    base = _cells(spark, 60, "src", depth="1 + id % 3")
    targets = _cells(spark, 20, "dst", total="if(id = 7, 0, 2 + id % 5)")
    links = spark.range(180).selectExpr("id % 60 as src", "(id * 7 + id div 60) % 20 as dst", "1.0D + id % 4 as weight")
    rows = lambda s: sorted((r["dst"], round(r["residual"], 9), r["flags"]) for r in s.targets.collect())
    want = rows(projection.solve(base, targets, links))
    seen, real = [], projection.blocks.rounds
    monkeypatch.setattr(projection, "ROWS_A_BLOCK", 10)
    monkeypatch.setattr(projection.blocks, "rounds", lambda sources, goals, by, n, *x: seen.append(n) or real(sources, goals, by, n, *x))
    assert rows(projection.solve(base, targets, links)) == want
    assert seen == [(24, 8)]


def _jobs_of(spark, group: str, job) -> int:
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        job()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def _slow_month(spark) -> tuple[DataFrame, DataFrame, DataFrame, projection.Bounds]:
    """A month that does not settle in its rounds."""
    links = spark.range(180).selectExpr("id % 60 as src", "(id * 7 + id div 60) % 20 as dst", "1.0D + id % 4 as weight")
    return _cells(spark, 60, "src", depth="1 + id % 3"), _cells(spark, 20, "dst", total="if(id = 7, 0, 2 + id % 5)"), links, projection.Bounds(rounds=30, most_depth=4000.0, tolerance=1e-13)


def test_rounds_of_a_month_share_jobs(spark):
    *given, bounds = _slow_month(spark)

    def job():
        assert projection.reconcile_month(*given, bounds=bounds).runs.head()["iterations"] == 30

    assert _jobs_of(spark, "month", job) <= 50


def test_bounds_of_a_sweep_share_jobs(spark):
    *given, bounds = _slow_month(spark)

    def job():
        rows = projection.bounds_sweep(*given, ratios=[1.5, 2.0, 10.0], bounds=bounds).collect()
        assert sorted(r["bound"] for r in rows) == [1.5, 2.0, 10.0] and max(r["iterations"] for r in rows) == 30

    assert _jobs_of(spark, "sweep", job) <= 60
