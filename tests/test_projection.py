"""The projection against a dense solve of one period at a time, over random links, dry and missing cells and targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflume.operators import projection, reconcile
from gridflume.operators.projection import Bounds


def dense(hours, totals, links, b):
    """(hours corrected, residuals, flags, iterations, converged) of one period, as full arrays; NaN is missing."""
    n_hours, n_src = hours.shape
    w = np.zeros((len(totals), n_src))
    for s, d, x in links:
        w[d, s] += x
    wide, high = w.sum(axis=1), w.sum(axis=0)
    with np.errstate(all="ignore"):
        at_targets = lambda v: np.where(wide > 0, w @ v / wide, np.nan)
        base = np.where(np.isnan(hours).all(axis=0), np.nan, np.nansum(hours, axis=0))
        now = np.nan_to_num(base)
        given, wet = ~np.isnan(totals), totals > b.dry
        start = at_targets(now)
        dry_base = wet & ~(start > b.dry)
        if b.synthetic:
            part = w * dry_base[:, None]
            seed = np.where(part.sum(axis=0) > 0, (part * np.nan_to_num(totals)[:, None]).sum(axis=0) / part.sum(axis=0), 0)
            now = np.where((now <= b.dry) & (seed > 0), seed, now)
        bound = np.where(np.isnan(base), 0, np.fmax(base, now))
        lo, hi = (np.minimum(bound * k, b.most_depth) for k in b.cumulative)
        beyond = wet & ~(totals <= at_targets(hi) * (1 + b.tolerance))
        flags = ~given * 1 + (given & ~wet) * 2 + dry_base * 4 + (dry_base & b.synthetic) * 8
        capped = beyond.copy()
        active_in = given & ~beyond & (b.synthetic | ~dry_base)
        for k in range(1, b.rounds + 1):
            e = at_targets(now)
            active = active_in & (np.abs(e - totals) / np.fmax(totals, 1) > b.tolerance)
            if not active.any():
                break
            ratio = np.ones(len(totals))
            moves = active & wet & (e > b.dry)
            raw = totals / e
            capped |= moves & ((raw < b.ratio[0]) | (raw > b.ratio[1]))
            ratio[moves] = np.clip(raw[moves], *b.ratio) ** b.damping
            ratio[active & ~wet] = 0
            now = np.clip(now * np.where(high > 0, w.T @ ratio / high, 1), lo, hi)
        e = at_targets(now)
        unmet = active_in & (np.abs(e - totals) / np.fmax(totals, 1) > b.tolerance)
        profile = np.nansum(hours, axis=1)
        profile = profile / profile.sum() if profile.sum() > 0 else np.full(n_hours, 1 / n_hours)
        share = np.where(base > b.dry, np.nan_to_num(hours) / base, 0)
        share = np.where((base <= b.dry) & (now > b.dry), profile[:, None], share)
    return share * now, e - totals, flags + capped * 16 + unmet * 32, k, not unmet.any()


def case(rng, n_src=40, n_dst=12, n_hours=5):
    hours = rng.gamma(0.6, 3, (n_hours, n_src)) * (rng.random((n_hours, n_src)) < 0.8)
    hours[:, :5] = 0
    hours[:, 5] = np.nan
    hours[1, 6] = np.nan
    totals = rng.gamma(2, 4, n_dst)
    totals[[0, 1, 2]] = np.nan, 0, 900
    links = [(s, min(n_dst - 2, s // 4 + k), float(rng.random() + 0.1)) for s in range(n_src - 1) for k in (0, 1)]
    return hours, totals, [*links, *((s, 3, 0.7) for s in range(5))]


def frames(spark, hours, totals, links, key):
    none = lambda v: None if np.isnan(v) else float(v)
    h = [(key, s, k, none(hours[k, s])) for k in range(hours.shape[0]) for s in range(hours.shape[1])]
    t = [(key, d, none(v)) for d, v in enumerate(totals)]
    bad = [(0, 5, float("nan")), (0, 5, -3.0), (0, 5, 0.0), (0, 5, None), (0, 5, float("inf"))]
    return (spark.createDataFrame(h, "day string, src long, hour int, depth double"), spark.createDataFrame(t, "day string, dst long, total double"),
            spark.createDataFrame([*links, *bad], "src long, dst long, weight double"))


@pytest.mark.parametrize("b", [Bounds(rounds=4), Bounds(rounds=3, damping=0.6, synthetic=True), Bounds(rounds=2, ratio=(0.7, 1.3), cumulative=(0.3, 2.0), most_depth=12.0)])
def test_periods_side_by_side_equal_dense_solves(spark, b):
    rng, dry = np.random.default_rng(11), np.random.default_rng(12)
    cases = {"a": case(rng), "b": case(rng), "dry": case(dry)}
    links = cases["a"][2]
    cases["dry"][0][~np.isnan(cases["dry"][0])] = 0
    parts = [frames(spark, h, t, links, k) for k, (h, t, _) in cases.items()]
    hours, totals = parts[0][0].union(parts[1][0]).union(parts[2][0]), parts[0][1].union(parts[1][1]).union(parts[2][1])
    out, s = projection.reconcile_period(hours, totals, parts[0][2], ["day"], b)
    got, targets, runs = out.collect(), s.targets.collect(), {r["day"]: r for r in s.runs.collect()}
    for k, (h, t, _) in cases.items():
        want, residual, flags, rounds, converged = dense(h, t, links, b)
        mine = np.zeros(h.shape)
        for r in got:
            if r["day"] == k:
                mine[r["hour"], r["src"]] = r["corrected"]
        assert np.allclose(mine, want, rtol=1e-9, atol=1e-9)
        for r in targets:
            if r["day"] == k:
                assert r["flags"] == flags[r["dst"]]
                assert (r["residual"] is None and np.isnan(residual[r["dst"]])) or abs(r["residual"] - residual[r["dst"]]) < 1e-8
        assert (runs[k]["iterations"], runs[k]["converged"]) == (rounds, converged)


def test_days_without_24_hours_are_left_out(spark):
    links = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0)], "src long, dst long, weight double")
    hours = spark.createDataFrame([(d, s, h, 1.0) for d, n in (("whole", 24), ("short", 23)) for s in (1, 2) for h in range(n)], "day string, src long, hour int, depth double")
    totals = spark.createDataFrame([("whole", 1, 30.0), ("short", 1, 30.0)], "day string, dst long, total double")
    out, s, verdict = projection.reconcile_day(hours, totals, links)
    assert [(r["day"], r["converged"], r["accepted"]) for r in verdict.collect()] == [("whole", True, True)]
    assert out.agg(F.round(F.sum("corrected"), 3)).head()[0] == pytest.approx(60, rel=1e-3) and out.select("day").distinct().count() == 1


def test_each_bound_of_a_sweep_equals_its_own_solve(spark):
    h, t, links = case(np.random.default_rng(13))
    hours, totals, links = frames(spark, h, t, links, "m")
    depths = hours.groupBy("src").agg(F.sum("depth").alias("depth"))
    got = {r["bound"]: r for r in projection.bounds_sweep(depths, totals.select("dst", "total"), links, [1.5, 4.0], Bounds(rounds=3, most_depth=4000.0)).collect()}
    for bound, r in got.items():
        b = Bounds(rounds=3, most_depth=4000.0, ratio=(0.1, bound), cumulative=(0.0, bound))
        s = projection.reconcile_month(depths, totals.select("dst", "total"), links, bounds=b)
        factors = sorted(x["factor"] for x in s.cells.where("factor is not null").collect())
        alone = reconcile.acceptance(s.targets).head()
        assert (r["iterations"], r["converged"]) == tuple(s.runs.head()) and all(r[k] == alone[k] for k in (*reconcile.LIMITS, "accepted", "constrained_cells"))
        assert np.allclose([r["minimum"], r["p50"], r["maximum"]], [factors[0], factors[(len(factors) + 1) // 2 - 1], factors[-1]], rtol=1e-9)


def test_negative_depths_and_totals_are_refused(spark):
    links = spark.createDataFrame([(1, 1, 1.0)], "src long, dst long, weight double")
    for depth, total in ((-1.0, 1.0), (1.0, -1.0)):
        hours, totals = spark.createDataFrame([(1, 0, depth)], "src long, hour int, depth double"), spark.createDataFrame([(1, total)], "dst long, total double")
        with pytest.raises(Exception, match="negative"):
            projection.reconcile_period(hours, totals, links)
    with pytest.raises(ValueError):
        Bounds(ratio=(1.5, 2.0))


def test_no_cell_of_a_month_is_lost(spark):
    rain = spark.createDataFrame([(c, h, r) for c, r in ((1, 2.0), (2, 0.0), (3, 0.0), (6, 1.0)) for h in (0, 1)], "cell long, hour int, rate double")
    cells = spark.createDataFrame([(1, 4.0, 8.0, None), (2, 0.0, 6.0, 1), (3, 0.0, 5.0, None), (4, 0.0, 5.0, 9), (5, 0.0, 5.0, 3)], "cell long, baseline double, corrected double, donor long")
    got = sorted((r["cell"], r["hour"] if r["hour"] is not None else -1, r["rate"], r["fault"]) for r in reconcile.monthly_hours(rain, cells, "cell").collect())
    assert got == [(1, 0, 4.0, None), (1, 1, 4.0, None), (2, 0, 3.0, None), (2, 1, 3.0, None), (3, 0, 0.0, "no_donor"), (3, 1, 0.0, "no_donor"), (4, -1, None, "no_donor"), (5, -1, None, "no_donor"), (6, 0, 1.0, None), (6, 1, 1.0, None)]


def test_odd_rows_leave_a_solve_as_it_is(spark):
    """Rows without a key are kept, but nothing meets them; rows of one target are capped together."""
    links = [(1, 1, 1.0), (2, 1, 1.0), (2, 2, 3.0)]
    base, totals = [("a", 1, 4.0), ("a", 2, 4.0), ("b", 1, 2.0)], [("a", 1, 6.0), ("a", 2, 5.0), ("b", 1, 3.0)]
    frame = lambda b, t, n: (spark.createDataFrame(b, "day string, src int, depth double"), spark.createDataFrame(t, "day string, dst long, total double"), spark.createDataFrame(n, "src long, dst int, weight double"))
    plain = projection.solve(*frame(base, totals, links), ["day"])
    odd = [(None, 1, 4.0), ("a", None, 4.0)]
    s = projection.solve(*frame([*base, *odd, ("c", 7, 1.0)], [*totals, *odd], [*links, (None, 1, 5.0), (9, None, 2.0)]), ["day"])
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert s.cells.dtypes[:3] == [("day", "string"), ("src", "int"), ("base", "double")] and s.targets.dtypes[:2] == [("day", "string"), ("dst", "bigint")]
    assert rows(s.cells) == sorted([*rows(plain.cells), (None, 1, 4.0, 4.0, 1.0), ("a", None, 4.0, 4.0, 1.0), ("c", 7, 1.0, 1.0, 1.0)], key=str)
    # nothing reaches them, so they count as dry and out of reach
    assert rows(s.targets) == sorted([*rows(plain.targets), (None, 1, 4.0, None, 20), ("a", None, 4.0, None, 20)], key=str)
    twice = projection.solve(*frame([("a", 1, 4.0)], [("a", 1, 0.0), ("a", 1, 6.0)], links), ["day"], Bounds(rounds=3, ratio=(0.9, 1.1)))
    assert [r["flags"] & reconcile.RATIO_CAPPED for r in twice.targets.collect()] == [16, 16]


def test_blocks_are_the_same_whenever_read(spark):
    """A shuffle read again gives rows in another order, which must not part a block's slots from what was told of them."""
    from gridflume.operators import blocks

    df = spark.range(5000, numPartitions=7).selectExpr("id % 90 as src", "rand() as value").repartition(3, "src")
    records = blocks.packed(df, "sources")
    assert sorted(records.collect()) == sorted(records.collect()) and sum(blocks._table(x).num_rows for _, x in records.collect()) == 5000
