"""Queries whose memory or time outgrew their input: what their plans hold, and rows that the leaner plans must not lose."""

import json
import re
from datetime import date

from pyspark.sql import functions as F

from gridflume.operators import observations
from gridflume.plans import registry
from gridflume.sources import normalize
from test_oracles import SF


def plan_of(spark, name):
    """The physical plan as it is before it runs."""
    return registry.queries()[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()


def test_hourly_leads(spark):
    rows = [("a", 0, 1, 10.0), ("a", 0, 2, 8.0), (None, 0, 1, 1.0), (None, 0, 1, 2.0), (None, 0, 2, 2.0), ("c", None, 1, 1.0), ("d", 0, None, 1.0), ("e", 0, 1, float("nan"))]
    df = spark.createDataFrame(rows, "k string, s int, lead int, v double").withColumn("more", F.lit("x"))
    out = {(r["k"], r["s"], r["lead"]): (r["same"], r["fault"], r["hour_value"]) for r in normalize.hourly_leads(df, ["k"], "s", "lead", "v", True, 0.2).collect()}
    assert out == {
        ("a", 0, 1): (1, None, 10.0), ("a", 0, 2): (1, None, 6.0), (None, 0, 1): (2, "repeated", None), (None, 0, 2): (1, "repeated", None),
        ("c", None, 1): (1, "interval", None), ("d", 0, None): (1, "interval", None), ("e", 0, 1): (1, "missing", None),
    }
    each = normalize.hourly_statistic(df, ["k"], "s", "lead", "v", True, 0.2)
    assert each.columns == [*df.columns, "fault", "hour_value", "clipped"] and each.count() == len(rows)


def test_hourly_statistic_shuffles_once(spark):
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(spark, "src21_hourly_statistic_checked"))) <= 1


def test_faults_of_pages(spark):
    page = lambda ids, n: json.dumps({"type": "FeatureCollection", "numberReturned": n, "features": [{"id": i, "properties": {}} for i in ids]})
    rows = [(1, page(["a", "", "", None, "b"], 5)), (2, page(["b", "b", "c"], 4)), (3, "no json"), (3, "no json"), (None, page([""], 2)), (None, page(["", "d"], 2))]
    faults = normalize.paged_features(spark.createDataFrame(rows, "page long, text string"), "page", "text")[1]
    assert sorted(map(tuple, faults.collect()), key=str) == sorted([
        (1, "", "missing_id"), (1, "", "missing_id"), (1, None, "missing_id"), (2, None, "count"), (None, "b", "repeated_id"), (3, None, "invalid"), (3, None, "invalid"),
        (None, None, "count"), (None, "", "missing_id"), (None, "", "missing_id"),
    ], key=str)


def test_pages_are_read_once(spark):
    plan = plan_of(spark, "src12_paged_feature_faults")
    assert plan.count("collect_list") <= 2 and "Union" not in plan
    # pages gather numbers, not the features made from them
    assert not re.search(r"collect_list\([^\n]*ft\^3/s", plan)


def test_report_of_odd_records(spark):
    d = date(2020, 3, 1)
    rows = [("A", "p", d, 1.0), ("A", None, d, 2.0), ("A", "gone", d, -3.0), ("A", "p", date(2020, 3, 5), 2.0), ("A", "p", date(2019, 1, 1), 1.0), (None, "p", d, 1.0), ("Z", "p", d, 1.0), ("B", "n", d, None)]
    records = spark.createDataFrame(rows, "station string, series string, day date, discharge double").withColumns({"approval": F.lit("Approved"), "qualifier": F.lit(None).cast("string")})
    series = spark.createDataFrame([("A", "p", None), ("A", None, True), ("B", "n", True), (None, "p", True)], "station string, series string, primary boolean")
    out = {r["station"]: r for r in observations.discharge_report(records, series.where("series is not null"), F.lit("2020-02-28").cast("date"), F.lit("2020-03-10").cast("date")).collect()}
    assert set(out) == {"A", "B", None} and out[None]["rows"] == out[None]["requested_valid_days"] == 0 and out["B"]["rows"] == 1 and out["B"]["first_day"] is None
    a = out["A"]
    assert (a["rows"], a["series_returned"], a["negative_rows"], a["approved_days"], a["first_day"], a["last_day"]) == (5, 2, 1, 3, date(2019, 1, 1), date(2020, 3, 5))
    assert (a["observed_valid_days"], a["observed_longest_gap"], a["requested_valid_days"], a["requested_longest_gap"], a["years_with_data"], a["full_years"]) == (3, 424, 2, 5, 2, 0)
    # a primary series without a name is nobody's, but its station has a primary one
    assert {r["station"]: r["observed_valid_days"] for r in observations.discharge_report(records, series, F.lit("2020-02-28").cast("date"), F.lit("2020-03-10").cast("date")).collect()}["A"] is None


def test_report_reads_pages_once(spark):
    # orders as pages, and twice as series: known to the provider and to the report
    assert len(re.findall(r"Scan parquet", plan_of(spark, "obs03_discharge_report"))) <= 3


def test_near_copies_join_staged_edges(spark, monkeypatch):
    """Edges are read from the shared folder when they are joined up: no task then runs two Python steps at once."""
    from gridflume.llm import near_copies

    plans, real = [], near_copies.components
    monkeypatch.setattr(near_copies, "components", lambda edges: plans.append(edges._jdf.queryExecution().executedPlan().toString()) or real(edges))
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:58], "x", "y"])), (3, "other text that is alone here"), (None, " ".join(words)), (4, None)]
    out = near_copies.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in out} == {(1, 1), (2, 1), (3, 3), (None, 1), (4, 4)}
    assert len(plans) == 4 and not any(re.search(r"MapInArrow.*\n(?!.*Exchange)", p) and "Exchange" not in p for p in plans)
    assert not any(p.count("FlatMapCoGroups") for p in plans)


def test_components_shuffle_no_more_parts_than_edges_ask_for(spark):
    """Each task of a shuffle leaves files: rounds over few edges must not have as many tasks as the session's shuffles."""
    from gridflume.llm import components

    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tracker, group = spark.sparkContext.statusTracker(), "few-edges"
        spark.sparkContext.setJobGroup(group, group)
        edges = [(i, i + 1) for i in range(30)] + [(100 + i, 99) for i in range(30)]
        found = components.components(spark.createDataFrame(edges, "u long, v long").repartition(6))
        assert {(r["node"], r["root"]) for r in found.collect()} == {(i, 0) for i in range(31)} | {(99 + i, 99) for i in range(31)}
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        wide = [s for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks >= 40]
        assert len(wide) <= 8, f"{len(wide)} of {len(stages)} stages"
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_staged_tables_leave_no_shuffle_files(spark):
    """A job of many steps would else hold the shuffles of all of them until the driver collects garbage."""
    from pathlib import Path

    from gridflume.llm.common import staged

    folder = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    known = set(folder.rglob("shuffle_*.data"))
    df = spark.range(5000).selectExpr("id % 977 as k").groupBy("k").count()
    table = staged(df, "left")
    assert table.count() == 977 and {tuple(r) for r in table.where("k < 2").collect()} == {(0, 6), (1, 6)}
    assert staged(df.select("k").join(table, "k"), "left").count() == 977
    left = {p for p in set(folder.rglob("shuffle_*.data")) - known if p.stat().st_size > 3000}
    assert not left, left


def test_katz_contexts_are_staged_apart(spark, monkeypatch):
    """Disk then holds either the shuffles that find contexts or those that meet them with their grams, not both."""
    from gridflume.llm import katz

    plans, real = {}, katz.staged
    monkeypatch.setattr(katz, "staged", lambda df, name, *by: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or real(df, name, *by))
    rows = [(i, f"a b c{i % 3} a b d{i % 2}") for i in range(12)]
    out = katz.scored(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") == 1, 3).collect()
    assert len(out) == 12 and all(r["score"] < 0 for r in out)
    assert not any("SUM(" in plans[k].upper() for k in ("katz2", "katz3"))


def test_katz_shuffles_no_row_per_ngram(spark, monkeypatch):
    """Chunks ask buckets in packed rows; contexts may be frequent, in one chunk only, or held out in another one."""
    import random

    import numpy as np

    from gridflume.llm import katz

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdef") if rng.random() < 0.8 else f"w{rng.randrange(90)}" for _ in range(rng.randrange(40))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, real = {}, katz.staged
    monkeypatch.setattr(katz, "staged", lambda df, name, *by: rows.update({name: (out := real(df, name, *by)).count()}) or out)
    got = {r["doc_id"]: r["score"] for r in katz.scored(df, F.col("doc_id") % 7 == 2, 3).collect()}
    assert set(rows) == {"chunks", "katz1", "katz2", "katz3", "scores"}
    tokens = sum(len(t.split()) + 1 for t in texts)
    assert rows["chunks"] == 3 < tokens / 20 and rows["katz3"] <= katz.LEAST_BUCKETS * (rows["chunks"] + 1 + katz.LEAST_BUCKETS)
    tables, total = katz.train(df.where("doc_id % 7 <> 2").select("text"), 3)
    words = {r["w"]: r["p"] for r in tables[0].collect()}
    grams = [{(r["context"], r["w"]): r["p"] for r in t.collect()} for t in tables[1:]]
    for i, text in enumerate(texts):
        want = 0.0
        for w, *contexts in katz.tokens(text.encode(), 3).astype(np.uint64).view(np.int64).tolist():
            p = words.get(w, total["unknown"])
            for context, level in zip(contexts, grams, strict=True):
                p = level.get((context, w), p * level.get((context, None), 1.0))
            want += np.log10(p)
        assert abs(got[i] - want) < 1e-9 * max(1, abs(want))
