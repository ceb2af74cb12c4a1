"""Streaming jobs and publications over small tables: late, repeated, short and restarted batches."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridflume.streaming import jobs, publishing


def streamed(spark, df, path):
    df.coalesce(1).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_latest_revision_replaces_earlier_ones(spark, tmp_path):
    rows = [("a", datetime(2024, 1, 1), 1, 5.0), ("a", datetime(2024, 1, 1), 3, 7.0), ("a", datetime(2024, 1, 1), 2, 6.0), ("b", datetime(2024, 1, 1), 1, None), ("a", datetime(2024, 2, 1), 1, 1.0)]
    stream = streamed(spark, spark.createDataFrame(rows, "k string, t timestamp, revision int, v double"), str(tmp_path / "in"))
    out = jobs.finished(spark, jobs.latest(stream, ["k"], "t", "revision", ["v"], "7 days"), "latest_test")
    # the last record may still be revised
    assert sorted((r["k"], r["revision"], r["v"]) for r in out.where(F.col("t").isNotNull()).collect()) == [("a", 3, 7.0), ("b", 1, None)]


def test_blocks_with_constraints_late_and_never(spark, tmp_path):
    t = lambda d, h: datetime(2024, 1, d, h)
    hours = [("a", t(1, h), 1.0) for h in range(1, 13)] + [("a", t(9, 1), 0.0)]
    # of the two blocks one gets its constraint, after other blocks' have come, and one never does
    constraints = [("a", t(8, 0), 99.0), ("a", t(1, 6), 7.0), ("b", t(1, 12), 5.0), ("a", t(9, 6), 1.0)]
    given = spark.createDataFrame(hours, "k string, ts timestamp, v double")
    side = spark.createDataFrame(constraints, "k string, block_end timestamp, wanted double")
    for how, want in (("inner", [(6, 6.0, 6, 7.0)]), ("left_outer", [(6, 6.0, 6, 7.0), (12, 6.0, 6, None)])):
        out = jobs.finished(spark, jobs.six_hour_blocks(streamed(spark, given, str(tmp_path / how / "h")), streamed(spark, side, str(tmp_path / how / "c")), "k", "ts", "v", how=how), f"blocks_{how}")
        assert sorted((r["block_end"].hour, r["total"], r["samples"], r["wanted"]) for r in out.collect()) == want


CANDIDATES = "day date, as_of long, hour int, constrained boolean, v double"


def candidate(day, as_of, hours, constrained=False):
    return [(date(2024, 1, day), as_of, h, constrained, float(100 * as_of + h)) for h in hours]


def test_days_are_extended_and_never_shortened(spark, tmp_path):
    root = str(tmp_path)
    arrivals = [
        candidate(1, 1, range(3)) + candidate(2, 1, range(24)) + candidate(3, 1, [0, 2]) + [(None, 1, 0, False, 0.0), (date(2024, 1, 9), None, 0, False, 0.0)],
        candidate(1, 2, range(5)) + candidate(1, 3, range(4)) + candidate(2, 2, range(20)) + candidate(3, 2, range(2), True),
        candidate(1, 4, range(5)) + candidate(3, 3, range(9)),
    ]
    frames = [spark.createDataFrame(a, CANDIDATES) for a in arrivals]
    put = publishing.extend_days(root)
    publishing.gathered(spark, root, frames, put)

    def shown():
        rows = publishing.published_days(spark, root, CANDIDATES).collect()
        return {d: (sorted(r["v"] for r in rows if r["day"].day == d), {(r["batch"], r["complete"]) for r in rows if r["day"].day == d}) for d in {r["day"].day for r in rows}}

    want = {1: ([400.0 + h for h in range(5)], {(2, False)}), 2: ([100.0 + h for h in range(24)], {(0, True)}), 3: ([200.0, 201.0], {(1, False)})}
    assert shown() == want
    # a batch that is run again changes nothing, be it the last or one before
    for number in (2, 1, 0, 2):
        put(frames[number], number)
        assert shown() == want


def test_a_batch_killed_before_its_manifest_is_not_seen_and_comes_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put = publishing.extend_days(root)
    real, deaths = publishing.current_days, []

    def dying(batch, number):
        put(batch, number) if number or deaths else None
        if number == 1 and not deaths:
            # the data is there, the manifest isn't
            import shutil

            shutil.rmtree(f"{root}/manifest/of=1")
            deaths.append(number)
            raise RuntimeError("killed")

    put(spark.createDataFrame(candidate(1, 1, range(2)), CANDIDATES), 0)
    first, second = (spark.createDataFrame(candidate(1, k, range(n)), CANDIDATES) for k, n in ((1, 2), (2, 6)))
    with pytest.raises(Exception, match="killed"):
        publishing.gathered(spark, root, [first, second], dying)
    assert real(spark.read.schema(publishing.MANIFEST).parquet(f"{root}/manifest")).head()["hours"] == 2
    assert publishing.published_days(spark, root, CANDIDATES).count() == 2
    stream = spark.readStream.schema(second.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    stream.writeStream.foreachBatch(dying).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["v"] for r in publishing.published_days(spark, root, CANDIDATES).collect()) == [200.0 + h for h in range(6)]


@pytest.mark.parametrize("days", [7, 215])
def test_late_rows_are_applied_or_kept_for_the_backlog(spark, tmp_path, days):
    root, day = str(tmp_path), lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    arrivals = [[(1, day(300)), (2, day(10))], [(3, day(301)), (4, day(299)), (5, day(293)), (6, day(292)), (7, day(85)), (8, day(84)), (9, None)], [(10, day(294)), (11, day(293))]]
    frames = [spark.createDataFrame(a, "id long, t timestamp") for a in arrivals]
    put = publishing.route_late(root, "t", f"{days} days")
    publishing.gathered(spark, root, frames, put)
    put(frames[1], 1)
    got = {r["id"]: r["kind"] for r in publishing.routed_rows(spark, root, "id long, t timestamp").collect()}
    newest, want = None, {}
    for a in arrivals:
        for i, t in a:
            want[i] = "on_time" if newest is None and t else "backlog" if t is None or t < newest - timedelta(days=days) else "late" if t < newest else "on_time"
        newest = max([t for _, t in a if t] + ([newest] if newest else []))
    assert got == want
    counts = publishing.route_counts(spark, root).agg(F.sum("on_time"), F.sum("late"), F.sum("backlog")).head()
    assert tuple(counts) == tuple(list(want.values()).count(k) for k in ("on_time", "late", "backlog")) and sum(counts) == 11


def test_receipts_count_what_was_written(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    publishing.publish(rows, root, "good", ["y", "x"], ["k", "v"])
    publishing.publish(rows.withColumn("v", F.when(F.col("k") == 1, "a")), root, "holes", ["x"], ["k", "v"])
    publishing.publish(rows.limit(0), root, "none", [], ["k", "v"])
    publishing.publish(rows.orderBy(F.desc("k")).repartition(3), root, "again", ["x"], ["k", "v"])
    got = {r["publication"]: r for r in publishing.receipts(spark, root).collect()}
    assert {k: (r["rows"], r["missing"], r["status"]) for k, r in got.items()} == {"good": (3, 0, "passed"), "holes": (3, 2, "incomplete"), "none": (0, 0, "refused"), "again": (3, 0, "passed")}
    assert got["good"]["inputs"] == ["x", "y"] and got["good"]["digest"] == got["again"]["digest"] != got["holes"]["digest"] and got["none"]["digest"] == "0"
    assert {r["publication"] for r in publishing.accepted_rows(spark, root, "k long, v string").collect()} == {"good", "again"}
    # published again, it replaces data and receipt
    publishing.publish(rows.where("k = 1"), root, "good", [], ["k", "v"])
    assert publishing.receipts(spark, root).where("publication = 'good'").head()["rows"] == 1
