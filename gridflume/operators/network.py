"""Domain windows and the river network as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import staged, staged_counted


def bbox_window(cells: DataFrame, south: float, north: float, west: float, east: float, padding: int, rows: int, columns: int) -> DataFrame:
    """Rows and columns of the cells inside a box, padded and clamped to the grid."""
    inside = cells.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    lo = lambda c: F.greatest(F.min(c) - padding, F.lit(0)).alias(f"{c}_min")
    hi = lambda c, n: F.least(F.max(c) + padding, F.lit(n - 1)).alias(f"{c}_max")
    return inside.agg(lo("y"), hi("y", rows), lo("x"), hi("x", columns))


def downstream(seeds: DataFrame, reaches: DataFrame) -> DataFrame:
    """All links reachable downstream of the seeds within ``reaches`` (link, to_link), however far; cycles end.

    Levels are walked in rounds of doubled steps: each round joins the reach map with itself, so a
    network of depth d takes about log2(d) rounds. Each round is staged.
    """
    jump = staged(reaches.select("link", F.col("to_link").alias("to")).join(reaches.select(F.col("link").alias("to")), "to", "left_semi").select("link", "to"), "jump")
    found, before = staged_counted(seeds.select("link").join(reaches.select("link"), "link", "left_semi").distinct(), "found")
    while True:
        found, after = staged_counted(found.union(found.join(jump, "link").select(F.col("to").alias("link"))).distinct(), "found")
        if after == before:
            # no link one jump on was new; with jumps of 2**k the set is closed once the single step adds nothing
            single = found.join(reaches, "link").join(found.select(F.col("link").alias("to_link")), "to_link", "left_anti").join(reaches.select(F.col("link").alias("to_link")), "to_link", "left_semi")
            if not single.take(1):
                return found
        jump = staged(jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.link")).select(F.col("a.link").alias("link"), F.col("b.to").alias("to")), "jump")
        before = after


def topology_errors(reaches: DataFrame, weights: DataFrame | None = None, polygons: DataFrame | None = None, buckets: DataFrame | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """Counts of what is wrong with a routing network, a row (check, errors) each.

    ``reaches``: link, to_link, and index if the order is to be checked; ``polygons``: place (from 0), polyid, overlaps; ``weights``: place
    (from 0), polyid, i, j, in one row for each overlap; ``buckets``: place (from 0), polyid, basin. ``size`` is that of the routing grid (rows, columns).
    Checked are: repeated links, ends that are no link, loops; indices that are not 0 to the number of links less one, each once;
    overlaps that do not add up to the weights; polygons that are no link; weights that are not in the order of the polygons, as many as
    each overlaps; cells outside the grid; buckets not in the order of the polygons, and basins that don't count from 1.
    """
    rows = [_repeated(reaches, "link", "repeated_link")]
    ends = reaches.where("to_link <> 0").join(reaches.select(F.col("link").alias("to_link")).distinct(), "to_link", "left_anti")
    rows += [_errors(ends, "unresolved_downstream"), _errors(reaches.where("to_link = link"), "self_loop")]
    if "index" in reaches.columns:
        # as many as the links, all of them distinct and between the ends
        found = reaches.agg(F.count("*").alias("n"), F.count_distinct("index").alias("kinds"), F.min("index").alias("low"), F.max("index").alias("high"))
        wrong = F.when((F.col("n") == 0) | ((F.col("kinds") == F.col("n")) & (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)), 0).otherwise(F.greatest(F.col("n") - F.col("kinds"), F.lit(1)))
        rows.append(found.select(wrong.cast("long").alias("errors"), F.lit("index_not_a_permutation").alias("check")))
    if weights is not None and polygons is not None:
        sums = polygons.agg(F.coalesce(F.sum("overlaps"), F.lit(0)).alias("a"), F.lit(1).alias("_one")).join(weights.agg(F.count("*").alias("b"), F.lit(1).alias("_one")), "_one")
        rows.append(sums.select(F.abs(F.col("a") - F.col("b")).cast("long").alias("errors"), F.lit("overlap_sum").alias("check")))
        rows.append(_errors(polygons.join(reaches.select(F.col("link").alias("polyid")), "polyid", "left_anti"), "unknown_polygon"))
        # where a polygon's weights should lie follows from those of the polygons before it
        starts = running(polygons, "place", "overlaps").select("polyid", (F.col("through") - F.col("overlaps")).alias("first"), F.col("through").alias("end"))
        lying = weights.select("polyid", "place").join(starts, "polyid", "left")
        rows.append(_errors(lying.where("first is null or place < first or place >= end"), "weight_order"))
    if weights is not None and size is not None:
        outside = ~(F.col("i").between(1, size[1]) & F.col("j").between(1, size[0]))
        rows.append(_errors(weights.where(F.coalesce(outside, F.lit(True))), "outside_grid"))
    if buckets is not None and polygons is not None:
        at = polygons.select("place", F.col("polyid").alias("_poly")).join(buckets.select("place", "polyid"), "place", "full_outer")
        rows += [_errors(at.where("not (_poly <=> polyid)"), "bucket_order"), _errors(buckets.where("not (basin <=> place + 1)"), "basin_order")]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _errors(wrong: DataFrame, check: str) -> DataFrame:
    return wrong.agg(F.count("*").alias("errors")).withColumn("check", F.lit(check))


def _repeated(rows: DataFrame, key: str, check: str) -> DataFrame:
    return _errors(rows.groupBy(key).count().where("count > 1"), check)


def running(rows: DataFrame, order: str, value: str) -> DataFrame:
    """``rows`` with ``through``, the sum of ``value`` up to each in the order; summed in sorted partitions, so no task holds them all."""
    dealt = staged(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "running")
    sums = dealt.groupBy("_part").agg(F.sum(value).alias("_s"))
    # a row for each partition
    before = sums.withColumn("_before", F.sum("_s").over(Window.orderBy("_part")) - F.col("_s")).select("_part", "_before")
    own = F.sum(value).over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("through", own).join(F.broadcast(before), "_part").withColumn("through", F.col("through") + F.col("_before")).drop("_part", "_before")


def incomplete_catchments(full: DataFrame, retained: DataFrame, key: str) -> DataFrame:
    """Polygons with fewer retained overlaps than they have in all."""
    a = full.groupBy(key).agg(F.count("*").alias("overlaps"))
    b = retained.groupBy(key).agg(F.count("*").alias("kept"))
    return a.join(b, key).where("kept < overlaps")


def localized(indices: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """One-based indices inside a zero-based window, counted from its corner."""
    inside = indices.where((F.col("j") - 1).between(y0, y1) & (F.col("i") - 1).between(x0, x1))
    return inside.withColumns({"i": F.col("i") - x0, "j": F.col("j") - y0})


def refined_window(low: Column, high: Column, factor: int) -> tuple[Column, Column]:
    """Bounds of the same window on a grid ``factor`` times as fine; both bounds are inside it."""
    return low * factor, (high + 1) * factor - 1


def in_box(reaches: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """Reaches whose coordinates (lat, lon) are finite and inside a box."""
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in ("lat", "lon")]
    return reaches.where(finite[0] & finite[1] & F.col("lat").between(south, north) & F.col("lon").between(west, east))


def spatial_weights(records: DataFrame, candidates: DataFrame, key: str, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """Overlaps (key, i, j) of candidate polygons inside a window, counted from its corner, with ``overlaps`` of each polygon there."""
    inside = localized(records.join(candidates.select(key), key, "left_semi"), y0, y1, x0, x1)
    return inside.join(inside.groupBy(key).agg(F.count("*").alias("overlaps")), key)


def boundary_influence(full: DataFrame, retained: DataFrame, incomplete: DataFrame) -> DataFrame:
    """Retained links at or below one whose upstream link was clipped, or whose catchment is incomplete."""
    clipped = full.join(retained.select("link"), "link", "left_anti").select(F.col("to_link").alias("link"))
    return downstream(clipped.union(incomplete.select("link")), retained)


def selected_gauges(retained: DataFrame, gauges: DataFrame, name: str = "gage") -> DataFrame:
    """Gauges that a retained link names; names are compared without the spaces around them, blank ones name none."""
    named = retained.select(F.trim(name).alias(name)).where(F.col(name) != "")
    return gauges.withColumn(name, F.trim(name)).join(named, name, "left_semi")


def subset_network(reaches: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """Reaches inside a box and all below them, in the order of their links: ``to_link`` is 0 where it leads out, ``index`` counts from 0.

    Links are numbered in sorted partitions, with the counts of the partitions before, so no task sorts them all.
    """
    seeds = in_box(reaches, south, north, west, east)
    kept = reaches.join(downstream(seeds, reaches), "link", "left_semi")
    there = kept.select(F.col("link").alias("to_link"), F.lit(True).alias("_in")).distinct()
    cut = kept.join(there, "to_link", "left").withColumn("to_link", F.when(F.col("_in"), F.col("to_link")).otherwise(0)).drop("_in")
    # partitions must be the same for counts and numbers
    dealt = cut.repartitionByRange("link").withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).select("_part", "_before")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("link")) - 1
    return dealt.withColumn("index", place).join(F.broadcast(before), "_part").withColumn("index", F.col("index") + F.col("_before")).drop("_part", "_before")
