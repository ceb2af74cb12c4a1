"""Masks, gaps and donors on grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import staged, staged_counted


def domain_mask(lat: Column, lon: Column, south: float = 25, north: float = 53, west: float = -125, east: float = -67) -> Column:
    turned = F.pmod(lon + 180, F.lit(360.0)) - 180
    return lat.between(south, north) & turned.between(west, east)


def persistent_gaps(values: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Cells of which some field is missing at every time."""
    always = [F.bool_and(F.col(f).isNull()) for f in fields]
    gap = always[0]
    for a in always[1:]:
        gap = gap | a
    return values.groupBy(*keys).agg(gap.alias("persistent_gap"))


def _near(at: str, tile: str, size: int) -> Column:
    """How far along an axis the nearest cell of a tile is."""
    low = F.col(tile) * size
    return F.greatest(low - F.col(at), F.col(at) - (low + size - 1), F.lit(0))


def _far(at: str, tile: str, size: int) -> Column:
    low = F.col(tile) * size
    return F.greatest(F.abs(F.col(at) - low), F.abs(F.col(at) - (low + size - 1)))


def _around(cells: DataFrame, size: int, ring: int) -> DataFrame:
    """Cells (y, x) with each tile (ty, tx) of a side ``size`` in the rings about their own."""
    steps = F.sequence(F.lit(-ring), F.lit(ring))
    near = cells.withColumn("dy", F.explode(steps)).withColumn("dx", F.explode(steps))
    return near.withColumns({"ty": F.floor(F.col("y") / size) + F.col("dy"), "tx": F.floor(F.col("x") / size) + F.col("dx")}).drop("dy", "dx")


def nearest_donor(gaps: DataFrame, donors: DataFrame, tile: int = 8, by: list[str] = ()) -> DataFrame:
    """For each gap cell (by, y, x) the nearest donor cell of its ``by`` by grid distance, ties by (y, x), however far it is.

    Occupied tiles form a pyramid, each level of tiles twice the size of those below. A gap goes up to the
    first level where its own tile or one beside it holds a donor, and down again through those tiles
    alone that can hold a nearer one. Donors are null where there is none at all.
    """
    by = list(by)
    at, cell = [*by, "ty", "tx"], [*by, "y", "x"]
    d = staged(donors.select(*by, F.col("y").cast("long").alias("donor_y"), F.col("x").cast("long").alias("donor_x")).distinct(), "donors")
    asked = staged(gaps.select(*by, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x")).distinct(), "gaps")
    one = F.lit(1).alias("_one")
    served = d.select(*by, one).distinct()
    left = staged(asked.withColumn("_one", F.lit(1)).join(served, [*by, "_one"], "left_semi").drop("_one"), "gaps")
    none = asked.withColumn("_one", F.lit(1)).join(served, [*by, "_one"], "left_anti").select(*cell, F.lit(None).cast("long").alias("donor_y"), F.lit(None).cast("long").alias("donor_x"), F.lit(None).cast("double").alias("distance"))
    levels: list[tuple[DataFrame, DataFrame]] = []
    n = left.count()
    while n:
        below = levels[-1][0].select(*by, (F.col("ty") / 2).alias("ty"), (F.col("tx") / 2).alias("tx")) if levels else d.select(*by, (F.col("donor_y") / tile).alias("ty"), (F.col("donor_x") / tile).alias("tx"))
        tiles = staged(below.select(*by, F.floor("ty").alias("ty"), F.floor("tx").alias("tx")).distinct(), "tiles")
        met = staged(_around(left, tile << len(levels), 1).join(tiles, at).select(*cell).distinct(), "met")
        levels.append((tiles, met))
        left, n = staged_counted(left.join(met, cell, "left_anti"), "gaps")
    now = None
    for level in reversed(range(len(levels))):
        tiles, met = levels[level]
        size = tile << level
        # a donor in a tile beside one's own is at most the diagonal of two tiles away, so within three rings
        mine = _around(met, size, 3).join(tiles, at).select(*cell, "ty", "tx")
        now = mine if now is None else now.unionByName(mine)
        near = _near("y", "ty", size) ** 2 + _near("x", "tx", size) ** 2
        held = now.withColumns({"_near": near, "_far": _far("y", "ty", size) ** 2 + _far("x", "tx", size) ** 2})
        held = held.withColumn("_most", F.min("_far").over(Window.partitionBy(*cell))).where("_near <= _most").select(*cell, "ty", "tx")
        now = staged(held, "near_tiles")
        if level:
            children = levels[level - 1][0].select(*by, F.col("ty").alias("cy"), F.col("tx").alias("cx"), F.floor(F.col("ty") / 2).alias("ty"), F.floor(F.col("tx") / 2).alias("tx"))
            now = now.join(children, at).select(*cell, F.col("cy").alias("ty"), F.col("cx").alias("tx"))
    if now is None:
        return none
    # a tile's donors, tile * tile at most, are one row; of them each gap takes its nearest before any rows are sorted
    placed = d.withColumns({"ty": F.floor(F.col("donor_y") / tile), "tx": F.floor(F.col("donor_x") / tile)}).groupBy(*at).agg(F.collect_list(F.struct("donor_y", "donor_x")).alias("held"))
    d2 = lambda k: (k["donor_y"] - F.col("y")) ** 2 + (k["donor_x"] - F.col("x")) ** 2
    nearest = F.array_min(F.transform("held", lambda k: F.struct(d2(k).alias("d2"), k["donor_y"].alias("donor_y"), k["donor_x"].alias("donor_x"))))
    best = now.join(placed.hint("merge"), at).select(*cell, nearest.alias("b")).groupBy(*cell).agg(F.min("b").alias("b"))
    return staged(best.select(*cell, "b.donor_y", "b.donor_x", F.sqrt("b.d2").alias("distance")).union(none), "nearest")


def mask_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    a, b = old.select(*keys).distinct().withColumn("_old", F.lit(1)), new.select(*keys).distinct().withColumn("_new", F.lit(1))
    both = a.join(b, keys, "full_outer")
    return both.agg(F.count("_old").alias("old_cells"), F.count("_new").alias("new_cells"), F.count_if(F.col("_old").isNull()).alias("added"), F.count_if(F.col("_new").isNull()).alias("removed"))


def derived_masks(cells: DataFrame) -> DataFrame:
    """Model cells are active inside the boundary, forcing cells kept inside it; counts and model cells without forcing."""
    model, forcing = F.col("boundary") & F.col("active"), F.col("boundary") & F.col("keep")
    return cells.agg(F.count_if(model).alias("model_cells"), F.count_if(forcing).alias("forcing_cells"), F.count_if(model & ~forcing).alias("uncovered"))


#: Edges of a polygon that are sent to all tasks.
MOST_EDGES = 200_000


def in_polygon(points: DataFrame, edges: DataFrame) -> DataFrame:
    """Points (id, lon, lat) inside a polygon of edges (x1, y1, x2, y2), by an odd number of crossings to the east.

    The edges are broadcast; a polygon of more than ``MOST_EDGES`` is refused.
    """
    if edges.limit(MOST_EDGES + 1).count() > MOST_EDGES:
        raise ValueError(f"a polygon of more than {MOST_EDGES} edges is not broadcast")
    crossing = ((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))) & (
        F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) + F.col("x1")
    )
    return points.join(F.broadcast(edges), crossing).groupBy("id").agg(F.count("*").alias("n")).where("n % 2 = 1").select("id")


def _reflected(cells: DataFrame, axis: str, before: int, after: int, low: int, high: int) -> DataFrame:
    """Cells and their mirror images beyond both ends of an axis, the end cells themselves not repeated."""
    at = F.col(axis)
    images = F.array(at, F.when((at > low) & (at <= low + before), 2 * low - at), F.when((at < high) & (at >= high - after), 2 * high - at))
    return cells.withColumn(axis, F.explode(F.array_compact(images)))


def box_smooth(cells: DataFrame, values: list[str], window: int, rows: tuple[int, int], columns: tuple[int, int], by: list[str] = ()) -> DataFrame:
    """``<value>_smooth``: the mean over a box of ``window`` cells a side, of the cells that have a value.

    The grid (first and last row and column) is mirrored at its edges. One pass along rows and one along
    columns serve all values; null where a box has none.
    """
    before = window // 2
    after = window - before - 1
    span = lambda axis, across: Window.partitionBy(*by, across).orderBy(axis).rangeBetween(-before, after)
    held = cells.withColumns({f"_s_{v}": F.coalesce(F.col(v), F.lit(0.0)) for v in values} | {f"_n_{v}": F.when(F.col(v).isNotNull(), 1).otherwise(0) for v in values})
    for axis, across, (low, high) in (("x", "y", columns), ("y", "x", rows)):
        w = span(axis, across)
        wide = _reflected(held, axis, before, after, low, high)
        held = wide.withColumns({f"_{k}_{v}": F.sum(f"_{k}_{v}").over(w) for k in "sn" for v in values}).where(F.col(axis).between(low, high))
    return held.withColumns({f"{v}_smooth": F.try_divide(F.col(f"_s_{v}"), F.col(f"_n_{v}")) for v in values}).drop(*(f"_{k}_{v}" for k in "sn" for v in values))


def cropped(fields: DataFrame, y0: int, y1: int, x0: int, x1: int, active: Column, columns: list[str]) -> DataFrame:
    """Cells of an inclusive window, counted from its corner; ``lacking`` marks active cells that miss a field."""
    missing = F.lit(False)
    for f in columns:
        missing = missing | F.col(f).isNull()
    inside = fields.where(F.col("y").between(y0, y1) & F.col("x").between(x0, x1)).withColumn("lacking", F.coalesce(active, F.lit(False)) & missing)
    return inside.withColumns({"y": F.col("y") - y0, "x": F.col("x") - x0})


def propagated(cells: DataFrame, value: str, land: Column, allowed: Column, most: int) -> DataFrame:
    """Values of cells (y, x) that lack one, taken from a side neighbour nearer to a value, step by step up to ``most`` steps.

    Of such neighbours the one to the right goes first, then left, below, above. Steps cross any cell, but only
    approved land changes: ``distance`` counts its steps and is 0 elsewhere. ``fault``: ``unapproved`` (land without a value that is not
    allowed), ``too_far`` (no value within ``most`` steps, or none to be reached). Each step is checkpointed.
    """
    gap = F.col(value).isNull() | F.isnan(value)
    held = cells.select("y", "x", F.when(~gap, F.col(value)).alias("v"), (F.coalesce(land, F.lit(False)) & gap).alias("target"), F.coalesce(allowed, F.lit(False)).alias("allowed")).checkpoint()
    front, still, done = held.where("v is not null").select("y", "x", "v"), held.where("v is null").select("y", "x", "target"), None
    # which neighbour the giving cell is to the one at this offset: right, left, below, above
    to = F.array(*(F.struct(F.lit(k).alias("rank"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for k, (dy, dx) in enumerate([(0, -1), (0, 1), (-1, 0), (1, 0)])))
    for step in range(1, most + 1):
        if not still.where("target").take(1):
            break
        offers = front.select("y", "x", "v", F.explode(to).alias("o")).select((F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), "o.rank", "v")
        front = offers.join(still.select("y", "x"), ["y", "x"]).groupBy("y", "x").agg(F.min_by("v", "rank").alias("v")).checkpoint()
        given = front.withColumn("step", F.lit(step))
        done = given if done is None else done.unionByName(given)
        still = still.join(front.select("y", "x"), ["y", "x"], "left_anti").checkpoint()
    if done is None:
        done = front.where("false").withColumn("step", F.lit(0))
    found = held.join(done.withColumnRenamed("v", "_new"), ["y", "x"], "left")
    good = F.col("target") & F.col("allowed") & F.col("step").isNotNull()
    fault = F.when(F.col("target") & ~F.col("allowed"), "unapproved").when(F.col("target") & F.col("step").isNull(), "too_far")
    return found.select("y", "x", F.when(good, F.col("_new")).otherwise(F.col("v")).alias("value"), F.when(good, F.col("step")).otherwise(0).alias("distance"), fault.alias("fault"))
