"""Where fields are there, how far the next value is, and how far two products agree."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import evaluate, fill

# Fixed value: radius of the sphere in km.
RADIUS = 6371.0


def _on_sphere(lat: Column, lon: Column) -> list[Column]:
    a, b = F.radians(lat), F.radians(lon)
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def nearest_native(targets: DataFrame, donors: DataFrame, most_km: float = 25.0) -> DataFrame:
    """For each target (dst, lat, lon) the nearest donor (src, lat, lon) on the great circle, ties by src, and its distance in km.

    Points of the unit sphere are bucketed in cubes as wide as the chord of ``most_km``, so a donor within
    reach is in one of 27 cubes. Targets without a donor that near have neither donor nor distance. Places (lat, lon)
    are searched, not points: of donors at one place the least ``src`` stands for all, and targets there share what was found.
    """
    if not 0 < most_km < 1000:
        raise ValueError("most_km must be above 0 and below 1000")
    side = 2 * math.sin(most_km / RADIUS / 2) * (1 + 1e-9)
    axes = ["_x", "_y", "_z"]
    placed = lambda df, key, to: df.select(F.col(key), *(v.alias(f"{to}{a}") for a, v in zip(axes, _on_sphere(F.col("lat"), F.col("lon")), strict=True))).where(" and ".join(f"{to}{a} is not null and not isnan({to}{a})" for a in axes))
    places = ["lat", "lon"]
    d = placed(donors.groupBy(*places).agg(F.min("src").alias("src")), "src", "d").withColumns({f"c{a}": F.floor(F.col(f"d{a}") / side) for a in axes})
    at = targets.select(*places).distinct().select(F.struct(*places).alias("at"), *places)
    t = placed(at, "at", "t")
    for a in axes:
        cube = F.floor(F.col(f"t{a}") / side)
        t = t.withColumn(f"c{a}", F.explode(F.array(cube - 1, cube, cube + 1)))
    chord = F.sqrt(sum(((F.col(f"d{a}") - F.col(f"t{a}")) ** 2 for a in axes[1:]), (F.col("d_x") - F.col("t_x")) ** 2))
    near = t.join(d.hint("merge"), [f"c{a}" for a in axes]).groupBy("at").agg(F.min(F.struct(chord.alias("chord"), "src")).alias("b"))
    km = RADIUS * 2 * F.asin(F.least(F.col("b.chord") / 2, F.lit(1.0)))
    best = near.select("at.*", "b.src", km.alias("km")).where(F.col("km") <= most_km)
    # as many places as targets at worst
    return targets.select("dst", *places).join(best.hint("merge"), places, "left").select("dst", "src", "km")


def gap_categories(cells: DataFrame, fields: list[str], land: Column, mapped: DataFrame, most_cells: float) -> DataFrame:
    """Per cell (y, x): how many fields it lacks, the distance of the worst donor, and its category.

    0 lacks nothing, 1 is water, 2 is land with donors within ``most_cells``, 3 is land beyond, 4 such land that is in ``mapped`` (y, x).
    Where no cell has a field, its gaps count as beyond ``most_cells``.
    """
    held = cells.select("y", "x", land.alias("land"), *fields)
    none = lambda f: F.col(f).isNull() | F.isnan(f)
    out = held.withColumn("missing_fields", sum((F.when(none(f), 1).otherwise(0) for f in fields), F.lit(0)))
    far = F.lit(0.0)
    for f in fields:
        found = fill.nearest_donor(held.where(none(f)), held.where(~none(f))).select("y", "x", F.coalesce("distance", F.lit(float("inf"))).alias(f"_{f}"))
        out = out.join(found, ["y", "x"], "left")
        far = F.greatest(far, F.coalesce(f"_{f}", F.lit(0.0)))
    out = out.withColumn("distance", far).join(mapped.select("y", "x", F.lit(True).alias("_mapped")).distinct(), ["y", "x"], "left")
    category = F.when(F.col("missing_fields") == 0, 0).when(~F.coalesce("land", F.lit(False)), 1).when(F.col("distance") <= most_cells, 2).when(F.col("_mapped").isNull(), 3).otherwise(4)
    return out.select("y", "x", "missing_fields", "distance", category.alias("category"))


def coverage_patterns(samples: DataFrame, by: list[str], record: str, cell: str, valid: Column) -> DataFrame:
    """Per group: cells valid in some and in all records, distinct patterns of valid cells, and the least and most valid cells of a record.

    Samples hold each (record, cell) once. A pattern is known by the count, sum and exclusive-or of its cells' 64-bit hashes.
    """
    ok = F.coalesce(valid, F.lit(False))
    s = samples.select(*by, record, cell, ok.alias("_ok"))
    records = s.select(*by, record).distinct().groupBy(*by).agg(F.count("*").alias("records"))
    times = s.groupBy(*by, cell).agg(F.count_if("_ok").alias("n")).join(records, list(by))
    cells = times.groupBy(*by).agg(F.max("records").alias("records"), F.count_if(F.col("n") > 0).alias("union_cells"), F.count_if(F.col("n") == F.col("records")).alias("common_cells"))
    h = F.when(F.col("_ok"), F.xxhash64(cell))
    prints = s.groupBy(*by, record).agg(F.count(h).alias("n"), F.sum(h.cast("decimal(20,0)")).alias("a"), F.bit_xor(h).alias("b"))
    kinds = prints.groupBy(*by).agg(F.count_distinct(F.struct("n", "a", "b")).alias("patterns"), F.min("n").alias("least_valid"), F.max("n").alias("most_valid"))
    return cells.join(kinds, list(by))


def overlap_diagnostics(pairs: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Per group and variable of paired hours (``<f>`` and ``<f>_reference``): pairs asked for and found, bias, RMSE and the 95th percentile of the absolute difference."""
    each = F.array(*(F.struct(F.lit(f).alias("variable"), (F.col(f) - F.col(f"{f}_reference")).alias("d")) for f in fields))
    d = pairs.select(*by, F.explode(each).alias("e")).select(*by, "e.variable", F.when(~F.isnan("e.d") & (F.abs("e.d") < float("inf")), F.col("e.d")).alias("d"))
    found = d.groupBy(*by, "variable").agg(F.count("*").alias("requested"), F.count("d").alias("paired"), F.avg("d").alias("bias"), F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"))
    high = evaluate.quantiles(d.withColumn("d", F.abs("d")), [*by, "variable"], "d", {"p95": 0.95})
    return evaluate.same_keys(found, high, [*by, "variable"], "left")


def raster_sample(targets: DataFrame, raster: DataFrame, west: float, north: float, width: float, height: float, rows: int, columns: int) -> DataFrame:
    """Heights of targets (dst, lon, lat) between the four cells (row, col, value) around them of a north-up raster.

    Cells without a value are left out and the others' weights made up for; a target outside, or with no cell, has null.
    """
    fx, fy = (F.col("lon") - west) / width - 0.5, (F.lit(north) - F.col("lat")) / height - 0.5
    held = targets.withColumns({"_c": F.floor(fx), "_r": F.floor(fy), "_a": fx - F.floor(fx), "_b": fy - F.floor(fy)})
    inside = held.where((F.col("_c") >= 0) & (F.col("_r") >= 0) & (F.col("_c") + 1 < columns) & (F.col("_r") + 1 < rows))
    share = lambda part, k: F.col(part) if k else 1 - F.col(part)
    corners = F.array(*(F.struct((F.col("_r") + j).alias("row"), (F.col("_c") + i).alias("col"), (share("_a", i) * share("_b", j)).alias("w")) for j in (0, 1) for i in (0, 1)))
    near = inside.select("dst", F.explode(corners).alias("k")).select("dst", "k.row", "k.col", "k.w").join(raster.where("value is not null and not isnan(value)"), ["row", "col"])
    mean = near.groupBy("dst").agg(F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum("w")).alias("height"))
    return targets.select("dst").join(mean, "dst", "left")
