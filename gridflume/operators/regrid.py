"""Regridding as joins with a sparse link table (src, dst, weight)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("weight").isNotNull() & ~F.isnan("weight") & (F.col("weight") > 0) & (F.col("weight") < float("inf")))


def remap(values: DataFrame, links: DataFrame, fields: list[str], times: list[str] = ()) -> DataFrame:
    """Per target cell and time: weighted means over links with a value; null where none has one.

    All fields ride on one join, so links are shuffled once however many there are.
    """
    joined = values.join(links, values["src"] == links["src"]).drop(links["src"])
    weight = lambda f: F.when(F.col(f).isNotNull(), F.col("weight"))
    means = [F.try_divide(F.sum(F.col("weight") * F.col(f)), F.sum(weight(f))).alias(f) for f in fields]
    return joined.groupBy(*times, "dst").agg(*means)


def backproject(ratios: DataFrame, links: DataFrame, sources: DataFrame, unmapped: float = 1.0) -> DataFrame:
    """Per source cell the weighted mean of its targets' ratios; sources without a target get ``unmapped``."""
    joined = ratios.where("ratio is not null").join(links, "dst")
    mean = joined.groupBy("src").agg(F.try_divide(F.sum(F.col("weight") * F.col("ratio")), F.sum("weight")).alias("ratio"))
    return sources.join(mean, "src", "left").withColumn("ratio", F.coalesce("ratio", F.lit(unmapped)))


def inactive_links(links: DataFrame, active: DataFrame) -> DataFrame:
    return links.join(active.select("src").distinct(), "src", "left_anti").agg(F.count("*").alias("inactive_links"))


def normalised(links: DataFrame) -> DataFrame:
    """Links whose weights sum to one for each target."""
    total = links.groupBy("dst").agg(F.sum("weight").alias("total"))
    return links.join(total, "dst").select("src", "dst", (F.col("weight") / F.col("total")).alias("weight"))


def weight_error(links: DataFrame) -> DataFrame:
    return links.groupBy("dst").agg(F.sum("weight").alias("t")).agg(F.max(F.abs(F.col("t") - 1)).alias("largest_error"), F.count("*").alias("targets"))


def downsample(cells: DataFrame, value: str, factor: int) -> DataFrame:
    """Block maximum and mean over factor x factor cells; blocks that are not full are dropped."""
    by = [F.floor(F.col(c) / factor).alias(f"block_{c}") for c in ("y", "x")]
    blocks = cells.groupBy(*by).agg(F.max(value).alias("block_max"), F.avg(value).alias("block_mean"), F.count("*").alias("cells"))
    return blocks.where(F.col("cells") == factor * factor)


def bilinear_links(targets: DataFrame, lat0: float, lon0: float, step: float, rows: int, columns: int) -> DataFrame:
    """Four links (y, x, weight) of each target on a regular grid; none for targets outside it."""
    fy, fx = (F.col("lat") - lat0) / step, (F.col("lon") - lon0) / step
    y = F.least(F.floor(fy), F.lit(rows - 2))
    x = F.least(F.floor(fx), F.lit(columns - 2))
    inside = targets.where((fy >= 0) & (fy <= rows - 1) & (fx >= 0) & (fx <= columns - 1)).withColumns({"_y": y, "_x": x, "_a": fy - y, "_b": fx - x})

    def corner(dy: int, dx: int) -> Column:
        wy, wx = (F.col("_a") if dy else 1 - F.col("_a")), (F.col("_b") if dx else 1 - F.col("_b"))
        return F.struct((F.col("_y") + dy).alias("y"), (F.col("_x") + dx).alias("x"), (wy * wx).alias("weight"))

    corners = F.array(*[corner(dy, dx) for dy in (0, 1) for dx in (0, 1)])
    return inside.select("dst", F.explode(corners).alias("c")).select("dst", "c.y", "c.x", "c.weight")


def terrain_report(cells: DataFrame, needed: Column, height: str, low: float = -500.0, high: float = 9000.0) -> DataFrame:
    """One row: cells, needed cells without a height, heights outside the limits, and whether the terrain is valid."""
    there = F.col(height).isNotNull() & ~F.isnan(height)
    found = cells.agg(F.count("*").alias("cells"), F.count_if(F.coalesce(needed, F.lit(False)) & ~there).alias("uncovered"), F.count_if(there & ~F.col(height).between(low, high)).alias("out_of_range"))
    return found.withColumn("valid", (F.col("cells") > 0) & (F.col("uncovered") == 0) & (F.col("out_of_range") == 0))


def remap_day(hours: DataFrame, links: DataFrame, fields: list[str], day: str, hour: str, needed: int = 24) -> DataFrame:
    """All fields of all hours of whole days on target cells, by one join with the links; days without ``needed`` hours are not given."""
    whole = hours.groupBy(day).agg(F.count_distinct(hour).alias("_n")).where(F.col("_n") == needed).select(day)
    return remap(hours.join(whole, day, "left_semi"), usable_links(links), fields, [day, hour])
