"""Fallback fields at gap cells, their provenance, masks applied to published fields, and guards on replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Usage bits, source ids and confidence of the fallback.
USED, RAIN_USED, TERRAIN, CLIPPED, ROUNDED, REPAIRED = 1, 2, 4, 8, 16, 32
FALLBACK_MET, FALLBACK_RAIN, FALLBACK_CONFIDENCE, FALLBACK_FLAG = 4, 8, 0.15, 4
TRUSTED_RAIN = [1, 2, 3, 4, 5, 7]


def best_available(pass2: Column, pass1: Column) -> Column:
    return F.coalesce(pass2, pass1)


def precipitation_supported(source: Column, value: Column, qc: Column) -> Column:
    """Whether rain was chosen from an observation or analysis, and is neither missing nor negative."""
    ok = source.isin(TRUSTED_RAIN) & ~F.isnan(value) & (value >= 0) & (value < float("inf")) & (qc.bitwiseAND(F.lit(8)) == 0)
    return F.coalesce(ok, F.lit(False))


def merged(primary: DataFrame, fallback: DataFrame, keys: list[str], fields: list[str], rain: str, supported: Column, preferred: Column) -> DataFrame:
    """Fallback fields at the cells that ``fallback`` has, and its rain there where the primary's has no support.

    Hours whose preferred source is there (``preferred``) stay as they are. ``used`` and ``rain_used`` tell what was replaced.
    """
    side = fallback.select(*keys, *(F.col(f).alias(f"_{f}") for f in [*fields, rain]), F.lit(True).alias("_gap"))
    used = F.coalesce(F.col("_gap"), F.lit(False)) & ~preferred
    rain_used = used & ~supported
    joined = primary.join(side, keys, "left").withColumns({"used": used, "rain_used": rain_used})
    now = {f: F.when(F.col("used"), F.col(f"_{f}")).otherwise(F.col(f)) for f in fields}
    now[rain] = F.when(F.col("rain_used"), F.col(f"_{rain}")).otherwise(F.col(rain))
    return joined.withColumns(now).drop("_gap", *(f"_{f}" for f in [*fields, rain]))


def provenance(cells: DataFrame) -> DataFrame:
    """Usage bits and the sources, flags and confidence that follow, from used, rain_used, terrain, clipped, rounded, repaired, keep.

    Cells outside ``keep`` have source 0.
    """
    bit = lambda c, b: F.when(F.col(c), F.lit(b)).otherwise(F.lit(0))
    usage = bit("used", USED) + bit("rain_used", RAIN_USED) + F.when(F.col("used"), bit("terrain", TERRAIN) + bit("clipped", CLIPPED) + bit("rounded", ROUNDED)).otherwise(F.lit(0)) + bit("repaired", REPAIRED)
    outside = ~F.col("keep")
    return cells.withColumns({
        "usage": usage,
        "met_source": F.when(outside, 0).when(F.col("used"), FALLBACK_MET).otherwise(F.col("met_source")),
        "met_qc": F.when(F.col("used"), 0).otherwise(F.col("met_qc")),
        "rain_source": F.when(outside, 0).when(F.col("rain_used"), FALLBACK_RAIN).otherwise(F.col("rain_source")),
        "rain_qc": F.when(F.col("rain_used"), FALLBACK_FLAG).otherwise(F.col("rain_qc")),
        "confidence": F.when(F.col("rain_used"), FALLBACK_CONFIDENCE).otherwise(F.col("confidence")),
    })


def six_hour_collection(files: DataFrame, keys: list[str], hour: Column, encoding: Column) -> DataFrame:
    """Of a day's files at 00, 06, 12 and 18 the newest encoding each; days without all four are not given."""
    w = Window.partitionBy(*keys, "_hour").orderBy(F.desc("_encoding"), F.desc("file"))
    best = files.withColumns({"_hour": hour, "_encoding": encoding}).where(F.col("_hour").isin(0, 6, 12, 18)).withColumn("_k", F.row_number().over(w)).where("_k = 1")
    whole = F.count("*").over(Window.partitionBy(*keys))
    return best.withColumn("_n", whole).where("_n = 4").select(*keys, F.col("_hour").alias("hour"), "file")


def downgrades(old: DataFrame, new: DataFrame, keys: list[str], hour: str, product: str, preferred: str) -> DataFrame:
    """Hours that a replacement would lose or take from the preferred source; a replacement is allowed where there are none."""
    both = old.select(*keys, hour, F.col(product).alias("_old")).join(new.select(*keys, hour, F.col(product).alias("_new")), [*keys, hour], "left")
    why = F.when(F.col("_new").isNull(), "lost").when((F.col("_old") == preferred) & (F.col("_new") != preferred), "downgraded")
    return both.withColumn("reason", why).where("reason is not null").select(*keys, hour, "reason")


def masked(fields: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    """Published rows inside the mask, unchanged."""
    return fields.join(keep.select(*keys).distinct(), keys, "left_semi")


def incomplete(fields: DataFrame, active: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Active cells that have no row or miss a field; published fields must have none."""
    gone = F.lit(False)
    for n in names:
        gone = gone | F.col(n).isNull()
    return active.select(*keys).join(fields, keys, "left").where(gone).select(*keys)


def restored(fields: DataFrame, donor: DataFrame, keys: list[str], name: str, active: str) -> DataFrame:
    """The donor's value in cells that are not active; active cells stay as they are."""
    joined = fields.join(donor.select(*keys, F.col(name).alias("_donor")), keys, "left")
    return joined.withColumn(name, F.when(~F.col(active), F.coalesce("_donor", name)).otherwise(F.col(name))).drop("_donor")


def deactivated(cells: DataFrame, inside: Column, land: str, water: int = 2) -> DataFrame:
    """Land cells outside become water; ``changed`` marks them."""
    change = ~inside & (F.col(land) != water)
    return cells.withColumn("changed", change).withColumn(land, F.when(F.col("changed"), F.lit(water)).otherwise(F.col(land)))


def mask_digest(cells: DataFrame, keys: list[str], kept: Column, part: Column) -> DataFrame:
    """SHA-256 of a mask: cells are digested by ``part`` (a few thousand cells each, in order of their keys), then the parts' digests in order."""
    rows = cells.select(part.alias("part"), F.struct(*keys).alias("at"), F.concat_ws(",", *keys, kept.cast("int")).alias("row"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "row"))), lambda x: x["row"]), ";")
    parts = rows.groupBy("part").agg(F.sha2(text, 256).alias("digest"))
    return parts.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda x: x["digest"]), ""), 256).alias("mask_sha256"))
