"""Whole hours in one plan: from the choice of a source to eight fields with their provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bundle, composite, regrid


def complete_hours(candidates: DataFrame, native: DataFrame, links: DataFrame, targets: DataFrame, rain: DataFrame, done: DataFrame, sources: dict[str, int], quality: float = 0.5) -> DataFrame:
    """Rows (ts, dst) of all hours that are not in ``done`` (ts) and have a valid source.

    ``candidates``: ts, product, valid; ``sources`` names the products by preference, with their ids. ``native``: ts, product, src, t, q, p, lw, z0, sw,
    u, v (to the east and north); ``links``: product, src, dst, weight; ``targets``: dst, z1, lat, lon, active; ``rain``: what
    ``composite.composite`` takes, by ts and dst. Of each hour only the chosen product's cells are remapped. Gives the seven fields, rain
    rate, qc, both source ids, the product and whether it is a fallback; an hour with no candidate of rain has none.
    """
    todo = candidates.join(done.select("ts").distinct(), "ts", "left_anti")
    chosen = composite.select_source(todo, ["ts"], "product", "valid", list(sources)).where("selected is not null").select("ts", F.col("selected").alias("product"), "fallback_used")
    cells = native.join(chosen, ["ts", "product"])
    state = bundle.native_radiation_wind(bundle.reference_state(cells), None).withColumns({"negative": F.col("negative").cast("double"), "src": F.struct("product", "src")})
    keyed = links.select(F.struct("product", "src").alias("src"), "dst", "weight")
    fields = ["t_ref", "p_ref", "rh", "lw_factor", "shortwave", "negative", "east", "north"]
    at = regrid.remap(state.select("ts", "product", "fallback_used", "src", *fields), regrid.usable_links(keyed), fields, ["ts", "product", "fallback_used"]).join(targets, "dst")
    done_state = bundle.target_radiation(bundle.target_state(at.withColumn("negative", F.coalesce(F.col("negative") > 0, F.lit(False)))))
    source = F.lit(0)
    for product, number in sources.items():
        source = F.when(F.col("product") == product, F.lit(number)).otherwise(source)
    hours = bundle.combined(done_state, ["ts", "dst"], source, "product", "fallback_used")
    return bundle.with_precipitation(hours, composite.composite(rain.join(chosen.select("ts"), "ts", "left_semi"), quality), ["ts", "dst"])


def hour_summary(hours: DataFrame) -> DataFrame:
    """Per hour: its product, whether it is a fallback, cells, cells without a rain source, and how many of each rain source."""
    counts = hours.groupBy("ts", "product", "fallback_used", F.coalesce("precip_source_id", F.lit(0)).alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("source_id") == 0).alias("partial"))
    return counts.groupBy("ts", "product", "fallback_used").agg(F.sum("n").alias("cells"), F.sum("partial").alias("partial_cells"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("id", "n")))).alias("precipitation_sources"))
