"""Choice of sources per hour and per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Source ids and quality-control bits.
SOURCE_IDS = {"pass2": 1, "pass1": 2, "archive": 3, "realtime": 4, "land": 5, "forecast": 6, "six_hour": 7}
LOW_QUALITY, OVERRIDE, FALLBACK, MISSING, EXTREME, EXCLUDED = 1, 2, 4, 8, 32, 64


def select_source(candidates: DataFrame, keys: list[str], product: str, valid: str, preference: list[str]) -> DataFrame:
    """Per key the first valid product in order of preference, whether it is a fallback, and the rejected ones before it."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col(product))
    ranked = candidates.withColumn("_rank", rank).where("_rank > 0")
    best = F.min(F.when(F.col(valid), F.col("_rank"))).over(Window.partitionBy(*keys))
    return ranked.withColumn("_best", best).groupBy(*keys, "_best").agg(
        F.max(F.when(F.col("_rank") == F.col("_best"), F.col(product))).alias("selected"),
        F.sort_array(F.collect_set(F.when(~F.col(valid) & (F.col("_rank") < F.coalesce("_best", F.lit(1 << 30))), F.col(product)))).alias("rejected"),
    ).withColumn("fallback_used", F.coalesce(F.col("_best") > 1, F.lit(False))).drop("_best")


def composite(cells: DataFrame, threshold: float = 0.5, extreme: float = 300.0) -> DataFrame:
    """Depth, source id, confidence and quality bits per cell.

    Columns: pass2, pass1, archive, realtime, land, forecast (depths or null), quality, override,
    exclusion. An override takes the archive or else the realtime product, outside exclusions;
    gauge-corrected passes need quality; the rest follow in order of trust. What is not finite counts
    as missing.
    """
    products = ["pass2", "pass1", "archive", "realtime", "land", "forecast", "quality"]
    cells = cells.withColumns({k: F.when(~F.isnan(k) & (F.abs(k) < float("inf")), F.col(k)) for k in products})
    q = F.coalesce("quality", F.lit(0.0))
    good = F.coalesce(F.col("quality") >= threshold, F.lit(False))
    override, open_ = F.coalesce("override", F.lit(False)), ~F.coalesce("exclusion", F.lit(False))
    has = lambda p: F.coalesce(F.col(p) >= 0, F.lit(False))
    order: list[tuple[str, Column, Column]] = [
        ("archive", override & open_, F.lit(0.85)), ("realtime", override & open_, F.lit(0.75)),
        ("pass2", good, q), ("pass1", good, q * 0.9),
        ("archive", open_, F.lit(0.8)), ("realtime", open_, F.lit(0.7)),
        ("land", F.lit(True), F.lit(0.4)), ("forecast", F.lit(True), F.lit(0.2)),
    ]
    depth, source, confidence = F.lit(None).cast("double"), F.lit(0), F.lit(0.0)
    for product, ok, trust in reversed(order):
        take = has(product) & ok
        depth = F.when(take, F.col(product)).otherwise(depth)
        source = F.when(take, F.lit(SOURCE_IDS[product])).otherwise(source)
        confidence = F.when(take, trust).otherwise(confidence)
    out = cells.withColumns({"depth": depth, "source_id": source, "confidence": confidence})
    s = F.col("source_id")
    bit = lambda ok, b: F.when(F.coalesce(ok, F.lit(False)), F.lit(b)).otherwise(F.lit(0))
    bits = [
        bit(F.col("quality").isNotNull() & ~good, LOW_QUALITY), bit(s.isin(SOURCE_IDS["archive"], SOURCE_IDS["realtime"]) & override, OVERRIDE),
        bit(s.between(3, 6), FALLBACK), bit(s == 0, MISSING), bit(F.col("depth") > extreme, EXTREME),
        bit(~open_ & (has("archive") | has("realtime")), EXCLUDED),
    ]
    return out.withColumn("qc", sum(bits[1:], bits[0]))


def classify_hours(cells: DataFrame, hour: str, source: str) -> DataFrame:
    """What a whole hour was made from, by the set of its cells' source ids."""
    ids = F.sort_array(F.collect_set(source))
    kind = F.when(F.col("ids") == F.array(F.lit(1)), "land").when(F.col("ids") == F.array(F.lit(1), F.lit(3)), "hybrid").when(F.col("ids") == F.array(F.lit(2)), "forecast").otherwise("mixed")
    return cells.groupBy(hour).agg(ids.alias("ids")).withColumn("kind", kind).drop("ids")
