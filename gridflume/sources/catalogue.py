"""Which file holds what: candidates of an hour, hours of a window, and checks of what files and weights say of themselves."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def candidates(files: DataFrame, by: list[str], product: str, hour: Column, six_hourly: Column, preference: Column) -> DataFrame:
    """Per key (with the valid time) and product the preferred file (column ``path``); six-hour products only where the hour divides by 6.

    The smallest ``preference`` wins, then the smallest path.
    """
    usable = files.where(~F.coalesce(six_hourly, F.lit(False)) | (hour % 6 == 0))
    return usable.groupBy(*by, product).agg(F.min_by("path", F.struct(preference, F.col("path"))).alias("path"))


def resolved_hours(wanted: DataFrame, records: DataFrame, by: list[str], preference: Column) -> DataFrame:
    """Per wanted key the one record (column ``path``) that holds it; ``missing`` where none does."""
    best = records.groupBy(*by).agg(F.min_by("path", F.struct(preference, F.col("path"))).alias("path"))
    return wanted.select(*by).distinct().join(best, by, "left").withColumn("missing", F.col("path").isNull())


def schema_faults(found: DataFrame, required: DataFrame, by: list[str]) -> DataFrame:
    """Required variables (by, variable, units) that a schema lacks or has in other units, with the fault's name."""
    have = found.select(*by, "variable", F.col("units").alias("_units"), F.lit(True).alias("_there"))
    fault = F.when(F.col("_there").isNull(), "missing").when(~F.col("_units").eqNullSafe(F.col("units")), "units")
    return required.join(have, [*by, "variable"], "left").withColumn("fault", fault).where("fault is not null").select(*by, "variable", "fault")


def weight_mismatches(operators: DataFrame, grids: DataFrame, method: str) -> DataFrame:
    """Weights (weights, source_grid, source_print, target_grid, target_print, method) whose fingerprints or method are not the present ones."""
    prints = lambda side: grids.select(F.col("grid").alias(f"{side}_grid"), F.col("print").alias(f"_{side}"))
    joined = operators.join(prints("source"), "source_grid", "left").join(prints("target"), "target_grid", "left")
    off = {"source": ~F.col("source_print").eqNullSafe(F.col("_source")), "target": ~F.col("target_print").eqNullSafe(F.col("_target")), "method": ~F.col("method").eqNullSafe(F.lit(method))}
    return joined.select("weights", *(c.alias(f"{k}_differs") for k, c in off.items())).where("source_differs or target_differs or method_differs")


def cohort(plan: DataFrame, results: DataFrame, station: str, by: list[str], counted: list[str]) -> DataFrame:
    """Per domain: stations planned, done once, absent, repeated and unplanned, and sums of what the results count."""
    done = results.groupBy(station).agg(F.count("*").alias("_n"), *(F.sum(c).alias(c) for c in counted))
    both = plan.select(station, *by, F.lit(True).alias("_planned")).join(done, station, "full_outer")
    planned, n = F.col("_planned").isNotNull(), F.coalesce("_n", F.lit(0))
    return both.groupBy(*by).agg(
        F.count_if(planned).alias("planned"), F.count_if(planned & (n == 1)).alias("once"), F.count_if(planned & (n == 0)).alias("absent"), F.count_if(planned & (n > 1)).alias("repeated"),
        F.count_if(~planned).alias("unplanned"), *(F.sum(F.when(planned, F.col(c))).alias(c) for c in counted),
    )


def index_ranges(lines: DataFrame, file: str, place: str, line: str) -> DataFrame:
    """Byte ranges of the records that a file's index lines (``number:offset:date:variable:level:timing...``) name.

    Lines of fewer than six fields, or without a whole number and offset, are left out. A record ends before the next one of its
    file, in the order of ``place``; the last one's end is not known.
    """
    parts = F.split(F.col(line), ":")
    whole = lambda k: F.when(F.regexp_like(F.get(parts, F.lit(k)), F.lit(r"^\s*[+-]?\d{1,18}\s*$")), F.trim(F.get(parts, F.lit(k))).cast("long"))
    field = lambda k, n: F.get(parts, F.lit(k)).alias(n)
    found = lines.where(F.size(parts) >= 6).select(file, place, whole(0).alias("number"), whole(1).alias("first_byte"), field(3, "variable"), field(4, "level"), field(5, "timing")).where("number is not null and first_byte is not null")
    return found.withColumn("last_byte", F.lead("first_byte").over(Window.partitionBy(file).orderBy(place)) - 1)


def selected_ranges(records: DataFrame, file: str, wanted: list[tuple[str, str, str]]) -> DataFrame:
    """For each file with an index and each wanted (variable, level, timing): its one record's range, else a ``fault``.

    ``fault`` is ``absent`` or ``repeated`` where not exactly one record fits, ``no_end`` where it is the file's last.
    """
    kinds = F.explode(F.array(*(F.struct(F.lit(v).alias("variable"), F.lit(h).alias("level"), F.lit(t).alias("timing")) for v, h, t in wanted)))
    asked = records.select(file).distinct().select(file, kinds.alias("w")).select(file, "w.*")
    names = [file, "variable", "level", "timing"]
    have = records.groupBy(*names).agg(F.count("*").alias("records"), F.min("first_byte").alias("first_byte"), F.min("last_byte").alias("last_byte"))
    n = F.coalesce("records", F.lit(0))
    fault = F.when(n == 0, "absent").when(n > 1, "repeated").when(F.col("last_byte").isNull(), "no_end")
    out = asked.join(have, names, "left").withColumn("fault", fault)
    ok = F.col("fault").isNull()
    return out.select(*names, F.when(ok, F.col("first_byte")).alias("first_byte"), F.when(ok, F.col("last_byte")).alias("last_byte"), "fault")


def latest_coverage(files: DataFrame, name: str, products: dict[str, tuple[str, str]]) -> DataFrame:
    """Per product its files and the newest valid time that their names give; a product without files has 0 and null.

    ``products`` maps a name to a pattern, whose groups together read as a stamp of the given form. A name counts for every
    product whose pattern it holds; one that holds it, but reads as no stamp, is counted in ``unread`` alone. Paths are cut to their last part.
    """
    last = F.substring_index(name, "/", -1)

    def read(product: str, pattern: str, form: str) -> Column:
        groups = re.compile(pattern).groups
        text = F.concat(*(F.regexp_extract(last, pattern, k + 1) for k in range(groups)))
        return F.when(last.rlike(pattern), F.struct(F.lit(product).alias("product"), F.try_to_timestamp(text, F.lit(form)).alias("stamp")))

    found = files.select(F.explode(F.array_compact(F.array(*(read(n, *how) for n, how in products.items())))).alias("_p")).select("_p.*")
    seen = found.groupBy("product").agg(F.max("stamp").alias("latest"), F.count("stamp").alias("files"), F.count_if(F.col("stamp").isNull()).alias("unread"))
    every = files.sparkSession.createDataFrame([(n,) for n in products], "product string")
    return every.join(seen, "product", "left").withColumns({"files": F.coalesce("files", F.lit(0)), "unread": F.coalesce("unread", F.lit(0))})
