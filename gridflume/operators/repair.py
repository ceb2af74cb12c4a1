"""Repair of holes in gridded records, proofs that nothing else changed, and the check before a run.

A record is what ``keys`` name, an hour say; its cells are rows (keys, y, x, fields), null or NaN where missing. Static
cells are rows (y, x, ...) of flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import staged
from ..functions import physics
from . import bundle, coverage, fill


def missing(column: str) -> Column:
    return F.col(column).isNull() | F.isnan(column)


def _mask(flag: Column) -> list[Column]:
    """What a set of cells is known by, whatever the order of its rows."""
    h = F.when(flag, F.xxhash64("y", "x"))
    return [F.count(h), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")), F.coalesce(F.bit_xor(h), F.lit(0).cast("long"))]


def fill_active_holes(values: DataFrame, keys: list[str], fields: list[str], cells: DataFrame) -> DataFrame:
    """Each field's missing active cells outside gaps filled from its nearest valid kept cell outside gaps.

    ``cells`` has y, x, active, keep and gap. Rows come back with ``<field>_filled``, ``<field>_distance`` (in cells, null where not filled)
    and ``<field>_fault``: ``no_donor`` on holes of records without a donor. Records of one field that lack the
    same cells share one search of donors, as do fields.
    """
    held = staged(values.join(cells.select("y", "x", "active", "keep", "gap"), ["y", "x"], "left"), "records")
    yes = lambda n: F.coalesce(F.col(n), F.lit(False))
    target = lambda f: missing(f) & yes("active") & ~yes("gap")
    donor = lambda f: ~missing(f) & yes("keep") & ~yes("gap")
    prints = held.groupBy(*keys).agg(*(F.md5(F.concat_ws(",", *(c.cast("string") for c in (*_mask(target(f)), *_mask(donor(f)))))).alias(f) for f in fields))
    masks = staged(prints.select(*keys, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("mask")) for f in fields))).alias("m")).select(*keys, "m.*"), "masks")
    # one record stands for all that lack the same cells
    of = masks.groupBy("mask").agg(F.min(F.struct("field", *keys)).alias("r")).select("mask", "r.*")
    each = held.join(of, keys).select("mask", "y", "x", *(F.when(F.col("field") == f, F.when(target(f), "target").when(donor(f), "donor")).alias(f"_{f}") for f in fields))
    each = each.select("mask", "y", "x", F.coalesce(*(f"_{f}" for f in fields)).alias("role"))
    donors = fill.nearest_donor(each.where("role = 'target'"), each.where("role = 'donor'"), by=["mask"])
    out = held
    for f in fields:
        mine = masks.where(F.col("field") == f).select(*keys, "mask").join(donors, "mask")
        given = held.select(*keys, F.col("y").alias("donor_y"), F.col("x").alias("donor_x"), F.col(f).alias("_given"))
        found = mine.join(given, [*keys, "donor_y", "donor_x"], "left").select(*keys, "y", "x", "_given", F.col("distance").alias(f"{f}_distance"), F.lit(True).alias("_hole"))
        out = out.join(found, [*keys, "y", "x"], "left")
        filled = F.coalesce(F.col("_hole"), F.lit(False)) & F.col(f"{f}_distance").isNotNull()
        out = out.withColumns({f: F.when(filled, F.col("_given")).otherwise(F.col(f)), f"{f}_filled": filled, f"{f}_fault": F.when(F.col("_hole") & ~filled, "no_donor")}).drop("_given", "_hole")
    return out.drop("active", "keep", "gap")


def proof(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str], cells: DataFrame) -> DataFrame:
    """Per field, from two versions of all records and cells (y, x, land, domain): what lacks, and that all else is as it was.

    ``missing_land`` and ``valid_outside`` count what the later version lacks on land and has outside the domain. ``inactive_same``
    and ``active_same``: digests of the domain's values off land, and of land values that were there before, agree. Both versions
    are read in one pass, and the order of their rows plays no part. ``complete`` is all of these together.
    """
    state = cells.select("y", "x", F.coalesce("land", F.lit(False)).alias("land"), F.coalesce("domain", F.lit(False)).alias("domain"))
    versions = [df.select(F.lit(k).alias("_after"), *keys, "y", "x", *fields) for k, df in ((False, before), (True, after))]
    # which cells had a value is known by the earlier version and travels with both
    had = before.select(*keys, "y", "x", *((~missing(f)).alias(f"_had_{f}") for f in fields))
    both = versions[0].union(versions[1]).join(had, [*keys, "y", "x"], "left").join(state, ["y", "x"])
    fold = lambda f, on: F.sum(F.when(on, F.xxhash64(F.lit(f), *keys, "y", "x", F.when(~missing(f), F.col(f)))).cast("decimal(38,0)"))
    aggregates = []
    for f in fields:
        for name, on in (("inactive", F.col("domain") & ~F.col("land")), ("active", F.col("land") & F.coalesce(F.col(f"_had_{f}"), F.lit(False)))):
            for side in (False, True):
                there = on & (F.col("_after") == side)
                aggregates += [fold(f, there).alias(f"{f}_{name}_{side}"), F.count_if(there).alias(f"{f}_{name}_n_{side}")]
        aggregates += [F.count_if(F.col("_after") & F.col("land") & missing(f)).alias(f"{f}_missing_land"), F.count_if(F.col("_after") & ~F.col("domain") & ~missing(f)).alias(f"{f}_valid_outside")]
    found = both.agg(*aggregates)
    same = lambda f, name: F.col(f"{f}_{name}_False").eqNullSafe(F.col(f"{f}_{name}_True")) & (F.col(f"{f}_{name}_n_False") == F.col(f"{f}_{name}_n_True"))
    rows = [F.struct(F.lit(f).alias("field"), F.col(f"{f}_missing_land").alias("missing_land"), F.col(f"{f}_valid_outside").alias("valid_outside"), same(f, "inactive").alias("inactive_same"), same(f, "active").alias("active_same")) for f in fields]
    out = found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.withColumn("complete", (F.col("missing_land") == 0) & (F.col("valid_outside") == 0) & F.col("inactive_same") & F.col("active_same"))


def domain_repair(values: DataFrame, keys: list[str], fields: list[str], cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with missing land filled from the nearest valid cell of the domain and nothing outside the domain, and the report.

    ``cells`` has y, x, land and domain; land outside the domain is an error. The report has a row per field: filled cells, their greatest distance,
    values taken away outside the domain, and the ``proof``. Donors are found in the records as they came.
    """
    land = F.coalesce("land", F.lit(False)) & ~F.coalesce("domain", F.lit(False))
    checked = cells.withColumn("land", F.when(land, F.raise_error(F.lit("land reaches beyond the domain"))).otherwise(F.coalesce("land", F.lit(False))))
    before = staged(values.select(*keys, "y", "x", *fields), "before")
    roles = checked.select("y", "x", F.col("land").alias("active"), F.col("domain").alias("keep"), F.lit(False).alias("gap"))
    filled = fill_active_holes(before, keys, fields, roles).join(checked.select("y", "x", "domain"), ["y", "x"], "left")
    inside = F.coalesce("domain", F.lit(False))
    after = filled.withColumns({f: F.when(inside, F.col(f)) for f in fields} | {f"_out_{f}": ~inside & ~missing(f) for f in fields})
    after = staged(after.drop("domain"), "after")
    counts = after.agg(*(x for f in fields for x in (F.count_if(f"{f}_filled").alias(f"n_{f}"), F.coalesce(F.max(f"{f}_distance"), F.lit(0.0)).alias(f"d_{f}"), F.count_if(f"_out_{f}").alias(f"o_{f}"))))
    rows = counts.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("filled"), F.col(f"d_{f}").alias("most_distance"), F.col(f"o_{f}").alias("masked")) for f in fields))).alias("r")).select("r.*")
    return after.select(*keys, "y", "x", *fields), rows.join(proof(before, after, keys, fields, checked), "field")


def preflight(hours: DataFrame, time: str, fields: list[str], cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What hours (time, y, x, fields) lack before a run, and the active land that may be edge-filled.

    The first table has a row per field: missing values on active land, the transient ones among them (on cells that some
    other hour has), the hours, whether they follow one another hour by hour, and ``issues``. The second has the cells (y, x)
    that lack some field in every hour. ``cells`` has y, x and land. A row that an hour lacks is as missing as its values.
    """
    land = cells.where(F.coalesce("land", F.lit(False))).select("y", "x").distinct()
    when = F.unix_timestamp(time)
    # one row
    clock = hours.select(when.alias("t")).distinct().agg(F.count("*").alias("hours"), ((F.max("t") - F.min("t")) / 3600 + 1).alias("span"), F.count_if(F.col("t").isNull()).alias("untimed"))
    clock = clock.select("hours", (F.coalesce(F.col("span") == F.col("hours"), F.lit(False)) & (F.col("untimed") == 0)).alias("continuous"))
    # hours that are there twice are one; a value counts if any of its rows has it
    each = hours.groupBy("y", "x", when.alias("t")).agg(*(F.max(~missing(f)).alias(f) for f in fields))
    per_cell = land.join(each.groupBy("y", "x").agg(*(F.count_if(f).alias(f) for f in fields)), ["y", "x"], "left").withColumn("_one", F.lit(1)).join(F.broadcast(clock.withColumn("_one", F.lit(1))), "_one")
    lacks = {f: F.col("hours") - F.coalesce(F.col(f), F.lit(0)) for f in fields}
    persistent = F.greatest(*(lacks[f] == F.col("hours") for f in fields), F.lit(False))
    held = staged(per_cell.select("y", "x", "hours", "continuous", persistent.alias("persistent"), *(lacks[f].alias(f) for f in fields)), "preflight")
    sums = held.agg(F.max("hours").alias("hours"), F.bool_and("continuous").alias("continuous"), F.count_if("persistent").alias("persistent_cells"), *(x for f in fields for x in (F.sum(f).alias(f), F.sum(F.when(~F.col("persistent"), F.col(f)).otherwise(0)).alias(f"t_{f}"))))
    rows = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit(0)).alias("missing"), F.coalesce(F.col(f"t_{f}"), F.lit(0)).alias("transient")) for f in fields)))
    report = sums.select("hours", "continuous", "persistent_cells", rows.alias("r")).select("r.*", "persistent_cells", "hours", "continuous")
    issues = F.array_compact(F.array(F.when(~F.coalesce("continuous", F.lit(False)), "not_hourly"), F.when(F.col("transient") > 0, "transient_gaps")))
    return report.withColumn("issues", issues), held.where("persistent").select("y", "x")


# What was taken from native cells, and how.
COUPLED, WIND, SHORTWAVE, RAIN, MODEL_TERRAIN, HUMIDITY_CLIPPED = 1, 2, 4, 8, 16, 32
_GROUPS = ((COUPLED, ("t", "q", "p", "lw")), (WIND, ("u", "v")), (SHORTWAVE, ("sw",)), (RAIN, ("rain",)))


def native_repair(primary: DataFrame, native: DataFrame, most_km: float = 25.0) -> DataFrame:
    """Active cells' missing field groups taken from the nearest native cell that has the whole group.

    ``primary``: dst, lat, lon, z, model_z (used where z is missing), active, t, q, p, lw, u, v, sw, rain; ``native``: src, lat, lon, z0 and
    the same fields. A group lacks if one of its fields does and is then replaced whole. Temperature, pressure, humidity and longwave
    are moved to the target's elevation together, humidity clipped where it must be. Gives the fields, ``flags``
    (which groups, model terrain, clipped humidity), ``km`` (of the farthest donor) and ``fault``: ``no_donor`` within ``most_km`` or ``no_elevation``.
    """
    state = bundle.reference_state(native, tolerance=0.2, reject=False).withColumn("_clip", F.col("qc").bitwiseAND(F.lit(3)) != 0)
    given = staged(state.select("src", "lat", "lon", "t_ref", "p_ref", "rh", "lw_factor", "_clip", "t", "q", "p", "lw", "u", "v", "sw", "rain"), "native")
    height = F.coalesce(bundle.finite(F.col("z")), bundle.finite(F.col("model_z")))
    fields = [f for _, names in _GROUPS for f in names]
    out = staged(primary.select("dst", "lat", "lon", "active", height.alias("z1"), bundle.finite(F.col("z")).isNull().alias("_model"), *(bundle.finite(F.col(f)).alias(f) for f in fields)), "primary")
    lacks = {bit: F.coalesce("active", F.lit(False)) & F.greatest(*(F.col(f).isNull() for f in names), F.lit(False)) for bit, names in _GROUPS}
    # what lacks is known at the start, so that no group's search runs the repairs before it again
    out = start = out.withColumns({f"_lacks{bit}": on for bit, on in lacks.items()} | {"flags": F.lit(0), "km": F.lit(0.0), "fault": F.lit(None).cast("string")})
    for bit, names in _GROUPS:
        whole = F.lit(True)
        for f in names if bit != COUPLED else (*names, "t_ref", "p_ref", "rh", "lw_factor"):
            whole = whole & bundle.finite(F.col(f)).isNotNull()
        if bit in (SHORTWAVE, RAIN):
            whole = whole & (F.col(names[0]) >= 0)
        near = coverage.nearest_native(start.where(f"_lacks{bit}").select("dst", "lat", "lon"), given.where(whole).select("src", "lat", "lon"), most_km).where("src is not null")
        side = ("t_ref", "p_ref", "rh", "lw_factor", "_clip") if bit == COUPLED else names
        # the cells' files are small for their rows, so Spark would send both sides to the driver
        donors = near.join(given.select("src", *(F.col(f).alias(f"_d_{f}") for f in side)).hint("merge"), "src").drop("src").withColumnRenamed("km", "_km")
        out = out.join(donors.hint("merge"), "dst", "left")
        found = F.col(f"_lacks{bit}") & F.col("_km").isNotNull()
        if bit == COUPLED:
            found = found & F.col("z1").isNotNull()
            moved = bundle.target_state(out.select("*", *(F.col(f"_d_{f}").alias(f) for f in ("t_ref", "p_ref", "rh", "lw_factor"))), tolerance=0.2)
            clipped = F.coalesce("_d__clip", F.lit(False)) | (F.col("target_qc").bitwiseAND(F.lit(3)) != 0)
            new = {"t": "temperature", "q": "humidity", "p": "pressure", "lw": "longwave"}
            bits = bit + F.when(clipped, HUMIDITY_CLIPPED).otherwise(0) + F.when(F.col("_model"), MODEL_TERRAIN).otherwise(0)
            out = moved
        else:
            new, bits = {f: f"_d_{f}" for f in names}, F.lit(bit)
        fault = F.when(F.col(f"_lacks{bit}") & F.col("_km").isNull(), "no_donor")
        if bit == COUPLED:
            fault = F.when(F.col(f"_lacks{bit}") & F.col("z1").isNull(), "no_elevation").otherwise(fault)
        out = out.withColumns({f: F.when(found, F.col(v)).otherwise(F.col(f)) for f, v in new.items()} | {
            "flags": F.col("flags").bitwiseOR(F.when(found, bits).otherwise(0)), "km": F.when(found, F.greatest("km", "_km")).otherwise(F.col("km")), "fault": F.coalesce("fault", fault),
        })
        out = out.select("dst", "lat", "lon", "active", "z1", "_model", *fields, *(f"_lacks{k}" for k, _ in _GROUPS), "flags", "km", "fault")
    return out.select("dst", *fields, "flags", "km", "fault")


def gap_geometry(targets: DataFrame, origin: tuple[float, float], step: tuple[float, float], size: tuple[int, int], central: float = -97.5, parallel: float = 38.5) -> DataFrame:
    """Kept targets outside the native grid, with the elevation a fallback needs.

    ``targets``: dst, lat, lon, keep, active, elevation, model_elevation. The grid is given in its Lambert projection on a sphere of radius one: the first
    cell's place ``origin`` (x, y), ``step`` between cells and ``size`` in cells (x, y); a target is supported where its fractional index is
    within the grid. An active gap without an elevation takes the model's, if between -500 and 9000 m (``from_model``). ``fault``
    is ``no_elevation`` where it has none either; inactive gaps without one are ``excluded``.
    """
    x, y = physics.lambert_coordinates(F.col("lat"), F.col("lon"), central, parallel)
    ix, iy = (x - origin[0]) / step[0], (y - origin[1]) / step[1]
    supported = F.coalesce(ix.between(0, size[0] - 1) & iy.between(0, size[1] - 1), F.lit(False))
    own, model = bundle.finite(F.col("elevation")), bundle.finite(F.col("model_elevation"))
    on = F.coalesce("active", F.lit(False))
    borrowed = own.isNull() & on & F.coalesce((model > -500) & (model < 9000), F.lit(False))
    height = F.coalesce(own, F.when(borrowed, model))
    gaps = targets.withColumns({"index_x": ix, "index_y": iy}).where(F.coalesce("keep", F.lit(False)) & ~supported)
    return gaps.select("dst", "lat", "lon", "index_x", "index_y", on.alias("active"), height.alias("z1"), borrowed.alias("from_model"), (~on & height.isNull()).alias("excluded"), F.when(on & height.isNull(), "no_elevation").alias("fault"))


def remap_hour(source: DataFrame, geometry: DataFrame, links: DataFrame, rain_links: DataFrame | None = None) -> DataFrame:
    """A fallback hour at the gaps of ``geometry`` (dst, z1): all eight fields, ``clipped``, and ``fault`` where one is incomplete.

    ``source`` has src, t, q, p, lw, z0, sw, u, v and depth (mm an hour); ``links`` (src, dst, weight) are bilinear, the state rides on them at sea level and
    is moved to each target's elevation. Depth follows ``rain_links`` if given. A target needs all of its links: one source
    value that lacks leaves the field empty.
    """
    state = bundle.reference_state(source, tolerance=0.2).withColumn("_clip", (F.col("qc").bitwiseAND(F.lit(3)) != 0).cast("int"))
    fields = ["t_ref", "p_ref", "rh", "lw_factor", "sw", "u", "v", *([] if rain_links is not None else ["depth"])]

    def summed(over: DataFrame, names: list[str]) -> DataFrame:
        joined = over.join(state, "src", "left")
        total = lambda f: F.when(F.count(f) == F.count(F.lit(1)), F.sum(F.col("weight") * F.col(f)))
        return joined.groupBy("dst").agg(*(total(f).alias(f) for f in names), F.max(F.coalesce("_clip", F.lit(0))).alias("_clip"))

    at = geometry.select("dst", "z1").join(summed(links, fields), "dst", "left")
    if rain_links is not None:
        at = at.join(summed(rain_links, ["depth"]).drop("_clip"), "dst", "left")
    done = bundle.target_state(at, tolerance=0.2)
    out = {"t": "temperature", "p": "pressure", "q": "humidity", "lw": "longwave", "sw": "sw", "u": "u", "v": "v"}
    done = done.select("dst", *(F.col(v).alias(k) for k, v in out.items()), (F.col("depth") / 3600).alias("rain"), ((F.col("_clip") > 0) | (F.col("target_qc").bitwiseAND(F.lit(3)) != 0)).alias("clipped"))
    lacking = F.array_compact(F.array(*(F.when(bundle.finite(F.col(f)).isNull(), f) for f in (*out, "rain"))))
    return done.withColumn("fault", F.when(F.size(lacking) > 0, F.concat(F.lit("incomplete "), F.array_join(lacking, " "))))
