"""The thermodynamic, radiation and wind fields of an hour, kept consistent with one another.

Missing values are null; every operator works row by row, so an hour of any size is one scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as ph

# Quality bits of the bundle and of radiation and wind.
RH_LOW, RH_HIGH, INVALID, INVALID_FACTOR = 1, 2, 4, 8
SW_NEGATIVE, SW_NIGHT, RADIATION_INVALID, SW_HIGH = 1, 2, 4, 8
INCOMPLETE = 1 << 31


def bit(ok: Column, value: int) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(value)).otherwise(F.lit(0))


def flags(*bits: Column) -> Column:
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def finite(value: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def clipped_humidity(rh: Column, tolerance: float = 0.05, reject: bool = True) -> tuple[Column, Column]:
    """Relative humidity within 0 and 1, and its flags; what is further off than the tolerance is null if ``reject``, else clipped too."""
    material = (rh < -tolerance) | (rh > 1 + tolerance)
    inside = F.when(rh.isNotNull(), F.greatest(F.least(rh, F.lit(1.0)), F.lit(0.0)))
    return F.when(~material, inside) if reject else inside, flags(bit(rh < 0, RH_LOW), bit(rh > 1, RH_HIGH), bit(material, INVALID))


def reference_state(cells: DataFrame, tolerance: float = 0.05, reject: bool = True) -> DataFrame:
    """From t, q, p, lw and z0: t_ref and p_ref at sea level, rh, lw_factor and qc. One missing input empties the bundle."""
    t, q, p, lw, z = (F.col(k) for k in ("t", "q", "p", "lw", "z0"))
    given = t.isNotNull() & q.isNotNull() & p.isNotNull() & lw.isNotNull() & z.isNotNull()
    rh, qc = clipped_humidity(ph.relative_humidity(q, t, p, "water"), tolerance, reject)
    emission = ph.emissivity(t, q, p) * F.pow(t, F.lit(4))
    factor = F.when(emission > 0, lw / emission)
    ok = given & rh.isNotNull()
    sea = F.lit(0.0)
    return cells.withColumns({
        "t_ref": F.when(ok, ph.temperature_at_elevation(t, z, sea)), "p_ref": F.when(ok, ph.pressure_at_elevation(p, t, z, sea)),
        "rh": F.when(ok, rh), "lw_factor": F.when(ok, factor), "qc": flags(qc, bit(~given, INVALID), bit(factor.isNull(), INVALID_FACTOR)),
    })


def target_state(cells: DataFrame, final: str | None = None, tolerance: float = 0.05, checked: bool = True) -> DataFrame:
    """From t_ref, p_ref, rh, lw_factor and z1: temperature, pressure, humidity, longwave at the target's elevation, and qc.

    Pressure follows the preliminary temperature alone; ``final`` names a column that replaces it in all else. Air so hot that its
    vapour's pressure exceeds its own has no humidity and longwave; if not ``checked``, they are what the formulas give (NaN at worst).
    """
    t, p, z = F.col("t_ref"), F.col("p_ref"), F.col("z1")
    given = t.isNotNull() & p.isNotNull() & F.col("rh").isNotNull() & F.col("lw_factor").isNotNull() & z.isNotNull()
    rh, qc = clipped_humidity(F.col("rh"), tolerance)
    early = ph.temperature_at_elevation(t, F.lit(0.0), z)
    pressure = ph.pressure_at_elevation(p, t, F.lit(0.0), z)
    temperature = F.coalesce(F.col(final), early) if final else early
    q = ph.humidity_from_relative(rh, temperature, pressure, "water", checked)
    lw = F.col("lw_factor") * ph.emissivity(temperature, q, pressure, checked) * F.pow(temperature, F.lit(4))
    found = {"temperature": temperature, "preliminary": early, "pressure": pressure, "humidity": q, "longwave": lw, "relative": rh}
    return cells.withColumns({k: F.when(given, v) for k, v in found.items()} | {"target_qc": flags(qc, bit(~given, INVALID))})


def constrained_state(base: DataFrame, corrected: DataFrame, keys: list[str]) -> DataFrame:
    """A base state (t, q, p, lw) at a corrected temperature ``t_new``: relative humidity and longwave factor stay, q and lw follow.

    Cells without a correction keep their state.
    """
    t, q, p, new = F.col("t"), F.col("q"), F.col("p"), F.col("t_new")
    rh, _ = clipped_humidity(ph.relative_humidity(q, t, p, "water"), reject=False)
    q_new = ph.humidity_from_relative(rh, new, p, "water")
    joined = base.join(corrected.select(*keys, "t_new"), keys, "left")
    return joined.withColumns({
        "q_new": F.when(new.isNull(), q).otherwise(q_new), "lw_new": F.when(new.isNull(), F.col("lw")).otherwise(ph.longwave_at_target(F.col("lw"), t, q, p, new, q_new, p)),
        "t_new": F.coalesce(new, t),
    })


def native_radiation_wind(cells: DataFrame, central: float | None = -97.5, parallel: float = 38.5, tolerance: float = 1.0) -> DataFrame:
    """From sw, u, v and lon: shortwave without small negatives, wind to the east and north (both missing where one is).

    ``central`` is None where the wind is relative to the earth already. ``material`` marks shortwave below -tolerance,
    which no hour may hold.
    """
    sw, u, v = F.col("sw"), F.col("u"), F.col("v")
    east, north = (u, v) if central is None else ph.rotated_wind(u, v, ph.lambert_x_angle(F.col("lon"), central, parallel))
    both = east.isNotNull() & north.isNotNull()
    return cells.withColumns({
        "shortwave": F.when(sw.isNotNull(), F.greatest(sw, F.lit(0.0))), "negative": F.coalesce(sw < 0, F.lit(False)), "material": F.coalesce(sw < -tolerance, F.lit(False)),
        "east": F.when(both, east), "north": F.when(both, north),
    })


def target_radiation(cells: DataFrame, most: float = 1400.0, horizon: float = -0.833) -> DataFrame:
    """Shortwave that is zero at night, and qc; ``negative`` marks cells with clipped sources."""
    sun = ph.solar_zenith_cosine(F.col("ts"), F.col("lat"), F.col("lon"))
    night = sun <= math.sin(math.radians(horizon))
    sw = F.when(night, F.lit(0.0)).otherwise(F.col("shortwave"))
    invalid = sw.isNull() | F.col("east").isNull() | F.col("north").isNull()
    return cells.withColumns({
        "radiation_qc": flags(bit(F.col("negative"), SW_NEGATIVE), bit(night & (F.col("shortwave") > 0), SW_NIGHT), bit(sw > most, SW_HIGH), bit(invalid, RADIATION_INVALID)),
        "shortwave": sw,
    })


def assembled(thermo: DataFrame, radiation: DataFrame, keys: list[str], source_id: int) -> DataFrame:
    """The seven fields of cells in both components of an hour and product; ``keys`` name time, product and cell.

    ``qc`` holds the thermodynamic bits, the radiation bits 16 places higher, and bit 31 where an active cell lacks a field.
    """
    return combined(thermo.join(radiation, keys), keys, F.lit(source_id))


#: The seven fields of an hour without its precipitation.
FIELDS = ("temperature", "pressure", "humidity", "longwave", "shortwave", "east", "north")


def combined(cells: DataFrame, keys: list[str], source_id: Column, *others: str) -> DataFrame:
    """``assembled`` for rows that have both components already."""
    whole = F.lit(True)
    for f in FIELDS:
        whole = whole & F.col(f).isNotNull()
    qc = F.col("target_qc").cast("long").bitwiseOR(F.shiftleft(F.col("radiation_qc").cast("long"), 16)).bitwiseOR(F.when(F.col("active") & ~whole, F.lit(INCOMPLETE)).otherwise(F.lit(0)).cast("long"))
    return cells.select(*keys, *FIELDS, qc.alias("qc"), F.when(whole, source_id).otherwise(F.lit(0)).alias("source_id"), *others)


def with_precipitation(hours: DataFrame, precipitation: DataFrame, keys: list[str]) -> DataFrame:
    """Hours with the rate (per second) of the depth of the same time and cell; hours without one have none."""
    rate = F.when(F.col("depth") >= 0, F.col("depth") / 3600)
    return hours.join(precipitation.select(*keys, rate.alias("rainrate"), F.col("source_id").alias("precip_source_id")), keys, "left")


def with_auxiliary(rows: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """``rows`` with every auxiliary column: a missing one gets its default, one of another type is an error."""
    have = dict(rows.dtypes)
    for name, (kind, default) in columns.items():
        if name not in have:
            rows = rows.withColumn(name, F.lit(default).cast(kind))
        elif have[name] != kind:
            raise ValueError(f"{name} is {have[name]}, not {kind}")
    return rows
