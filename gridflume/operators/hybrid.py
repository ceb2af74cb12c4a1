"""Refinement of a base hour by the small-scale anomalies of a finer one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as ph
from . import fill

# Quality bits of refined and of clipped cells.
REFINED, CLIPPED = 1 << 14, 1 << 13
SOLAR_CONSTANT = 1361.0


def anomalies(cells: DataFrame, fields: dict[str, Column], window: int, rows: tuple[int, int], columns: tuple[int, int], by: list[str] = ()) -> DataFrame:
    """Each field less its box mean, as ``<name>_anomaly``; all fields share the passes over rows and columns."""
    given = cells.withColumns({f"_v_{k}": v for k, v in fields.items()})
    smooth = fill.box_smooth(given, [f"_v_{k}" for k in fields], window, rows, columns, by)
    return smooth.withColumns({f"{k}_anomaly": F.col(f"_v_{k}") - F.col(f"_v_{k}_smooth") for k in fields}).drop(*(f"_v_{k}" for k in fields), *(f"_v_{k}_smooth" for k in fields))


def _limited(name: str, cap: float) -> tuple[Column, Column, Column]:
    """The anomaly within its cap (0 where there is none), whether it was clipped, and whether there is one."""
    raw = F.col(f"{name}_anomaly")
    inside = F.greatest(F.least(raw, F.lit(cap)), F.lit(-cap))
    return F.when(raw.isNotNull(), inside).otherwise(F.lit(0.0)), F.coalesce(raw != inside, F.lit(False)), raw.isNotNull()


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for x in columns:
        out = out | x
    return out


def _qc(refined: Column, clipped: Column) -> Column:
    return F.when(refined, F.lit(REFINED)).otherwise(F.lit(0)) + F.when(clipped, F.lit(CLIPPED)).otherwise(F.lit(0))


#: What a refinement needs and gives: fields to take anomalies of, refined fields by name, and quality bits.
Refinement = tuple[dict[str, Column], dict[str, Column], Column]


def _thermodynamics(weights: dict[str, float], caps: dict[str, float]) -> Refinement:
    c = F.col
    if not any(weights.values()):
        return {}, {k: c(k) for k in ("t", "p", "rh", "q", "lw")}, F.lit(0)
    emission = lambda t, q, p: ph.emissivity(t, q, p) * F.pow(t, F.lit(4))
    fine_factor = c("fine_lw") / emission(c("fine_t"), c("fine_q"), c("fine_p"))
    move, clip, have = ({k: x for k, x in zip(weights, each, strict=True)} for each in zip(*(_limited(k, caps[k]) for k in weights), strict=True))
    t = c("t") + weights["t"] * move["t"]
    p = F.exp(F.ln("p") + weights["p"] * move["p"])
    rh = F.greatest(F.least(c("rh") + weights["rh"] * move["rh"], F.lit(1.0)), F.lit(0.0))
    q = ph.humidity_from_relative(rh, t, p, "water")
    lw = F.exp(F.ln(c("lw") / emission(c("t"), c("q"), c("p"))) + weights["lw"] * move["lw"]) * emission(t, q, p)
    refined = _any([have[k] for k, w in weights.items() if w])
    found = {"t": t, "p": p, "rh": rh, "q": q, "lw": lw}
    fields = {"t": c("fine_t"), "p": F.ln("fine_p"), "rh": c("fine_rh"), "lw": F.ln(fine_factor)}
    return fields, {k: F.when(refined, v).otherwise(c(k)) for k, v in found.items()}, _qc(refined, _any(list(clip.values())))


def _radiation_wind(weights: dict[str, float], caps: dict[str, float]) -> Refinement:
    c = F.col
    if not any(weights.values()):
        return {}, {k: c(k) for k in ("sw", "u", "v")}, F.lit(0)
    scale = lambda k: SOLAR_CONSTANT * F.greatest(c(k), F.lit(0.0))
    move, clip, have = ({k: x for k, x in zip(weights, each, strict=True)} for each in zip(*(_limited(k, caps["sw" if k == "sw" else "wind"]) for k in weights), strict=True))
    index = F.when(scale("sun") > 1, c("sw") / scale("sun")).otherwise(F.lit(0.0))
    sw = F.when(scale("sun") > 1, F.greatest(index + weights["sw"] * move["sw"], F.lit(0.0)) * scale("sun")).otherwise(F.lit(0.0))
    refined = _any([have[k] for k, w in weights.items() if w])
    fields = {"sw": F.when(scale("fine_sun") > 1, c("fine_sw") / scale("fine_sun")), "u": c("fine_u"), "v": c("fine_v")}
    return fields, {"sw": sw, "u": c("u") + weights["u"] * move["u"], "v": c("v") + weights["v"] * move["v"]}, _qc(refined, _any(list(clip.values())))


def _refined(cells: DataFrame, how: Refinement, window: int, rows: tuple[int, int], columns: tuple[int, int], by: list[str]) -> DataFrame:
    fields, found, qc = how
    a = anomalies(cells, fields, window, rows, columns, by) if fields else cells
    return a.select(*by, "y", "x", *(v.alias(f"new_{k}") for k, v in found.items()), qc.alias("qc"))


def thermodynamics(cells: DataFrame, weights: dict[str, float], caps: dict[str, float], window: int, rows: tuple[int, int], columns: tuple[int, int], by: list[str] = ()) -> DataFrame:
    """Base fields t, p, rh, q, lw refined by those of the finer hour (fine_t ...): t, log p, rh and log longwave factor.

    ``weights`` and ``caps`` have the keys t, p, rh, lw. Humidity and longwave are rebuilt; where no weight counts the base stays as it is.
    """
    return _refined(cells, _thermodynamics(weights, caps), window, rows, columns, by)


def radiation_wind(cells: DataFrame, weights: dict[str, float], caps: dict[str, float], window: int, rows: tuple[int, int], columns: tuple[int, int], by: list[str] = ()) -> DataFrame:
    """Base sw, u, v refined by the finer hour's clear-sky index and wind; ``sun`` and ``fine_sun`` are cosines of the zenith angle.

    ``weights`` have the keys sw, u, v, ``caps`` sw and wind. Shortwave is zero at night.
    """
    return _refined(cells, _radiation_wind(weights, caps), window, rows, columns, by)


def components(base: DataFrame, fine: DataFrame, weights: dict[str, float], caps: dict[str, float], window: int, rows: tuple[int, int], columns: tuple[int, int]) -> DataFrame:
    """Base hours (ts, y, x, t, p, rh, q, lw, sw, u, v, sun, thermo_qc, radiation_qc) refined by the fine ones (the fields and sun) of the same time and cell.

    The refined fields replace the base's, what refinement flags is added to its flags by OR, and ``hybrid`` says that it was done.
    Hours or cells that only the base has stay as they are; those that only the fine side has are not given. ``weights`` has t, p, rh, lw, sw, u,
    v, ``caps`` t, p, rh, lw, sw and wind. One join brings both together, and one smoothing serves all fields, so nothing is joined back. It is a merge join:
    Spark takes the fine side's files for small and would broadcast it through the driver.
    """
    keys, fields = ["ts", "y", "x"], ["t", "p", "rh", "q", "lw", "sw", "u", "v"]
    side = fine.select(*keys, *(F.col(f).alias(f"fine_{f}") for f in (*fields, "sun")), F.lit(True).alias("_fine"))
    both = base.join(side.hint("merge"), keys, "left")
    of = lambda d, *ks: {k: d[k] for k in ks}
    warm, warm_fields, thermo = _thermodynamics(of(weights, "t", "p", "rh", "lw"), of(caps, "t", "p", "rh", "lw"))
    bright, bright_fields, radiation = _radiation_wind(of(weights, "sw", "u", "v"), of(caps, "sw", "wind"))
    # cells without a fine side have no fine values, so no box counts them
    done = anomalies(both, warm | bright, window, rows, columns, ["ts"]) if warm | bright else both
    on, new = F.col("_fine").isNotNull(), warm_fields | bright_fields
    added = lambda name, bits: F.col(name).bitwiseOR(F.when(on, bits).otherwise(F.lit(0))).alias(name)
    return done.select(*keys, *(F.when(on, new[f]).otherwise(F.col(f)).alias(f) for f in fields), "sun", added("thermo_qc", thermo), added("radiation_qc", radiation), on.alias("hybrid"))
