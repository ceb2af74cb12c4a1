"""Column functions of near-surface meteorology. Inputs are kelvin, pascal, kg/kg, degrees and metres.

Null in gives null out; an input outside its physical domain gives null too, so a bad cell never
stops a job. Where a function takes ``checked``, false gives the bare formula.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants.
LAPSE_RATE = -0.0065
DRY_AIR = 287.05
WATER_VAPOR = 461.5
GRAVITY = 9.80665
EPSILON = DRY_AIR / WATER_VAPOR
FREEZING = 273.15


def _valid(ok: Column, value: Column) -> Column:
    return F.when(ok, value)


def temperature_at_elevation(t: Column, z_from: Column, z_to: Column, lapse: float = LAPSE_RATE) -> Column:
    moved = t + lapse * (z_to - z_from)
    return _valid((t > 0) & (moved > 0), moved)


def pressure_at_elevation(p: Column, t: Column, z_from: Column, z_to: Column, lapse: float = LAPSE_RATE) -> Column:
    """Hydrostatic, through air of a constant lapse rate (isothermal air if that is nearly zero)."""
    rise = z_to - z_from
    if abs(lapse) < 1e-12:
        return _valid((p > 0) & (t > 0), p * F.exp(-GRAVITY * rise / (DRY_AIR * t)))
    ratio = (t + lapse * rise) / t
    return _valid((p > 0) & (t > 0) & (ratio > 0), p * F.pow(ratio, F.lit(-GRAVITY / (DRY_AIR * lapse))))


def saturation_vapor_pressure(t: Column, phase: str = "auto") -> Column:
    c = t - FREEZING
    water = 611.2 * F.exp(17.67 * c / (c + 243.5))
    ice = 611.15 * F.exp(22.452 * c / (c + 272.55))
    value = {"water": water, "ice": ice}.get(phase, F.when(t >= FREEZING, water).otherwise(ice))
    return _valid(t > 100, value)


def vapor_pressure(q: Column, p: Column) -> Column:
    return _valid((q >= 0) & (q < 1) & (p > 0), q * p / (EPSILON + (1 - EPSILON) * q))


def humidity_from_vapor_pressure(e: Column, p: Column) -> Column:
    return _valid((e >= 0) & (p > e), EPSILON * e / (p - (1 - EPSILON) * e))


def relative_humidity(q: Column, t: Column, p: Column, phase: str = "auto") -> Column:
    return vapor_pressure(q, p) / saturation_vapor_pressure(t, phase)


def humidity_from_relative(rh: Column, t: Column, p: Column, phase: str = "auto", checked: bool = True) -> Column:
    most = saturation_vapor_pressure(t, phase)
    # multiplied from left to right: where vapour fills nearly all of the pressure, another order shows in the digits
    return humidity_from_vapor_pressure(rh * most, p) if checked else F.try_divide(EPSILON * rh * most, p - (1 - EPSILON) * rh * most)


def emissivity(t: Column, q: Column, p: Column, checked: bool = True) -> Column:
    """Clear-sky atmospheric emissivity from vapor pressure in hPa."""
    value = 1.08 * (1 - F.exp(-F.pow(q * p / 62.2, t / 2016.0)))
    return _valid((t > 0) & (q >= 0) & (q < 1) & (p > 0), value) if checked else value


def longwave_at_target(lw: Column, t0: Column, q0: Column, p0: Column, t1: Column, q1: Column, p1: Column) -> Column:
    return F.try_divide(lw * emissivity(t1, q1, p1) * F.pow(t1, F.lit(4)), emissivity(t0, q0, p0) * F.pow(t0, F.lit(4)))


def rotated_wind(u: Column, v: Column, angle: Column) -> tuple[Column, Column]:
    """Grid-relative to earth-relative components; ``angle`` in radians from east to the grid's x axis."""
    return u * F.cos(angle) - v * F.sin(angle), u * F.sin(angle) + v * F.cos(angle)


def lambert_cone(parallel_1: float, parallel_2: float | None = None) -> float:
    a = math.radians(parallel_1)
    if parallel_2 is None or math.isclose(parallel_1, parallel_2):
        return math.sin(a)
    b = math.radians(parallel_2)
    return math.log(math.cos(a) / math.cos(b)) / math.log(math.tan(math.pi / 4 + b / 2) / math.tan(math.pi / 4 + a / 2))


def lambert_x_angle(lon: Column, central: float, parallel_1: float, parallel_2: float | None = None) -> Column:
    turn = F.pmod(lon - central + 180, F.lit(360.0)) - 180
    return -lambert_cone(parallel_1, parallel_2) * F.radians(turn)


def solar_zenith_cosine(valid_time: Column, lat: Column, lon: Column) -> Column:
    """NOAA's fractional-year approximation; ``valid_time`` is UTC."""
    year = F.year(valid_time)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    hour = F.hour(valid_time) + F.minute(valid_time) / 60.0 + F.second(valid_time) / 3600.0
    gamma = 2 * math.pi / F.when(leap, 366).otherwise(365) * (F.dayofyear(valid_time) - 1 + (hour - 12) / 24)

    def series(constant: float, *terms: tuple[float, float]) -> Column:
        total = F.lit(constant)
        for k, (c, s) in enumerate(terms, 1):
            total = total + c * F.cos(k * gamma) + s * F.sin(k * gamma)
        return total

    # The coefficients of the two series.
    equation = 229.18 * series(0.000075, (0.001868, -0.032077), (-0.014615, -0.040849))
    declination = series(0.006918, (-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148))
    angle = F.radians(F.pmod(hour * 60 + equation + 4 * lon, F.lit(1440.0)) / 4 - 180)
    at = F.radians(lat)
    return F.sin(at) * F.sin(declination) + F.cos(at) * F.cos(declination) * F.cos(angle)


def lambert_coordinates(lat: Column, lon: Column, central: float, parallel_1: float, parallel_2: float | None = None) -> tuple[Column, Column]:
    """Spherical Lambert x and y on a sphere of radius one."""
    n = lambert_cone(parallel_1, parallel_2)
    a = math.radians(parallel_1)
    scale = math.cos(a) * math.tan(math.pi / 4 + a / 2) ** n / n
    rho = scale / F.pow(F.tan(math.pi / 4 + F.radians(lat) / 2), F.lit(n))
    theta = -lambert_x_angle(lon, central, parallel_1, parallel_2)
    return rho * F.sin(theta), -rho * F.cos(theta)


def unit_sphere(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)


def wind_speed(u: Column, v: Column) -> Column:
    return F.hypot(u, v)
