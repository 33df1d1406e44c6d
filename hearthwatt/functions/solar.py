"""Sun position and the light a fixed panel gets, as column expressions.

Declination, equation of time and the incidence angle on a tilted plane are the usual textbook formulas.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .timeparts import as_col


def _number(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def _sin_cos(degrees: Column | float) -> tuple[Column, Column]:
    """Sine and cosine of an angle, which may differ by row."""
    if isinstance(degrees, Column):
        return F.sin(F.radians(degrees)), F.cos(F.radians(degrees))
    return F.lit(math.sin(math.radians(degrees))), F.lit(math.cos(math.radians(degrees)))


def sun_position(ts: Column | str, lat: Column | float, lon: Column | float) -> dict[str, Column]:
    """Declination and hour angle (radians) and elevation (degrees) at a UTC time."""
    ts = as_col(ts)
    day = F.dayofyear(ts).cast("double")
    minutes = F.hour(ts) * 60.0 + F.minute(ts) + F.second(ts) / F.lit(60.0)
    b = F.radians(F.lit(360.0 / 365.0) * (day - 81.0))
    equation_of_time = 9.87 * F.sin(2.0 * b) - 7.53 * F.cos(b) - 1.5 * F.sin(b)
    declination = F.lit(math.radians(23.45)) * F.sin(F.radians(F.lit(360.0 / 365.0) * (day + 284.0)))
    hour_angle = F.radians(15.0 * ((minutes + F.lit(4.0) * _number(lon) + equation_of_time) / 60.0 - 12.0))
    sin_lat, cos_lat = _sin_cos(lat)
    sin_elevation = sin_lat * F.sin(declination) + cos_lat * F.cos(declination) * F.cos(hour_angle)
    return {
        "declination": declination,
        "hour_angle": hour_angle,
        "elevation_deg": F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sin_elevation)))),
    }


def cos_incidence(declination: Column, hour_angle: Column, lat: Column | float, tilt_deg: Column | float,
                  azimuth_deg: Column | float) -> Column:
    """Cosine of the angle between the sun and the panel normal; azimuth is from north, 90 = east."""
    (sin_lat, cos_lat), (sin_tilt, cos_tilt), (sin_turn, cos_turn) = _sin_cos(lat), _sin_cos(tilt_deg), _sin_cos(azimuth_deg - 180.0)
    flat = sin_lat * cos_tilt - cos_lat * sin_tilt * cos_turn
    noon = cos_lat * cos_tilt + sin_lat * sin_tilt * cos_turn
    side = sin_tilt * sin_turn
    return (F.sin(declination) * flat + F.cos(declination) * F.cos(hour_angle) * noon
            + F.cos(declination) * F.sin(hour_angle) * side)


def cloud_factor(cloud_pct: Column | str, floor: float, exponent: float) -> Column:
    clear = F.lit(1.0) - as_col(cloud_pct) / 100.0
    return F.lit(floor) + F.lit(1.0 - floor) * F.pow(F.greatest(clear, F.when(clear.isNotNull(), F.lit(0.0))), F.lit(exponent))


def panel_gain(cos_aoi: Column, diffuse_floor: float) -> Column:
    return F.lit(diffuse_floor) + F.lit(1.0 - diffuse_floor) * F.greatest(F.lit(0.0), cos_aoi)
