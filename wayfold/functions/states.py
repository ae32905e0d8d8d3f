"""Derived states and encodings of road attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: upper bounds of slope states in percent, width classes in metres
SLOPE_BOUNDS, WIDTH_BOUNDS = ((3.0, "FLAT"), (5.56, "MODERATE"), (8.33, "STEEP")), ((1.5, "ADEQUATE_150"), (1.2, "ADEQUATE_120"))


def width_state(width: Column) -> Column:
    out = F.when(width.isNull() | (width <= 0), F.lit("UNKNOWN"))
    for bound, name in WIDTH_BOUNDS:
        out = out.when(width >= bound, F.lit(name))
    return out.otherwise(F.lit("NARROW"))


def slope_state(slope: Column) -> Column:
    out = F.when(slope.isNull(), F.lit("UNKNOWN"))
    for bound, name in SLOPE_BOUNDS:
        out = out.when(slope < bound, F.lit(name))
    return out.otherwise(F.lit("RISK"))


def bucket(value: Column, bounds: tuple[tuple[float, str], ...], top: str, missing: str = "UNKNOWN") -> Column:
    """Name of the first upper bound above the value."""
    out = F.when(value.isNull(), F.lit(missing))
    for bound, name in bounds:
        out = out.when(value < bound, F.lit(name))
    return out.otherwise(F.lit(top))


def quantize(value: Column, step: float, bits: int) -> Column:
    """Nearest storable value of a fixed-width number; missing becomes 0, too large the largest."""
    k = F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor(F.coalesce(value, F.lit(0.0)) / step + 0.5).cast("int")))
    return k * F.lit(step)


def osm_width(c: Column) -> Column:
    """First number of a width text in (0, 20], comma read as point."""
    v = F.nullif(F.regexp_extract(F.regexp_replace(c, ",", "."), r"([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double")
    return F.when((v > 0) & (v <= 20), v)


def osm_incline(c: Column) -> Column:
    """Percent of an incline text: degrees through the tangent, up and down unknown, above 40 rejected."""
    v = F.abs(F.nullif(F.regexp_extract(F.regexp_replace(c, ",", "."), r"(-?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double"))
    pct = F.when(F.contains(c, F.lit("°")), F.tan(F.radians(v)) * 100).otherwise(v)
    return F.when(pct <= 40, pct)


#: fixed values: upper bounds of road width levels in metres and of slope levels in percent, with the names above the last
WIDTH_LEVELS, WIDEST = ((2.0, "VERY_NARROW"), (4.0, "NARROW"), (8.0, "MEDIUM"), (10.0, "WIDE")), "VERY_WIDE"
SLOPE_LEVELS, STEEPEST = ((3.0, "VERY_GENTLE"), (5.0, "GENTLE"), (8.0, "CAUTION"), (12.0, "SLOPED"), (20.0, "STEEP"), (35.0, "VERY_STEEP")), "DANGEROUS"
#: fixed values: risk points from a slope or a width on, by surface code, and levels by points
SLOPE_RISK, WIDTH_RISK, SURFACE_RISK = ((20.0, 4), (12.0, 3), (8.0, 2), (5.0, 1)), ((2.0, 2), (4.0, 1)), {"RDQ005": 2, "RDQ000": 1}
RISK_LEVELS = ((6, "VERY_HIGH"), (4, "HIGH"), (2, "MEDIUM"))


def width_level(width: Column) -> Column:
    return bucket(width, WIDTH_LEVELS, WIDEST)


def slope_level(slope: Column) -> Column:
    return bucket(slope, SLOPE_LEVELS, STEEPEST)


def risk_level(slope: Column, width: Column, surface: Column) -> Column:
    """LOW to VERY_HIGH by the sum of the points of slope, width and surface."""
    s, w, f = F.lit(0), F.lit(0), F.lit(0)
    for bound, v in reversed(SLOPE_RISK):
        s = F.when(slope >= bound, v).otherwise(s)
    for bound, v in reversed(WIDTH_RISK):
        w = F.when(width < bound, v).otherwise(w)
    for code, v in SURFACE_RISK.items():
        f = F.when(surface == code, v).otherwise(f)
    out = F.lit("LOW")
    for bound, name in reversed(RISK_LEVELS):
        out = F.when(s + w + f >= bound, name).otherwise(out)
    return out


def display_slope(slope: Column, width: Column, level: Column | None = None) -> Column:
    """Slope state as drawn: bounds belong to the lower state, and a way below 2 m is impassable whatever its slope."""
    slim = F.coalesce(width < 2.0, F.lit(False)) if level is None else F.coalesce(width < 2.0, F.lit(False)) | F.coalesce(level == "VERY_NARROW", F.lit(False))
    return F.when(slim, "IMPASSABLE").when(slope.isNull(), "UNKNOWN").when(slope <= 3.0, "FLAT").when(slope <= 5.56, "MODERATE").when(slope <= 8.33, "STEEP").otherwise("IMPASSABLE")
