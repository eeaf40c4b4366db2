"""Column expressions over reflectance bands and scene totals. No joins, no aggregates."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake.constants import (
    ADVICE_BY_SEVERITY,
    ADVICE_LARGE_AREA,
    ADVICE_MEDIUM_AREA,
    ADVICE_MOISTURE,
    ADVICE_NORMAL,
    ADVICE_SMOKE,
    FIRE_LEVELS,
    FIRE_TESTS,
    NO_THREAT,
    QUICK_SCREEN_CONFIDENCE,
    RISK_LEVELS,
    THREATS,
)
from hazardlake.functions.numeric import ratio, round_to

# Reads a band or index of one pixel, from a row or from an array element.
Pixel = Callable[[str], Column]


def row_pixel(name: str) -> Column:
    return F.col(name)


def _band(p: Pixel, name: str) -> Column:
    return F.coalesce(p(name), F.lit(0.0))


def quick_screen(p: Pixel = row_pixel) -> Column:
    """True for clearly healthy vegetation: at least two of bright NIR, cool SWIR, high NIR/red."""
    b4, b8 = _band(p, "b4"), _band(p, "b8")
    signs = [
        b8 > 0.3,
        (_band(p, "b11") < 0.2) & (_band(p, "b12") < 0.2),
        (b4 > 0) & (ratio(b8, b4) > 2.0),
    ]
    return reduce(add, [sign.cast("int") for sign in signs]) >= 2


def normalised_difference(a: Column, b: Column) -> Column:
    return round_to(ratio(a - b, a + b), 4)


def spectral_indices(p: Pixel = row_pixel) -> dict[str, Column]:
    b8 = _band(p, "b8")
    return {
        "ndvi": normalised_difference(b8, _band(p, "b4")),
        "ndmi": normalised_difference(b8, _band(p, "b11")),
        "ndwi": normalised_difference(_band(p, "b3"), b8),
        "nbr": normalised_difference(b8, _band(p, "b12")),
    }


def fire_signs(p: Pixel = row_pixel) -> Column:
    return reduce(add, [(p(name) < limit).cast("int") for name, limit, _ in FIRE_TESTS])


def fire_points(p: Pixel = row_pixel) -> Column:
    return reduce(add, [F.when(p(name) < limit, points).otherwise(0) for name, limit, points in FIRE_TESTS])


def fire_level(signs: Column, points: Column) -> Column:
    level = F.lit("normal")
    for min_signs, min_points, name in reversed(FIRE_LEVELS):
        level = F.when((signs >= min_signs) & (points >= min_points), F.lit(name)).otherwise(level)
    return level


def classified(quick: Column, signs: Column, points: Column) -> dict[str, Column]:
    """Class columns of a pixel; a screened pixel never reaches the index tests."""
    level = F.when(quick, F.lit("normal")).otherwise(fire_level(signs, points))
    return {
        "classification_status": F.when(quick, F.lit("OK")).otherwise(F.lit("")),
        "scene_class": F.when(level == "normal", F.lit("vegetation")).otherwise(F.lit("fire")),
        "classification_level": level,
        "classification_confidence": F.when(quick, F.lit(QUICK_SCREEN_CONFIDENCE)).otherwise(points),
        "processing_type": F.when(quick, F.lit("quick_screen")).otherwise(F.lit("full_analysis")),
    }


def indicator_tests(p: Pixel = row_pixel) -> dict[str, Column]:
    """The five fire indicators of an analysed pixel."""

    def index(name: str) -> Column:
        return F.coalesce(p(name), F.lit(1.0))

    return {
        "high_temperature_signatures": (_band(p, "b11") > 0.2) | (_band(p, "b12") > 0.2),
        "vegetation_stress_detected": index("ndvi") < -0.3,
        "moisture_deficit_areas": index("ndmi") < -0.15,
        "burn_scar_indicators": index("nbr") < -0.2,
        "smoke_signatures": (_band(p, "b4") > 0.3) & (_band(p, "b2") > 0.1),
    }


def vegetation_status(mean_ndvi: Column) -> Column:
    return (
        F.when(mean_ndvi.isNull(), "unknown")
        .when(mean_ndvi > 0.3, "healthy")
        .when(mean_ndvi > 0.1, "moderate")
        .otherwise("stressed")
    )


def moisture_status(mean_ndmi: Column) -> Column:
    return (
        F.when(mean_ndmi.isNull(), "unknown")
        .when(mean_ndmi < -0.2, "very_dry")
        .when(mean_ndmi < 0, "dry")
        .when(mean_ndmi < 0.2, "moderate")
        .otherwise("moist")
    )


def fire_weather_level(hot_percent: Column, moisture_percent: Column) -> Column:
    return (
        F.when((hot_percent > 20) & (moisture_percent > 30), "extreme")
        .when((hot_percent > 10) | (moisture_percent > 20), "high")
        .when((hot_percent > 5) | (moisture_percent > 10), "moderate")
        .otherwise("low")
    )


def environmental_stress(vegetation: Column, moisture: Column) -> Column:
    points = F.when(vegetation == "stressed", 3).when(vegetation == "moderate", 2).when(
        vegetation == "healthy", 1
    ).otherwise(0) + F.when(moisture == "very_dry", 3).when(moisture == "dry", 2).when(
        moisture == "moderate", 1
    ).otherwise(0)
    return F.when(points >= 5, "critical").when(points >= 4, "high").when(points >= 2, "moderate").otherwise("low")


def scene_severity(
    total: Column,
    anomalous: Column,
    means: dict[str, Column],
    indicators: dict[str, Column],
    stress: Column,
    floor: float | None = None,
) -> Column:
    """Severity in [0, 1] of one image. ``floor`` lifts every anomalous image to at least that value."""
    r = anomalous / total
    closeness = (
        means["b4"] / 0.5
        + means["b11"] / 0.4
        + means["b12"] / 0.4
        + F.abs(means["ndvi"])
        + F.abs(means["ndmi"])
        + F.abs(means["ndwi"])
        + F.abs(means["nbr"])
    ) / 7.0
    curve = F.lit(1.0) - F.exp(r * -8.0)
    pressure = F.when(r >= 0.05, F.greatest(curve, F.lit(0.25) * (r / 0.05))).otherwise(curve)
    base = pressure * 0.55 + closeness * 0.45
    signs = (
        (indicators["high_temperature_signatures"] / total > 0.1).cast("int")
        + (indicators["moisture_deficit_areas"] / total > 0.2).cast("int")
        + (indicators["vegetation_stress_detected"] / total > 0.15).cast("int")
        + (indicators["smoke_signatures"] / total > 0.05).cast("int")
    )
    boost = F.least((signs * 0.1) * F.greatest(F.lit(0.3), F.lit(1.0) - r / 0.8), F.lit(0.2))
    score = F.when((signs >= 2) & (r > 0), F.least(base * (boost + 1.0), F.lit(1.0))).otherwise(base)
    score = (
        F.when((stress == "critical") & (r >= 0.1), F.least(score * 1.1, F.lit(1.0)))
        .when((stress == "high") & (r >= 0.1), F.least(score * 1.05, F.lit(1.0)))
        .otherwise(score)
    )
    score = F.least(round_to(score, 2), F.lit(1.0))
    return score if floor is None else F.greatest(score, F.lit(float(floor)))


def risk_level(severity: Column) -> Column:
    level = F.lit("minimal")
    for lower, name in reversed(RISK_LEVELS):
        level = F.when(severity >= lower, F.lit(name)).otherwise(level)
    return level


def threat(severity: Column, is_normal: Column | None = None) -> Column:
    """Threat struct ``level, priority, evacuation_consideration, description`` by severity."""

    def entry(level: str, priority: str, evacuate: bool, text: str) -> Column:
        return F.struct(
            F.lit(level).alias("level"),
            F.lit(priority).alias("priority"),
            F.lit(evacuate).alias("evacuation_consideration"),
            F.lit(text).alias("description"),
        )

    *graded, lowest = THREATS
    chosen = entry(*lowest[1:])
    for lower, *fields in reversed(graded):
        chosen = F.when(severity >= lower, entry(*fields)).otherwise(chosen)
    return chosen if is_normal is None else F.when(is_normal, entry(*NO_THREAT)).otherwise(chosen)


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def recommendations(
    severity: Column,
    area_km2: Column,
    moisture_pixels: Column,
    smoke_pixels: Column,
    total: Column,
    is_normal: Column | None = None,
) -> Column:
    """Ordered advice: by severity, by area, by moisture, by smoke."""
    none = F.array().cast("array<string>")
    by_severity = none
    for lower, texts in reversed(ADVICE_BY_SEVERITY):
        by_severity = F.when(severity >= lower, _texts(texts)).otherwise(by_severity)
    by_area = (
        F.when(area_km2 > 100, _texts([ADVICE_LARGE_AREA]))
        .when(area_km2 > 50, _texts([ADVICE_MEDIUM_AREA]))
        .otherwise(none)
    )
    advice = F.concat(
        by_severity,
        by_area,
        F.when(moisture_pixels > total * 0.3, _texts([ADVICE_MOISTURE])).otherwise(none),
        F.when(smoke_pixels > 0, _texts([ADVICE_SMOKE])).otherwise(none),
    )
    return advice if is_normal is None else F.when(is_normal, _texts(ADVICE_NORMAL)).otherwise(advice)
