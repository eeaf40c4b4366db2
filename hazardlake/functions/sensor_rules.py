"""Column expressions over station readings and area means. No joins, no aggregates."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake.constants import (
    AIR_QUALITY_LABELS,
    ALERT_LEVELS,
    COMPASS,
    SENSOR_THRESHOLDS,
    TOP_AIR_QUALITY_LABEL,
    TOP_ALERT_LEVEL,
)
from hazardlake.functions.numeric import ratio, round_to
from hazardlake.functions.timefmt import from_millis, iso_millis


def _beyond(value: Column, limit: float, below: bool) -> Column:
    return value < limit if below else value > limit


def exceeds_any(thresholds: Mapping[str, float] = SENSOR_THRESHOLDS, below: Collection[str] = ()) -> Column:
    """True when a present field passes its limit (strictly). Fields named in ``below`` alarm downwards."""
    tests = [
        F.coalesce(_beyond(F.col(name), limit, name in below), F.lit(False)) for name, limit in thresholds.items()
    ]
    return reduce(or_, tests)


def exceeded_map(thresholds: Mapping[str, float] = SENSOR_THRESHOLDS, below: Collection[str] = ()) -> Column:
    """Map of the fields past their limit to their values."""
    pairs = [
        F.when(
            _beyond(F.col(name), limit, name in below),
            F.struct(F.lit(name).alias("key"), F.col(name).cast("double").alias("value")),
        )
        for name, limit in thresholds.items()
    ]
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


def station_pressure(r: Column) -> Column:
    """How strongly a share ``r`` of alarming stations counts: exponential, then linear from 5 %."""
    curve = F.lit(1.0) - F.exp(r * -5.0)
    return F.when(r >= 0.05, F.greatest(curve, F.lit(0.4) * (r / 0.05))).otherwise(curve)


def criticality(means: Mapping[str, Column], extremes: Mapping[str, Column], n_fields: Column) -> Column:
    """Weighted closeness of the means to the worst values seen, spread over the fields present."""
    weights = {"humidity_percent": 1.5, "temperature_c": 1.3}
    terms = []
    for name, worst in extremes.items():
        dry = name == "humidity_percent"
        closeness = F.when(worst > 0, means[name] / worst).otherwise(F.lit(1.0 if dry else 0.0))
        share = (F.lit(1.0) - closeness) if dry else closeness
        terms.append(
            F.when(
                means[name].isNotNull() & worst.isNotNull() & (n_fields > 0),
                share * ratio(F.lit(weights.get(name, 1.0)), n_fields),
            ).otherwise(F.lit(0.0))
        )
    return reduce(add, terms) if terms else F.lit(0.0)


def sensor_severity(
    r: Column,
    means: Mapping[str, Column],
    n_fields: Column,
    extremes: Mapping[str, Column] | None = None,
    dry_season: Column | None = None,
) -> Column:
    """Severity in [0, 1] of an area window.

    Without ``extremes`` the criticality term is zero and the indicator limits are fixed values:
    the score that the monitored system produces. With ``extremes`` the documented intent is scored.
    ``dry_season`` optionally turns on the 15 % context boost, which never fires by default.
    """
    worst = dict(extremes or {})
    base = station_pressure(r) * 0.40 + criticality(means, worst, n_fields) * 0.60

    def limit(name: str, missing: float) -> Column:
        return F.coalesce(worst[name], F.lit(missing)) if name in worst else F.lit(missing)

    hot = F.coalesce(means["temperature_c"], F.lit(0.0)) > limit("temperature_c", 100.0) * 0.7
    dry = F.coalesce(means["humidity_percent"], F.lit(100.0)) < limit("humidity_percent", 0.0) * 0.3
    smoky = F.coalesce(means["smoke_index"], F.lit(0.0)) > limit("smoke_index", 100.0) * 0.5
    signs = hot.cast("int") + dry.cast("int") + smoky.cast("int")
    boost = (signs * 0.15) * F.greatest(F.lit(0.3), F.lit(1.0) - r / 0.6)
    score = F.when((signs >= 2) & (r > 0), F.least(base * (boost + 1.0), F.lit(1.0))).otherwise(base)
    if dry_season is not None:
        score = F.when(dry_season & (r >= 0.1), F.least(score * 1.15, F.lit(1.0))).otherwise(score)
    return F.least(round_to(score, 2), F.lit(1.0))


def detection_confidence(r: Column, severity: Column) -> Column:
    return F.least(r * 0.2 + 0.7 + severity * 0.1, F.lit(0.99))


def air_quality_index(pm25: Column, co2: Column) -> Column:
    """Index in [50, 500] from mean fine dust and CO2; NULL unless both are known."""
    dust = F.least(pm25 / 35.0, F.lit(3.0))
    gas = F.least(F.greatest((co2 - 400.0) / 600.0, F.lit(0.0)), F.lit(3.0))
    index = F.least(round_to((dust * 0.7 + gas * 0.3) * 150.0 + 50.0, 1), F.lit(500.0))
    return F.when(pm25.isNotNull() & co2.isNotNull(), index)


def air_quality_label(index: Column) -> Column:
    label = F.when(index.isNull(), F.lit("Unknown"))
    for upper, name in AIR_QUALITY_LABELS:
        label = label.when(index <= upper, F.lit(name))
    return label.otherwise(F.lit(TOP_AIR_QUALITY_LABEL))


def alert_level(severity: Column) -> Column:
    (first, name), *rest = ALERT_LEVELS
    level = F.when(severity <= first, F.lit(name))
    for upper, name in rest:
        level = level.when(severity <= upper, F.lit(name))
    return F.when(severity.isNotNull(), level.otherwise(F.lit(TOP_ALERT_LEVEL)))


def ignition_time(response_ms: Column, severity: Column) -> Column:
    """ISO text of the estimated start: 10 to 30 minutes before the response, by severity."""
    back = F.floor((severity * 20.0 + 10.0) * 60.0 * 1000.0).cast("bigint")
    return iso_millis(from_millis(response_ms - back))


def spread_factor(temperature: Column, humidity: Column) -> Column:
    """Heat over dryness; NULL unless both are known (``greatest`` would skip a NULL humidity)."""
    floor = F.when(humidity > 1, humidity).when(humidity.isNotNull(), F.lit(1.0))
    return (temperature / 30.0) * (F.lit(30.0) / floor)


def spread_rate(factor: Column) -> Column:
    return F.when(
        factor.isNotNull(),
        F.when(factor > 5, "extreme").when(factor > 3, "rapid").when(factor > 1.5, "moderate").otherwise("slow"),
    )


def spread_speed_mph(factor: Column) -> Column:
    speed = (
        F.when(factor > 5, (factor - 5.0) * 2.0 + 10.0)
        .when(factor > 3, (factor - 3.0) * 2.5 + 5.0)
        .when(factor > 1.5, (factor - 1.5) * 2.0 + 2.0)
        .otherwise(factor + 0.5)
    )
    return round_to(speed, 1)


def fire_direction(event: Column) -> Column:
    """A compass direction fixed by the event id (the readings hold no wind to derive it from)."""
    pick = F.ascii(F.substring(F.sha2(event, 256), 1, 1)) % 8
    return F.element_at(F.array(*[F.lit(name) for name in COMPASS]), pick + 1)
