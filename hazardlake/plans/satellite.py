"""The imagery flow as one declarative plan, and its registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import (
    ADVICE_BY_SEVERITY,
    ADVICE_LARGE_AREA,
    ADVICE_MEDIUM_AREA,
    ADVICE_MOISTURE,
    ADVICE_NORMAL,
    ADVICE_SMOKE,
    BANDS,
    INDICES,
    NO_THREAT,
    THREATS,
)
from hazardlake.functions import spectral
from hazardlake.functions.numeric import snap
from hazardlake.operators import dims, imagery
from hazardlake.plans import oracle as sql
from hazardlake.plans import proxies

IMAGE_KEYS = ["image_pointer", "timestamp", "microarea_id", "macroarea_id"]


# ------------------------------------------------------------------ plan stages
def scene_stage(pixels: DataFrame, severity_floor: float | None = None) -> DataFrame:
    """Pixel rows to assessed images: one exchange."""
    return imagery.assess_scenes(
        imagery.scenes_from_rows(imagery.classify_pixels(pixels), IMAGE_KEYS), severity_floor
    )


def array_scene_stage(images: DataFrame, severity_floor: float | None = None) -> DataFrame:
    """Images with pixel arrays to assessed images: no exchange, usable on streams."""
    return imagery.assess_scenes(imagery.scenes_from_arrays(images, IMAGE_KEYS), severity_floor)


def message_scene_stage(images: DataFrame, severity_floor: float | None = None) -> DataFrame:
    """The same from exploded pixels: one small exchange; for batches and micro-batches."""
    return imagery.assess_scenes(imagery.scenes_from_messages(images, IMAGE_KEYS), severity_floor)


def classified_scene_stage(rows: DataFrame, severity_floor: float | None = None) -> DataFrame:
    """The same from rows of ``imagery.classified_messages``, where another layer needs them too."""
    scenes = imagery.scenes_from_rows(rows, [*IMAGE_KEYS, "message_no"]).drop("message_no")
    return imagery.assess_scenes(scenes, severity_floor)


def gold_stage(assessed: DataFrame, microareas: DataFrame) -> DataFrame:
    """The area rectangle joins the few assessed images, not the pixels."""
    return imagery.flat_scenes(dims.enrich_microareas(_plain(assessed), microareas))


def _plain(assessed: DataFrame) -> DataFrame:
    return assessed.drop("min_latitude", "max_latitude", "min_longitude", "max_longitude")


# ------------------------------------------------------------------ registered queries
_PIXEL_ID = ["image_pointer", "latitude", "longitude"]


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return imagery.classify_pixels(proxies.pixels(spark, sf))


def _scenes(spark: SparkSession, sf: str) -> DataFrame:
    return scene_stage(proxies.pixels(spark, sf))


def spectral_indices(spark: SparkSession, sf: str) -> DataFrame:
    indices = spectral.spectral_indices()
    return proxies.pixels(spark, sf).select(*_PIXEL_ID, *[indices[name].alias(name) for name in INDICES])


def veg_quick_screen(spark: SparkSession, sf: str) -> DataFrame:
    return proxies.pixels(spark, sf).select(*_PIXEL_ID, "b4", "b8", "b11", "b12", spectral.quick_screen().alias("quick_ok"))


def fire_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select(
        *_PIXEL_ID,
        "classification_status",
        "scene_class",
        "classification_level",
        "classification_confidence",
        "processing_type",
    )


def enrich_microarea(spark: SparkSession, sf: str) -> DataFrame:
    pixels = proxies.pixels(spark, sf).select("image_pointer", "microarea_id", "latitude", "longitude")
    joined = dims.enrich_microareas(pixels, proxies.microareas(spark))
    return joined.select(
        "image_pointer", "microarea_id", "latitude", "longitude", *[snap(F.col(name)).alias(name) for name in dims.BBOX]
    )


def rounded_box(df: DataFrame) -> DataFrame:
    for name in ("min_longitude", "min_latitude", "max_longitude", "max_latitude"):
        df = df.withColumn(name, snap(F.col(name)))
    return df


def silver_sat_pixels(spark: SparkSession, sf: str) -> DataFrame:
    enriched = dims.enrich_microareas(_classified(spark, sf), proxies.microareas(spark))
    return rounded_box(imagery.silver_pixels(enriched))


def silver_sat_exploded(spark: SparkSession, sf: str) -> DataFrame:
    """Silver pixels from messages with pixel arrays."""
    pixels = imagery.classify_pixels(imagery.explode_pixels(proxies.image_messages(spark, sf)))
    enriched = dims.enrich_microareas(pixels, proxies.microareas(spark))
    return rounded_box(imagery.silver_pixels(enriched))


def sat_scene_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select(
        "image_pointer", "total_pixels", "anomalous_pixels", "anomaly_percentage", "affected_area_km2", "confidence_level"
    )


def sat_fire_indicators(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select("image_pointer", *imagery.INDICATORS)


_SPECTRAL = [
    *[f"anomalous_{name}" for name in [*BANDS, *INDICES]],
    *[f"scene_{name}" for name in BANDS],
]


def sat_spectral_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select("image_pointer", *_SPECTRAL)


_SPATIAL = ["cluster_density", "geographic_spread_km2", "hotspot_concentration_percent"]


def sat_spatial(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select("image_pointer", *_SPATIAL)


_ENVIRONMENT = [
    "vegetation_status",
    "average_ndvi",
    "healthy_vegetation_percent",
    "moisture_status",
    "average_ndmi",
    "average_ndwi",
    "dry_pixel_percent",
    "fire_weather_level",
    "temperature_signature_percent",
    "moisture_deficit_percent",
    "smoke_detection_percent",
    "environmental_stress_level",
]


def sat_environment(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select("image_pointer", *_ENVIRONMENT)


def sat_severity(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select("image_pointer", "severity_score", "risk_level")


def threat_class(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select(
        "image_pointer",
        F.col("threat.level").alias("threat_level"),
        F.col("threat.priority").alias("threat_priority"),
        F.col("threat.evacuation_consideration").alias("evacuation_consideration"),
        F.col("threat.description").alias("threat_description"),
    )


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return _scenes(spark, sf).select(
        "image_pointer", F.size("advice").alias("n_recommendations"), F.array_join("advice", ",").alias("recommendations")
    )


def gold_sat_flat(spark: SparkSession, sf: str) -> DataFrame:
    return rounded_box(gold_stage(_scenes(spark, sf), proxies.microareas(spark)))


def gold_sat_from_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The same gold layout computed inside pixel arrays, without an exchange."""
    return rounded_box(gold_stage(array_scene_stage(proxies.image_messages(spark, sf)), proxies.microareas(spark)))


def gold_sat_from_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The same gold layout from exploded pixel arrays."""
    return rounded_box(gold_stage(message_scene_stage(proxies.image_messages(spark, sf)), proxies.microareas(spark)))


# ------------------------------------------------------------------ oracle SQL
def _quoted(texts: list[str]) -> str:
    return "[" + ", ".join(f"'{text}'" for text in texts) + "]"


def _threat_sql(position: int) -> str:
    def value(row: tuple) -> str:
        cell = row[position]
        return str(cell).lower() if isinstance(cell, bool) else f"'{cell}'"

    cases = " ".join(
        f"WHEN severity_score >= {row[0]} THEN {value(row[1:])}" for row in THREATS if row[0] is not None
    )
    return f"CASE WHEN is_normal THEN {value(NO_THREAT)} {cases} ELSE {value(THREATS[-1][1:])} END"


_THREAT = ", ".join(
    f"{_threat_sql(i)} AS {name}"
    for i, name in enumerate(("threat_level", "threat_priority", "evacuation_consideration", "threat_description"))
)
_ADVICE = (
    f"CASE WHEN is_normal THEN {_quoted(ADVICE_NORMAL)} ELSE list_concat(list_concat(list_concat(CASE "
    + " ".join(f"WHEN severity_score >= {low} THEN {_quoted(texts)}" for low, texts in ADVICE_BY_SEVERITY)
    + f" ELSE []::VARCHAR[] END, CASE WHEN affected_area_km2 > 100 THEN ['{ADVICE_LARGE_AREA}']"
    f" WHEN affected_area_km2 > 50 THEN ['{ADVICE_MEDIUM_AREA}'] ELSE []::VARCHAR[] END),"
    f" CASE WHEN moisture_deficit_areas > total_pixels*0.3::DOUBLE THEN ['{ADVICE_MOISTURE}'] ELSE []::VARCHAR[] END),"
    f" CASE WHEN smoke_signatures > 0 THEN ['{ADVICE_SMOKE}'] ELSE []::VARCHAR[] END) END"
)
_DATE = (
    'CAST(year(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS year, CAST(month(CAST("timestamp" AS TIMESTAMP)) AS INTEGER)'
    ' AS month, CAST(day(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS day'
)
_BOX = ", ".join(
    f"{sql.snap(f'm.{a}')} AS {b}"
    for a, b in zip(dims.BBOX, ("min_longitude", "min_latitude", "max_longitude", "max_latitude"))
)
_SUMMARY = "total_pixels, anomalous_pixels, anomaly_percentage, affected_area_km2, confidence_level"
_GOLD = f"""SELECT image_pointer, "timestamp" AS event_timestamp, a.microarea_id, a.macroarea_id, {_BOX}, {_SUMMARY},
  {", ".join(imagery.INDICATORS)}, {", ".join(_SPECTRAL)}, {", ".join(_ENVIRONMENT)}, severity_score, risk_level, {_THREAT},
  {", ".join(_SPATIAL)}, array_to_string({_ADVICE}, ',') AS recommendations, {_DATE}
FROM assessed a LEFT JOIN v_microarea m ON a.microarea_id = m.microarea_id"""
_SILVER = f"""SELECT image_pointer, "timestamp", c.microarea_id, c.macroarea_id, {_BOX}, latitude, longitude,
  {", ".join(f"{b} AS band_{b.upper()}" for b in BANDS)}, classification_status, scene_class, classification_level,
  classification_confidence, processing_type, {", ".join(f"coalesce({i}, 0.0::DOUBLE) AS {i}" for i in INDICES)}, {_DATE}
FROM classified c LEFT JOIN v_microarea m ON c.microarea_id = m.microarea_id"""
_ORDER_CLASSIFIED = [sql.V_ORDER_PIXEL, sql.INDEXED, sql.CLASSIFIED]
_AREAS = [sql.V_GRID, sql.V_MICROAREA]


_GOLD_FROM_ORDERS = sql.with_views(*_ORDER_CLASSIFIED, sql.SCENES, sql.ASSESSED, *_AREAS) + _GOLD


def _from_assessed(columns: str) -> str:
    return sql.with_views(*sql.SAT_TO_ASSESSED) + f"SELECT image_pointer, {columns} FROM assessed"


QUERIES = {
    "spectral_indices": (
        spectral_indices,
        sql.with_views(sql.V_PIXEL, sql.INDEXED.replace("CASE WHEN NOT quick_ok THEN ", "(").replace(" END AS n", ") AS n"))
        + "SELECT image_pointer, latitude, longitude, ndvi, ndmi, ndwi, nbr FROM indexed",
    ),
    "veg_quick_screen": (
        veg_quick_screen,
        sql.with_views(sql.V_PIXEL)
        + f"SELECT image_pointer, latitude, longitude, b4, b8, b11, b12, {sql.QUICK} AS quick_ok FROM v_pixel",
    ),
    "fire_classify": (
        fire_classify,
        sql.with_views(*sql.SAT_TO_CLASSIFIED)
        + "SELECT image_pointer, latitude, longitude, classification_status, scene_class, classification_level,"
        " classification_confidence, processing_type FROM classified",
    ),
    "enrich_microarea": (
        enrich_microarea,
        sql.with_views(sql.V_PIXEL, *_AREAS)
        + "SELECT image_pointer, p.microarea_id, latitude, longitude,"
        + ", ".join(f"{sql.snap(f'm.{name}')} AS {name}" for name in dims.BBOX)
        + " FROM v_pixel p LEFT JOIN v_microarea m ON p.microarea_id = m.microarea_id",
    ),
    "silver_sat_pixels": (silver_sat_pixels, sql.with_views(*sql.SAT_TO_CLASSIFIED, *_AREAS) + _SILVER),
    "silver_sat_exploded": (silver_sat_exploded, sql.with_views(*_ORDER_CLASSIFIED, *_AREAS) + _SILVER),
    "sat_scene_summary": (sat_scene_summary, _from_assessed(_SUMMARY)),
    "sat_fire_indicators": (sat_fire_indicators, _from_assessed(", ".join(imagery.INDICATORS))),
    "sat_spectral_stats": (sat_spectral_stats, _from_assessed(", ".join(_SPECTRAL))),
    "sat_spatial": (sat_spatial, _from_assessed(", ".join(_SPATIAL))),
    "sat_environment": (sat_environment, _from_assessed(", ".join(_ENVIRONMENT))),
    "sat_severity": (sat_severity, _from_assessed("severity_score, risk_level")),
    "threat_class": (threat_class, _from_assessed(_THREAT)),
    "recommendations": (
        recommendations,
        _from_assessed(f"CAST(len({_ADVICE}) AS INTEGER) AS n_recommendations, array_to_string({_ADVICE}, ',') AS recommendations"),
    ),
    "gold_sat_flat": (gold_sat_flat, sql.with_views(*sql.SAT_TO_ASSESSED, *_AREAS) + _GOLD),
    "gold_sat_from_arrays": (gold_sat_from_arrays, _GOLD_FROM_ORDERS),
    "gold_sat_from_messages": (gold_sat_from_messages, _GOLD_FROM_ORDERS),
}
