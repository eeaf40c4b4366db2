"""The sensor flow as one declarative plan, and its registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import AREA_MEASUREMENTS, MEASUREMENTS, TERRAIN, WEATHER
from hazardlake.functions import sensor_rules as rules
from hazardlake.functions.timefmt import millis
from hazardlake.operators import dims, sensors
from hazardlake.plans import oracle as sql
from hazardlake.plans import proxies
from hazardlake.plans.proxies import IOT_WINDOW
from hazardlake.sources.sinks import KEEP_NULLS, json_payload


# ------------------------------------------------------------------ plan stages
def station_stage(readings: DataFrame, stations: DataFrame, window: str) -> DataFrame:
    """Readings to enriched station windows; the silver layers are cut from this."""
    return dims.enrich_stations(sensors.station_windows(readings, window), stations)


def area_stage(enriched: DataFrame, window: str, use_extremes: bool = False) -> DataFrame:
    return sensors.scored_areas(sensors.area_windows(enriched, window), use_extremes)


def event_stage(readings: DataFrame, stations: DataFrame, window: str) -> DataFrame:
    return sensors.area_events(area_stage(station_stage(readings, stations, window), window))


def payload_pages(scored: DataFrame, enriched: DataFrame) -> DataFrame:
    """``key, value``: every event as JSON, a row for each page of its stations.

    A value holds the event's fields, ``page`` (from 0), ``pages`` and ``stations``; an area of any size is spread over
    pages, and a consumer has the whole event with every page.
    """
    events = sensors.area_events(scored, keep=("microarea_id", "w"))
    sent = [name for name in events.columns if name not in ("microarea_id", "w")]
    pages = sensors.event_station_pages(events.withColumn("event", F.struct(*sent)), enriched, carry=("event",))
    return json_payload(pages.select("event.*", "page", "pages", "stations"), "event_id")


# ------------------------------------------------------------------ registered queries
def _windows(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.station_windows(proxies.sensor_readings(spark, sf), IOT_WINDOW)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return station_stage(proxies.sensor_readings(spark, sf), proxies.stations(spark, sf), IOT_WINDOW)


def _scored(spark: SparkSession, sf: str, use_extremes: bool = False) -> DataFrame:
    return area_stage(_enriched(spark, sf), IOT_WINDOW, use_extremes)


def _area_key() -> list:
    return ["microarea_id", millis(F.col("w.start")).alias("window_start_ms")]


def threshold_exceed(spark: SparkSession, sf: str) -> DataFrame:
    readings = proxies.sensor_readings(spark, sf).withColumn("exceeded", rules.exceeded_map())
    return readings.select(
        "reading_id",
        "station_id",
        rules.exceeds_any().alias("exceeds"),
        F.array_join(F.map_keys("exceeded"), ";").alias("exceeded_fields"),
        *[F.try_element_at("exceeded", F.lit(name)).alias(f"exceeded_{name}") for name in MEASUREMENTS],
    )


def station_window_mean(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _windows(spark, sf)
        .filter("is_anomaly")
        .select("station_id", millis(F.col("w.start")).alias("window_start_ms"), *MEASUREMENTS)
    )


def station_window_status(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.station_status(_windows(spark, sf)).select(
        "station_id",
        millis(F.col("w.end")).alias("response_timestamp"),
        millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        "n_readings",
        "is_anomaly",
        "status",
        "message",
    )


def enrich_station(spark: SparkSession, sf: str) -> DataFrame:
    return dims.enrich_stations(
        proxies.sensor_readings(spark, sf).select("reading_id", "station_id"), proxies.stations(spark, sf)
    ).select("reading_id", "station_id", *sensors.STATION_COLUMNS)


_ROUTE = ["station_id", "response_timestamp", "latest_event_timestamp", *sensors.STATION_COLUMNS, "year", "month", "day"]


def silver_iot_routed(spark: SparkSession, sf: str) -> DataFrame:
    """Both silver layouts side by side, told apart by ``route``."""
    rows = sensors.silver_columns(_enriched(spark, sf))
    alarm = F.col("is_anomaly")
    return rows.select(
        F.when(alarm, "anomalies").otherwise("normal").alias("route"),
        alarm.alias("wildfire_detected"),
        *[F.when(~alarm, F.col(name)).alias(name) for name in ("status", "message")],
        *_ROUTE,
        *[F.when(alarm, F.col(name)).alias(name) for name in MEASUREMENTS],
        F.when(alarm, F.lit("wildfire")).alias("anomaly_type"),
    )


def area_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.area_windows(_enriched(spark, sf), IOT_WINDOW).select(
        *_area_key(),
        "total_stations",
        "anomalous_stations",
        millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
    )


def area_anomaly_means(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*_area_key(), "n_fields", *[f"mean_{name}" for name in AREA_MEASUREMENTS])


def area_extrema(spark: SparkSession, sf: str) -> DataFrame:
    return sensors.area_windows(_enriched(spark, sf), IOT_WINDOW).select(
        *_area_key(), *[f"ext_{name}" for name in AREA_MEASUREMENTS]
    )


def iot_severity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(
        *_area_key(), "severity_score", F.round("detection_confidence", 6).alias("detection_confidence")
    )


def iot_severity_intended(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, use_extremes=True).select(*_area_key(), "severity_score", "alert_level")


def air_quality(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*_area_key(), F.col("aqi").alias("air_quality_index"), "air_quality_status")


def ignition_time(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).filter("is_fire").select(*_area_key(), "ignition_time")


def fire_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*_area_key(), "spread_rate", "spread_speed_mph")


def alert_level(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(*_area_key(), "alert_level")


_NULLABLE_COUNTS = [
    "pop_center_distance_m", "pop_center_population", "power_infra_distance_m", "water_infra_distance_m", "evac_radius_m",
]


def gold_iot_flat(spark: SparkSession, sf: str) -> DataFrame:
    events = event_stage(proxies.sensor_readings(spark, sf), proxies.stations(spark, sf), IOT_WINDOW)
    flat = sensors.flat_events(events).withColumn("detection_confidence", F.round("detection_confidence", 6))
    # Quiet events have NULL here; doubles compare alike in every client, nullable integers do not.
    return flat.withColumns({name: F.col(name).cast("double") for name in _NULLABLE_COUNTS})


def gold_iot_event(spark: SparkSession, sf: str) -> DataFrame:
    """Events as topic payloads with their station pages, read back from the JSON a consumer would get."""
    enriched = _enriched(spark, sf)
    scored = area_stage(enriched, IOT_WINDOW)
    events = sensors.area_events(scored, keep=("microarea_id", "w"))
    sent = [name for name in events.columns if name not in ("microarea_id", "w")]
    events = events.withColumn("value", F.to_json(F.struct(*sent), KEEP_NULLS))
    notified = "$.system_response.sent_notifications_to[1]"
    return sensors.event_station_pages(events, enriched, carry=("value",)).select(
        "event_id",
        "page",
        "pages",
        F.size("stations").alias("page_stations"),
        F.array_join(F.col("stations.station_id"), ",").alias("station_ids"),
        F.get_json_object("value", "$.event_type").alias("event_type"),
        F.get_json_object("value", "$.aggregated_detection.severity_score").cast("double").alias("severity_score"),
        F.get_json_object("value", f"{notified}.agency").alias("second_agency"),
        F.get_json_object("value", f"{notified}.notification_timestamp").alias("notified_at"),
        F.get_json_object("value", "$.environmental_context.terrain_info.aspect").alias("aspect"),
    )


def alert_payload_json(spark: SparkSession, sf: str) -> DataFrame:
    """The payload of every event, quiet ones too, nulls included."""
    events = sensors.flat_events(
        event_stage(proxies.sensor_readings(spark, sf), proxies.stations(spark, sf), IOT_WINDOW)
    )
    alerts = events.select(
        "event_id", "region_id", "response_timestamp", "severity_score", "alert_level", "air_quality_status"
    )
    return json_payload(alerts, "event_id")


# ------------------------------------------------------------------ oracle SQL
_KEY = f"microarea_id, {sql.ms('w_start')} AS window_start_ms"
_EXCEEDED = ", ".join(f"CASE WHEN {f} > {t} THEN '{f}' END" for f, t in sql.SENSOR_THRESHOLDS.items())
_EXCEEDED_VALUES = ", ".join(f"CASE WHEN {f} > {t} THEN {f} END AS exceeded_{f}" for f, t in sql.SENSOR_THRESHOLDS.items())
_SILVER_STATION = ", ".join(sensors.STATION_COLUMNS)
_DATE = (
    "CAST(year(latest_event_ts) AS INTEGER) AS year, CAST(month(latest_event_ts) AS INTEGER) AS month,"
    " CAST(day(latest_event_ts) AS INTEGER) AS day"
)


def _lit(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else f"{value}::DOUBLE"


_GOLD = f"""
SELECT event_id, microarea_id AS region_id, response_ms AS response_timestamp, {sql.ms("latest_event_ts")} AS latest_event_timestamp,
  CASE WHEN is_fire THEN 'wildfire' ELSE 'normal' END AS event_type, 'sensor_network' AS detection_source,
  is_fire AS wildfire_detected, round(detection_confidence, 6) AS detection_confidence, severity_score, is_fire AS anomaly_detected,
  CASE WHEN is_fire THEN 'wildfire' END AS anomaly_type, CASE WHEN is_fire THEN aqi END AS air_quality_index,
  CASE WHEN is_fire THEN air_quality_status END AS air_quality_status, CASE WHEN is_fire THEN ignition_time END AS estimated_ignition_time,
  CASE WHEN is_fire THEN spread_rate END AS fire_spread_rate,
  CASE WHEN is_fire AND spread_rate IS NOT NULL THEN
    ['north','northeast','east','southeast','south','southwest','west','northwest'][ascii(substr(sha256(event_id), 1, 1)) % 8 + 1]
  END AS fire_direction,
  CASE WHEN is_fire AND spread_rate IS NOT NULL THEN spread_speed_mph END AS fire_speed_mph,
  {", ".join(f"{_lit(v)} AS {dict(temperature='weather_temperature', humidity='weather_humidity').get(k, k)}" for k, v in WEATHER.items())},
  {", ".join(f"{_lit(v)} AS {k}" for k, v in TERRAIN.items())},
  CASE WHEN is_fire THEN 'wildfire_alert' END AS event_triggered, alert_level,
  CASE WHEN is_fire THEN 'activated_coordination_and_recovery_system' END AS action_taken, true AS automated,
  CASE WHEN is_fire THEN 'Highland Park' END AS pop_center_name, CASE WHEN is_fire THEN 2500::DOUBLE END AS pop_center_distance_m,
  CASE WHEN is_fire THEN 12500::DOUBLE END AS pop_center_population, CASE WHEN is_fire THEN 'high' END AS pop_center_evac_priority,
  CASE WHEN is_fire THEN 'Highland Substation' END AS power_infra_name, CASE WHEN is_fire THEN 1800::DOUBLE END AS power_infra_distance_m,
  CASE WHEN is_fire THEN 'high' END AS power_infra_priority,
  CASE WHEN is_fire THEN 'Eagle Rock Reservoir' END AS water_infra_name, CASE WHEN is_fire THEN 3200::DOUBLE END AS water_infra_distance_m,
  CASE WHEN is_fire THEN 'medium' END AS water_infra_priority,
  CASE WHEN is_fire THEN 'high' END AS fire_deploy_priority,
  CASE WHEN is_fire THEN 'engine_company,brush_unit,water_tender' END AS fire_recommended_resources,
  CASE WHEN is_fire THEN 'medium' END AS evac_priority, CASE WHEN is_fire THEN 3000::DOUBLE END AS evac_radius_m,
  CASE WHEN is_fire THEN 'east' END AS evac_direction,
  CASE WHEN is_fire THEN 'confirmed' END AS fire_dept_delivery_status,
  CASE WHEN is_fire THEN {sql.iso("w_end")} END AS fire_dept_notif_timestamp,
  CASE WHEN is_fire THEN 'confirmed' END AS emergency_mgmt_delivery_status,
  CASE WHEN is_fire THEN {sql.iso("w_end")} END AS emergency_mgmt_notif_timestamp,
  {_DATE}
FROM scored"""

QUERIES = {
    "threshold_exceed": (
        threshold_exceed,
        sql.with_views(sql.V_SENSOR)
        + f"SELECT reading_id, station_id, {sql.EXCEEDS} AS exceeds, concat_ws(';', {_EXCEEDED}) AS exceeded_fields,"
        f" {_EXCEEDED_VALUES} FROM v_sensor",
    ),
    "station_window_mean": (
        station_window_mean,
        sql.with_views(*sql.IOT_TO_STATIONS)
        + f"SELECT station_id, {sql.ms('w_start')} AS window_start_ms, {', '.join(MEASUREMENTS)}"
        " FROM station_windows WHERE is_anomaly",
    ),
    "station_window_status": (
        station_window_status,
        sql.with_views(*sql.IOT_TO_STATIONS)
        + f"SELECT station_id, {sql.ms('w_end')} AS response_timestamp, {sql.ms('latest_event_ts')} AS latest_event_timestamp,"
        " n_readings, is_anomaly, CASE WHEN is_anomaly THEN '' ELSE 'OK' END AS status,"
        " CASE WHEN is_anomaly THEN '' ELSE 'No anomalies detected' END AS message FROM station_windows",
    ),
    "enrich_station": (
        enrich_station,
        sql.with_views(sql.V_SENSOR, sql.V_STATION, "station_windows AS (SELECT reading_id, station_id FROM v_sensor)", sql.ENRICHED)
        + f"SELECT reading_id, station_id, {_SILVER_STATION} FROM enriched",
    ),
    "silver_iot_routed": (
        silver_iot_routed,
        sql.with_views(*sql.IOT_TO_ENRICHED)
        + f"""SELECT CASE WHEN is_anomaly THEN 'anomalies' ELSE 'normal' END AS route,
  CASE WHEN NOT is_anomaly THEN 'OK' END AS status, CASE WHEN NOT is_anomaly THEN 'No anomalies detected' END AS message,
  station_id, {sql.ms("w_end")} AS response_timestamp, {sql.ms("latest_event_ts")} AS latest_event_timestamp, {_SILVER_STATION}, {_DATE},
  {", ".join(MEASUREMENTS)}, is_anomaly AS wildfire_detected, CASE WHEN is_anomaly THEN 'wildfire' END AS anomaly_type
FROM enriched""",
    ),
    "area_window_counts": (
        area_window_counts,
        sql.with_views(*sql.IOT_TO_AREAS)
        + f"SELECT {_KEY}, total_stations, anomalous_stations, {sql.ms('latest_event_ts')} AS latest_event_timestamp FROM area_windows",
    ),
    "area_anomaly_means": (
        area_anomaly_means,
        sql.with_views(*sql.IOT_TO_SCORED)
        + f"SELECT {_KEY}, n_fields, {', '.join(f'mean_{f}' for f in AREA_MEASUREMENTS)} FROM scored",
    ),
    "area_extrema": (
        area_extrema,
        sql.with_views(*sql.IOT_TO_AREAS) + f"SELECT {_KEY}, {', '.join(f'ext_{f}' for f in AREA_MEASUREMENTS)} FROM area_windows",
    ),
    "iot_severity": (
        iot_severity,
        sql.with_views(*sql.IOT_TO_SCORED)
        + f"SELECT {_KEY}, severity_score, round(detection_confidence, 6) AS detection_confidence FROM scored",
    ),
    "iot_severity_intended": (
        iot_severity_intended,
        sql.with_views(*sql.IOT_TO_AREAS, sql.scored(True)) + f"SELECT {_KEY}, severity_score, alert_level FROM scored",
    ),
    "air_quality": (
        air_quality,
        sql.with_views(*sql.IOT_TO_SCORED) + f"SELECT {_KEY}, aqi AS air_quality_index, air_quality_status FROM scored",
    ),
    "ignition_time": (
        ignition_time,
        sql.with_views(*sql.IOT_TO_SCORED) + f"SELECT {_KEY}, ignition_time FROM scored WHERE is_fire",
    ),
    "fire_behavior": (
        fire_behavior,
        sql.with_views(*sql.IOT_TO_SCORED) + f"SELECT {_KEY}, spread_rate, spread_speed_mph FROM scored",
    ),
    "alert_level": (alert_level, sql.with_views(*sql.IOT_TO_SCORED) + f"SELECT {_KEY}, alert_level FROM scored"),
    "gold_iot_flat": (gold_iot_flat, sql.with_views(*sql.IOT_TO_SCORED) + _GOLD),
    "gold_iot_event": (
        gold_iot_event,
        sql.with_views(*sql.IOT_TO_SCORED)
        + f"""SELECT event_id, 0::INTEGER AS page, 1::INTEGER AS pages, CAST(total_stations AS INTEGER) AS page_stations, station_ids,
  CASE WHEN is_fire THEN 'wildfire' ELSE 'normal' END AS event_type, severity_score,
  CASE WHEN is_fire THEN 'emergency_management' END AS second_agency, CASE WHEN is_fire THEN {sql.iso("s.w_end")} END AS notified_at,
  'west-facing' AS aspect
FROM scored s JOIN (SELECT microarea_id, w_end, string_agg(station_id, ',' ORDER BY station_id) AS station_ids FROM enriched GROUP BY ALL) e
  ON s.microarea_id = e.microarea_id AND s.w_end = e.w_end""",
    ),
    "alert_payload_json": (
        alert_payload_json,
        sql.with_views(*sql.IOT_TO_SCORED)
        + """SELECT event_id AS "key", '{"event_id":"' || event_id || '","region_id":"' || microarea_id || '","response_timestamp":'
  || response_ms || ',"severity_score":' || severity_score || ',"alert_level":' || coalesce('"' || alert_level || '"', 'null') || ',"air_quality_status":'
  || CASE WHEN is_fire AND air_quality_status IS NOT NULL THEN '"' || air_quality_status || '"' ELSE 'null' END || '}' AS "value" FROM scored""",
    ),
}
