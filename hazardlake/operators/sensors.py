"""Station readings -> station windows -> area windows -> events, on batch or streaming DataFrames.

Both window steps are plain grouped aggregates over decomposable functions, so Spark combines
map-side before each exchange and a hot station or area costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.constants import (
    AREA_MEASUREMENTS,
    FIRE_UNITS,
    INFRASTRUCTURE,
    MEASUREMENTS,
    NOTIFIED_AGENCIES,
    POPULATION_CENTER,
    SENSOR_MODELS,
    SENSOR_THRESHOLDS,
    TERRAIN,
    WEATHER,
)
from hazardlake.functions import sensor_rules as rules
from hazardlake.functions.numeric import ratio, round_to, snap
from hazardlake.functions.timefmt import date_parts, event_id, from_millis, iso_millis, millis

STATION_COLUMNS = [
    "microarea_id",
    "latitude",
    "longitude",
    "elevation_m",
    "station_model",
    "deployment_date",
    "maintenance_status",
    "battery_type",
    *SENSOR_MODELS,
]


def station_windows(
    readings: DataFrame,
    window: str = "1 minute",
    thresholds: Mapping[str, float] = SENSOR_THRESHOLDS,
    below: Collection[str] = (),
) -> DataFrame:
    """One row per station and window: alarm state, newest event time, field means of the alarming readings.

    A field's mean covers only readings that alarm and carry the field; ``avg`` skips the rest.
    """
    flagged = readings.withColumn("exceeds", rules.exceeds_any(thresholds, below))
    means = [
        round_to(F.avg(F.when(F.col("exceeds"), F.col(name))), 2).alias(name) for name in MEASUREMENTS
    ]
    return flagged.groupBy(F.window("ts", window).alias("w"), "station_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.max("exceeds").alias("is_anomaly"),
        F.max("ts").alias("latest_event_ts"),
        *means,
    )


def station_status(windows: DataFrame) -> DataFrame:
    """Adds the textual health report of a window."""
    return windows.withColumn("status", F.when(F.col("is_anomaly"), "").otherwise("OK")).withColumn(
        "message", F.when(F.col("is_anomaly"), "").otherwise("No anomalies detected")
    )


def silver_columns(stations: DataFrame) -> DataFrame:
    """Enriched station windows with the columns shared by both silver layouts and the date parts."""
    return station_status(stations).select(
        "*",
        millis(F.col("w.end")).alias("response_timestamp"),
        millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        *date_parts(F.coalesce(F.col("latest_event_ts"), F.col("w.end"))),
    )


def silver_normal(stations: DataFrame) -> DataFrame:
    """Quiet station windows in the 19-column layout plus date parts."""
    return (
        silver_columns(stations)
        .filter(~F.col("is_anomaly"))
        .select(
            "station_id",
            *STATION_COLUMNS,
            "status",
            "message",
            "response_timestamp",
            "latest_event_timestamp",
            "year",
            "month",
            "day",
        )
    )


def silver_anomalies(stations: DataFrame) -> DataFrame:
    """Alarming station windows in the 29-column layout plus date parts."""
    return (
        silver_columns(stations)
        .filter("is_anomaly")
        .select(
            "station_id",
            "response_timestamp",
            "latest_event_timestamp",
            *MEASUREMENTS,
            F.lit(True).alias("wildfire_detected"),
            F.lit(True).alias("smoke_detected"),
            F.lit(True).alias("flame_detected_ir"),
            F.lit(True).alias("anomaly_detected"),
            F.lit("wildfire").alias("anomaly_type"),
            *STATION_COLUMNS,
            "year",
            "month",
            "day",
        )
    )


def area_windows(stations: DataFrame, window: str = "1 minute", time: Column | None = None) -> DataFrame:
    """One row per area and window, from enriched station windows.

    ``window_time`` carries the first window's event time into the second, so the same expression
    chains two windowed aggregates in a stream. ``time`` replaces it where the windows come from a table.
    """
    time = F.window_time("w") if time is None else time
    anomalous = F.col("is_anomaly")
    means = [F.avg(F.when(anomalous, F.col(name))).alias(f"avg_{name}") for name in AREA_MEASUREMENTS]
    worst = [
        (F.min(name) if name == "humidity_percent" else F.max(name)).alias(f"ext_{name}")
        for name in AREA_MEASUREMENTS
    ]
    return stations.groupBy(F.window(time, window).alias("w"), "microarea_id").agg(
        F.count(F.lit(1)).alias("total_stations"),
        F.count_if(anomalous).alias("anomalous_stations"),
        F.max("latest_event_ts").alias("latest_event_ts"),
        *[snap(mean).alias(f"avg_{name}") for mean, name in zip(means, AREA_MEASUREMENTS)],
        *worst,
    )


def scored_areas(areas: DataFrame, use_extremes: bool = False) -> DataFrame:
    """Severity, confidence, air quality, spread and alert level of every area window.

    ``use_extremes`` scores with the observed extremes (the documented intent) instead of without them.
    """
    n_fields = sum((F.col(f"avg_{name}").isNotNull().cast("int") for name in AREA_MEASUREMENTS), F.lit(0))
    means = {name: F.col(f"mean_{name}") for name in AREA_MEASUREMENTS}
    extremes = {name: F.col(f"ext_{name}") for name in AREA_MEASUREMENTS} if use_extremes else None
    prepared = areas.select(
        "*",
        n_fields.alias("n_fields"),
        ratio(F.col("anomalous_stations"), F.col("total_stations")).alias("r"),
        (F.col("anomalous_stations") > 0).alias("is_fire"),
        millis(F.col("w.end")).alias("response_ms"),
        *[round_to(F.col(f"avg_{name}"), 2).alias(f"mean_{name}") for name in AREA_MEASUREMENTS],
        rules.air_quality_index(F.col("avg_pm25_ugm3"), F.col("avg_co2_ppm")).alias("aqi"),
        rules.spread_factor(F.col("avg_temperature_c"), F.col("avg_humidity_percent")).alias("spread_factor"),
    )
    severity = F.when(F.col("is_fire"), rules.sensor_severity(F.col("r"), means, F.col("n_fields"), extremes))
    scored = prepared.withColumn("severity_score", severity.otherwise(F.lit(0.0)))
    return scored.select(
        "*",
        F.when(F.col("is_fire"), rules.detection_confidence(F.col("r"), F.col("severity_score")))
        .otherwise(F.lit(0.0))
        .alias("detection_confidence"),
        F.when(F.col("is_fire"), rules.alert_level(F.col("severity_score"))).alias("alert_level"),
        rules.air_quality_label(F.col("aqi")).alias("air_quality_status"),
        rules.ignition_time(F.col("response_ms"), F.col("severity_score")).alias("ignition_time"),
        rules.spread_rate(F.col("spread_factor")).alias("spread_rate"),
        rules.spread_speed_mph(F.col("spread_factor")).alias("spread_speed_mph"),
        event_id(F.col("microarea_id"), F.col("response_ms")).alias("event_id"),
    )


def _literal_struct(values: Mapping[str, object]) -> Column:
    return F.struct(*[F.lit(value).alias(name) for name, value in values.items()])


def at_risk_assets() -> Column:
    name, distance, population, priority = POPULATION_CENTER
    center = {
        "name": name,
        "distance_meters": distance,
        "population": population,
        "evacuation_priority": priority,
    }
    infrastructure = [
        _literal_struct(dict(zip(("type", "name", "distance_meters", "priority"), row))) for row in INFRASTRUCTURE
    ]
    return F.struct(
        F.array(_literal_struct(center)).alias("population_centers"),
        F.array(*infrastructure).alias("critical_infrastructure"),
    )


def recommended_actions() -> Column:
    deploy = F.struct(
        F.lit("deploy_fire_units").alias("action"),
        F.lit("high").alias("priority"),
        F.array(*[F.lit(unit) for unit in FIRE_UNITS]).alias("recommended_resources"),
        F.lit(None).cast("int").alias("radius_meters"),
        F.lit(None).cast("string").alias("evacuation_direction"),
    )
    evacuate = F.struct(
        F.lit("evacuate_area").alias("action"),
        F.lit("medium").alias("priority"),
        F.lit(None).cast("array<string>").alias("recommended_resources"),
        F.lit(3000).alias("radius_meters"),
        F.lit("east").alias("evacuation_direction"),
    )
    return F.array(deploy, evacuate)


def notifications(sent_at: Column) -> Column:
    """The notified agencies, each stamped with the window end."""
    templates = F.array(
        *[_literal_struct({"agency": agency, "delivery_status": status}) for agency, status in NOTIFIED_AGENCIES]
    )
    return F.transform(templates, lambda row: row.withField("notification_timestamp", sent_at))


def area_events(scored: DataFrame, keep: Collection[str] = ()) -> DataFrame:
    """Scored area windows as nested events, the shape sent to the alert topic; ``keep`` names further columns to pass on."""
    fire = F.col("is_fire")
    behavior = F.when(
        F.col("spread_rate").isNotNull(),
        F.struct(
            F.col("spread_rate").alias("spread_rate"),
            rules.fire_direction(F.col("event_id")).alias("direction"),
            F.col("spread_speed_mph").alias("estimated_speed_mph"),
        ),
    )
    detection = F.struct(
        fire.alias("wildfire_detected"),
        F.col("detection_confidence"),
        F.col("severity_score"),
        fire.alias("anomaly_detected"),
        F.when(fire, F.lit("wildfire")).alias("anomaly_type"),
        F.when(fire, F.col("aqi")).alias("air_quality_index"),
        F.when(fire, F.col("air_quality_status")).alias("air_quality_status"),
        F.when(fire, F.col("ignition_time")).alias("estimated_ignition_time"),
        F.when(fire, behavior).alias("fire_behavior"),
    )
    context = F.struct(
        _literal_struct(WEATHER).alias("weather_conditions"), _literal_struct(TERRAIN).alias("terrain_info")
    )
    response = F.struct(
        F.when(fire, F.lit("wildfire_alert")).alias("event_triggered"),
        F.col("alert_level"),
        F.when(fire, F.lit("activated_coordination_and_recovery_system")).alias("action_taken"),
        F.lit(True).alias("automated"),
        F.when(fire, at_risk_assets()).alias("at_risk_assets"),
        F.when(fire, recommended_actions()).alias("recommended_actions"),
        F.when(fire, notifications(iso_millis(F.col("w.end")))).alias("sent_notifications_to"),
    )
    return scored.select(
        "event_id",
        F.col("microarea_id").alias("region_id"),
        F.col("response_ms").alias("response_timestamp"),
        millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        F.when(fire, "wildfire").otherwise("normal").alias("event_type"),
        F.lit("sensor_network").alias("detection_source"),
        detection.alias("aggregated_detection"),
        context.alias("environmental_context"),
        response.alias("system_response"),
        F.col("total_stations"),
        *keep,
    )


def _first(array: Column, field: str, value: str) -> Column:
    """First element whose ``field`` equals ``value``, NULL when there is none."""
    return F.get(F.filter(array, lambda row: row[field] == value), F.lit(0))


def flat_events(events: DataFrame) -> DataFrame:
    """Events in the 49-column gold layout plus date parts; quiet events keep NULLs in response columns."""
    weather = F.col("environmental_context.weather_conditions")
    terrain = F.col("environmental_context.terrain_info")
    detection = F.col("aggregated_detection")
    behavior = detection["fire_behavior"]
    response = F.col("system_response")
    assets = response["at_risk_assets"]
    center = F.get(assets["population_centers"], F.lit(0))
    power = _first(assets["critical_infrastructure"], "type", "power_substation")
    water = _first(assets["critical_infrastructure"], "type", "water_reservoir")
    deploy = _first(response["recommended_actions"], "action", "deploy_fire_units")
    evacuate = _first(response["recommended_actions"], "action", "evacuate_area")
    brigade = _first(response["sent_notifications_to"], "agency", "local_fire_department")
    management = _first(response["sent_notifications_to"], "agency", "emergency_management")
    event_time = from_millis(F.coalesce("latest_event_timestamp", "response_timestamp"))
    return events.select(
        "event_id",
        "region_id",
        "response_timestamp",
        "latest_event_timestamp",
        "event_type",
        "detection_source",
        detection["wildfire_detected"].alias("wildfire_detected"),
        detection["detection_confidence"].alias("detection_confidence"),
        detection["severity_score"].alias("severity_score"),
        detection["anomaly_detected"].alias("anomaly_detected"),
        detection["anomaly_type"].alias("anomaly_type"),
        detection["air_quality_index"].alias("air_quality_index"),
        detection["air_quality_status"].alias("air_quality_status"),
        detection["estimated_ignition_time"].alias("estimated_ignition_time"),
        behavior["spread_rate"].alias("fire_spread_rate"),
        behavior["direction"].alias("fire_direction"),
        behavior["estimated_speed_mph"].alias("fire_speed_mph"),
        weather["temperature"].alias("weather_temperature"),
        weather["humidity"].alias("weather_humidity"),
        weather["wind_speed"].alias("wind_speed"),
        weather["wind_direction"].alias("wind_direction"),
        weather["precipitation_chance"].alias("precipitation_chance"),
        terrain["vegetation_type"].alias("vegetation_type"),
        terrain["vegetation_density"].alias("vegetation_density"),
        terrain["slope"].alias("slope"),
        terrain["aspect"].alias("aspect"),
        response["event_triggered"].alias("event_triggered"),
        response["alert_level"].alias("alert_level"),
        response["action_taken"].alias("action_taken"),
        response["automated"].alias("automated"),
        center["name"].alias("pop_center_name"),
        center["distance_meters"].alias("pop_center_distance_m"),
        center["population"].alias("pop_center_population"),
        center["evacuation_priority"].alias("pop_center_evac_priority"),
        power["name"].alias("power_infra_name"),
        power["distance_meters"].alias("power_infra_distance_m"),
        power["priority"].alias("power_infra_priority"),
        water["name"].alias("water_infra_name"),
        water["distance_meters"].alias("water_infra_distance_m"),
        water["priority"].alias("water_infra_priority"),
        deploy["priority"].alias("fire_deploy_priority"),
        F.array_join(deploy["recommended_resources"], ",").alias("fire_recommended_resources"),
        evacuate["priority"].alias("evac_priority"),
        evacuate["radius_meters"].alias("evac_radius_m"),
        evacuate["evacuation_direction"].alias("evac_direction"),
        brigade["delivery_status"].alias("fire_dept_delivery_status"),
        brigade["notification_timestamp"].alias("fire_dept_notif_timestamp"),
        management["delivery_status"].alias("emergency_mgmt_delivery_status"),
        management["notification_timestamp"].alias("emergency_mgmt_notif_timestamp"),
        *date_parts(event_time),
    )


def event_station_pages(
    events: DataFrame, stations: DataFrame, page_size: int = 500, carry: Collection[str] = ()
) -> DataFrame:
    """The station records of every event, in pages of about ``page_size`` stations, with the event's ``carry`` columns.

    ``events`` must hold ``event_id, microarea_id, w, total_stations``. An area with few stations gives one
    page holding all of them. A larger one is spread over ``ceil(total / page_size)`` pages by station
    hash, so no task ever gathers an unbounded area and no station is left out.
    """
    keys = events.select("event_id", "microarea_id", F.col("w").alias("event_w"), "total_stations", *carry)
    record = F.struct(
        "station_id",
        F.col("is_anomaly"),
        millis(F.col("w.end")).alias("response_timestamp"),
        millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        *[F.col(name) for name in MEASUREMENTS],
        "latitude",
        "longitude",
    )
    rows = stations.select("microarea_id", F.col("w").alias("event_w"), "station_id", record.alias("station"))
    pages = F.ceil(F.col("total_stations") / F.lit(page_size))
    return (
        rows.join(keys, ["microarea_id", "event_w"])
        .withColumn("pages", pages.cast("int"))
        .withColumn("page", F.pmod(F.xxhash64("station_id"), F.col("pages")).cast("int"))
        .groupBy("event_id", "pages", "page")
        .agg(F.array_sort(F.collect_list("station")).alias("stations"), *[F.first(name).alias(name) for name in carry])
    )
