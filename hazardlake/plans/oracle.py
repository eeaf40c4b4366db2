"""DuckDB SQL fragments for the views and rules the registered queries share."""

from __future__ import annotations

from hazardlake.constants import AREA_MEASUREMENTS, BANDS, CASE_STUDY_BBOX, INDICES, MEASUREMENTS, SENSOR_THRESHOLDS


def snap(x: str) -> str:
    return f"(round_even(({x})*1e8, 0)/1e8)"


def rnd(x: str, digits: int) -> str:
    return f"(round_even(round_even(({x})*1e8, 0)/1e{8 - digits}, 0)/1e{digits})"


def div0(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a})::DOUBLE/({b}) ELSE 0.0::DOUBLE END)"


def with_views(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


MILLIS = "(epoch_us({0}) // 1000)"


def ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g')"


def iso_ms(ms_expr: str) -> str:
    return f"strftime(make_timestamp(({ms_expr}) * 1000), '%Y-%m-%dT%H:%M:%S.%g')"


# ------------------------------------------------------------------ sensors
V_SENSOR = """v_sensor AS (
  SELECT event_id AS reading_id,
         'S_A1-M' || (user_id % 9 + 1) || '_' || printf('%06d', user_id) AS station_id,
         ts,
         value * 0.25::DOUBLE + 15.0::DOUBLE AS temperature_c,
         85.0::DOUBLE - k * 0.75::DOUBLE AS humidity_percent,
         value * 2.5::DOUBLE + 380.0::DOUBLE AS co2_ppm,
         value * 0.1::DOUBLE + 2.0::DOUBLE AS pm25_ugm3,
         CASE WHEN event_type <> 'signup' THEN k * 0.21::DOUBLE END AS smoke_index,
         CASE WHEN event_type <> 'error' THEN value / 500.0::DOUBLE END AS infrared_intensity,
         k * 0.003::DOUBLE + 3.4::DOUBLE AS battery_voltage
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

EXCEEDS = "(" + " OR ".join(f"coalesce({f} > {t}, false)" for f, t in SENSOR_THRESHOLDS.items()) + ")"

V_STATION = """v_station AS (
  SELECT DISTINCT 'S_A1-M' || (user_id % 9 + 1) || '_' || printf('%06d', user_id) AS station_id,
         'A1-M' || (user_id % 9 + 1) AS microarea_id,
         38.66::DOUBLE + (user_id % 25) * 0.008::DOUBLE AS latitude,
         -122.14::DOUBLE + (user_id % 23) * 0.009::DOUBLE AS longitude,
         CAST(DATE '2020-01-01' + CAST(user_id % 365 AS INTEGER) AS DATE) AS install_date,
         ['FX-1','FX-2','GS-7','GS-9','TR-3'][CAST(user_id % 5 + 1 AS INTEGER)] AS model,
         'temp_sens-v' || (user_id % 3) AS temp_sens, 'hum_sens-v' || (user_id % 3) AS hum_sens,
         'co2_sens-v' || (user_id % 3) AS co2_sens, 'pm25_sens-v' || (user_id % 3) AS pm25_sens,
         'smoke_sens-v' || (user_id % 3) AS smoke_sens, 'ir_sens-v' || (user_id % 3) AS ir_sens,
         50.0::DOUBLE + user_id % 750 AS elevation_m,
         CASE WHEN user_id % 2 = 0 THEN 'lithium' ELSE 'solar' END AS battery_type
  FROM events WHERE user_id % 10 <> 0
)"""

STATION_WINDOWS = f"""station_windows AS (
  SELECT station_id, time_bucket(INTERVAL 6 HOUR, ts) AS w_start,
         time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS w_end,
         count(*) AS n_readings, bool_or({EXCEEDS}) AS is_anomaly, max(ts) AS latest_event_ts,
         {", ".join(f"{rnd(f'avg({f}) FILTER (WHERE {EXCEEDS})', 2)} AS {f}" for f in MEASUREMENTS)}
  FROM v_sensor GROUP BY ALL
)"""

ENRICHED = """enriched AS (
  SELECT w.*, coalesce(s.microarea_id, 'UNKNOWN') AS microarea_id, s.latitude, s.longitude, s.elevation_m,
         coalesce(s.model, 'UNKNOWN') AS station_model, strftime(s.install_date, '%Y-%m-%d') AS deployment_date,
         CASE WHEN s.station_id IS NULL THEN 'unknown' ELSE 'operational' END AS maintenance_status,
         coalesce(s.battery_type, 'UNKNOWN') AS battery_type,
         s.temp_sens, s.hum_sens, s.co2_sens, s.pm25_sens, s.smoke_sens, s.ir_sens
  FROM station_windows w LEFT JOIN v_station s ON w.station_id = s.station_id
)"""

AREA_WINDOWS = f"""area_windows AS (
  SELECT microarea_id, w_start, w_end, count(*) AS total_stations,
         count(*) FILTER (WHERE is_anomaly) AS anomalous_stations, max(latest_event_ts) AS latest_event_ts,
         {", ".join(f"{snap(f'avg({f}) FILTER (WHERE is_anomaly)')} AS avg_{f}" for f in AREA_MEASUREMENTS)},
         {", ".join(f"{'min' if f == 'humidity_percent' else 'max'}({f}) AS ext_{f}" for f in AREA_MEASUREMENTS)}
  FROM enriched GROUP BY microarea_id, w_start, w_end
)"""

_AQI = rnd(
    "50.0::DOUBLE + (least(avg_pm25_ugm3/35.0::DOUBLE, 3.0::DOUBLE)*0.7::DOUBLE"
    " + least(greatest((avg_co2_ppm-400.0::DOUBLE)/600.0::DOUBLE, 0.0::DOUBLE), 3.0::DOUBLE)*0.3::DOUBLE)*150.0::DOUBLE",
    1,
)


def _criticality() -> str:
    terms = []
    for f in AREA_MEASUREMENTS:
        weight = {"humidity_percent": 1.5, "temperature_c": 1.3}.get(f, 1.0)
        close = f"(CASE WHEN ext_{f} > 0 THEN mean_{f}/ext_{f} ELSE {1.0 if f == 'humidity_percent' else 0.0} END)"
        share = f"(1.0::DOUBLE - {close})" if f == "humidity_percent" else close
        terms.append(
            f"(CASE WHEN mean_{f} IS NOT NULL AND ext_{f} IS NOT NULL AND n_fields > 0"
            f" THEN {share} * ({weight}::DOUBLE/n_fields) ELSE 0.0::DOUBLE END)"
        )
    return "(" + " + ".join(terms) + ")"


def _severity(use_extremes: bool) -> str:
    pressure = (
        "(CASE WHEN r >= 0.05 THEN greatest(1.0::DOUBLE - exp(r * -5.0::DOUBLE), 0.4::DOUBLE*(r/0.05::DOUBLE))"
        " ELSE 1.0::DOUBLE - exp(r * -5.0::DOUBLE) END)"
    )
    base = f"({pressure}*0.4::DOUBLE + {_criticality() if use_extremes else '0.0::DOUBLE'}*0.6::DOUBLE)"
    ext = {f: (f"coalesce(ext_{f}, {d})" if use_extremes else f"{d}") for f, d in
           (("temperature_c", "100.0::DOUBLE"), ("humidity_percent", "0.0::DOUBLE"), ("smoke_index", "100.0::DOUBLE"))}
    c = (
        f"((coalesce(mean_temperature_c, 0) > {ext['temperature_c']}*0.7::DOUBLE)::INT"
        f" + (coalesce(mean_humidity_percent, 100) < {ext['humidity_percent']}*0.3::DOUBLE)::INT"
        f" + (coalesce(mean_smoke_index, 0) > {ext['smoke_index']}*0.5::DOUBLE)::INT)"
    )
    boosted = f"least({base}*(({c}*0.15::DOUBLE)*greatest(0.3::DOUBLE, 1.0::DOUBLE - r/0.6::DOUBLE) + 1.0::DOUBLE), 1.0::DOUBLE)"
    score = f"(CASE WHEN {c} >= 2 AND r > 0 THEN {boosted} ELSE {base} END)"
    return f"least({rnd(score, 2)}, 1.0::DOUBLE)"


def scored(use_extremes: bool = False) -> str:
    severity = _severity(use_extremes)
    return f"""prepared AS (
  SELECT *, {" + ".join(f"(avg_{f} IS NOT NULL)::INT" for f in AREA_MEASUREMENTS)} AS n_fields,
         anomalous_stations::DOUBLE/total_stations AS r, anomalous_stations > 0 AS is_fire, {ms("w_end")} AS response_ms,
         {", ".join(f"{rnd(f'avg_{f}', 2)} AS mean_{f}" for f in AREA_MEASUREMENTS)},
         CASE WHEN avg_pm25_ugm3 IS NOT NULL AND avg_co2_ppm IS NOT NULL THEN least({_AQI}, 500.0::DOUBLE) END AS aqi,
         (avg_temperature_c/30.0::DOUBLE)*(30.0::DOUBLE/CASE WHEN avg_humidity_percent > 1 THEN avg_humidity_percent
             WHEN avg_humidity_percent IS NOT NULL THEN 1.0::DOUBLE END) AS spread_factor
  FROM area_windows
), severity AS (
  SELECT *, CASE WHEN is_fire THEN {severity} ELSE 0.0::DOUBLE END AS severity_score FROM prepared
), scored AS (
  SELECT *, CASE WHEN is_fire THEN least(r*0.2::DOUBLE + 0.7::DOUBLE + severity_score*0.1::DOUBLE, 0.99::DOUBLE)
              ELSE 0.0::DOUBLE END AS detection_confidence,
         CASE WHEN NOT is_fire THEN NULL WHEN severity_score <= 0.2 THEN 'green' WHEN severity_score <= 0.4 THEN 'yellow'
              WHEN severity_score <= 0.6 THEN 'orange' WHEN severity_score <= 0.8 THEN 'deep_orange' ELSE 'red' END AS alert_level,
         CASE WHEN aqi IS NULL THEN 'Unknown' WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
              WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy'
              WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS air_quality_status,
         {iso_ms("response_ms - CAST(floor((severity_score*20.0::DOUBLE + 10.0::DOUBLE)*60.0::DOUBLE*1000.0::DOUBLE) AS BIGINT)")} AS ignition_time,
         CASE WHEN spread_factor IS NULL THEN NULL WHEN spread_factor > 5 THEN 'extreme' WHEN spread_factor > 3 THEN 'rapid'
              WHEN spread_factor > 1.5 THEN 'moderate' ELSE 'slow' END AS spread_rate,
         {rnd("CASE WHEN spread_factor > 5 THEN (spread_factor-5.0::DOUBLE)*2.0::DOUBLE+10.0::DOUBLE"
              " WHEN spread_factor > 3 THEN (spread_factor-3.0::DOUBLE)*2.5::DOUBLE+5.0::DOUBLE"
              " WHEN spread_factor > 1.5 THEN (spread_factor-1.5::DOUBLE)*2.0::DOUBLE+2.0::DOUBLE"
              " ELSE spread_factor+0.5::DOUBLE END", 1)} AS spread_speed_mph,
         microarea_id || '_' || response_ms || '_' || substr(sha256(microarea_id || response_ms), 1, 8) AS event_id
  FROM severity
)"""


IOT_TO_STATIONS = [V_SENSOR, STATION_WINDOWS]
IOT_TO_ENRICHED = [V_SENSOR, V_STATION, STATION_WINDOWS, ENRICHED]
IOT_TO_AREAS = [*IOT_TO_ENRICHED, AREA_WINDOWS]
IOT_TO_SCORED = [*IOT_TO_AREAS, scored()]

# ------------------------------------------------------------------ grid
_W, _S, _E, _N = (f"({v}::DOUBLE)" for v in CASE_STUDY_BBOX)
V_GRID = f"""v_grid AS (
  SELECT 'A1-M' || (i*9 + j + 1) AS microarea_id, i*9 + j + 1 AS cell_no,
         {_W} + j*(({_E}-{_W})/9) AS min_long, {_S} + i*(({_N}-{_S})/7) AS min_lat,
         {_W} + j*(({_E}-{_W})/9) + ({_E}-{_W})/9 AS max_long, {_S} + i*(({_N}-{_S})/7) + ({_N}-{_S})/7 AS max_lat
  FROM range(7) a(i), range(9) b(j)
)"""
V_MICROAREA = "v_microarea AS (SELECT * FROM v_grid WHERE microarea_id <> 'A1-M9')"

# ------------------------------------------------------------------ imagery
V_PIXEL = """v_pixel AS (
  SELECT image_id, 'satellite/A1-M' || (image_id % 9 + 1) || '/img_' || image_id || '.jpg' AS image_pointer,
         strftime(make_timestamp((1704067200 + image_id*60)*1000000), '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp",
         'A1-M' || (image_id % 9 + 1) AS microarea_id, 'A1' AS macroarea_id,
         38.66::DOUBLE + (l_partkey % 25)*0.008::DOUBLE AS latitude,
         -122.14::DOUBLE + (l_suppkey % 25)*0.009::DOUBLE AS longitude,
         0.05::DOUBLE + (l_linenumber % 4)*0.05::DOUBLE AS b2,
         CASE WHEN f THEN 0.05::DOUBLE + l_quantity/1000.0::DOUBLE ELSE 0.1::DOUBLE + l_quantity/250.0::DOUBLE END AS b3,
         CASE WHEN f THEN 0.3::DOUBLE + l_tax ELSE 0.05::DOUBLE + l_tax*1.875::DOUBLE END AS b4,
         CASE WHEN f THEN 0.1::DOUBLE + l_discount ELSE 0.3::DOUBLE + l_discount*2.0::DOUBLE END AS b8,
         0.05::DOUBLE + (l_partkey % 5)*0.05::DOUBLE AS b8a,
         CASE WHEN f THEN 0.2::DOUBLE + (l_suppkey % 100)/1000.0::DOUBLE ELSE 0.05::DOUBLE + (l_suppkey % 100)/500.0::DOUBLE END AS b11,
         CASE WHEN f THEN 0.2::DOUBLE + (l_orderkey % 100)/1000.0::DOUBLE ELSE 0.05::DOUBLE + (l_orderkey % 100)/500.0::DOUBLE END AS b12
  FROM (SELECT *, l_orderkey // 8 AS image_id, l_partkey % 11 = 0 AS f FROM lineitem)
)"""

V_ORDER_PIXEL = """v_pixel AS (
  SELECT o_orderkey AS image_id, 'satellite/A1-M' || (o_orderkey % 9 + 1) || '/order_' || o_orderkey || '.jpg' AS image_pointer,
         strftime(make_timestamp((1704067200 + o_orderkey*60)*1000000), '%Y-%m-%dT%H:%M:%S.%g') AS "timestamp",
         'A1-M' || (o_orderkey % 9 + 1) AS microarea_id, 'A1' AS macroarea_id,
         38.66::DOUBLE + (i % 5)*0.04::DOUBLE AS latitude, -122.14::DOUBLE + (i // 5)*0.05::DOUBLE AS longitude,
         0.05::DOUBLE + (s % 4)*0.05::DOUBLE AS b2,
         CASE WHEN s % 11 = 0 THEN 0.05::DOUBLE + s/2000.0::DOUBLE ELSE 0.1::DOUBLE + s/500.0::DOUBLE END AS b3,
         CASE WHEN s % 11 = 0 THEN 0.3::DOUBLE + s/1000.0::DOUBLE ELSE 0.05::DOUBLE + s/650.0::DOUBLE END AS b4,
         CASE WHEN s % 11 = 0 THEN 0.1::DOUBLE + s/1000.0::DOUBLE ELSE 0.3::DOUBLE + s/500.0::DOUBLE END AS b8,
         0.05::DOUBLE + (s % 5)*0.05::DOUBLE AS b8a,
         CASE WHEN s % 11 = 0 THEN 0.2::DOUBLE + s/1000.0::DOUBLE ELSE 0.05::DOUBLE + s/650.0::DOUBLE END AS b11,
         CASE WHEN s % 11 = 0 THEN 0.2::DOUBLE + s/970.0::DOUBLE ELSE 0.05::DOUBLE + s/600.0::DOUBLE END AS b12
  FROM (SELECT o_orderkey, i, (o_custkey*7 + i*31 + o_orderkey) % 97 AS s FROM orders, range(25) t(i))
)"""


def _nd(a: str, b: str) -> str:
    return rnd(div0(f"{a}-{b}", f"{a}+{b}"), 4)


QUICK = "((b8 > 0.3)::INT + (b11 < 0.2 AND b12 < 0.2)::INT + (CASE WHEN b4 > 0 THEN b8/b4 > 2.0 ELSE false END)::INT) >= 2"
INDEXED = f"""indexed AS (
  SELECT *, CASE WHEN NOT quick_ok THEN {_nd("b8", "b4")} END AS ndvi, CASE WHEN NOT quick_ok THEN {_nd("b8", "b11")} END AS ndmi,
         CASE WHEN NOT quick_ok THEN {_nd("b3", "b8")} END AS ndwi, CASE WHEN NOT quick_ok THEN {_nd("b8", "b12")} END AS nbr
  FROM (SELECT *, {QUICK} AS quick_ok FROM v_pixel)
)"""
_TESTS = [("ndvi", 0.3, 25), ("ndvi", 0.1, 35), ("ndmi", 0.1, 20), ("ndmi", -0.1, 40), ("nbr", 0.2, 15), ("nbr", -0.1, 25),
          ("ndwi", 0.0, 10)]
CLASSIFIED = f"""signed AS (
  SELECT *, {" + ".join(f"coalesce(({i} < {t})::INT, 0)" for i, t, _ in _TESTS)} AS k,
         {" + ".join(f"(CASE WHEN {i} < {t} THEN {p} ELSE 0 END)" for i, t, p in _TESTS)} AS s
  FROM indexed
), classified AS (
  SELECT * EXCLUDE (lvl), CASE WHEN quick_ok THEN 'OK' ELSE '' END AS classification_status,
         CASE WHEN lvl = 'normal' THEN 'vegetation' ELSE 'fire' END AS scene_class, lvl AS classification_level,
         CASE WHEN quick_ok THEN 95 ELSE s END AS classification_confidence,
         CASE WHEN quick_ok THEN 'quick_screen' ELSE 'full_analysis' END AS processing_type
  FROM (SELECT *, CASE WHEN quick_ok THEN 'normal' WHEN k >= 4 AND s >= 80 THEN 'high' WHEN k >= 3 AND s >= 60 THEN 'medium'
               WHEN k >= 2 AND s >= 40 THEN 'low' ELSE 'normal' END AS lvl FROM signed)
)"""

_A = "FILTER (WHERE NOT quick_ok)"
SCENES = f"""scenes AS (
  SELECT image_pointer, "timestamp", microarea_id, macroarea_id, count(*) AS total_pixels, count(*) {_A} AS anomalous_pixels,
         {snap("avg(classification_confidence)")} AS mean_confidence,
         count(*) FILTER (WHERE NOT quick_ok AND (b11 > 0.2 OR b12 > 0.2)) AS high_temperature_signatures,
         count(*) FILTER (WHERE NOT quick_ok AND ndvi < -0.3) AS vegetation_stress_detected,
         count(*) FILTER (WHERE NOT quick_ok AND ndmi < -0.15) AS moisture_deficit_areas,
         count(*) FILTER (WHERE NOT quick_ok AND nbr < -0.2) AS burn_scar_indicators,
         count(*) FILTER (WHERE NOT quick_ok AND b4 > 0.3 AND b2 > 0.1) AS smoke_signatures,
         {", ".join(f"{snap(f'avg({b}) {_A}')} AS anom_{b}, {snap(f'avg({b})')} AS all_{b}" for b in BANDS)},
         {", ".join(f"{snap(f'avg({i}) {_A}')} AS mean_{i}" for i in INDICES)},
         count(*) FILTER (WHERE ndvi > 0.2) AS healthy_pixels, count(*) FILTER (WHERE ndmi < -0.1) AS dry_pixels,
         min(latitude) {_A} AS min_latitude, max(latitude) {_A} AS max_latitude,
         min(longitude) {_A} AS min_longitude, max(longitude) {_A} AS max_longitude
  FROM classified GROUP BY image_pointer, "timestamp", microarea_id, macroarea_id
)"""

_STRESS = """CASE WHEN p >= 5 THEN 'critical' WHEN p >= 4 THEN 'high' WHEN p >= 2 THEN 'moderate' ELSE 'low' END"""
_CRIT = (
    "((anomalous_b4/0.5::DOUBLE + anomalous_b11/0.4::DOUBLE + anomalous_b12/0.4::DOUBLE + abs(anomalous_ndvi)"
    " + abs(anomalous_ndmi) + abs(anomalous_ndwi) + abs(anomalous_nbr))/7.0::DOUBLE)"
)
_PRESSURE = (
    "(CASE WHEN r >= 0.05 THEN greatest(1.0::DOUBLE - exp(r * -8.0::DOUBLE), 0.25::DOUBLE*(r/0.05::DOUBLE))"
    " ELSE 1.0::DOUBLE - exp(r * -8.0::DOUBLE) END)"
)
_BASE = f"({_PRESSURE}*0.55::DOUBLE + {_CRIT}*0.45::DOUBLE)"
_SIGNS = (
    "((high_temperature_signatures/total_pixels > 0.1)::INT + (moisture_deficit_areas/total_pixels > 0.2)::INT"
    " + (vegetation_stress_detected/total_pixels > 0.15)::INT + (smoke_signatures/total_pixels > 0.05)::INT)"
)
_BOOST = f"least(({_SIGNS}*0.1::DOUBLE)*greatest(0.3::DOUBLE, 1.0::DOUBLE - r/0.8::DOUBLE), 0.2::DOUBLE)"
ASSESSED = f"""summary AS (
  SELECT *, anomalous_pixels = 0 AS is_normal, anomalous_pixels::DOUBLE/total_pixels AS r,
         {rnd("anomalous_pixels::DOUBLE/total_pixels*100.0::DOUBLE", 2)} AS anomaly_percentage,
         anomalous_pixels*20 AS affected_area_km2, {rnd("mean_confidence", 1)} AS confidence_level,
         {", ".join(f"coalesce({rnd(f'anom_{b}', 3)}, 0.0::DOUBLE) AS anomalous_{b}" for b in BANDS)},
         {", ".join(f"coalesce({rnd(f'mean_{i}', 3)}, 0.0::DOUBLE) AS anomalous_{i}" for i in INDICES)},
         {", ".join(f"coalesce({rnd(f'all_{b}', 3)}, 0.0::DOUBLE) AS scene_{b}" for b in BANDS)},
         CASE WHEN anomalous_pixels = 0 THEN 0.0::DOUBLE WHEN anomalous_pixels = 1 THEN 20.0::DOUBLE
              ELSE {snap("(max_latitude-min_latitude)*(max_longitude-min_longitude)*12321.0::DOUBLE")} END AS spread_km2,
         CASE WHEN anomalous_pixels = 0 THEN 'unknown' WHEN mean_ndvi > 0.3 THEN 'healthy' WHEN mean_ndvi > 0.1 THEN 'moderate'
              ELSE 'stressed' END AS vegetation_status,
         CASE WHEN anomalous_pixels = 0 THEN 'unknown' WHEN mean_ndmi < -0.2 THEN 'very_dry' WHEN mean_ndmi < 0 THEN 'dry'
              WHEN mean_ndmi < 0.2 THEN 'moderate' ELSE 'moist' END AS moisture_status,
         high_temperature_signatures/total_pixels*100.0::DOUBLE AS hot,
         moisture_deficit_areas/total_pixels*100.0::DOUBLE AS moist, smoke_signatures/total_pixels*100.0::DOUBLE AS smoke
  FROM scenes
), environment AS (
  SELECT *, {rnd(div0("anomalous_pixels", "spread_km2"), 4)} AS cluster_density, {rnd("spread_km2", 2)} AS geographic_spread_km2,
         anomaly_percentage AS hotspot_concentration_percent, anomalous_ndvi AS average_ndvi,
         {rnd(div0("healthy_pixels", "anomalous_pixels") + "*100.0::DOUBLE", 1)} AS healthy_vegetation_percent,
         anomalous_ndmi AS average_ndmi, anomalous_ndwi AS average_ndwi,
         {rnd(div0("dry_pixels", "anomalous_pixels") + "*100.0::DOUBLE", 1)} AS dry_pixel_percent,
         CASE WHEN is_normal THEN 'unknown' WHEN hot > 20 AND moist > 30 THEN 'extreme' WHEN hot > 10 OR moist > 20 THEN 'high'
              WHEN hot > 5 OR moist > 10 THEN 'moderate' ELSE 'low' END AS fire_weather_level,
         {rnd("hot", 1)} AS temperature_signature_percent, {rnd("moist", 1)} AS moisture_deficit_percent,
         {rnd("smoke", 1)} AS smoke_detection_percent,
         CASE WHEN is_normal THEN 'unknown' ELSE {_STRESS} END AS environmental_stress_level
  FROM (SELECT *, (CASE vegetation_status WHEN 'stressed' THEN 3 WHEN 'moderate' THEN 2 WHEN 'healthy' THEN 1 ELSE 0 END)
               + (CASE moisture_status WHEN 'very_dry' THEN 3 WHEN 'dry' THEN 2 WHEN 'moderate' THEN 1 ELSE 0 END) AS p
        FROM summary)
), boosted AS (
  SELECT *, CASE WHEN {_SIGNS} >= 2 AND r > 0 THEN least({_BASE}*({_BOOST} + 1.0::DOUBLE), 1.0::DOUBLE) ELSE {_BASE} END AS raw
  FROM environment
), assessed AS (
  SELECT *, CASE WHEN is_normal THEN 'none' WHEN severity_score >= 0.8 THEN 'extreme' WHEN severity_score >= 0.6 THEN 'high'
              WHEN severity_score >= 0.4 THEN 'moderate' WHEN severity_score >= 0.2 THEN 'low' ELSE 'minimal' END AS risk_level
  FROM (SELECT *, CASE WHEN is_normal THEN 0.0::DOUBLE ELSE least({rnd(
      "CASE WHEN environmental_stress_level = 'critical' AND r >= 0.1 THEN least(raw*1.1::DOUBLE, 1.0::DOUBLE)"
      " WHEN environmental_stress_level = 'high' AND r >= 0.1 THEN least(raw*1.05::DOUBLE, 1.0::DOUBLE) ELSE raw END", 2)}, 1.0::DOUBLE)
      END AS severity_score FROM boosted)
)"""

SAT_TO_CLASSIFIED = [V_PIXEL, INDEXED, CLASSIFIED]
SAT_TO_SCENES = [*SAT_TO_CLASSIFIED, SCENES]
SAT_TO_ASSESSED = [*SAT_TO_SCENES, ASSESSED]
