"""Thresholds, cut points, labels and texts that define the results."""

# ---------------------------------------------------------------- sensors
SENSOR_THRESHOLDS = {
    "temperature_c": 35.0,
    "humidity_percent": 80.0,
    "co2_ppm": 600.0,
    "pm25_ugm3": 12.0,
    "smoke_index": 20.0,
    "infrared_intensity": 0.2,
    "battery_voltage": 3.7,
}
MEASUREMENTS = list(SENSOR_THRESHOLDS)
# Battery state never counts as a fire measurement once stations are merged into areas.
AREA_MEASUREMENTS = [name for name in MEASUREMENTS if name != "battery_voltage"]
SENSOR_MODELS = ["temp_sens", "hum_sens", "co2_sens", "pm25_sens", "smoke_sens", "ir_sens"]

ALERT_LEVELS = [(0.2, "green"), (0.4, "yellow"), (0.6, "orange"), (0.8, "deep_orange")]
TOP_ALERT_LEVEL = "red"
AIR_QUALITY_LABELS = [
    (50.0, "Good"),
    (100.0, "Moderate"),
    (150.0, "Unhealthy for Sensitive Groups"),
    (200.0, "Unhealthy"),
    (300.0, "Very Unhealthy"),
]
TOP_AIR_QUALITY_LABEL = "Hazardous"
COMPASS = ["north", "northeast", "east", "southeast", "south", "southwest", "west", "northwest"]

NOTIFIED_AGENCIES = [("local_fire_department", "confirmed"), ("emergency_management", "confirmed")]
FIRE_UNITS = ["engine_company", "brush_unit", "water_tender"]
POPULATION_CENTER = ("Highland Park", 2500, 12500, "high")
INFRASTRUCTURE = [
    ("power_substation", "Highland Substation", 1800, "high"),
    ("water_reservoir", "Eagle Rock Reservoir", 3200, "medium"),
]
WEATHER = {
    "temperature": 35.2,
    "humidity": 18.4,
    "wind_speed": 25.1,
    "wind_direction": 285.3,
    "precipitation_chance": 0.02,
}
TERRAIN = {
    "vegetation_type": "chaparral",
    "vegetation_density": "high",
    "slope": "moderate",
    "aspect": "west-facing",
}

# ---------------------------------------------------------------- imagery
BANDS = ["b2", "b3", "b4", "b8", "b8a", "b11", "b12"]
INDICES = ["ndvi", "ndmi", "ndwi", "nbr"]
PIXEL_AREA_KM2 = 20
KM_PER_DEGREE = 111
# (index, upper bound, points): each true test also counts as one fire sign.
FIRE_TESTS = [
    ("ndvi", 0.3, 25),
    ("ndvi", 0.1, 35),
    ("ndmi", 0.1, 20),
    ("ndmi", -0.1, 40),
    ("nbr", 0.2, 15),
    ("nbr", -0.1, 25),
    ("ndwi", 0.0, 10),
]
# (signs, points, level), strongest first
FIRE_LEVELS = [(4, 80, "high"), (3, 60, "medium"), (2, 40, "low")]
QUICK_SCREEN_CONFIDENCE = 95
# (lower bound, level, priority, evacuation, description), strongest first
THREATS = [
    (0.8, "CRITICAL", "immediate_response", True, "Extreme fire danger with immediate threat to life and property"),
    (0.6, "HIGH", "urgent_response", True, "High fire danger requiring immediate attention and resource deployment"),
    (0.4, "MODERATE", "monitor_closely", False, "Moderate fire risk requiring enhanced monitoring and preparation"),
    (0.2, "LOW", "routine_monitoring", False, "Low fire risk with standard monitoring protocols"),
    (None, "MINIMAL", "standard_monitoring", False, "Minimal fire risk under normal conditions"),
]
NO_THREAT = ("NORMAL", "routine_monitoring", False, "Normal conditions with no fire indicators detected")
RISK_LEVELS = [(0.8, "extreme"), (0.6, "high"), (0.4, "moderate"), (0.2, "low")]
ADVICE_BY_SEVERITY = [
    (
        0.6,
        [
            "Deploy fire suppression resources immediately",
            "Alert emergency services and evacuation authorities",
            "Establish incident command structure",
            "Monitor weather conditions for wind changes",
        ],
    ),
    (
        0.4,
        [
            "Position fire suppression resources for rapid deployment",
            "Increase aerial surveillance frequency",
            "Alert local fire departments and emergency services",
            "Prepare evacuation routes and shelters",
        ],
    ),
    (
        0.2,
        [
            "Enhance monitoring of detected hotspots",
            "Deploy ground crews for verification",
            "Review and update evacuation plans",
        ],
    ),
]
ADVICE_LARGE_AREA = "Coordinate with multiple fire departments due to large affected area"
ADVICE_MEDIUM_AREA = "Consider mutual aid agreements with neighboring departments"
ADVICE_MOISTURE = "Implement water drop missions due to severe moisture deficit"
ADVICE_SMOKE = "Issue air quality warnings for surrounding communities"
ADVICE_NORMAL = ["Continue routine monitoring schedule", "Maintain current observation protocols"]

# ---------------------------------------------------------------- messages
SIGNAL_CATEGORIES = [
    "emergency_help_request",
    "infrastructure_or_property_damage",
    "emotional_reaction_to_wildfire",
    "official_emergency_announcement",
]
NOISE_CATEGORIES = [
    "non_emergency_daily_chatter",
    "wildfire_related_misinformation",
    "scam_or_unsolicited_promotions",
]
ALL_CATEGORIES = SIGNAL_CATEGORIES + NOISE_CATEGORIES
VOCABULARY_SIZE = 5000

# ---------------------------------------------------------------- weather forecast
FEATURES = ["u10", "v10", "t2m", "d2m", "msl", "sst", "sp", "u100", "v100", "stl1", "swvl1", "cvh"]

# ---------------------------------------------------------------- grid
MICROAREA_KM2 = 500.0
CELL_KM2 = 20.0
# (min_long, min_lat, max_long, max_lat) of the case-study region
CASE_STUDY_BBOX = (-122.145996, 38.453589, -119.959717, 39.901309)
