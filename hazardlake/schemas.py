"""Fixed schemas of the inputs, dimensions and tables, as column -> type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardlake.constants import MEASUREMENTS, SENSOR_MODELS


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def _nested(names: list[str]) -> str:
    return "struct<" + ", ".join(f"{name}: double" for name in names) + ">"


_BBOX = {"min_long": "double", "min_lat": "double", "max_long": "double", "max_lat": "double"}
_PIXEL = (
    "struct<latitude: double, longitude: double, microarea_id: string, bands: "
    + _nested(["B2", "B3", "B4", "B8", "B8A", "B11", "B12"])
    + ">"
)

SENSOR_MESSAGE = {"station_id": "string", "timestamp": "string", "measurements": _nested(MEASUREMENTS)}
IMAGE_MESSAGE = {
    "image_pointer": "string",
    "metadata": "struct<timestamp: string, microarea_id: string, macroarea_id: string,"
    f" satellite_data: array<{_PIXEL}>>",
}
SOCIAL_MESSAGE = {
    "unique_msg_id": "string",
    "macroarea_id": "string",
    "microarea_id": "string",
    "text": "string",
    "latitude": "double",
    "longitude": "double",
    "timestamp": "string",
}

MACROAREAS = {"macroarea_id": "string", **_BBOX, "numof_microareas": "int"}
MICROAREAS = {"microarea_id": "string", "macroarea_id": "string", **_BBOX}
STATIONS = {
    "station_id": "string",
    "microarea_id": "string",
    "latitude": "double",
    "longitude": "double",
    "install_date": "date",
    "model": "string",
    **{name: "string" for name in SENSOR_MODELS},
    "elevation_m": "double",
    "battery_type": "string",
    "status": "string",
}
STATION_COUNTS = {"microarea_id": "string", "macroarea_id": "string", "numof_sens_stations": "int"}
METEO_HIST = {
    "date": "date",
    "cell_id": "string",
    "latitude": "double",
    "longitude": "double",
    "number": "double",
    "surface": "double",
    "u10": "double",
    "v10": "double",
    "d2m": "double",
    "t2m": "double",
    "msl": "double",
    "meanSea": "double",
    "sst": "double",
    "sp": "double",
    "u100": "double",
    "v100": "double",
    "depthBelowLandLayer": "double",
    "stl1": "double",
    "swvl1": "double",
    "cvh": "double",
    "cell_lat": "double",
    "cell_lon": "double",
    "frp_max": "double",
    "fire_class": "int",
}

TABLES = {
    "macroareas": MACROAREAS,
    "microareas": MICROAREAS,
    "stations": STATIONS,
    "n_sens_stations": STATION_COUNTS,
    "meteo_hist": METEO_HIST,
}


def create_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Create the catalogue's missing tables as Parquet; existing ones stay untouched."""
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl(columns)}) USING parquet")
    return list(TABLES)


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], ddl(TABLES[name]))
