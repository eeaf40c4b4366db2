"""Dimension tables: enrichment, keyed upsert, lookup, key/value publication, child counts.

No join here carries a broadcast hint: dimensions grow with the network, so Catalyst (by file size)
and AQE (by shuffle size) decide, and fall back to a shuffled join when a dimension is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.constants import SENSOR_MODELS

BBOX = ["min_long", "min_lat", "max_long", "max_lat"]


def enrich_stations(windows: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join with station metadata; an unknown station gets the UNKNOWN defaults."""
    dim = stations.select(
        "station_id",
        F.lit(True).alias("_known"),
        F.col("microarea_id").alias("_area"),
        "latitude",
        "longitude",
        "elevation_m",
        F.col("model").alias("_model"),
        F.date_format("install_date", "yyyy-MM-dd").alias("deployment_date"),
        F.col("battery_type").alias("_battery"),
        *SENSOR_MODELS,
    )
    known = F.col("_known").isNotNull()
    return (
        windows.join(dim, "station_id", "left")
        .withColumn("microarea_id", F.coalesce("_area", F.lit("UNKNOWN")))
        .withColumn("station_model", F.coalesce("_model", F.lit("UNKNOWN")))
        .withColumn("maintenance_status", F.when(known, "operational").otherwise("unknown"))
        .withColumn("battery_type", F.coalesce("_battery", F.lit("UNKNOWN")))
        .drop("_known", "_area", "_model", "_battery")
    )


def enrich_microareas(df: DataFrame, microareas: DataFrame, key: str = "microarea_id") -> DataFrame:
    """Left join with the area rectangle; an unknown area gives four NULLs."""
    dim = microareas.select(F.col("microarea_id").alias(key), *BBOX)
    return df.join(dim, key, "left")


def qualified_area(macroarea: Column, microarea: Column) -> Column:
    """Messages name areas ``M10`` inside ``A1``; the dimension key is ``A1-M10``."""
    return F.concat_ws("-", macroarea, microarea)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last write wins per key: the newest change replaces every column of an existing row.

    ``order`` is a column of ``changes`` (load sequence); rows of ``current`` come before all changes.
    One aggregate with map-side combine, so a key written many times in one load is no hot spot.
    """
    old = current.withColumn("_order", F.lit(None).cast("bigint"))
    new = changes.select(*current.columns, F.col(order).cast("bigint").alias("_order"))
    return newest_write(old.unionByName(new), keys, "_order").drop("_order")


def newest_write(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of each key with the greatest ``order``; one without (NULL sorts first) loses to any other.

    Rows of equal order are told apart by their values, so the result does not depend on partitions.
    """
    values = [name for name in rows.columns if name not in keys and name != order]
    latest = rows.select(*keys, F.struct(F.col(order), *values).alias("_row")).groupBy(*keys).agg(F.max("_row").alias("_row"))
    return latest.select(*[F.col(name) if name in keys else F.col(f"_row.{name}").alias(name) for name in rows.columns])


def point_lookup(dim: DataFrame, key: str, value: object) -> DataFrame:
    """Rows of one key; an equality filter that reaches the Parquet scan."""
    return dim.filter(F.col(key) == F.lit(value))


def station_key_values(stations: DataFrame) -> DataFrame:
    """``station:<id>`` -> JSON of the station's metadata, nulls included."""
    value = F.to_json(
        F.struct(
            "microarea_id",
            "latitude",
            "longitude",
            F.date_format("install_date", "yyyy-MM-dd").alias("install_date"),
            "model",
            *SENSOR_MODELS,
            "elevation_m",
            "battery_type",
        ),
        {"ignoreNullFields": "false"},
    )
    return stations.select(F.concat(F.lit("station:"), F.col("station_id")).alias("key"), value.alias("value"))


def microarea_key_values(microareas: DataFrame) -> DataFrame:
    """``microarea:<id>`` -> JSON of the area's rectangle."""
    value = F.to_json(F.struct(*BBOX), {"ignoreNullFields": "false"})
    return microareas.select(F.concat(F.lit("microarea:"), F.col("microarea_id")).alias("key"), value.alias("value"))


def children_per_parent(children: DataFrame, parent_key: str, name: str = "n_children") -> DataFrame:
    return children.groupBy(parent_key).agg(F.count(F.lit(1)).alias(name))
