"""Typed CSV, GeoJSON and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.operators.grid import GEOJSON_POLYGON
from hazardlake.schemas import METEO_HIST, ddl


def read_csv(spark: SparkSession, path: str, schema: dict[str, str] = METEO_HIST) -> DataFrame:
    """CSV with a header line into the given types; a value of the wrong type fails the read."""
    return spark.read.csv(path, schema=ddl(schema), header=True, mode="FAILFAST")


def read_forecast(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Forecast CSV whose ``time`` text becomes a timestamp; a value of the wrong type, or an unreadable time, fails
    the read. ``columns`` is the DDL of the other columns."""
    rows = spark.read.csv(path, schema=f"time string, {columns}", header=True, mode="FAILFAST")
    read = F.try_to_timestamp("time")
    bad = F.col("time").isNotNull() & read.isNull()
    return rows.withColumn("time", F.when(bad, F.raise_error(F.concat(F.lit("unreadable time: "), "time"))).otherwise(read))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stored table."""
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, name: str, partition_column: str, lower: int, upper: int, partitions: int
) -> DataFrame:
    """Database table read by ``partitions`` tasks over ranges of a numeric column."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", name)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )


def append_jdbc(df: DataFrame, url: str, name: str, batch_size: int = 10000) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", name).option("batchsize", batch_size).mode(
        "append"
    ).save()


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row per polygon file with its geometry struct."""
    return spark.read.schema(GEOJSON_POLYGON).json(path, multiLine=True).select(
        F.struct("type", "coordinates").alias("geometry")
    )


def write_geojson(polygons: DataFrame, geometry: str, path: str) -> None:
    polygons.select(F.to_json(geometry).alias("value")).write.mode("errorifexists").text(path)
