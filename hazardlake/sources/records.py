"""JSON records from files or topics: parse once, route what cannot be read to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.functions.timefmt import iso_millis, parse_iso
from hazardlake.schemas import IMAGE_MESSAGE, SENSOR_MESSAGE, SOCIAL_MESSAGE, ddl

CORRUPT = "_corrupt"


# ------------------------------------------------------------------ raw text
def kafka_text(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", fail_on_data_loss: bool = True
) -> DataFrame:
    """Stream of ``value`` texts from a topic (needs the Kafka connector on the classpath).

    Lost offsets stop the stream unless ``fail_on_data_loss`` is switched off.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
        .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("ingest_ts"))
    )


def file_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of ``value`` lines from a folder of JSON-line files."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.current_timestamp().alias("ingest_ts"))


# ------------------------------------------------------------------ parsing
def parse(
    raw: DataFrame, schema: dict[str, str], required: list[str], time_field: str | None, arrival_time: bool = False
) -> DataFrame:
    """Raw ``value`` texts to ``record, ts, problem`` columns next to the raw ones.

    ``problem`` is NULL for a usable record, else ``malformed``, ``missing <field>`` or ``bad time``. With
    ``arrival_time`` a missing or unreadable time becomes the time of arrival (``ingest_ts``, else the clock).
    """
    record = F.from_json("value", ddl({**schema, CORRUPT: "string"}), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = raw.withColumn("record", record)
    ts = parse_iso(F.col(f"record.{time_field}")) if time_field else F.lit(None).cast("timestamp")
    if arrival_time:
        ts = F.coalesce(ts, F.col("ingest_ts") if "ingest_ts" in raw.columns else F.current_timestamp())
    parsed = parsed.withColumn("ts", ts)
    problem = F.when(F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull(), F.lit("malformed"))
    for name in required:
        problem = problem.when(F.col(f"record.{name}").isNull(), F.lit(f"missing {name}"))
    if time_field:
        problem = problem.when(F.col("ts").isNull(), F.lit("bad time"))
    return parsed.withColumn("problem", problem)


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("problem").isNull())


def quarantined(parsed: DataFrame) -> DataFrame:
    """Raw text and reason of every record that cannot be used; nothing is dropped."""
    return parsed.filter(F.col("problem").isNotNull()).select("value", "problem")


def sensor_records(raw: DataFrame) -> DataFrame:
    return parse(raw, SENSOR_MESSAGE, ["station_id", "timestamp"], "timestamp")


def sensor_readings(parsed: DataFrame) -> DataFrame:
    """Flat readings; a missing measurement block leaves every field NULL."""
    return usable(parsed).select(F.col("record.station_id").alias("station_id"), "ts", "record.measurements.*")


def image_records(raw: DataFrame) -> DataFrame:
    parsed = parse(raw, IMAGE_MESSAGE, ["metadata.satellite_data"], "metadata.timestamp", arrival_time=True)
    empty = F.size("record.metadata.satellite_data") == 0
    return parsed.withColumn(
        "problem", F.when(F.col("problem").isNull() & empty, F.lit("no pixels")).otherwise(F.col("problem"))
    )


def images(parsed: DataFrame) -> DataFrame:
    """``image_pointer, timestamp, microarea_id, macroarea_id, pixels`` with flat pixel structs."""

    def pixel(row: Column) -> Column:
        bands = row["bands"]
        return F.struct(
            row["latitude"].alias("latitude"),
            row["longitude"].alias("longitude"),
            *[bands[name].alias(name.lower()) for name in ("B2", "B3", "B4", "B8", "B8A", "B11", "B12")],
        )

    meta = F.col("record.metadata")
    return usable(parsed).select(
        F.col("record.image_pointer").alias("image_pointer"),
        F.when(parse_iso(meta["timestamp"]).isNull(), iso_millis(F.col("ts"))).otherwise(meta["timestamp"]).alias("timestamp"),
        meta["microarea_id"].alias("microarea_id"),
        meta["macroarea_id"].alias("macroarea_id"),
        F.transform(meta["satellite_data"], pixel).alias("pixels"),
    )


def social_records(raw: DataFrame) -> DataFrame:
    """A missing text is no parsing problem: such a message goes on to the error rows of the message flow."""
    return parse(raw, SOCIAL_MESSAGE, ["unique_msg_id"], "timestamp", arrival_time=True)


def social_messages(parsed: DataFrame) -> DataFrame:
    return usable(parsed).select(
        F.col("record.unique_msg_id").alias("unique_msg_id"),
        F.col("record.macroarea_id").alias("macroarea_id"),
        F.col("record.microarea_id").alias("microarea_id"),
        F.col("record.text").alias("message"),
        F.col("record.latitude").alias("latitude"),
        F.col("record.longitude").alias("longitude"),
        "ts",
    )
