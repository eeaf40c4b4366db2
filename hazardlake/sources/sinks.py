"""Writers of the lake layers and topic payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hazardlake.functions.timefmt import date_parts

DATE_PARTITIONS = ["year", "month", "day"]
KEEP_NULLS = {"ignoreNullFields": "false"}


def json_payload(df: DataFrame, key: str | Column | None = None) -> DataFrame:
    """One JSON ``value`` per row (and a ``key``), the shape the Kafka sink takes."""
    columns = [F.to_json(F.struct("*"), KEEP_NULLS).alias("value")]
    if key is not None:
        source = F.col(key) if isinstance(key, str) else key
        columns.insert(0, source.cast("string").alias("key"))
    return df.select(*columns)


def exploded_payload(df: DataFrame, array: str, key: str) -> DataFrame:
    """One payload per element of an array column."""
    return df.select(F.col(key).cast("string").alias("key"), F.explode(array).alias("_item")).select(
        "key", F.to_json("_item", KEEP_NULLS).alias("value")
    )


def bronze_rows(raw: DataFrame, event_time: Column, ingest_time: Column) -> DataFrame:
    """Raw text with date partitions from the event time, or from the arrival time when that is unreadable."""
    return raw.select("value", *date_parts(F.coalesce(event_time, ingest_time)))


def write_layer(
    df: DataFrame, path: str, partitions: list[str] | None = None, mode: str = "append", file_format: str = "parquet"
) -> None:
    """Append rows to a partitioned folder.

    The rebalance hint lets AQE gather a day's rows into few large files and split a hot day over
    several tasks.
    """
    keys = DATE_PARTITIONS if partitions is None else partitions
    writer = (df.hint("rebalance", *keys) if keys else df).write.mode(mode).format(file_format)
    (writer.partitionBy(*keys) if keys else writer).save(path)


def compact_layer(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Rewrite a layer of many small files into a new folder with few large ones per partition."""
    write_layer(df, path, partitions, mode="errorifexists")


def kafka_sink(payload: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Stream of ``key, value`` payloads to a topic (needs the Kafka connector on the classpath)."""
    return (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("checkpointLocation", checkpoint)
    )


def file_sink(
    df: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None, file_format: str = "parquet"
) -> DataStreamWriter:
    """Exactly-once file sink."""
    keys = DATE_PARTITIONS if partitions is None else partitions
    writer = (
        df.writeStream.format(file_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*keys) if keys else writer
