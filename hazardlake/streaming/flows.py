"""The three event flows on streams. Each reuses the batch operators unchanged."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from hazardlake.functions.timefmt import date_parts, parse_iso
from hazardlake.operators import dims, imagery, sensors, serving
from hazardlake.operators.text_model import CentroidModel
from hazardlake.plans import iot, satellite, social
from hazardlake.sources import records
from hazardlake.sources.keyed import WRITTEN, KeyedTable
from hazardlake.sources.sinks import DATE_PARTITIONS, bronze_rows, file_sink
from hazardlake.streaming.sinks import Output, fan_out, merge_into

SENSOR_DELAY = "5 seconds"
SENSOR_WINDOW = "1 minute"
MESSAGE_DELAY = "2 seconds"
MESSAGE_WINDOW = "5 seconds"
#: Partitions that dates of images are dealt out to: with few, each has many dates, and each part it is split into has them all.
IMAGE_PIECES = 200


# ------------------------------------------------------------------ bronze
def bronze(raw: DataFrame, time_path: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw texts by date. ``time_path`` is the JSON path of the event time, e.g. ``$.timestamp``."""
    event_time = parse_iso(F.get_json_object("value", time_path))
    return file_sink(bronze_rows(raw, event_time, F.col("ingest_ts")), path, checkpoint, file_format="text")


def quarantine(parsed: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Raw text and reason of every record of a flow that cannot be used; runs beside the flow."""
    return file_sink(records.quarantined(parsed), path, checkpoint, [])


# ------------------------------------------------------------------ sensors
def station_stream(
    readings: DataFrame, stations: DataFrame, window: str = SENSOR_WINDOW, delay: str = SENSOR_DELAY
) -> DataFrame:
    """Closed, enriched station windows; readings later than ``delay`` are dropped by the watermark."""
    return iot.station_stage(readings.withWatermark("ts", delay), stations, window)


def area_stream(
    readings: DataFrame, stations: DataFrame, window: str = SENSOR_WINDOW, delay: str = SENSOR_DELAY
) -> DataFrame:
    """Closed area windows: the second windowed aggregate runs on the first one's window time."""
    return sensors.area_windows(station_stream(readings, stations, window, delay), window)


def station_stage(
    readings: DataFrame, stations: KeyedTable, path: str, checkpoint: str, window: str = SENSOR_WINDOW, delay: str = SENSOR_DELAY
) -> DataStreamWriter:
    """First of two streams: closed station windows, enriched from the newest snapshot of a stored dimension.

    A static side of a stream is listed once, when the stream starts. Here every micro-batch reads the snapshot that is
    newest then, so stations may be added and moved while the stream runs; ``staged_areas`` goes on from the stage.
    """
    windows = sensors.station_windows(readings.withWatermark("ts", delay), window)

    def build(batch: DataFrame) -> DataFrame:
        enriched = dims.enrich_stations(batch, stations.read(batch.sparkSession))
        return enriched.withColumn("ts", F.col("w.end") - F.expr("INTERVAL 1 MICROSECOND"))

    return fan_out(windows, [Output(path, build, ())], checkpoint)


def staged_areas(stage: DataFrame, window: str = SENSOR_WINDOW, delay: str | None = None) -> DataFrame:
    """Closed area windows over the stage of ``station_stage``, read as a stream.

    A station's window counts once, also when the first stream writes a batch again after a failure. ``delay`` is how
    far such repeats may lie behind the newest window, by default one window.
    """
    once = stage.withWatermark("ts", delay or window).dropDuplicatesWithinWatermark(["station_id", "ts"])
    return sensors.area_windows(once, window, F.col("ts"))


def alert_payloads(areas: DataFrame, stage: str, path: str, checkpoint: str) -> DataStreamWriter:
    """Second of two streams: every closed area window as JSON payloads that hold its stations, page by page.

    ``areas`` come from ``staged_areas`` over ``stage``. An area window closes after all its stations' windows were
    stored, so each micro-batch finds them there; only the files of its own times are read. ``kafka_sink`` takes the
    same ``key, value`` rows to a topic.
    """

    def build(batch: DataFrame) -> DataFrame:
        first, last = batch.agg(F.min("w.start"), F.max("w.end")).first()
        stations = batch.sparkSession.read.parquet(stage).filter((F.col("ts") >= F.lit(first)) & (F.col("ts") < F.lit(last)))
        return iot.payload_pages(sensors.scored_areas(batch), stations)

    return fan_out(areas, [Output(path, build, ())], checkpoint)


def sensor_silver(enriched: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Quiet and alarming station windows into their two layouts."""
    outputs = [
        Output(os.path.join(path, "normal"), sensors.silver_normal),
        Output(os.path.join(path, "anomalies"), sensors.silver_anomalies),
    ]
    return fan_out(enriched, outputs, checkpoint)


def sensor_events(areas: DataFrame) -> DataFrame:
    """Scored area windows as events."""
    return sensors.area_events(sensors.scored_areas(areas))


def sensor_gold(areas: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Scored area windows into the flat gold layout."""

    def build(batch: DataFrame) -> DataFrame:
        return sensors.flat_events(sensor_events(batch))

    return fan_out(areas, [Output(path, build, stamp="stored_at")], checkpoint)


# ------------------------------------------------------------------ images
def image_layers(images: DataFrame, microareas: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Pixels to silver and assessed images to gold. No state: an image is one message.

    Images travel, not their pixels: for silver they are dealt out by date before their arrays are exploded, so a task
    writes few dates and a date is few files, however many dates and tasks a batch has. A date of more images than a
    task should have is split by size. Each layer makes its pixels where it needs them; neither is kept.
    """

    def silver(batch: DataFrame) -> DataFrame:
        enriched = dims.enrich_microareas(batch, microareas)
        dates = {f"_{name}": part for name, part in zip(DATE_PARTITIONS, date_parts(parse_iso(F.col("timestamp"))))}
        dealt = enriched.withColumns(dates).hint("rebalance", IMAGE_PIECES, *dates).sortWithinPartitions(*dates)
        return imagery.silver_pixels(imagery.classified_messages(dealt.drop(*dates)))

    def gold(batch: DataFrame) -> DataFrame:
        return satellite.gold_stage(satellite.classified_scene_stage(imagery.classified_messages(batch)), microareas)

    outputs = [
        Output(os.path.join(path, "silver"), silver, dealt=True),
        Output(os.path.join(path, "gold"), gold, stamp="response_timestamp", pieces=IMAGE_PIECES),
    ]
    return fan_out(images, outputs, checkpoint, kept=False)


def assessed_images(images: DataFrame, microareas: DataFrame) -> DataFrame:
    """The gold layout as a stateless map over the stream, e.g. straight to a topic."""
    return satellite.gold_stage(satellite.array_scene_stage(images), microareas)


# ------------------------------------------------------------------ messages
def message_layers(messages: DataFrame, model: CentroidModel, path: str, checkpoint: str) -> DataStreamWriter:
    """Classified signal messages to gold, by category and date; rows without text to quarantine.

    The model is part of the plan, so a batch cannot lose messages to a failed classifier call.
    """

    def gold(batch: DataFrame) -> DataFrame:
        good, _ = social.split_errors(batch)
        return social.gold_social_columns(social.signals_only(social.classify_stage(good, model)), F.col("ts"))

    def errors(batch: DataFrame) -> DataFrame:
        return social.split_errors(batch)[1]

    outputs = [
        Output(os.path.join(path, "gold"), gold, ("category", "year", "month", "day"), stamp="response_timestamp"),
        Output(os.path.join(path, "errors"), errors, ()),
    ]
    return fan_out(messages, outputs, checkpoint)


def classified_messages(messages: DataFrame, model: CentroidModel, path: str, checkpoint: str) -> DataStreamWriter:
    """First of two streams: every message with its category to a stored stage, those without text to error rows."""

    def classified(batch: DataFrame) -> DataFrame:
        return social.classify_stage(social.split_errors(batch)[0], model)

    def errors(batch: DataFrame) -> DataFrame:
        return social.split_errors(batch)[1]

    outputs = [Output(os.path.join(path, "classified"), classified, ()), Output(os.path.join(path, "errors"), errors, ())]
    return fan_out(messages, outputs, checkpoint)


def signal_gold(classified: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Second of two streams: signal messages of the stored stage to gold."""

    def gold(batch: DataFrame) -> DataFrame:
        return social.gold_social_columns(social.signals_only(batch), F.col("ts"))

    output = Output(path, gold, ("category", "year", "month", "day"), stamp="response_timestamp")
    return fan_out(classified, [output], checkpoint)


def message_counts(classified: DataFrame, window: str = MESSAGE_WINDOW, delay: str = MESSAGE_DELAY) -> DataFrame:
    """Messages per window, area and category, each id counted once."""
    unique = classified.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["unique_msg_id"])
    return unique.groupBy(F.window("ts", window).alias("w"), "microarea_id", "category").agg(
        F.count(F.lit(1)).alias("n_messages")
    )


# ------------------------------------------------------------------ displays
def newest_records(records: DataFrame, kept: KeyedTable, keep: Mapping[str, int], checkpoint: str) -> DataStreamWriter:
    """The newest ``keep[stream]`` records of every stream, merged into a stored table with each micro-batch.

    ``kept`` has the columns ``stream``, ``record_id``, ``ts`` and others, by ``stream``. It never holds more than the
    limits; a record that arrives twice counts once.
    """

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new).dropDuplicates(["stream", "record_id"])
        return serving.recent_per_stream(both, keep).drop("recency")

    def change(batch: DataFrame, number: int) -> None:
        kept.change(serving.recent_per_stream(batch, keep).withColumn(WRITTEN, F.lit(number)), merge)

    return merge_into(records, change, checkpoint)


def latest_records(records: DataFrame, kept: KeyedTable, key: str, checkpoint: str) -> DataStreamWriter:
    """The newest record of every key, by event time and then ``record_id``, kept in a stored table.

    Records may arrive in any order and more than once. ``record_id`` must be the first column of ``kept`` after its key.
    """

    def change(batch: DataFrame, _: int) -> None:
        kept.upsert(serving.latest_per_key(batch, key).withColumn("_order", F.unix_micros("ts")), "_order")

    return merge_into(records, change, checkpoint)


def revised_counts(classified: DataFrame, kept: KeyedTable, checkpoint: str, window: str = MESSAGE_WINDOW, delay: str = MESSAGE_DELAY) -> DataStreamWriter:
    """Messages per window, area and category, revised as they arrive (update mode) and kept in a stored table.

    ``n_messages`` is the count so far and ``change`` what the last revision added; a revision written twice changes
    nothing. Ids must be unique, or the rows come through ``dropDuplicatesWithinWatermark`` in a stream of their own.
    """
    counts = classified.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "microarea_id", "category").agg(
        F.count(F.lit(1)).alias("n_messages")
    )
    rows = counts.select(F.col("w.start").alias("window_start"), "microarea_id", "category", "n_messages")

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        key = ["window_start", "microarea_id", "category"]
        row = F.struct(WRITTEN, "n_messages", "change")
        before, after = old.groupBy(*key).agg(F.max(row).alias("a")), new.groupBy(*key).agg(F.max(row).alias("b"))
        both = before.join(after, key, "full")
        stale = F.col("b").isNull() | (F.col(f"a.{WRITTEN}") >= F.col(f"b.{WRITTEN}"))
        revised = F.struct(
            F.col(f"b.{WRITTEN}").alias(WRITTEN),
            F.col("b.n_messages").alias("n_messages"),
            (F.col("b.n_messages") - F.coalesce("a.n_messages", F.lit(0))).alias("change"),
        )
        return both.select(*key, F.when(stale, F.col("a")).otherwise(revised).alias("r")).select(*key, "r.*")

    def change(batch: DataFrame, number: int) -> None:
        kept.change(batch.withColumns({"change": F.lit(None).cast("bigint"), WRITTEN: F.lit(number)}), merge)

    return merge_into(rows, change, checkpoint, "update")
