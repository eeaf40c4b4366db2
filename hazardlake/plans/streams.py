"""Registered queries that run the flows as streams over the given tables."""

from __future__ import annotations

import datetime
import os
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from hazardlake.constants import MEASUREMENTS
from hazardlake.functions.timefmt import millis
from hazardlake.operators import serving as serving_operators
from hazardlake.plans import early_warning, iot, proxies, satellite, serving, social
from hazardlake.plans import oracle as sql
from hazardlake.plans.proxies import IOT_WINDOW, table
from hazardlake.session import is_folder, scratch_dir, use_utc
from hazardlake.sources import records
from hazardlake.sources.keyed import KeyedTable
from hazardlake.sources.sinks import file_sink
from hazardlake.streaming import flows
from hazardlake.streaming.compaction import compact_closed
from hazardlake.streaming.progress import ProgressLog
from hazardlake.streaming.sinks import BATCH_PARTITIONS, run_and_drain, run_available


#: Partitions of a stream's state. The first run fixes them for good, so every session gets the same number.
STATE_PARTITIONS = 8
#: A time beyond every window of the tables.
CLOSING_TIME = "2200-01-01 00:00:00"


@contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _state_partitions(spark: SparkSession) -> AbstractContextManager[None]:
    return _setting(spark, "spark.sql.shuffle.partitions", STATE_PARTITIONS)


def _compiled(spark: SparkSession) -> AbstractContextManager[None]:
    """HotSpot interprets methods of more than 8,000 bytes; Spark then takes code that is split into smaller ones."""
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", 8000)


def _drained(spark: SparkSession, rows: DataFrame, out: str, start: Callable[[DataFrame], DataStreamWriter], **closing: str) -> None:
    """Run a stream over ``rows`` to its end and close its windows with one row of ``closing`` values."""
    folder = os.path.join(out, "closing")
    one = spark.range(1).select(
        *[F.lit(closing.get(f.name, CLOSING_TIME if f.name == "ts" else None)).cast(f.dataType).alias(f.name) for f in rows.schema]
    )
    one.limit(0).write.parquet(folder)
    with _state_partitions(spark):
        run_and_drain(lambda: start(rows.unionByName(spark.readStream.schema(rows.schema).parquet(folder))), one, folder)


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a file stream: the files of its folder, or the one file it is.

    A stream lists the files of a folder, so a table of one file is picked by its name from the folder of the tables.
    """
    path = os.path.join(sf, f"{name}.parquet")
    reader = use_utc(spark).readStream.schema(table(spark, sf, name).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _spread_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same for heavy per-row work: every micro-batch is dealt out as ``proxies.spread_table`` does it."""
    return _stream(spark, sf, name).repartition(proxies.spread_tasks(spark, sf, name))


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, "events").select(*proxies.reading_columns())


def stream_area_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Chained windows in append mode, all of them."""
    out = scratch_dir(spark, "areas")

    def start(readings: DataFrame) -> DataStreamWriter:
        areas = flows.area_stream(readings, proxies.stations(spark, sf), IOT_WINDOW)
        rows = areas.select(
            "microarea_id",
            millis(F.col("w.start")).alias("window_start_ms"),
            "total_stations",
            "anomalous_stations",
            millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        )
        return file_sink(rows, os.path.join(out, "data"), os.path.join(out, "state"), [])

    _drained(spark, _readings(spark, sf), out, start, station_id="closing")
    return spark.read.parquet(os.path.join(out, "data"))


def stream_silver_iot(spark: SparkSession, sf: str) -> DataFrame:
    """Both silver tables written by one stream."""
    out = scratch_dir(spark, "silver")

    def start(readings: DataFrame) -> DataStreamWriter:
        stations = flows.station_stream(readings, proxies.stations(spark, sf), IOT_WINDOW)
        return flows.sensor_silver(stations, os.path.join(out, "data"), os.path.join(out, "state"))

    _drained(spark, _readings(spark, sf), out, start, station_id="closing")
    return _silver_rows(spark, os.path.join(out, "data"))


def _silver_rows(spark: SparkSession, data: str) -> DataFrame:
    keep = ["station_id", "microarea_id", "response_timestamp", "latest_event_timestamp"]
    normal = spark.read.parquet(os.path.join(data, "normal")).select(F.lit("normal").alias("route"), *keep)
    alarms = spark.read.parquet(os.path.join(data, "anomalies")).select(
        F.lit("anomalies").alias("route"), *keep, *MEASUREMENTS
    )
    return normal.unionByName(alarms, allowMissingColumns=True)


def stream_gold_iot(spark: SparkSession, sf: str) -> DataFrame:
    """Gold events written by the chained stream."""
    out = scratch_dir(spark, "gold")

    def start(readings: DataFrame) -> DataStreamWriter:
        areas = flows.area_stream(readings, proxies.stations(spark, sf), IOT_WINDOW)
        return flows.sensor_gold(areas, os.path.join(out, "data"), os.path.join(out, "state"))

    _drained(spark, _readings(spark, sf), out, start, station_id="closing")
    return spark.read.parquet(os.path.join(out, "data")).select(
        "event_id", "region_id", "response_timestamp", "event_type", "severity_score", "alert_level", "air_quality_index",
        "estimated_ignition_time", "fire_spread_rate", "fire_direction", "fire_speed_mph",
    )


def stream_gold_sat(spark: SparkSession, sf: str) -> DataFrame:
    """Silver pixels and gold images written by one stateless stream; returns the gold rows."""
    out = scratch_dir(spark, "images")
    images = proxies.image_columns(_spread_stream(spark, sf, "orders"))
    with _state_partitions(spark), _compiled(spark):
        run_available(flows.image_layers(images, proxies.microareas(spark), os.path.join(out, "data"), os.path.join(out, "state")))
    gold = spark.read.parquet(os.path.join(out, "data", "gold")).drop(*BATCH_PARTITIONS, "response_timestamp")
    return satellite.rounded_box(gold)


def stream_message_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages per window, area and category."""
    out = scratch_dir(spark, "messages")

    def start(messages: DataFrame) -> DataStreamWriter:
        counts = flows.message_counts(messages, "5 minutes").select(
            millis(F.col("w.start")).alias("window_start_ms"), "microarea_id", "category", "n_messages"
        )
        return file_sink(counts, os.path.join(out, "data"), os.path.join(out, "state"), [])

    _drained(spark, proxies.message_columns(_stream(spark, sf, "conversations")), out, start, unique_msg_id="closing")
    return spark.read.parquet(os.path.join(out, "data"))


def stream_gold_social(spark: SparkSession, sf: str) -> DataFrame:
    """The message flow as two streams over a stored stage: messages are stored classified, then filtered into gold."""
    out = scratch_dir(spark, "social")
    model = social.category_model(spark, sf)
    messages = proxies.message_columns(_spread_stream(spark, sf, "conversations")).drop("category")
    with _state_partitions(spark):
        run_available(flows.classified_messages(messages, model, os.path.join(out, "stage"), os.path.join(out, "state-1")))
        stage = spark.read.parquet(os.path.join(out, "stage", "classified")).schema
        stored = spark.readStream.schema(stage).parquet(os.path.join(out, "stage", "classified"))
        run_available(flows.signal_gold(stored, os.path.join(out, "gold"), os.path.join(out, "state-2")))
    return spark.read.parquet(os.path.join(out, "gold")).drop(*BATCH_PARTITIONS, "response_timestamp")


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Event payloads, some broken: usable ones in one table, the others with their reason in quarantine."""
    out = scratch_dir(spark, "quarantine")
    parsed = records.parse(_stream(spark, sf, "events").select("event_id", early_warning.broken_payload().alias("value")), {"k": "int"}, ["k"], None)
    good = records.usable(parsed).select("value", F.col("record.k").cast("double").alias("k"))
    with _state_partitions(spark):
        run_available(file_sink(good, os.path.join(out, "good"), os.path.join(out, "state-1"), []))
        run_available(flows.quarantine(parsed, os.path.join(out, "bad"), os.path.join(out, "state-2")))
    bad = spark.read.parquet(os.path.join(out, "bad")).select("value", F.col("problem").alias("route"), F.lit(None).cast("double").alias("k"))
    return spark.read.parquet(os.path.join(out, "good")).select("value", F.lit("ok").alias("route"), "k").unionByName(bad)


def stream_late_records(spark: SparkSession, sf: str) -> DataFrame:
    """Station windows of a stream that got a third of its readings after the watermark had passed them all.

    The first run reads the other readings and a far one; what a second run from the same checkpoint adds is late, and
    the windows stay as they were. ``n_dropped`` is the number of late windows the stream reported.
    """
    out = scratch_dir(spark, "late")
    readings = proxies.sensor_readings(spark, sf)
    late = F.col("reading_id") % 3 == 0
    folder = os.path.join(out, "readings")
    readings.filter(~late).write.parquet(folder)
    stations = proxies.stations(spark, sf)

    def start() -> DataStreamWriter:
        stream = spark.readStream.schema(readings.schema).parquet(folder)
        windows = flows.station_stream(stream, stations, IOT_WINDOW)
        rows = windows.select("station_id", millis(F.col("w.start")).alias("window_start_ms"), "n_readings", "is_anomaly")
        return file_sink(rows, os.path.join(out, "data"), os.path.join(out, "state"), [])

    far = readings.limit(1).withColumn("ts", F.lit(CLOSING_TIME).cast("timestamp")).withColumn("station_id", F.lit("closing"))
    with _state_partitions(spark):
        run_and_drain(start, far, folder)
        readings.filter(late).write.mode("append").parquet(folder)
        with ProgressLog(spark, os.path.join(out, "progress")) as log:
            log.wait_for(run_available(start()))
    dropped = log.table().agg(F.coalesce(F.sum("n_dropped"), F.lit(0)).alias("n_dropped"))
    return spark.read.parquet(os.path.join(out, "data")).withColumn("n_dropped", dropped.scalar())


def stream_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows of a stream that goes on after its closed dates have been packed in place, twice.

    The readings come in four parts by time, two a run, so windows of one date are written by several batches.
    """
    out = scratch_dir(spark, "compacted")
    readings, stations = proxies.sensor_readings(spark, sf), proxies.stations(spark, sf)
    folder, data, state = (os.path.join(out, name) for name in ("readings", "data", "state"))
    at = F.unix_micros("ts")
    least, most = readings.agg(F.min(at), F.max(at)).first()
    if least is None:
        return stream_silver_iot(spark, sf)
    bounds = [least + (most + 1 - least) * i // 4 for i in range(5)]

    def start() -> DataStreamWriter:
        rows = spark.readStream.schema(readings.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        return flows.sensor_silver(flows.station_stream(rows, stations, IOT_WINDOW), data, state)

    def pack(passed: int) -> None:
        tomorrow = datetime.datetime.fromtimestamp(passed / 1e6, datetime.timezone.utc) + datetime.timedelta(days=1)
        for name in ("normal", "anomalies"):
            compact_closed(spark, os.path.join(data, name), state, tomorrow.date())

    with _state_partitions(spark):
        for i in range(4):
            readings.filter((at >= bounds[i]) & (at < bounds[i + 1])).coalesce(1).write.mode("append").parquet(folder)
            if i % 2:
                run_available(start())
                pack(bounds[i + 1])
        far = readings.limit(1).withColumns({"ts": F.lit(CLOSING_TIME).cast("timestamp"), "station_id": F.lit("closing")})
        run_and_drain(start, far, folder)
    pack(most + 86_400_000_000)
    return _silver_rows(spark, data)


#: Where the stations of ``stream_station_moves`` go, and which of them.
MOVED_TO, MOVED = "A1-M3", "battery_type = 'lithium'"


def stream_station_moves(spark: SparkSession, sf: str) -> DataFrame:
    """Area windows of a stream whose stored station table changes halfway: every second station moves to one area.

    Windows that were closed before the change count where the stations stood then, the others where they went.
    """
    out = scratch_dir(spark, "moves")
    readings, known = proxies.sensor_readings(spark, sf), proxies.stations(spark, sf)
    stations = KeyedTable(os.path.join(out, "stations"), known.schema, ["station_id"], buckets=STATE_PARTITIONS)
    stations.load(known)
    ends = readings.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    early = F.unix_micros("ts") < F.lit(((ends[0] or 0) + (ends[1] or 0)) // 2)
    folder, stage = os.path.join(out, "readings"), os.path.join(out, "stage")
    readings.filter(early).write.parquet(folder)

    def start() -> DataStreamWriter:
        stream = spark.readStream.schema(readings.schema).parquet(folder)
        return flows.station_stage(stream, stations, stage, os.path.join(out, "state-1"), IOT_WINDOW)

    far = spark.range(1).select(
        *[F.lit({"ts": CLOSING_TIME, "station_id": "closing"}.get(f.name)).cast(f.dataType).alias(f.name) for f in readings.schema]
    )
    with _state_partitions(spark):
        run_available(start())
        stations.upsert(known.filter(MOVED).withColumns({"microarea_id": F.lit(MOVED_TO), "load": F.lit(1)}), "load")
        readings.filter(~early).write.mode("append").parquet(folder)
        run_and_drain(start, far, folder)
    rows = spark.readStream.schema(spark.read.parquet(stage).schema).parquet(stage)

    def areas(stage_rows: DataFrame) -> DataStreamWriter:
        counted = flows.staged_areas(stage_rows, IOT_WINDOW).select(
            "microarea_id",
            millis(F.col("w.start")).alias("window_start_ms"),
            "total_stations",
            "anomalous_stations",
            millis(F.col("latest_event_ts")).alias("latest_event_timestamp"),
        )
        return file_sink(counted, os.path.join(out, "areas"), os.path.join(out, "state-2"), [])

    _drained(spark, rows, out, areas, station_id="closing")
    return spark.read.parquet(os.path.join(out, "areas"))


def stream_alert_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads with their stations, published by the chained stream and read back as a consumer would."""
    out = scratch_dir(spark, "payloads")
    known = proxies.stations(spark, sf)
    stations = KeyedTable(os.path.join(out, "stations"), known.schema, ["station_id"], buckets=STATE_PARTITIONS)
    stations.load(known)
    stage, sent = os.path.join(out, "stage"), os.path.join(out, "sent")

    def staged(readings: DataFrame) -> DataStreamWriter:
        return flows.station_stage(readings, stations, stage, os.path.join(out, "state-1"), IOT_WINDOW)

    _drained(spark, _readings(spark, sf), out, staged, station_id="closing")
    rows = spark.readStream.schema(spark.read.parquet(stage).schema).parquet(stage)

    def published(stage_rows: DataFrame) -> DataStreamWriter:
        return flows.alert_payloads(flows.staged_areas(stage_rows, IOT_WINDOW), stage, sent, os.path.join(out, "state-2"))

    _drained(spark, rows, os.path.join(out, "areas"), published, station_id="closing")
    event = "page int, pages int, event_type string, stations array<struct<station_id string>>"
    value = spark.read.parquet(sent).select(F.col("key").alias("event_id"), "value", F.from_json("value", event).alias("e"))
    notified = "$.system_response.sent_notifications_to[1]"
    return value.select(
        "event_id",
        "e.page",
        "e.pages",
        F.size("e.stations").alias("page_stations"),
        F.array_join("e.stations.station_id", ",").alias("station_ids"),
        "e.event_type",
        F.get_json_object("value", "$.aggregated_detection.severity_score").cast("double").alias("severity_score"),
        F.get_json_object("value", f"{notified}.agency").alias("second_agency"),
        F.get_json_object("value", f"{notified}.notification_timestamp").alias("notified_at"),
        F.get_json_object("value", "$.environmental_context.terrain_info.aspect").alias("aspect"),
    )


def _in_batches(spark: SparkSession, rows: DataFrame, folder: str, batches: int = 3) -> DataFrame:
    """A stream that gives ``rows`` in several micro-batches, dealt by hash and so out of the order of their times."""
    parts = rows.withColumn("_part", F.pmod(F.xxhash64(rows.columns[0], rows.columns[1]), F.lit(batches)))
    for part in range(batches):
        parts.filter(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def stream_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The newest records of every source, kept by a stream whose records come out of order."""
    out = scratch_dir(spark, "recent")
    records = serving.streams(spark, sf)
    kept = KeyedTable(os.path.join(out, "kept"), records.schema, ["stream"], buckets=4)
    with _state_partitions(spark):
        rows = _in_batches(spark, records, os.path.join(out, "records"))
        run_available(flows.newest_records(rows, kept, serving.KEEP, os.path.join(out, "state")))
    ranked = serving_operators.recent_per_stream(kept.read(spark), serving.KEEP)
    return ranked.select("stream", "record_id", millis(F.col("ts")).alias("ts_ms"), "recency")


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest reading of every station, kept by a stream whose readings come out of order."""
    out = scratch_dir(spark, "latest")
    readings = proxies.sensor_readings(spark, sf).select(
        "station_id", F.col("reading_id").alias("record_id"), "ts", "temperature_c", "humidity_percent"
    )
    kept = KeyedTable(os.path.join(out, "kept"), readings.schema, ["station_id"], buckets=STATE_PARTITIONS)
    with _state_partitions(spark):
        rows = _in_batches(spark, readings, os.path.join(out, "readings"))
        run_available(flows.latest_records(rows, kept, "station_id", os.path.join(out, "state")))
    return kept.read(spark).select("station_id", "record_id", millis(F.col("ts")).alias("ts_ms"), "temperature_c", "humidity_percent")


def stream_revised_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages per window, area and category as the last revision of a running count leaves them."""
    out = scratch_dir(spark, "counts")
    messages = proxies.messages(spark, sf)
    schema = StructType.fromDDL("window_start timestamp, microarea_id string, category string, n_messages bigint, change bigint")
    kept = KeyedTable(os.path.join(out, "kept"), schema, schema.names[:3], buckets=STATE_PARTITIONS)
    with _state_partitions(spark):
        rows = _in_batches(spark, messages, os.path.join(out, "messages"))
        run_available(flows.revised_counts(rows, kept, os.path.join(out, "state"), "5 minutes", "100 days"))
    return kept.read(spark).select(millis(F.col("window_start")).alias("window_start_ms"), "microarea_id", "category", "n_messages")


_MOVES = f"""halves AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS t FROM events),
seen AS (SELECT max(epoch_us(ts)) - 5000000 AS mark FROM events, halves WHERE epoch_us(ts) < t),
placed AS (
  SELECT w.*, CASE WHEN s.station_id IS NULL THEN 'UNKNOWN' WHEN s.{MOVED} AND epoch_us(w_end) > mark THEN '{MOVED_TO}' ELSE s.microarea_id END AS microarea_id
  FROM station_windows w CROSS JOIN seen LEFT JOIN v_station s ON w.station_id = s.station_id
)"""

_COUNTED = (
    sql.with_views(serving.V_MESSAGE)
    + f"""SELECT {sql.ms("time_bucket(INTERVAL 5 MINUTE, ts)")} AS window_start_ms, microarea_id, category, count(*) AS n_messages
FROM v_message GROUP BY ALL"""
)

_SILVER = (
    sql.with_views(*sql.IOT_TO_ENRICHED)
    + f"""SELECT CASE WHEN is_anomaly THEN 'anomalies' ELSE 'normal' END AS route, station_id, microarea_id,
  {sql.ms("w_end")} AS response_timestamp, {sql.ms("latest_event_ts")} AS latest_event_timestamp, {", ".join(MEASUREMENTS)}
FROM enriched"""
)

QUERIES = {
    "stream_compacted": (stream_compacted, _SILVER),
    "stream_station_moves": (
        stream_station_moves,
        sql.with_views(sql.V_SENSOR, sql.V_STATION, sql.STATION_WINDOWS, _MOVES)
        + f"""SELECT microarea_id, {sql.ms("w_start")} AS window_start_ms, count(*) AS total_stations, count(*) FILTER (WHERE is_anomaly) AS anomalous_stations,
  {sql.ms("max(latest_event_ts)")} AS latest_event_timestamp FROM placed GROUP BY microarea_id, w_start""",
    ),
    "stream_recent": (stream_recent, serving.QUERIES["recent_per_stream"][1]),
    "stream_latest": (stream_latest, serving.QUERIES["latest_per_key"][1]),
    "stream_revised_counts": (stream_revised_counts, _COUNTED),
    "stream_alert_payloads": (stream_alert_payloads, iot.QUERIES["gold_iot_event"][1]),
    "stream_area_windows": (
        stream_area_windows,
        sql.with_views(*sql.IOT_TO_AREAS)
        + f"SELECT microarea_id, {sql.ms('w_start')} AS window_start_ms, total_stations, anomalous_stations,"
        f" {sql.ms('latest_event_ts')} AS latest_event_timestamp FROM area_windows",
    ),
    "stream_silver_iot": (stream_silver_iot, _SILVER),
    "stream_gold_iot": (
        stream_gold_iot,
        f"SELECT event_id, region_id, response_timestamp, event_type, severity_score, alert_level, air_quality_index,"
        f" estimated_ignition_time, fire_spread_rate, fire_direction, fire_speed_mph FROM ({iot.QUERIES['gold_iot_flat'][1]})",
    ),
    "stream_gold_sat": (stream_gold_sat, satellite.QUERIES["gold_sat_from_messages"][1]),
    "stream_message_counts": (stream_message_counts, _COUNTED),
    "stream_gold_social": (stream_gold_social, social.QUERIES["gold_social_classified"][1]),
    "stream_quarantine": (
        stream_quarantine,
        f"SELECT value, route, CASE WHEN route = 'ok' THEN k END AS k FROM ({early_warning.QUERIES['parse_quarantine'][1]})",
    ),
    "stream_late_records": (
        stream_late_records,
        sql.with_views(
            sql.V_SENSOR.replace("v_sensor AS", "all_sensor AS"),
            *[part.replace("FROM events", "FROM events WHERE event_id % 3 <> 0") if i == 0 else part for i, part in enumerate(sql.IOT_TO_ENRICHED)],
        )
        + f"SELECT station_id, {sql.ms('w_start')} AS window_start_ms, n_readings, is_anomaly, (SELECT count(DISTINCT"
        " (station_id, time_bucket(INTERVAL 6 HOUR, ts))) FROM all_sensor WHERE reading_id % 3 = 0) AS n_dropped FROM enriched",
    ),
}
