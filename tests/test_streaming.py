import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import text_model as tm
from hazardlake.plans import iot, proxies, social, streams
from hazardlake.sources import records
from hazardlake.streaming import flows
from hazardlake.streaming.sinks import compact, run_available
from hazardlake.sources.sinks import file_sink

from .test_sensor_rules import NORMAL, stations_dim


def reading(station, stamp, **changed):
    return {"station_id": station, "timestamp": f"2024-01-01T{stamp}", "measurements": {**NORMAL, **changed}}


clock = itertools.count(1_700_000_000)


def drop_file(folder, name, *values):
    """Write a file of its own second: a stream reads files in order of their times."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join((v if isinstance(v, str) else json.dumps(v)) + "\n" for v in values))
    stamp = next(clock)
    os.utime(folder / name, (stamp, stamp))


FIRST = [reading("a", "00:00:01.000"), reading("a", "00:00:02.000", temperature_c=45.0), reading("b", "00:00:30.000"), "broken {"]
SECOND = [reading("a", "00:01:10.000"), reading("b", "00:00:58.000", temperature_c=50.0)]  # in order of arrival, not of time
THIRD = [reading("a", "00:05:00.000"), reading("b", "00:00:10.000", co2_ppm=900.0)]  # the second is too late


@pytest.fixture
def source(spark, tmp_path):
    folder = tmp_path / "in"
    drop_file(folder, "1.json", *FIRST)

    def open_stream():
        return records.sensor_readings(records.sensor_records(flows_raw(spark, folder)))

    return folder, open_stream


def flows_raw(spark, folder):
    return records.file_text(spark, str(folder), max_files=1)


def test_chained_windows_lateness_and_restart(spark, tmp_path, source):
    folder, open_stream = source
    dim = stations_dim(spark, ["a", "b"])
    out, state = str(tmp_path / "gold"), str(tmp_path / "state")

    def run():
        run_available(flows.sensor_gold(flows.area_stream(open_stream(), dim), out, state))
        return {r.response_timestamp: r for r in spark.read.parquet(out).collect()}

    drop_file(folder, "2.json", *SECOND)
    run_available(flows.sensor_gold(flows.area_stream(open_stream(), dim), out, state))
    drop_file(folder, "3.json", *THIRD)
    rows = run()  # restarted from the checkpoint
    drop_file(folder, "4.json", reading("a", "00:09:00.000"))
    rows = run()
    assert {1704067260000, 1704067320000} <= set(rows)
    first = rows[1704067260000]
    assert first.event_type == "wildfire" and first.stored_at is not None
    assert spark.read.parquet(out).count() == len(rows)
    # the late reading would have raised the CO2 mean of station b
    batch = records.sensor_readings(records.sensor_records(spark.read.text(str(folder)))).filter(
        "NOT (station_id = 'b' AND co2_ppm = 900)"
    )
    expected = {
        r.response_ms: r for r in iot.area_stage(iot.station_stage(batch, dim, "1 minute"), "1 minute").collect()
    }
    for ms, row in rows.items():
        assert (row.severity_score, row.alert_level, row.air_quality_index) == (
            expected[ms].severity_score,
            expected[ms].alert_level,
            expected[ms].aqi if expected[ms].is_fire else None,
        )


def test_silver_tables_from_one_stream(spark, tmp_path, source):
    folder, open_stream = source
    drop_file(folder, "2.json", *SECOND)
    drop_file(folder, "3.json", reading("a", "00:20:00.000"))
    dim = stations_dim(spark, ["a"])
    out = tmp_path / "silver"
    run_available(flows.sensor_silver(flows.station_stream(open_stream(), dim), str(out), str(tmp_path / "state")))
    alarms = {r.station_id: r for r in spark.read.parquet(str(out / "anomalies")).collect()}
    assert alarms["a"].temperature_c == 45.0 and alarms["b"].temperature_c == 50.0 and alarms["b"].microarea_id == "UNKNOWN"
    normal = spark.read.parquet(str(out / "normal"))
    assert [(r.station_id, r.latest_event_timestamp) for r in normal.collect()] == [("a", 1704067270000)]


def test_bronze_keeps_every_text(spark, tmp_path, source):
    folder, _ = source
    out = tmp_path / "bronze"
    run_available(flows.bronze(flows_raw(spark, folder), "$.timestamp", str(out), str(tmp_path / "state")))
    stored = spark.read.text(str(out))
    assert stored.count() == len(FIRST) and stored.filter("value LIKE 'broken%'").count() == 1
    assert stored.filter("year = 2024 AND month = 1 AND day = 1").count() == 3


def test_images_and_replayed_batches(spark, tmp_path):
    bands = {"B2": 0.15, "B3": 0.07, "B4": 0.35, "B8": 0.15, "B8A": 0.1, "B11": 0.25, "B12": 0.25}
    pixel = {"latitude": 38.7, "longitude": -122.0, "microarea_id": "A1-M1", "bands": bands}
    message = {"image_pointer": "p", "metadata": {"timestamp": "2024-01-01T00:00:00.000", "microarea_id": "A1-M1", "macroarea_id": "A1",
                                                  "satellite_data": [pixel, pixel]}}
    folder, out = tmp_path / "in", str(tmp_path / "out")
    drop_file(folder, "1.json", message)
    areas = spark.createDataFrame([("A1-M1", 1.0, 2.0, 3.0, 4.0)], "microarea_id string, min_long double, min_lat double, max_long double, max_lat double")

    def run(state):
        stream = records.images(records.image_records(flows_raw(spark, folder)))
        run_available(flows.image_layers(stream, areas, out, str(tmp_path / state)))

    run("state")
    # The same batch once more, as after a crash before the commit: its own files are replaced.
    for name in (tmp_path / "state" / "commits").iterdir():
        name.unlink()
    run("state")
    gold = spark.read.parquet(out + "/gold").collect()
    assert len(gold) == 1 and gold[0].total_pixels == 2 and gold[0].min_longitude == 1.0
    assert spark.read.parquet(out + "/silver").count() == 2
    # A fresh checkpoint starts at batch 0 again, with other data: older rows stay.
    (folder / "1.json").unlink()
    drop_file(folder, "2.json", {**message, "image_pointer": "q"})
    run("fresh")
    assert sorted(r.total_pixels for r in spark.read.parquet(out + "/gold").collect()) == [2, 2]
    assert spark.read.parquet(out + "/silver").count() == 4
    compact(spark, out + "/silver", out + "/packed")
    packed = spark.read.parquet(out + "/packed")
    assert packed.count() == 4 and "batch_id" not in packed.columns
    drop_file(folder, "1.json", message)
    plain = flows.assessed_images(records.images(records.image_records(spark.read.text(str(folder)))), areas)
    assert plain.first().severity_score == gold[0].severity_score


def message(i, text, stamp, area="M1"):
    return {"unique_msg_id": i, "macroarea_id": "A1", "microarea_id": area, "text": text, "latitude": 1.0, "longitude": 2.0,
            "timestamp": f"2024-01-01T{stamp}"}


def test_messages_are_classified_filtered_and_partitioned(spark, tmp_path):
    training = spark.createDataFrame(
        [(1, "emergency_help_request", "trapped by fire, send help"), (2, "non_emergency_daily_chatter", "nice coffee this morning")],
        "id int, label string, text string",
    )
    model = tm.fit_centroids(training, "id").save(str(tmp_path / "model"))
    folder, out = tmp_path / "in", tmp_path / "out"
    drop_file(folder, "1.json", message("1", "help, fire!", "00:00:01.000"), message("2", "coffee", "00:00:02.000"), message("3", "", "00:00:03.000"))
    stream = records.social_messages(records.social_records(flows_raw(spark, folder)))
    run_available(flows.message_layers(stream, model, str(out), str(tmp_path / "state")))
    gold = spark.read.parquet(str(out / "gold")).collect()
    assert [(r.unique_msg_id, r.category, r.day) for r in gold] == [("1", "emergency_help_request", 1)]
    errors = spark.read.parquet(str(out / "errors")).collect()
    assert len(errors) == 1 and json.loads(errors[0].input)["unique_msg_id"] == "3"


def test_repeated_messages_count_once(spark, tmp_path):
    folder = tmp_path / "in"
    drop_file(folder, "1.json", message("1", "x", "00:00:01.000"), message("1", "x", "00:00:01.500"), message("2", "x", "00:00:02.000"))
    drop_file(folder, "2.json", message("9", "x", "00:01:00.000"))
    stream = records.social_messages(records.social_records(flows_raw(spark, folder))).withColumn("category", F.lit("c"))
    counts = flows.message_counts(stream)
    out = str(tmp_path / "counts")
    run_available(file_sink(counts, out, str(tmp_path / "state"), []))
    assert [(r.microarea_id, r.n_messages) for r in spark.read.parquet(out).collect()] == [("M1", 2)]


def test_quarantine_error_rows_and_arrival_time(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    timeless = {k: v for k, v in message("4", "no time", "00:00:01.000").items() if k != "timestamp"}
    drop_file(folder, "1.json", message("1", "fine", "00:00:01.000"), "broken {", {**message("2", None, "00:00:02.000")}, timeless, {"text": "no id"})
    parsed = records.social_records(flows_raw(spark, folder))
    run_available(flows.quarantine(parsed, str(out / "bad"), str(tmp_path / "state")))
    bad = {r.problem: r.value for r in spark.read.parquet(str(out / "bad")).collect()}
    assert set(bad) == {"malformed", "missing unique_msg_id"} and bad["malformed"] == "broken {"
    good = records.social_messages(records.social_records(spark.read.text(str(folder)))).collect()
    assert len(good) + len(bad) == 5 and all(r.ts is not None for r in good)
    assert {r.unique_msg_id: r.message for r in good} == {"1": "fine", "2": None, "4": "no time"}


@pytest.mark.parametrize("query", [streams.stream_silver_iot, streams.stream_compacted])
def test_two_layers_of_a_stream_with_a_large_dimension(spark, tmp_path, query):
    """A batch of a sort-merge join is ordered by a column it does not have; cached as it is, it cannot be planned over."""
    id_ = F.col("id")
    events = spark.range(40).select(
        id_.alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=id_.cast("int"))).alias("ts"),
        (id_ % 5).alias("user_id"),
        F.lit("view").alias("event_type"),
        (id_ * 10.0).alias("value"),
        F.format_string('{"k": %d}', id_).alias("props"),
    )
    sf = tmp_path / "sf"
    sf.mkdir()
    pd = events.toPandas()
    pd.to_parquet(sf / "events.parquet", coerce_timestamps="us")
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        rows = query(spark, str(sf)).collect()
    finally:
        spark.conf.set(name, before)
    assert len(rows) == iot._enriched(spark, str(sf)).count()
    assert {r.microarea_id for r in rows} == {"UNKNOWN", "A1-M2", "A1-M3", "A1-M4", "A1-M5"}


def test_a_table_that_is_a_folder_is_streamed_whole(spark, tmp_path):
    """A stream over the folder of the tables does not list the files of a table that is a folder itself."""
    id_ = F.col("id")
    text = F.concat_ws(" ", F.lit("fire smoke"), F.concat(F.lit("w"), (id_ % 7).cast("string")))
    lang = F.element_at(F.array(*[F.lit(x) for x in social.LANGUAGES]), (id_ % 4 + 1).cast("int"))
    rows = spark.range(28).repartition(3)
    rows.select(id_.alias("doc_id"), text.alias("text"), lang.alias("lang"), F.lit("web").alias("source")).write.parquet(str(tmp_path / "documents.parquet"))
    turns = rows.select((id_ % 5).alias("conv_id"), id_.alias("turn"), text.alias("text"))
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    assert len(list((tmp_path / "conversations.parquet").glob("*.parquet"))) == 3
    sf = str(tmp_path)
    streamed, batch = streams.stream_gold_social(spark, sf), social.gold_social_classified(spark, sf)
    assert sorted(streamed.select(*batch.columns).collect()) == sorted(batch.collect()) and not batch.isEmpty()
    assert streams.stream_message_counts(spark, sf).agg(F.sum("n_messages")).first()[0] == 28


def test_images_of_many_dates_are_few_files(spark, tmp_path):
    """Pixels that are dealt out by date to few partitions and split by size give a file per date and part."""
    id_ = F.col("id")
    orders = spark.range(800).select((id_ % 40 * 1440 + id_ / 40).cast("bigint").alias("o_orderkey"), (id_ % 90).alias("o_custkey"))
    orders.repartition(16).write.parquet(str(tmp_path / "orders"))
    rows = spark.readStream.schema(orders.schema).parquet(str(tmp_path / "orders")).repartition(16)
    images, areas, out = proxies.image_columns(rows), proxies.microareas(spark), tmp_path / "out"
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "32k")
    try:
        run_available(flows.image_layers(images, areas, str(out), str(tmp_path / "state")))
    finally:
        spark.conf.set(name, before)
    for layer, rows in (("silver", 20_000), ("gold", 800)):
        stored = spark.read.parquet(str(out / layer))
        assert stored.count() == rows and stored.select("year", "month", "day").distinct().count() == 40
        files = len(list((out / layer).rglob("*.parquet")))
        assert files <= 80, (layer, files)  # 40 dates
