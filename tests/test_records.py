import json

from hazardlake.sources import records, sinks

READING = {"station_id": "S1", "timestamp": "2024-01-01T00:00:01.000", "measurements": {"temperature_c": 40.0, "smoke_index": None}}


def raw(spark, *values):
    texts = [v if isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_sensor_records_are_routed(spark):
    no_block = {k: v for k, v in READING.items() if k != "measurements"}
    parsed = records.sensor_records(
        raw(spark, READING, "not json", no_block, {**READING, "timestamp": "soon"}, {**READING, "station_id": None},
            {**READING, "timestamp": "2024-01-01T00:00:01"}, {**READING, "measurements": {"temperature_c": "hot"}})
    )
    bad = {r.problem for r in records.quarantined(parsed).collect()}
    assert bad == {"malformed", "bad time", "missing station_id"}
    good = records.sensor_readings(parsed).collect()
    assert len(good) == 3 and sorted(r.temperature_c or 0 for r in good) == [0, 40.0, 40.0]
    assert all(r.smoke_index is None for r in good)
    assert records.quarantined(parsed).count() + len(good) == 7


def test_images_without_pixels_are_quarantined(spark):
    pixel = {"latitude": 1.0, "longitude": 2.0, "microarea_id": "A1-M1", "bands": {"B2": 0.1, "B8A": 0.2}}
    meta = {"timestamp": "2024-01-01T00:00:00.000", "microarea_id": "A1-M1", "macroarea_id": "A1"}
    parsed = records.image_records(
        raw(spark, {"image_pointer": "p", "metadata": {**meta, "satellite_data": [pixel]}},
            {"image_pointer": "q", "metadata": {**meta, "satellite_data": []}}, {"image_pointer": "r", "metadata": meta})
    )
    assert {r.problem for r in records.quarantined(parsed).collect()} == {"no pixels", "missing metadata.satellite_data"}
    row = records.images(parsed).first()
    assert row.pixels[0].b8a == 0.2 and row.pixels[0].b4 is None


def test_messages(spark):
    message = {"unique_msg_id": "m", "macroarea_id": "A1", "microarea_id": "M1", "text": "hi", "latitude": 1.0, "longitude": 2.0,
               "timestamp": "2024-01-01T00:00:00.000"}
    parsed = records.social_records(raw(spark, message, {**message, "text": None}, {**message, "unique_msg_id": None}))
    assert [r.message for r in records.social_messages(parsed).collect()] == ["hi", None]
    assert [r.problem for r in records.quarantined(parsed).collect()] == ["missing unique_msg_id"]


def test_payloads(spark):
    df = spark.createDataFrame([("k", [{"a": 1}, {"a": 2}])], "id string, items array<struct<a: int>>")
    assert [r.value for r in sinks.exploded_payload(df, "items", "id").collect()] == ['{"a":1}', '{"a":2}']
    assert sinks.json_payload(df.select("id"), "id").first() == ("k", '{"id":"k"}')
    with_null = spark.createDataFrame([("k", None)], "id string, level int")
    assert sinks.json_payload(with_null, "id").first() == ("k", '{"id":"k","level":null}')


def test_layers_are_partitioned_pruned_and_compacted(spark, tmp_path):
    from pyspark.sql import functions as F

    path, packed = str(tmp_path / "layer"), str(tmp_path / "packed")
    days = spark.range(60).select(F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 3 + 1).cast("int").alias("day"), "id")
    for _ in range(3):
        sinks.write_layer(days, path)
    one_day = spark.read.parquet(path).filter("year = 2024 AND day = 2 AND id > 5")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThan(id,5)" in plan
    sinks.compact_layer(spark.read.parquet(path), packed)
    assert spark.read.parquet(packed).count() == 180
    assert len(list((tmp_path / "packed").rglob("*.parquet"))) == 3
