import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hazardlake.constants import AREA_MEASUREMENTS, MEASUREMENTS
from hazardlake.functions import sensor_rules as rules
from hazardlake.functions.numeric import round_to
from hazardlake.functions.timefmt import parse_iso
from hazardlake.operators import dims, sensors

NORMAL = dict(zip(MEASUREMENTS, (20.0, 50.0, 400.0, 5.0, 10.0, 0.1, 3.5)))
DOUBLES = ", ".join(f"{name} double" for name in MEASUREMENTS)


def reading(station, second, **changed):
    return (station, dt.datetime(2024, 1, 1, 0, 0, second), *{**NORMAL, **changed}.values())


def readings(spark, rows):
    return spark.createDataFrame(rows, f"station_id string, ts timestamp, {DOUBLES}")


@pytest.mark.parametrize("field,limit", [("temperature_c", 35.0), ("humidity_percent", 80.0), ("battery_voltage", 3.7)])
def test_threshold_is_strict(one, field, limit):
    assert not one({**NORMAL, field: limit}, x=rules.exceeds_any()).x
    assert one({**NORMAL, field: limit + 0.01}, x=rules.exceeds_any()).x


def test_missing_field_is_ignored_and_direction_is_a_parameter(one):
    row = one({**NORMAL, "smoke_index": None}, x=rules.exceeds_any(), dry=rules.exceeds_any({"humidity_percent": 60.0}, ["humidity_percent"]))
    assert not row.x and row.dry


def test_exceeded_map(one):
    row = one({**NORMAL, "temperature_c": 40.0, "co2_ppm": 601.0, "smoke_index": None}, m=rules.exceeded_map())
    assert row.m == {"temperature_c": 40.0, "co2_ppm": 601.0}


@pytest.mark.parametrize("value,digits,expected", [(0.125, 2, 0.12), (2.5, 0, 2.0), (0.285, 2, 0.28), (1.005, 2, 1.0), (16.655, 2, 16.66)])
def test_round_half_even(one, value, digits, expected):
    assert one({"v": value}, x=round_to(F.col("v"), digits)).x == expected


def severity(one, r, **means):
    values = {name: means.get(name) for name in AREA_MEASUREMENTS}
    columns = {name: F.col(name) for name in values}
    return one({"r": r, **values}, s=rules.sensor_severity(F.col("r"), columns, F.lit(6))).s


@pytest.mark.parametrize("r", [0.01, 0.04, 0.05, 0.1, 0.25, 0.3125, 0.5, 1.0])
def test_severity_without_extremes(one, r):
    expected = 0.4 * (1 - math.exp(-5 * r)) if r < 0.05 else 3.2 * r
    assert severity(one, r) == pytest.approx(min(round(expected, 2), 1.0), abs=1e-9)


def test_severity_with_extremes(one):
    means = {n: F.lit(v) for n, v in zip(AREA_MEASUREMENTS, (40.0, 20.0, 700.0, 30.0, 30.0, 0.5))}
    worst = {n: F.lit(v) for n, v in zip(AREA_MEASUREMENTS, (50.0, 10.0, 900.0, 60.0, 40.0, 1.0))}
    got = one({"r": 0.04}, s=rules.sensor_severity(F.col("r"), means, F.lit(6), worst)).s
    q = (40 / 50 * 1.3 + (1 - 20 / 10) * 1.5 + 700 / 900 + 30 / 60 + 30 / 40 + 0.5) / 6
    base = 0.4 * (1 - math.exp(-0.2)) + 0.6 * q
    boost = 0.3 * max(0.3, 1 - 0.04 / 0.6)  # hot and smoky
    assert got == pytest.approx(round(min(base * (1 + boost), 1.0), 2))


@pytest.mark.parametrize("s,level", [(0.2, "green"), (0.21, "yellow"), (0.4, "yellow"), (0.6, "orange"), (0.8, "deep_orange"), (0.81, "red")])
def test_alert_levels(one, s, level):
    assert one({"s": s}, x=rules.alert_level(F.col("s"))).x == level


@pytest.mark.parametrize("pm,co2,index,label", [(0.0, 400.0, 50.0, "Good"), (12.0, 600.0, 101.0, "Unhealthy for Sensitive Groups"),
                                                (1000.0, 9000.0, 500.0, "Hazardous"), (None, 500.0, None, "Unknown")])
def test_air_quality(one, pm, co2, index, label):
    row = one({"p": pm, "c": co2}, i=rules.air_quality_index(F.col("p"), F.col("c")))
    assert row.i == index
    assert one({"i": index}, x=rules.air_quality_label(F.col("i"))).x == label


@pytest.mark.parametrize("t,h,rate,speed", [(30.0, 30.0, "slow", 1.5), (40.0, 20.0, "moderate", 3.0), (40.0, 10.0, "rapid", 7.5), (40.0, 0.5, "extreme", 80.0)])
def test_fire_behavior(one, t, h, rate, speed):
    factor = rules.spread_factor(F.col("t"), F.col("h"))
    row = one({"t": t, "h": h}, r=rules.spread_rate(factor), s=rules.spread_speed_mph(factor))
    assert (row.r, row.s) == (rate, speed)


def test_fire_behavior_needs_both(one):
    factor = rules.spread_factor(F.col("t"), F.col("h"))
    assert one({"t": 30.0, "h": None}, r=rules.spread_rate(factor), s=rules.spread_speed_mph(factor)) == (None, None)


def test_ignition_time(one):
    row = one({"ms": 1704067200000, "s": 0.5}, x=rules.ignition_time(F.col("ms"), F.col("s")))
    assert row.x == "2023-12-31T23:40:00.000"


def test_iso_text(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:01.250",), ("2024-01-01T00:00:01",), ("soon",)], "t string")
    got = [row.x for row in rows.select(parse_iso(F.col("t")).alias("x")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 1, 250000), dt.datetime(2024, 1, 1, 0, 0, 1), None]


def stations_dim(spark, ids):
    rows = [(i, "A1-M1", 38.7, -122.0, dt.date(2020, 1, 2), "FX", "t", "h", "c", "p", "s", "i", 100.0, "solar") for i in ids]
    return spark.createDataFrame(
        rows,
        "station_id string, microarea_id string, latitude double, longitude double, install_date date, model string, temp_sens string,"
        " hum_sens string, co2_sens string, pm25_sens string, smoke_sens string, ir_sens string, elevation_m double, battery_type string",
    )


def test_window_means_cover_only_alarming_readings(spark):
    rows = [reading("a", 1), reading("a", 2, temperature_c=40.0), reading("a", 3, temperature_c=41.01, smoke_index=None), reading("b", 9)]
    got = {r.station_id: r for r in sensors.station_windows(readings(spark, rows)).collect()}
    a = got["a"]
    assert a.is_anomaly and a.n_readings == 3 and a.temperature_c == 40.5 and a.smoke_index == 10.0
    assert a.latest_event_ts == dt.datetime(2024, 1, 1, 0, 0, 3)
    assert not got["b"].is_anomaly and got["b"].temperature_c is None


def area_rows(spark, rows, known):
    enriched = dims.enrich_stations(sensors.station_windows(readings(spark, rows)), stations_dim(spark, known))
    return enriched, sensors.scored_areas(sensors.area_windows(enriched))


def test_unknown_station_defaults_and_area(spark):
    enriched, scored = area_rows(spark, [reading("a", 1), reading("x", 2, temperature_c=50.0)], ["a"])
    rows = {r.station_id: r for r in enriched.collect()}
    assert rows["x"].microarea_id == rows["x"].station_model == "UNKNOWN" and rows["x"].temp_sens is None
    assert rows["a"].maintenance_status == "operational" and rows["x"].maintenance_status == "unknown"
    areas = {r.microarea_id: r for r in scored.collect()}
    assert areas["UNKNOWN"].severity_score == 1.0 and areas["UNKNOWN"].alert_level == "red"
    assert areas["A1-M1"].severity_score == 0.0 and areas["A1-M1"].alert_level is None


def test_quiet_events_reach_gold_with_null_response(spark):
    _, scored = area_rows(spark, [reading("a", 1), reading("b", 2)], ["a", "b"])
    row = sensors.flat_events(sensors.area_events(scored)).first()
    assert row.event_type == "normal" and row.pop_center_name is None and row.fire_spread_rate is None and row.automated
    assert len(row.asDict()) == 49 + 3


def test_silver_layout_widths(spark):
    enriched, _ = area_rows(spark, [reading("a", 1)], ["a"])
    assert len(sensors.silver_normal(enriched).columns) == 19 + 3
    assert len(sensors.silver_anomalies(enriched).columns) == 29 + 3


@pytest.mark.parametrize("page_size,pages", [(100, 1), (4, 3)])
def test_station_pages_hold_every_station_once(spark, page_size, pages):
    ids = [f"s{i:02d}" for i in range(12)]
    enriched, scored = area_rows(spark, [reading(i, 1, temperature_c=50.0) for i in ids], ids)
    rows = sensors.event_station_pages(scored, enriched, page_size).collect()
    assert sorted(s.station_id for row in rows for s in row.stations) == ids
    assert {row.pages for row in rows} == {pages}


def test_event_ids_repeat_and_directions_follow(spark):
    _, scored = area_rows(spark, [reading("a", 1, temperature_c=50.0)], ["a"])
    events = sensors.flat_events(sensors.area_events(scored))
    first, again = events.first(), events.first()
    assert first == again and first.event_id.startswith("A1-M1_1704067260000_") and first.fire_direction is not None
