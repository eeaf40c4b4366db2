import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardlake import schemas
from hazardlake.constants import CASE_STUDY_BBOX
from hazardlake.operators import dims, grid
from hazardlake.plans import proxies
from hazardlake.sources import tables

BOX = "min_long double, min_lat double, max_long double, max_lat double"


def region(spark):
    return spark.createDataFrame([("A1", *CASE_STUDY_BBOX)], f"macroarea_id string, {BOX}")


def test_case_study_has_63_areas_of_25_cells(spark):
    areas = grid.microarea_grid(region(spark), 500.0)
    assert areas.count() == 63
    tenth = areas.filter("microarea_id = 'A1-M10'")
    row = tenth.first()
    assert (row.min_long, row.max_long) == pytest.approx((-122.145996, -121.903076111111))
    assert (row.min_lat, row.max_lat) == pytest.approx((38.660406142857, 38.867223285714))
    cells = grid.labelled_cells(tenth.drop("macroarea_id"), 20.0)
    assert cells.count() == 25 and cells.filter("label = 'wildfire'").count() == 4  # rows 1..2, columns 1..2


def test_station_block_starts_earlier(spark):
    tenth = grid.microarea_grid(region(spark), 500.0).filter("microarea_id = 'A1-M10'").drop("macroarea_id")
    assert grid.labelled_cells(tenth, 20.0, first_row_share=0.17).filter("label = 'wildfire'").count() == 6


def brute_cell(spark, points):
    cells = grid.grid_cells(region(spark), 500.0).collect()
    found = {}
    for p in points:
        hits = [c.cell_no for c in cells if c.min_long <= p.longitude <= c.max_long and c.min_lat <= p.latitude <= c.max_lat]
        found[p.point_id] = min(hits) if hits else None
    return found


def test_points_on_edges_take_the_first_cell(spark):
    points = proxies.points(spark, "/root/testdata/sf0.001").withColumn("macroarea_id", F.lit("A1"))
    got = {r.point_id: r.cell_no for r in grid.locate_points(points, region(spark), 500.0, "macroarea_id").collect()}
    assert got == brute_cell(spark, points.collect())
    assert None in got.values()


def test_far_points_and_corners(spark):
    west, south, east, north = CASE_STUDY_BBOX
    rows = [(1, west, south), (2, east, north), (3, 0.0, 0.0), (4, west - 1e-9, south), (5, None, south)]
    points = spark.createDataFrame([(*r, "A1") for r in rows], "point_id int, longitude double, latitude double, macroarea_id string")
    got = {r.point_id: r.cell_no for r in grid.locate_points(points, region(spark), 500.0, "macroarea_id").collect()}
    assert got[1] == 1 and got[2] in (63, None) and got[3] is None and got[4] is None and got[5] is None


def test_only_polygons(spark):
    bad = spark.createDataFrame([(("Point", [[[1.0, 2.0]]]),)], "geometry struct<type: string, coordinates: array<array<array<double>>>>")
    with pytest.raises(Exception, match="not a polygon"):
        grid.polygon_bbox(bad, "geometry").collect()


def test_geojson_files(spark, tmp_path):
    boxes = region(spark).select(grid.bbox_polygon().alias("geometry"))
    path = str(tmp_path / "polygons")
    tables.write_geojson(boxes, "geometry", path)
    row = grid.polygon_bbox(tables.read_geojson(spark, path), "geometry").first()
    assert (row.min_long, row.min_lat, row.max_long, row.max_lat) == CASE_STUDY_BBOX
    ring = row.geometry.coordinates[0]
    assert len(ring) == 5 and ring[0] == ring[-1]


def test_upsert_inserts_overwrites_and_takes_the_last_write(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, name string, x double")
    new = spark.createDataFrame([(2, None, 5.0, 1), (3, "c", 3.0, 1), (3, "d", 4.0, 2)], "id int, name string, x double, seq int")
    got = sorted(tuple(r) for r in dims.upsert(old, new, ["id"], "seq").collect())
    assert got == [(1, "a", 1.0), (2, None, 5.0), (3, "d", 4.0)]


def test_key_values_keep_nulls(spark):
    row = (  # a station without an install date
        "S1", "A1-M1", 38.5, -122.0, None, "FX", "t", "h", "c", "p", "s", "i", 10.0, "solar", "active")
    station = spark.createDataFrame([row], schemas.ddl(schemas.STATIONS))
    got = dims.station_key_values(station).first()
    assert got.key == "station:S1" and '"install_date":null' in got.value
    area = spark.createDataFrame([("A1-M1", 1.0, 2.0, 3.0, 4.0)], f"microarea_id string, {BOX}")
    assert dims.microarea_key_values(area).first() == ("microarea:A1-M1", '{"min_long":1.0,"min_lat":2.0,"max_long":3.0,"max_lat":4.0}')


def test_unknown_area_gives_nulls_and_ids_are_qualified(spark):
    msg = spark.createDataFrame([("A1", "M10"), ("A1", "M77")], "macroarea_id string, m string").withColumn(
        "microarea_id", dims.qualified_area(F.col("macroarea_id"), F.col("m"))
    )
    got = {r.m: r.min_long for r in dims.enrich_microareas(msg, proxies.case_study_grid(spark).drop("macroarea_id")).collect()}
    assert got["M10"] == pytest.approx(-122.145996) and got["M77"] is None


def test_catalogue_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_test")
    try:
        schemas.create_tables(spark, "lake_test")
        assert set(schemas.create_tables(spark, "lake_test")) == {t.name for t in spark.catalog.listTables("lake_test")}
        assert len(spark.table("lake_test.meteo_hist").columns) == 24
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


def test_csv_is_typed_and_strict(spark, tmp_path):
    schema = {"d": "date", "x": "double", "n": "int"}
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("d,x,n\n2024-01-02,1.5,3\n")
    bad.write_text("d,x,n\n2024-01-02,wet,3\n")
    assert tables.read_csv(spark, str(good), schema).first() == (dt.date(2024, 1, 2), 1.5, 3)
    with pytest.raises(Exception):
        tables.read_csv(spark, str(bad), schema).collect()
