import pytest
from pyspark.sql import functions as F

from hazardlake.constants import BANDS
from hazardlake.functions import spectral
from hazardlake.operators import imagery
from hazardlake.plans import proxies, satellite

from .conftest import SF

FIRE = dict(b2=0.15, b3=0.07, b4=0.35, b8=0.15, b8a=0.1, b11=0.25, b12=0.25)
GREEN = dict(b2=0.1, b3=0.2, b4=0.1, b8=0.4, b8a=0.2, b11=0.1, b12=0.1)
PIXEL = "struct<latitude: double, longitude: double, " + ", ".join(f"{b}: double" for b in BANDS) + ">"


def image(spark, *pixels):
    rows = [("img", "2024-01-01T00:00:00.000", "A1-M1", "A1", [(lat, lon, *bands.values()) for lat, lon, bands in pixels])]
    return spark.createDataFrame(
        rows, f"image_pointer string, timestamp string, microarea_id string, macroarea_id string, pixels array<{PIXEL}>"
    )


@pytest.mark.parametrize(
    "change,quick",
    [({}, True), ({"b11": 0.2}, True), ({"b11": 0.2, "b8": 0.3}, False), ({"b4": 0.0}, True), ({"b4": 0.0, "b11": 0.2}, False),
     ({"b4": 0.2}, True), ({"b4": 0.2, "b12": 0.2}, False)],
)
def test_quick_screen(one, change, quick):
    assert one({**GREEN, **change}, x=spectral.quick_screen()).x == quick


def test_fire_ranges_never_pass_the_screen(one):
    assert not one(FIRE, x=spectral.quick_screen()).x


def test_indices_and_zero_denominator(one):
    row = one({**FIRE, "b8": 0.0, "b4": 0.0}, **spectral.spectral_indices())
    assert row.ndvi == 0.0 and row.ndmi == -1.0 and row.ndwi == 1.0
    assert one({**GREEN, "b8": None}, **spectral.spectral_indices()).ndvi == -1.0
    assert one(FIRE, **spectral.spectral_indices()).ndvi == round((0.15 - 0.35) / 0.5, 4)


@pytest.mark.parametrize(
    "ndvi,ndmi,nbr,ndwi,expected",
    [(0.0, -0.2, -0.2, -0.1, (7, 170, "high")), (0.3, 0.1, 0.2, 0.0, (0, 0, "normal")), (0.2, 0.0, 0.3, 0.1, (2, 45, "low")),
     (0.05, 0.3, 0.3, -0.1, (3, 70, "medium")), (0.2, 0.2, 0.1, 0.1, (2, 40, "low")), (0.2, 0.2, 0.3, -0.1, (2, 35, "normal"))],
)
def test_fire_class(one, ndvi, ndmi, nbr, ndwi, expected):
    values = {"ndvi": ndvi, "ndmi": ndmi, "nbr": nbr, "ndwi": ndwi}
    signs, points = spectral.fire_signs(), spectral.fire_points()
    assert one(values, k=signs, s=points, l=spectral.fire_level(signs, points)) == expected


def assessed(spark, *pixels):
    return satellite.message_scene_stage(image(spark, *pixels)).first()


def test_single_pixel_spreads_over_one_pixel_area(spark):
    row = assessed(spark, (38.0, -122.0, FIRE), (38.1, -122.1, GREEN))
    assert row.geographic_spread_km2 == 20.0 and row.cluster_density == 0.05 and row.hotspot_concentration_percent == 50.0


def test_collinear_pixels_have_no_density(spark):
    row = assessed(spark, (38.0, -122.0, FIRE), (38.0, -122.1, FIRE))
    assert row.geographic_spread_km2 == 0.0 and row.cluster_density == 0.0


def test_quiet_image_gets_the_constant_assessment(spark):
    row = assessed(spark, (38.0, -122.0, GREEN))
    assert (row.risk_level, row.threat.level, row.severity_score) == ("none", "NORMAL", 0.0)
    assert row.vegetation_status == row.fire_weather_level == "unknown" and len(row.advice) == 2 and row.confidence_level == 95.0


def test_floor_lifts_only_anomalous_images(spark):
    weak = satellite.message_scene_stage(image(spark, (38.0, -122.0, {**GREEN, "b8": 0.29, "b11": 0.3}), *[(38.0, -122.0, GREEN)] * 30), 0.8)
    assert weak.first().risk_level == "extreme"
    assert satellite.message_scene_stage(image(spark, (38.0, -122.0, GREEN)), 0.8).first().severity_score == 0.0


def test_image_without_pixels_gives_no_rows(spark):
    empty = image(spark)
    assert imagery.explode_pixels(empty).count() == 0
    assert satellite.array_scene_stage(empty).count() == 0


def test_array_and_row_forms_agree(spark):
    images = proxies.image_messages(spark, SF)
    rows = {r.image_pointer: r for r in satellite.message_scene_stage(images).collect()}
    arrays = {r.image_pointer: r for r in satellite.array_scene_stage(images).collect()}
    assert rows.keys() == arrays.keys() and all(rows[k].asDict() == arrays[k].asDict() for k in rows)


def test_classified_arrays_equal_classified_rows(spark):
    images = proxies.image_messages(spark, SF).limit(50)
    a = imagery.explode_pixels(imagery.classify_pixel_array(images))
    b = imagery.classify_pixels(imagery.explode_pixels(images)).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_repeated_delivery_is_not_merged(spark):
    one_image = image(spark, (38.0, -122.0, FIRE))
    assert [r.total_pixels for r in satellite.message_scene_stage(one_image.union(one_image)).collect()] == [1, 1]


def test_gold_and_silver_widths(spark):
    images = image(spark, (38.0, -122.0, FIRE))
    area = spark.createDataFrame([("A1-M1", 1.0, 2.0, 3.0, 4.0)], "microarea_id string, min_long double, min_lat double, max_long double, max_lat double")
    gold = satellite.gold_stage(satellite.message_scene_stage(images), area)
    assert len(gold.columns) == 58 + 3  # response_timestamp is the sink's
    pixels = imagery.classify_pixels(imagery.explode_pixels(images)).join(area, "microarea_id")
    assert len(imagery.silver_pixels(pixels).columns) == 26 + 3


def test_stress_and_weather_levels(one):
    stress = spectral.environmental_stress(F.lit("stressed"), F.lit("dry"))
    row = one({"a": 21.0, "b": 31.0}, s=stress, w=spectral.fire_weather_level(F.col("a"), F.col("b")))
    assert row == ("critical", "extreme")


def test_exploded_arrays_are_computed_once(spark):
    """A plain explode of a computed array gets a filter below it that computes the array again."""
    images = spark.range(3).select("id", F.expr("transform(sequence(0, 3), i -> named_struct('b2', i + id))").alias("pixels"))
    empty = spark.sql("SELECT 7L AS id, CAST(array() AS array<struct<b2: bigint>>) AS pixels UNION ALL SELECT 8L, NULL UNION ALL SELECT 9L, array(NULL)")
    rows = imagery.explode_pixels(images)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("transform(") == 1
    assert rows.count() == 12
    assert [tuple(r) for r in imagery.explode_pixels(empty).collect()] == [(9, None)]


def test_array_metrics_are_one_fold_above_the_spread(spark):
    """A filter by the size of a computed array goes down to the scan, and takes the array along."""
    plan = satellite.gold_sat_from_arrays(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1, plan
    above, below = plan.split("Repartition", 1)[0], plan.rsplit("Repartition", 1)[1].split("Relation")[0]
    assert "transform(" in above and "b8a" not in below, plan


def test_array_and_row_forms_agree_on_missing_bands(spark):
    rows = [
        (38.0, -122.0, {**FIRE, "b8a": None, "b11": None}), (38.2, -122.1, {**GREEN, "b2": None}), (38.1, None, FIRE),
        (38.3, -122.3, dict.fromkeys(FIRE)), (38.4, -122.2, GREEN),
    ]
    images = image(spark, *rows).union(image(spark, *rows[1:2])).union(image(spark)).union(image(spark, rows[3]))
    arrays = satellite.array_scene_stage(images).collect()
    assert sorted(map(str, arrays)) == sorted(map(str, satellite.message_scene_stage(images).collect()))
    assert sorted(r.total_pixels for r in arrays) == [1, 1, 5]
