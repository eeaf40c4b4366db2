"""Pixels -> classified pixels -> scene assessment.

Every scene metric is written once against a small ``count/mean/min/max`` interface and evaluated
either as grouped aggregates over pixel rows (batch: one exchange, partial aggregation, no image is
ever gathered) or over the pixel array inside one message (streams: no state and no exchange).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.constants import BANDS, INDICES, KM_PER_DEGREE, PIXEL_AREA_KM2
from hazardlake.functions import spectral
from hazardlake.functions.numeric import ratio, round_to, snap
from hazardlake.functions.spectral import Pixel, row_pixel
from hazardlake.functions.timefmt import date_parts, parse_iso

INDICATORS = [
    "high_temperature_signatures",
    "vegetation_stress_detected",
    "moisture_deficit_areas",
    "burn_scar_indicators",
    "smoke_signatures",
]


# ------------------------------------------------------------------ pixels
def classify_pixels(pixels: DataFrame) -> DataFrame:
    """Adds the screen result, indices (NULL when screened out) and class columns to pixel rows."""
    screened = pixels.withColumn("quick_ok", spectral.quick_screen())
    indices = spectral.spectral_indices()
    indexed = screened.select("*", *[F.when(~F.col("quick_ok"), indices[name]).alias(name) for name in INDICES])
    signed = indexed.withColumn("signs", spectral.fire_signs()).withColumn("points", spectral.fire_points())
    classes = spectral.classified(F.col("quick_ok"), F.col("signs"), F.col("points"))
    return signed.select("*", *[expr.alias(name) for name, expr in classes.items()]).drop("signs", "points")


def classify_pixel_array(images: DataFrame, pixels: str = "pixels") -> DataFrame:
    """The same classification inside an array of pixel structs (``latitude, longitude, b2..b12``)."""

    def with_fields(array: Column, build: Callable[[Column], dict[str, Column]]) -> Column:
        def extend(row: Column) -> Column:
            for name, value in build(row).items():
                row = row.withField(name, value)
            return row

        return F.transform(array, extend)

    def indexed(row: Column) -> dict[str, Column]:
        quick = row["quick_ok"]
        return {name: F.when(~quick, value) for name, value in spectral.spectral_indices(lambda f: row[f]).items()}

    def tested(row: Column) -> dict[str, Column]:
        quick = row["quick_ok"]  # a screened pixel's class needs neither
        return {
            "signs": F.when(~quick, spectral.fire_signs(lambda f: row[f])),
            "points": F.when(~quick, spectral.fire_points(lambda f: row[f])),
        }

    array = F.col(pixels)
    array = with_fields(array, lambda row: {"quick_ok": spectral.quick_screen(lambda f: row[f])})
    array = with_fields(array, indexed)
    array = with_fields(array, tested)
    array = with_fields(array, lambda row: spectral.classified(row["quick_ok"], row["signs"], row["points"]))
    array = F.transform(array, lambda row: row.dropFields("signs", "points"))
    return images.withColumn(pixels, array)


def explode_pixels(images: DataFrame, pixels: str = "pixels") -> DataFrame:
    """One row per pixel; an image without pixels gives no row.

    A plain explode would get a ``size(array) > 0`` filter below it, which computes a computed array twice.
    """
    kept = [name for name in images.columns if name != pixels]
    rows = images.select(*kept, F.posexplode_outer(pixels).alias("_position", "_pixel"))
    return rows.filter("_position IS NOT NULL").select(*kept, "_pixel.*")


def silver_pixels(pixels: DataFrame) -> DataFrame:
    """Classified, area-enriched pixels in the 26-column layout plus date parts."""
    return pixels.withColumn("_ts", parse_iso(F.col("timestamp"))).select(
        "image_pointer",
        "timestamp",
        "microarea_id",
        "macroarea_id",
        F.col("min_long").alias("min_longitude"),
        F.col("min_lat").alias("min_latitude"),
        F.col("max_long").alias("max_longitude"),
        F.col("max_lat").alias("max_latitude"),
        "latitude",
        "longitude",
        *[F.col(name).alias(f"band_{name.upper()}") for name in BANDS],
        "classification_status",
        "scene_class",
        "classification_level",
        "classification_confidence",
        "processing_type",
        *[F.coalesce(F.col(name), F.lit(0.0)).alias(name) for name in INDICES],
        *date_parts(F.col("_ts")),
    )


# ------------------------------------------------------------------ scene metrics
class RowScene:
    """Metrics as aggregate functions over pixel rows."""

    def __init__(self, test: Callable[[Pixel], Column] | None = None):
        self._test = test

    def where(self, test: Callable[[Pixel], Column]) -> RowScene:
        """The metrics of the pixels that pass a test."""
        return RowScene(test)

    def _chosen(self, value: Callable[[Pixel], Column]) -> Column:
        return value(row_pixel) if self._test is None else F.when(self._test(row_pixel), value(row_pixel))

    def count(self, test: Callable[[Pixel], Column] | None = None) -> Column:
        tests = [t(row_pixel) for t in (self._test, test) if t is not None]
        return F.count_if(reduce(and_, tests)) if tests else F.count(F.lit(1))

    def mean(self, value: Callable[[Pixel], Column]) -> Column:
        return snap(F.avg(self._chosen(value)))

    def low(self, value: Callable[[Pixel], Column]) -> Column:
        return F.min(self._chosen(value))

    def high(self, value: Callable[[Pixel], Column]) -> Column:
        return F.max(self._chosen(value))


class ArrayScene:
    """Metrics as one fold over an array column of pixel structs.

    ``fold`` keeps the sums, counts and bounds of every metric asked for so far in one struct, the metrics read that
    struct, as column ``FOLD``. Lambdas are interpreted, so a pixel is looked at once, and what only
    concerns the pixels of ``where`` is left out for the others.
    """

    FOLD = "_fold"

    def __init__(self, pixels: str = "pixels"):
        self._array = F.col(pixels)
        self._parts: list[_Part] = []
        self._all = self.where(None)
        self.count, self.mean, self.low, self.high = self._all.count, self._all.mean, self._all.low, self._all.high

    def where(self, test: Callable[[Pixel], Column] | None) -> _Part:
        """The metrics of the pixels that pass a test."""
        self._parts.append(_Part(F.col(self.FOLD)[f"p{len(self._parts)}"], test))
        return self._parts[-1]

    def fold(self) -> Column:
        def merge(acc: Column, row: Column) -> Column:
            return F.struct(*[part.merged(acc[f"p{i}"], lambda f: row[f]).alias(f"p{i}") for i, part in enumerate(self._parts)])

        return F.aggregate(self._array, F.struct(*[part.start().alias(f"p{i}") for i, part in enumerate(self._parts)]), merge)


class _Part:
    """The fields of a fold that concern the pixels of one test."""

    def __init__(self, result: Column, test: Callable[[Pixel], Column] | None):
        self._result, self._test = result, test
        self._starts: list[Column] = []
        self._steps: list[Callable[[Column, Pixel], Column]] = []

    def _field(self, start: Column, step: Callable[[Column, Pixel], Column]) -> Column:
        """The end value of a new field; ``step`` gives its next value from the last one and a pixel."""
        self._starts.append(start)
        self._steps.append(step)
        return self._result[f"f{len(self._starts) - 1}"]

    def start(self) -> Column:
        return F.struct(*[value.alias(f"f{i}") for i, value in enumerate(self._starts)])

    def merged(self, acc: Column, pixel: Pixel) -> Column:
        after = F.struct(*[step(acc[f"f{i}"], pixel).alias(f"f{i}") for i, step in enumerate(self._steps)])
        return after if self._test is None else F.when(self._test(pixel), after).otherwise(acc)

    def count(self, test: Callable[[Pixel], Column] | None = None) -> Column:
        one = F.lit(1).cast("bigint")
        return self._field(F.lit(0).cast("bigint"), lambda n, p: n + one if test is None else F.when(test(p), n + one).otherwise(n))

    def mean(self, value: Callable[[Pixel], Column]) -> Column:
        def chosen(p: Pixel) -> Column:
            return value(p).cast("double")

        total = self._field(F.lit(0.0), lambda s, p: F.coalesce(s + chosen(p), s))
        n = self._field(F.lit(0), lambda n, p: F.when(chosen(p).isNull(), n).otherwise(n + 1))
        return snap(ratio(total, n, when_zero=None))

    def low(self, value: Callable[[Pixel], Column]) -> Column:
        return self._field(F.lit(None).cast("double"), lambda least, p: F.least(least, value(p)))

    def high(self, value: Callable[[Pixel], Column]) -> Column:
        return self._field(F.lit(None).cast("double"), lambda most, p: F.greatest(most, value(p)))


def _analysed(p: Pixel) -> Column:
    """A pixel counts as anomalous when it was analysed at all, whatever class it got."""
    return ~p("quick_ok")


def scene_metrics(scene: RowScene | ArrayScene) -> dict[str, Column]:
    """Every base metric of an image."""
    analysed = scene.where(_analysed)
    metrics = {
        "total_pixels": scene.count(),
        "anomalous_pixels": analysed.count(),
        "mean_confidence": scene.mean(
            lambda p: F.coalesce(p("classification_confidence"), F.lit(spectral.QUICK_SCREEN_CONFIDENCE))
        ),
    }
    for name in INDICATORS:
        metrics[name] = analysed.count(lambda p, n=name: spectral.indicator_tests(p)[n])
    for name in BANDS:
        metrics[f"anom_{name}"] = analysed.mean(lambda p, n=name: p(n))
        metrics[f"all_{name}"] = scene.mean(lambda p, n=name: p(n))
    for name in INDICES:
        metrics[f"mean_{name}"] = analysed.mean(lambda p, n=name: p(n))
    metrics["healthy_pixels"] = analysed.count(lambda p: p("ndvi") > 0.2)
    metrics["dry_pixels"] = analysed.count(lambda p: p("ndmi") < -0.1)
    for name in ("latitude", "longitude"):
        coordinate = lambda p, n=name: F.coalesce(p(n), F.lit(0.0))
        metrics[f"min_{name}"] = analysed.low(coordinate)
        metrics[f"max_{name}"] = analysed.high(coordinate)
    return metrics


def scenes_from_rows(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Base metrics per image from classified pixel rows."""
    return pixels.groupBy(*keys).agg(*[expr.alias(name) for name, expr in scene_metrics(RowScene()).items()])


def scenes_from_arrays(images: DataFrame, keys: list[str], pixels: str = "pixels") -> DataFrame:
    """Base metrics per image from unclassified pixel arrays, without state or exchange.

    An image without pixels gives no row. It is left out by the fold it does not have: a filter by the size of a
    computed array would go down to the scan and compute the array there too, in as few tasks as the file has. Lambdas are
    interpreted, so where an exchange is allowed ``scenes_from_messages`` is faster.
    """
    scene = ArrayScene(pixels)
    metrics = scene_metrics(scene)
    fold = F.when(F.size(pixels) > 0, scene.fold())
    folded = classify_pixel_array(images, pixels).select(*keys, F.explode_outer(F.array(fold)).alias(scene.FOLD))
    return folded.filter(F.col(scene.FOLD).isNotNull()).select(*keys, *[expr.alias(name) for name, expr in metrics.items()])


def classified_messages(images: DataFrame, pixels: str = "pixels") -> DataFrame:
    """Classified pixel rows of messages; ``message_no`` keeps repeated deliveries of an image apart."""
    numbered = images.withColumn("message_no", F.monotonically_increasing_id())
    return classify_pixels(explode_pixels(numbered, pixels))


def scenes_from_messages(images: DataFrame, keys: list[str], pixels: str = "pixels") -> DataFrame:
    """Base metrics per message from unclassified pixel arrays, exploded into generated code.

    A message's pixels stay in one task, so partial aggregation leaves one row per message for the
    exchange.
    """
    return scenes_from_rows(classified_messages(images, pixels), [*keys, "message_no"]).drop("message_no")


# ------------------------------------------------------------------ assessment
def assess_scenes(scenes: DataFrame, severity_floor: float | None = None) -> DataFrame:
    """Summary, spectral, spatial, environment, severity, threat and advice columns of every image."""
    col = F.col
    total, anomalous = col("total_pixels"), col("anomalous_pixels")
    normal = anomalous == 0

    def percent(part: Column, digits: int) -> Column:
        return round_to(ratio(part, total) * 100.0, digits)

    spread = F.when(
        anomalous > 1,
        (col("max_latitude") - col("min_latitude"))
        * (col("max_longitude") - col("min_longitude"))
        * float(KM_PER_DEGREE**2),
    ).otherwise(F.lit(float(PIXEL_AREA_KM2)))
    summary = scenes.select(
        "*",
        normal.alias("is_normal"),
        percent(anomalous, 2).alias("anomaly_percentage"),
        (anomalous * PIXEL_AREA_KM2).alias("affected_area_km2"),
        round_to(col("mean_confidence"), 1).alias("confidence_level"),
        *[F.coalesce(round_to(col(f"anom_{name}"), 3), F.lit(0.0)).alias(f"anomalous_{name}") for name in BANDS],
        *[F.coalesce(round_to(col(f"mean_{name}"), 3), F.lit(0.0)).alias(f"anomalous_{name}") for name in INDICES],
        *[F.coalesce(round_to(col(f"all_{name}"), 3), F.lit(0.0)).alias(f"scene_{name}") for name in BANDS],
        F.when(normal, 0.0).otherwise(snap(spread)).alias("spread_km2"),
        F.when(normal, "unknown").otherwise(spectral.vegetation_status(col("mean_ndvi"))).alias("vegetation_status"),
        F.when(normal, "unknown").otherwise(spectral.moisture_status(col("mean_ndmi"))).alias("moisture_status"),
        (ratio(col("high_temperature_signatures"), total) * 100.0).alias("_hot"),
        (ratio(col("moisture_deficit_areas"), total) * 100.0).alias("_moist"),
        (ratio(col("smoke_signatures"), total) * 100.0).alias("_smoke"),
    )
    environment = summary.select(
        "*",
        round_to(ratio(anomalous.cast("double"), col("spread_km2")), 4).alias("cluster_density"),
        round_to(col("spread_km2"), 2).alias("geographic_spread_km2"),
        percent(anomalous, 2).alias("hotspot_concentration_percent"),
        col("anomalous_ndvi").alias("average_ndvi"),
        round_to(ratio(col("healthy_pixels"), anomalous) * 100.0, 1).alias("healthy_vegetation_percent"),
        col("anomalous_ndmi").alias("average_ndmi"),
        col("anomalous_ndwi").alias("average_ndwi"),
        round_to(ratio(col("dry_pixels"), anomalous) * 100.0, 1).alias("dry_pixel_percent"),
        F.when(normal, "unknown").otherwise(spectral.fire_weather_level(col("_hot"), col("_moist"))).alias(
            "fire_weather_level"
        ),
        round_to(col("_hot"), 1).alias("temperature_signature_percent"),
        round_to(col("_moist"), 1).alias("moisture_deficit_percent"),
        round_to(col("_smoke"), 1).alias("smoke_detection_percent"),
        F.when(normal, "unknown")
        .otherwise(spectral.environmental_stress(col("vegetation_status"), col("moisture_status")))
        .alias("environmental_stress_level"),
    ).drop("_hot", "_moist", "_smoke")
    severity = spectral.scene_severity(
        total,
        anomalous,
        {name: col(f"anomalous_{name}") for name in [*BANDS, *INDICES]},
        {name: col(name) for name in INDICATORS},
        col("environmental_stress_level"),
        severity_floor,
    )
    scored = environment.withColumn("severity_score", F.when(normal, 0.0).otherwise(severity))
    return (
        scored.withColumn(
            "risk_level", F.when(normal, "none").otherwise(spectral.risk_level(col("severity_score")))
        )
        .withColumn("threat", spectral.threat(col("severity_score"), normal))
        .withColumn(
            "advice",
            spectral.recommendations(
                col("severity_score"),
                col("affected_area_km2"),
                col("moisture_deficit_areas"),
                col("smoke_signatures"),
                total,
                normal,
            ),
        )
    )


def flat_scenes(assessed: DataFrame) -> DataFrame:
    """Assessed, area-enriched images in the gold layout plus date parts.

    ``response_timestamp`` is the wall clock of the sink and is added there, not here.
    """
    return assessed.withColumn("_ts", parse_iso(F.col("timestamp"))).select(
        "image_pointer",
        F.col("timestamp").alias("event_timestamp"),
        "microarea_id",
        "macroarea_id",
        F.col("min_long").alias("min_longitude"),
        F.col("min_lat").alias("min_latitude"),
        F.col("max_long").alias("max_longitude"),
        F.col("max_lat").alias("max_latitude"),
        "total_pixels",
        "anomalous_pixels",
        "anomaly_percentage",
        "affected_area_km2",
        "confidence_level",
        *INDICATORS,
        *[f"anomalous_{name}" for name in [*BANDS, *INDICES]],
        *[f"scene_{name}" for name in BANDS],
        "vegetation_status",
        "average_ndvi",
        "healthy_vegetation_percent",
        "moisture_status",
        "average_ndmi",
        "average_ndwi",
        "dry_pixel_percent",
        "fire_weather_level",
        "temperature_signature_percent",
        "moisture_deficit_percent",
        "smoke_detection_percent",
        "environmental_stress_level",
        "severity_score",
        "risk_level",
        F.col("threat.level").alias("threat_level"),
        F.col("threat.priority").alias("threat_priority"),
        F.col("threat.evacuation_consideration").alias("evacuation_consideration"),
        F.col("threat.description").alias("threat_description"),
        "cluster_density",
        "geographic_spread_km2",
        "hotspot_concentration_percent",
        F.array_join("advice", ",").alias("recommendations"),
        *date_parts(F.col("_ts")),
    )
