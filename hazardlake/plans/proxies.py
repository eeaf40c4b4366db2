"""Hazard-monitoring views derived, by expressions only, from the TPC-H-like test tables."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import ALL_CATEGORIES, CASE_STUDY_BBOX, FEATURES, MICROAREA_KM2, SENSOR_MODELS
from hazardlake.operators.grid import microarea_grid
from hazardlake.session import use_utc

IOT_WINDOW = "6 hours"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Rows that a task of heavy per-row work should have at least and at most, and tasks from which cores are busy.
SPREAD_LEAST, SPREAD_MOST, SPREAD_TASKS = 500, 100_000, 32
#: Texts that a task should have at most: it counts their terms in memory.
TEXTS_MOST = 10_000


def spread_tasks(spark: SparkSession, sf_dir: str, name: str, most: int = SPREAD_MOST) -> int:
    """Tasks for heavy per-row work on a table: enough for all cores, more for large tables, few for small ones.

    ``spark.hazardlake.spreadTasks`` sets another number.
    """
    fixed = spark.conf.get("spark.hazardlake.spreadTasks", None)
    if fixed:
        return int(fixed)
    rows = table(spark, sf_dir, name).count()  # from the files' footers
    wanted = max(SPREAD_TASKS, 3 * spark.sparkContext.defaultParallelism, rows // most)
    return max(1, min(wanted, rows // SPREAD_LEAST))


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for heavy per-row work (pixels, texts), spread over ``spread_tasks``.

    A file of few row groups is few tasks however many cores wait, so the rows of the table are dealt out first; they
    are small against what is computed from them.
    """
    return table(spark, sf_dir, name).repartition(spread_tasks(spark, sf_dir, name))


def spread_texts(spark: SparkSession, sf_dir: str, texts: DataFrame, name: str, key: str) -> DataFrame:
    """Texts (all or most of them of table ``name``) spread by their key.

    A text's terms then stay in its task: they are counted, weighted and scored there, and no row per term travels.
    """
    return texts.repartition(spread_tasks(spark, sf_dir, name, TEXTS_MOST), key)


def _station_id(user: Column) -> Column:
    text = user.cast("string")
    number = F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0"))
    return F.concat(F.lit("S_"), _user_area(user), F.lit("_"), number)


def _user_area(user: Column) -> Column:
    return F.concat(F.lit("A1-M"), (user % 9 + 1).cast("string"))


def reading_columns() -> list[Column]:
    """Sensor columns computed from one ``events`` row; also used on the streaming source."""
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("value")
    return [
        F.col("event_id").alias("reading_id"),
        _station_id(F.col("user_id")).alias("station_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (value * 0.25 + 15.0).alias("temperature_c"),
        (F.lit(85.0) - k * 0.75).alias("humidity_percent"),
        (value * 2.5 + 380.0).alias("co2_ppm"),
        (value * 0.1 + 2.0).alias("pm25_ugm3"),
        F.when(F.col("event_type") != "signup", k * 0.21).alias("smoke_index"),
        F.when(F.col("event_type") != "error", value / 500.0).alias("infrared_intensity"),
        (k * 0.003 + 3.4).alias("battery_voltage"),
    ]


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*reading_columns())


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per reporting station except every tenth, which stays unknown to the dimension."""
    users = table(spark, sf_dir, "events").select("user_id").filter("user_id % 10 <> 0").distinct()
    user = F.col("user_id")
    models = F.array(*[F.lit(name) for name in ("FX-1", "FX-2", "GS-7", "GS-9", "TR-3")])
    return users.select(
        _station_id(user).alias("station_id"),
        _user_area(user).alias("microarea_id"),
        (F.lit(38.66) + (user % 25) * 0.008).alias("latitude"),
        (F.lit(-122.14) + (user % 23) * 0.009).alias("longitude"),
        F.date_add(F.lit("2020-01-01").cast("date"), (user % 365).cast("int")).alias("install_date"),
        F.element_at(models, (user % 5 + 1).cast("int")).alias("model"),
        *[F.concat(F.lit(f"{name}-v"), (user % 3).cast("string")).alias(name) for name in SENSOR_MODELS],
        (F.lit(50.0) + user % 750).alias("elevation_m"),
        F.when(user % 2 == 0, "lithium").otherwise("solar").alias("battery_type"),
        F.lit("active").alias("status"),
    )


def case_study_grid(spark: SparkSession) -> DataFrame:
    """The 63 areas of the case-study region."""
    region = spark.range(1).select(
        F.lit("A1").alias("macroarea_id"),
        *[
            F.lit(value).alias(name)
            for name, value in zip(("min_long", "min_lat", "max_long", "max_lat"), CASE_STUDY_BBOX)
        ],
    )
    return microarea_grid(region, MICROAREA_KM2)


def microareas(spark: SparkSession) -> DataFrame:
    """The area dimension; ``A1-M9`` is left out so that it misses."""
    return case_study_grid(spark).filter("microarea_id <> 'A1-M9'")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reflectance pixel per ``lineitem`` row; eight orders share an image."""
    items = spread_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_discount",
        "l_tax",
        F.expr("l_orderkey div 8").alias("image_id"),
        (F.col("l_partkey") % 11 == 0).alias("fire"),
    )

    def split(fire: Column, other: Column) -> Column:
        return F.when(F.col("fire"), fire).otherwise(other)

    tax, discount, quantity = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity")
    supplier, order = F.col("l_suppkey") % 100, F.col("l_orderkey") % 100
    image = F.col("image_id")
    area = F.concat(F.lit("A1-M"), (image % 9 + 1).cast("string"))
    return items.select(
        "image_id",
        F.concat(F.lit("satellite/"), area, F.lit("/img_"), image.cast("string"), F.lit(".jpg")).alias("image_pointer"),
        F.date_format(
            F.timestamp_seconds(F.lit(1704067200) + image * 60), "yyyy-MM-dd'T'HH:mm:ss.SSS"
        ).alias("timestamp"),
        area.alias("microarea_id"),
        F.lit("A1").alias("macroarea_id"),
        (F.lit(38.66) + (F.col("l_partkey") % 25) * 0.008).alias("latitude"),
        (F.lit(-122.14) + (F.col("l_suppkey") % 25) * 0.009).alias("longitude"),
        (F.lit(0.05) + (F.col("l_linenumber") % 4) * 0.05).alias("b2"),
        split(F.lit(0.05) + quantity / 1000.0, F.lit(0.1) + quantity / 250.0).alias("b3"),
        split(F.lit(0.3) + tax, F.lit(0.05) + tax * 1.875).alias("b4"),
        split(F.lit(0.1) + discount, F.lit(0.3) + discount * 2.0).alias("b8"),
        (F.lit(0.05) + (F.col("l_partkey") % 5) * 0.05).alias("b8a"),
        split(F.lit(0.2) + supplier / 1000.0, F.lit(0.05) + supplier / 500.0).alias("b11"),
        split(F.lit(0.2) + order / 1000.0, F.lit(0.05) + order / 500.0).alias("b12"),
    )


def image_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all orders. The coalesce keeps every partition; it ends the generated code of the arrays, which is long."""
    tasks = spread_tasks(spark, sf_dir, "orders")
    return image_columns(table(spark, sf_dir, "orders").repartition(tasks)).coalesce(tasks)


def image_columns(orders: DataFrame) -> DataFrame:
    """One message with an array of 25 pixels per ``orders`` row, as the imaging service sends them."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")

    def pixel(i: Column) -> Column:
        seed = (customer * 7 + i * 31 + order) % 97
        fire = (seed % 11) == 0
        return F.struct(
            (F.lit(38.66) + (i % 5) * 0.04).alias("latitude"),
            (F.lit(-122.14) + (i / 5).cast("int") * 0.05).alias("longitude"),
            (F.lit(0.05) + (seed % 4) * 0.05).alias("b2"),
            F.when(fire, F.lit(0.05) + seed / 2000.0).otherwise(F.lit(0.1) + seed / 500.0).alias("b3"),
            F.when(fire, F.lit(0.3) + seed / 1000.0).otherwise(F.lit(0.05) + seed / 650.0).alias("b4"),
            F.when(fire, F.lit(0.1) + seed / 1000.0).otherwise(F.lit(0.3) + seed / 500.0).alias("b8"),
            (F.lit(0.05) + (seed % 5) * 0.05).alias("b8a"),
            F.when(fire, F.lit(0.2) + seed / 1000.0).otherwise(F.lit(0.05) + seed / 650.0).alias("b11"),
            F.when(fire, F.lit(0.2) + seed / 970.0).otherwise(F.lit(0.05) + seed / 600.0).alias("b12"),
        )

    area = F.concat(F.lit("A1-M"), (order % 9 + 1).cast("string"))
    return orders.select(
        F.concat(F.lit("satellite/"), area, F.lit("/order_"), order.cast("string"), F.lit(".jpg")).alias(
            "image_pointer"
        ),
        F.date_format(
            F.timestamp_seconds(F.lit(1704067200) + order * 60), "yyyy-MM-dd'T'HH:mm:ss.SSS"
        ).alias("timestamp"),
        area.alias("microarea_id"),
        F.lit("A1").alias("macroarea_id"),
        F.array(*[pixel(F.lit(i)) for i in range(25)]).alias("pixels"),  # a lambda would be interpreted
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(table(spark, sf_dir, "conversations"))


def message_columns(conversations: DataFrame) -> DataFrame:
    """One short message per conversation turn, with a category from its position."""
    conv, turn = F.col("conv_id"), F.col("turn")
    categories = F.array(*[F.lit(name) for name in ALL_CATEGORIES])
    return conversations.select(
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("unique_msg_id"),
        F.lit("A1").alias("macroarea_id"),
        F.concat(F.lit("M"), (conv % 9 + 1).cast("string")).alias("microarea_id"),
        F.col("text").alias("message"),
        F.element_at(categories, ((conv + turn) % 7 + 1).cast("int")).alias("category"),
        (F.lit(38.5) + (conv % 100) * 0.01).alias("latitude"),
        (F.lit(-122.1) + (conv % 100) * 0.02).alias("longitude"),
        F.timestamp_seconds(F.lit(1704067200) + conv * 60 + turn).alias("ts"),
    )


def weather_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve weather-like features and a fire class 0..2 per labelled document; some features are NULL."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    n, key = F.col("n_chars"), F.col("doc_id")
    fire = F.col("quality") + F.col("toxic")
    values = {
        "u10": (n % 17) * 0.5 - 4.0 + fire,
        "v10": (n % 13) * 0.5 - 3.0,
        "t2m": F.lit(280.0) + (n % 23) + fire * 4.0,
        "d2m": F.lit(270.0) + (n % 19) - fire * 2.0,
        "msl": F.lit(100000.0) + (n % 101) * 10.0,
        "sst": F.when(key % 20 != 7, F.lit(285.0) + (n % 11)),
        "sp": F.lit(99000.0) + (n % 89) * 10.0,
        "u100": (n % 29) * 0.4 - 5.0,
        "v100": (n % 31) * 0.4 - 6.0,
        "stl1": F.lit(283.0) + (n % 7) + fire * 1.5,
        "swvl1": F.when(key % 25 != 3, F.lit(0.4) - (n % 5) * 0.05 - fire * 0.05),
        "cvh": (n % 10) * 0.1,
    }
    return labels.join(documents, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        *[values[name].cast("double").alias(name) for name in FEATURES],
        fire.cast("int").alias("fire_class"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers spread over the case-study region, many of them exactly on cell edges or outside."""
    key = F.col("c_custkey")
    min_long, min_lat, max_long, max_lat = CASE_STUDY_BBOX
    return table(spark, sf_dir, "customer").select(
        key.alias("point_id"),
        F.col("c_nationkey").alias("group_id"),
        (F.lit(min_long) + (key % 21) * ((max_long - min_long) / 18)).alias("longitude"),
        (F.lit(min_lat) + (key % 17) * ((max_lat - min_lat) / 14)).alias("latitude"),
    )
