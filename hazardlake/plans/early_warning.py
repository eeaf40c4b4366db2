"""The forecast flow, and its registered queries."""

from __future__ import annotations

import datetime
import hashlib
import os
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import FEATURES
from hazardlake.functions.timefmt import date_parts, file_stamp
from hazardlake.operators import forecast
from hazardlake.plans import oracle as sql
from hazardlake.plans import proxies
from hazardlake.plans.proxies import table
from hazardlake.schemas import METEO_HIST
from hazardlake.session import scratch_dir, stored
from hazardlake.sources import records, tables

START = datetime.date(2024, 6, 1)
#: Partition levels of the predictions table that keep runs apart.
RUN_PARTITIONS = ["run_start", "run_token"]


# ------------------------------------------------------------------ the flow
def train(history: DataFrame, trees: int = 100, depth: int = 15):
    """Complete rows, stratified 80 % part, balanced classes, forest."""
    complete = forecast.drop_incomplete(history)
    training = forecast.stratified_split(complete, "fire_class", "row_id").filter("is_train").drop("is_train")
    return forecast.train_forest(forecast.balance(training, "fire_class"), trees=trees, depth=depth)


def run(
    history: DataFrame, coming: DataFrame, start: datetime.date, output: str, trees: int = 100, depth: int = 15, token: str | None = None
) -> DataFrame:
    """Train, score the forecast, append it to the predictions table, return the gate decision on this run's rows."""
    return score(train(history, trees, depth), coming, start, output, token)


def run_token(coming: DataFrame, start: datetime.date) -> str:
    """A name for scoring these rows from this date on: equal for a replay, another one for other rows.

    Counts and sums of row hashes, so neither the order of the rows nor their partitions matter.
    """
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in coming.columns]), {"ignoreNullFields": "false"}))
    total = coming.select(row.alias("h"), F.xxhash64(row, F.lit(1)).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h"), F.sum(F.col("g").cast("decimal(38,0)")).alias("g")
    )
    n, h, g = total.first()
    return hashlib.sha256(f"{start}|{n}|{h}|{g}".encode()).hexdigest()[:20]


def score(model: PipelineModel, coming: DataFrame, start: datetime.date, output: str, token: str | None = None) -> DataFrame:
    """Score a forecast with a fitted model, append it, return the gate decision on its rows.

    The table is partitioned by the run's first date and its ``token``, and only that partition is written. So any other
    run appends, of the same date too, and a replay replaces its own rows. Without a token the rows name the run
    (``run_token``); pass one to append equal rows twice.
    """
    token = token or run_token(coming, start)
    remapped = forecast.remap_times(coming, "time", F.lit(start))
    scored = forecast.predict(model, remapped).withColumns({"run_start": F.lit(start), "run_token": F.lit(token)})
    scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN_PARTITIONS).parquet(output)
    return forecast.gate(predictions(coming.sparkSession, output).filter((F.col("run_start") == F.lit(start)) & (F.col("run_token") == token)))


def predictions(spark: SparkSession, output: str) -> DataFrame:
    """The predictions table; a token stays text, even one of digits alone."""
    stored = spark.read.parquet(output)
    names = [f.name for f in stored.schema if f.name not in RUN_PARTITIONS]
    kinds = ", ".join(f"`{n}` {stored.schema[n].dataType.simpleString()}" for n in names)
    return spark.read.schema(f"{kinds}, run_start date, run_token string").parquet(output)


# ------------------------------------------------------------------ registered queries
def broken_payload() -> Column:
    """Event payloads, every fifth cut short and every seventh without its field."""
    event = F.col("event_id")
    return (
        F.when(event % 5 == 0, F.expr("substring(props, 1, length(props) - 2)"))
        .when(event % 7 == 0, F.regexp_replace("props", '"k"', '"other"'))
        .otherwise(F.col("props"))
    )


def parse_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads, some of them broken, through the parser."""
    raw = table(spark, sf, "events").select("event_id", broken_payload().alias("value"))
    parsed = records.parse(raw, {"k": "int"}, ["k"], None)
    return parsed.select("event_id", "value", F.coalesce("problem", F.lit("ok")).alias("route"), F.col("record.k").cast("double").alias("k"))


def bronze_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Raw payload counts and newest file stamp per date partition."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    days = events.select("ts", *date_parts(F.coalesce("ts", F.current_timestamp())))
    return days.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n_records"), file_stamp(F.max("ts")).alias("last_stamp"))


def _meteo(spark: SparkSession, sf: str) -> DataFrame:
    """Weather history in the 24-column table layout."""
    rows = proxies.weather_history(spark, sf)
    made = {
        "date": F.date_add(F.lit("2020-01-01").cast("date"), (F.col("row_id") % 1000).cast("int")),
        "cell_id": F.concat(F.lit("cell_"), F.col("row_id").cast("string")),
        "latitude": F.lit(38.0) + F.col("row_id") % 10 * 0.25,
        "longitude": F.lit(-122.0) + F.col("row_id") % 8 * 0.25,
        "number": F.lit(0.0),
        "surface": F.lit(0.0),
        "meanSea": F.lit(0.0),
        "depthBelowLandLayer": F.lit(0.0),
        "cell_lat": F.lit(38.0) + F.col("row_id") % 10 * 0.25,
        "cell_lon": F.lit(-122.0) + F.col("row_id") % 8 * 0.25,
        "frp_max": F.col("fire_class") * 12.5,
    }
    return rows.select(*[made[name].alias(name) if name in made else F.col(name) for name in METEO_HIST])


def csv_typed_load(spark: SparkSession, sf: str) -> DataFrame:
    """The history written as CSV with a header and loaded back with its types."""
    path = scratch_dir(spark, "meteo-csv")
    _meteo(spark, sf).write.option("header", True).csv(path)
    loaded = tables.read_csv(spark, path)
    return loaded.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), "cell_id", "latitude", "longitude", *FEATURES, "frp_max", "fire_class"
    )


def feature_dropna(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.drop_incomplete(proxies.weather_history(spark, sf))


def time_remap(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("time"))
    return forecast.remap_times(orders, "time", F.lit(START)).select(
        "o_orderkey", F.date_format("time", "yyyy-MM-dd").alias("new_date")
    )


def prediction_gate(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.gate(proxies.weather_history(spark, sf), "fire_class")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rank = F.pmod(F.col("row_id") * F.lit(1103515245) + F.lit(42), F.lit(1 << 31))
    split = forecast.stratified_split(proxies.weather_history(spark, sf), "fire_class", "row_id", rank=rank)
    return split.select("row_id", "fire_class", "is_train")


def class_rebalance(spark: SparkSession, sf: str) -> DataFrame:
    """Original and synthetic rows per class; whether all of these lie between the two rows of the class they name.

    ``in_range``: no synthetic value lies beyond the class's own. ``on_segment``: distances to both ends add up to the
    distance of the ends.
    """
    history = forecast.drop_incomplete(proxies.weather_history(spark, sf))
    rows = stored(forecast.smote(history, "fire_class", pair=True), "balanced")
    made = F.col("synthetic")
    vector = F.array(*[F.col(n) for n in FEATURES])
    ends = history.select(F.col("row_id").alias("end"), F.col("fire_class").alias("end_class"), vector.alias("end_v"))
    a, b = (ends.select(*[F.col(c).alias(f"{c}_{side}") for c in ends.columns]) for side in "ab")

    def apart(x: Column, y: Column) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(x, y, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda total, d: total + d))

    point = rows.filter(made).select("fire_class", "near_a", "near_b", vector.alias("v"))
    point = point.join(a, F.col("near_a") == F.col("end_a"), "left").join(b, F.col("near_b") == F.col("end_b"), "left")
    whole = apart(F.col("end_v_a"), F.col("end_v_b"))
    between = F.abs(apart(F.col("v"), F.col("end_v_a")) + apart(F.col("v"), F.col("end_v_b")) - whole) <= whole * 1e-9 + 1e-9
    own = (F.col("end_class_a") == F.col("fire_class")) & (F.col("end_class_b") == F.col("fire_class"))
    segments = point.groupBy("fire_class").agg(F.min(F.coalesce(own & between, F.lit(False))).alias("on_segment"))
    extremes = [("ol", F.min, ~made), ("oh", F.max, ~made), ("sl", F.min, made), ("sh", F.max, made)]
    ranges = rows.groupBy("fire_class").agg(
        F.count_if(~F.col("synthetic")).alias("n_original"),
        F.count_if("synthetic").alias("n_synthetic"),
        *[f(F.when(w, F.col(n))).alias(f"{c}_{n}") for n in FEATURES for c, f, w in extremes],
        *[F.sum(F.when(~F.col("synthetic"), F.col(n))).alias(f"sum_{n}") for n in FEATURES[:2]],
    )
    inside = [(F.coalesce(F.col(f"sl_{n}") >= F.col(f"ol_{n}"), F.lit(True)) & F.coalesce(F.col(f"sh_{n}") <= F.col(f"oh_{n}"), F.lit(True))) for n in FEATURES]
    return ranges.join(segments, "fire_class", "left").select(
        "fire_class", "n_original", "n_synthetic", reduce(and_, inside).alias("in_range"), F.coalesce("on_segment", F.lit(True)).alias("on_segment"),
        *[F.round(f"sum_{n}", 6).alias(f"sum_{n}") for n in FEATURES[:2]],
    )


def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    history = forecast.drop_incomplete(proxies.weather_history(spark, sf))
    return forecast.class_weights(history, "fire_class").select("row_id", "fire_class", F.round("weight", 8).alias("weight"))


def fire_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows the forest scores, and whether it beats always naming the largest class."""
    history = proxies.weather_history(spark, sf)
    scored = forecast.predict(train(history), history).select("row_id", "fire_class", "fire_prediction")
    by_class = scored.filter("fire_prediction IS NOT NULL").groupBy("fire_class").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("fire_prediction") == F.col("fire_class")).alias("hits")
    )
    beats = by_class.agg((F.sum("hits") > F.max("n")).alias("beats"))
    return scored.select("row_id", "fire_class", F.col("fire_prediction").isNotNull().alias("scored"), beats.scalar().alias("beats_majority"))


def early_warning_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast CSV to appended predictions: rows and scored rows of each run in the table.

    Two forecasts start on the same date, the second one of every second row; a third, later one is replayed.
    """
    path = scratch_dir(spark, "forecast")
    history = proxies.weather_history(spark, sf)
    hour = F.timestamp_seconds(F.col("row_id") * 3600)
    coming = history.select(F.date_format(hour, "yyyy-MM-dd HH:mm:ss").alias("time"), "row_id", *FEATURES)
    coming.write.option("header", True).csv(os.path.join(path, "csv"))
    columns = "row_id bigint, " + ", ".join(f"{name} double" for name in FEATURES)
    rows = tables.read_forecast(spark, os.path.join(path, "csv"), columns)
    output = os.path.join(path, "predictions")
    later = START + datetime.timedelta(days=400)
    blind = rows.withColumn("sst", F.lit(None).cast("double"))
    model = train(history)
    runs = [(rows, START), (rows.filter("row_id % 2 = 0"), START), (blind, later), (blind, later)]
    gates = {run_token(part, start): score(model, part, start, output).first()["start_monitoring"] for part, start in runs}
    stored = predictions(spark, output).groupBy(*RUN_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("fire_prediction").alias("n_scored"),
        F.date_format(F.min("time"), "yyyy-MM-dd").alias("first_date"),
    )
    decided = spark.createDataFrame(list(gates.items()), "run_token string, start_monitoring boolean")
    return stored.join(decided, "run_token").drop("run_token").withColumn("run_start", F.date_format("run_start", "yyyy-MM-dd"))


# ------------------------------------------------------------------ oracle SQL
_FIRE = "(quality + toxic)"
V_WEATHER = f"""v_weather AS (
  SELECT doc_id AS row_id, (n_chars % 17)*0.5::DOUBLE - 4.0::DOUBLE + {_FIRE} AS u10, (n_chars % 13)*0.5::DOUBLE - 3.0::DOUBLE AS v10,
         280.0::DOUBLE + (n_chars % 23) + {_FIRE}*4.0::DOUBLE AS t2m, 270.0::DOUBLE + (n_chars % 19) - {_FIRE}*2.0::DOUBLE AS d2m,
         100000.0::DOUBLE + (n_chars % 101)*10.0::DOUBLE AS msl, CASE WHEN doc_id % 20 <> 7 THEN 285.0::DOUBLE + (n_chars % 11) END AS sst,
         99000.0::DOUBLE + (n_chars % 89)*10.0::DOUBLE AS sp, (n_chars % 29)*0.4::DOUBLE - 5.0::DOUBLE AS u100,
         (n_chars % 31)*0.4::DOUBLE - 6.0::DOUBLE AS v100, 283.0::DOUBLE + (n_chars % 7) + {_FIRE}*1.5::DOUBLE AS stl1,
         CASE WHEN doc_id % 25 <> 3 THEN 0.4::DOUBLE - (n_chars % 5)*0.05::DOUBLE - {_FIRE}*0.05::DOUBLE END AS swvl1,
         (n_chars % 10)*0.1::DOUBLE AS cvh, CAST({_FIRE} AS INTEGER) AS fire_class
  FROM labels JOIN documents USING (doc_id)
)"""
_COMPLETE = "SELECT * FROM v_weather WHERE sst IS NOT NULL AND swvl1 IS NOT NULL"

QUERIES = {
    "parse_quarantine": (
        parse_quarantine,
        """SELECT event_id, value, CASE WHEN NOT json_valid(value) THEN 'malformed' WHEN k IS NULL THEN 'missing k' ELSE 'ok' END AS route, k::DOUBLE AS k
FROM (SELECT *, CASE WHEN json_valid(value) THEN TRY_CAST(json_extract_string(value, '$.k') AS INTEGER) END AS k
      FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN substr(props, 1, length(props) - 2)
                                  WHEN event_id % 7 = 0 THEN replace(props, '"k"', '"other"') ELSE props END AS value FROM events))""",
    ),
    "bronze_partitioned": (
        bronze_partitioned,
        """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  count(*) AS n_records, strftime(max(ts), '%Y%m%d_%H%M%S_%g') AS last_stamp FROM events GROUP BY 1, 2, 3""",
    ),
    "csv_typed_load": (
        csv_typed_load,
        sql.with_views(V_WEATHER)
        + f"""SELECT strftime(DATE '2020-01-01' + CAST(row_id % 1000 AS INTEGER), '%Y-%m-%d') AS date, 'cell_' || row_id AS cell_id,
  38.0::DOUBLE + row_id % 10*0.25::DOUBLE AS latitude, (-122.0::DOUBLE) + row_id % 8*0.25::DOUBLE AS longitude, {", ".join(FEATURES)},
  fire_class*12.5::DOUBLE AS frp_max, fire_class FROM v_weather""",
    ),
    "feature_dropna": (feature_dropna, sql.with_views(V_WEATHER) + _COMPLETE),
    "time_remap": (
        time_remap,
        f"""SELECT o_orderkey, strftime(DATE '{START}' + CAST(dense_rank() OVER (ORDER BY o_orderdate) - 1 AS INTEGER), '%Y-%m-%d') AS new_date
FROM orders""",
    ),
    "prediction_gate": (
        prediction_gate,
        sql.with_views(V_WEATHER)
        + "SELECT max(fire_class) AS max_class, coalesce(max(fire_class) IN (1, 2), false) AS start_monitoring FROM v_weather",
    ),
    "stratified_split": (
        stratified_split,
        sql.with_views(
            V_WEATHER,
            "sizes AS (SELECT fire_class, count(*) AS n, (SELECT count(*) FROM v_weather) AS total FROM v_weather GROUP BY fire_class)",
            "shares AS (SELECT *, (total*4)//5 AS train, ((total*4)//5)*n // total AS base, (((total*4)//5)*n) % total AS rest FROM sizes)",
            "quotas AS (SELECT fire_class, base + (row_number() OVER (ORDER BY rest DESC, fire_class)"
            " <= train - sum(base) OVER ())::INT AS quota FROM shares)",
        )
        + """SELECT row_id, w.fire_class, row_number() OVER (PARTITION BY w.fire_class
  ORDER BY (row_id*1103515245 + 42) % 2147483648, row_id) <= quota AS is_train FROM v_weather w JOIN quotas q ON w.fire_class = q.fire_class""",
    ),
    "class_rebalance": (
        class_rebalance,
        sql.with_views(V_WEATHER, f"complete AS ({_COMPLETE})", "sizes AS (SELECT fire_class, count(*) AS n FROM complete GROUP BY fire_class)")
        + f"""SELECT c.fire_class, count(*) AS n_original, (SELECT max(n) FROM sizes) - count(*) AS n_synthetic, true AS in_range, true AS on_segment,
  {", ".join(f"round(sum(c.{n}), 6) AS sum_{n}" for n in FEATURES[:2])} FROM complete c GROUP BY c.fire_class""",
    ),
    "class_weights": (
        class_weights,
        sql.with_views(V_WEATHER, f"complete AS ({_COMPLETE})")
        + """SELECT row_id, fire_class, round((SELECT max(c) FROM (SELECT count(*) AS c FROM complete GROUP BY fire_class))
  / count(*) OVER (PARTITION BY fire_class), 8) AS weight FROM complete""",
    ),
    "fire_forest": (
        fire_forest,
        sql.with_views(V_WEATHER)
        + "SELECT row_id, fire_class, sst IS NOT NULL AND swvl1 IS NOT NULL AS scored, true AS beats_majority FROM v_weather",
    ),
    "early_warning_flow": (
        early_warning_flow,
        sql.with_views(V_WEATHER)
        + f"""SELECT '{START}' AS run_start, count(*) AS n_rows, count(*) FILTER (WHERE sst IS NOT NULL AND swvl1 IS NOT NULL) AS n_scored,
  '{START}' AS first_date, true AS start_monitoring FROM v_weather
UNION ALL SELECT '{START}', count(*), count(*) FILTER (WHERE sst IS NOT NULL AND swvl1 IS NOT NULL), '{START}', true FROM v_weather WHERE row_id % 2 = 0
UNION ALL SELECT strftime(DATE '{START}' + 400, '%Y-%m-%d'), count(*), 0, strftime(DATE '{START}' + 400, '%Y-%m-%d'), false FROM v_weather""",
    ),
}
