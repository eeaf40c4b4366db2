"""Registered queries of the display and dimension operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import BANDS, INDICES
from hazardlake.functions.numeric import snap
from hazardlake.functions.timefmt import millis
from hazardlake.operators import dims, grid, serving
from hazardlake.plans import iot, proxies, satellite
from hazardlake.plans import oracle as sql
from hazardlake.plans.proxies import IOT_WINDOW, table
from hazardlake.session import scratch_dir
from hazardlake.sources.keyed import KeyedTable

KEEP = {"social": 20, "iot": 10, "satellite": 10}


def streams(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the three sources in one shape."""
    iot_rows = proxies.sensor_readings(spark, sf).select(
        F.lit("iot").alias("stream"), F.col("reading_id").cast("string").alias("record_id"), "ts"
    )
    social = proxies.messages(spark, sf).select(F.lit("social").alias("stream"), F.col("unique_msg_id").alias("record_id"), "ts")
    images = table(spark, sf, "orders").select(
        F.lit("satellite").alias("stream"), F.col("o_orderkey").cast("string").alias("record_id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    return iot_rows.unionByName(social).unionByName(images)


def recent_per_stream(spark: SparkSession, sf: str) -> DataFrame:
    return serving.recent_per_stream(streams(spark, sf), KEEP).select(
        "stream", "record_id", millis(F.col("ts")).alias("ts_ms"), "recency"
    )


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    readings = proxies.sensor_readings(spark, sf).withColumnRenamed("reading_id", "record_id")
    return serving.latest_per_key(readings, "station_id").select(
        "station_id", "record_id", millis(F.col("ts")).alias("ts_ms"), "temperature_c", "humidity_percent"
    )


def recent_feed(spark: SparkSession, sf: str) -> DataFrame:
    return serving.recent_feed(proxies.messages(spark, sf)).select(
        "unique_msg_id", "category", "category_label", "position", "short_text", millis(F.col("ts")).alias("ts_ms")
    )


def dedup_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every message delivered twice, the second time later and from elsewhere."""
    once = proxies.messages(spark, sf)
    again = once.withColumn("ts", F.col("ts") + F.expr("INTERVAL 5 SECONDS")).withColumn(
        "latitude", F.col("latitude") + 0.5
    )
    return serving.dedup_messages(once.unionByName(again)).select(
        "unique_msg_id", "category", "latitude", millis(F.col("ts")).alias("ts_ms")
    )


def category_counts_delta(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return serving.category_counts_delta(events, F.to_date("ts"), "event_type").select(
        F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "event_type", "n", "delta"
    )


def source_status(spark: SparkSession, sf: str) -> DataFrame:
    return serving.source_status(streams(spark, sf)).select("stream", "n_records", millis(F.col("last_ts")).alias("last_ms"))


_METRICS = [f"anomalous_{name}" for name in [*BANDS, *INDICES]] + [f"scene_{name}" for name in BANDS]


def metric_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    scenes = satellite.scene_stage(proxies.pixels(spark, sf)).select("image_pointer", *_METRICS)
    return serving.metric_table(scenes, ["image_pointer"], _METRICS)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return iot.event_stage(proxies.sensor_readings(spark, sf), proxies.stations(spark, sf), IOT_WINDOW)


def at_risk_assets(spark: SparkSession, sf: str) -> DataFrame:
    return serving.at_risk_assets(_events(spark, sf))


def station_map(spark: SparkSession, sf: str) -> DataFrame:
    enriched = iot.station_stage(proxies.sensor_readings(spark, sf), proxies.stations(spark, sf), IOT_WINDOW)
    return serving.station_map(enriched).withColumn("w", millis(F.col("w.end"))).withColumnRenamed("w", "window_end_ms")


def region_outline(spark: SparkSession, sf: str) -> DataFrame:
    outline = serving.region_outline(_events(spark, sf), proxies.microareas(spark))
    return outline.select(
        "region_id",
        "response_timestamp",
        snap(F.col("center_lat")).alias("center_lat"),
        snap(F.col("center_long")).alias("center_long"),
        F.posexplode("ring").alias("corner", "point"),
    ).select(
        "region_id", "response_timestamp", "center_lat", "center_long", "corner",
        snap(F.col("point.lat")).alias("lat"), snap(F.col("point.long")).alias("long"),
    )


def near_station_match(spark: SparkSession, sf: str) -> DataFrame:
    """A click near some station for every event; a third of them just out of reach."""
    user, shift = F.col("user_id"), F.col("event_id") % 3
    clicks = table(spark, sf, "events").select(
        F.col("event_id").alias("click_id"),
        (F.lit(38.66) + (user % 25) * 0.008 + shift * 0.00007).alias("latitude"),
        (F.lit(-122.14) + (user % 23) * 0.009 - shift * 0.00003).alias("longitude"),
    )
    return serving.near_station_match(clicks, proxies.stations(spark, sf)).select("click_id", "station_id")


# ------------------------------------------------------------------ dimensions
def point_in_cell(spark: SparkSession, sf: str) -> DataFrame:
    """Points of two regions that share the case-study rectangle."""
    regions = spark.range(2).select(
        F.concat(F.lit("A"), F.col("id").cast("string")).alias("macroarea_id"),
        *[F.lit(value).alias(name) for name, value in zip(grid.BBOX, proxies.CASE_STUDY_BBOX)],
    )
    points = proxies.points(spark, sf).withColumn(
        "macroarea_id", F.concat(F.lit("A"), (F.col("point_id") % 2).cast("string"))
    )
    return grid.locate_points(points, regions, proxies.MICROAREA_KM2, "macroarea_id").select(
        "point_id", F.coalesce("cell_no", F.lit(0)).alias("cell_no")
    )


def _nation_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """A box per nation around its customers, stretched by the nation key so that shapes differ."""
    points = proxies.points(spark, sf)
    return points.groupBy("group_id").agg(
        F.min("longitude").alias("min_long"),
        F.min("latitude").alias("min_lat"),
        (F.max("longitude") + F.col("group_id") * 0.05 + 0.1).alias("max_long"),
        (F.max("latitude") + F.col("group_id") * 0.02 + 0.1).alias("max_lat"),
    )


def _macroareas(spark: SparkSession, sf: str) -> DataFrame:
    return _nation_boxes(spark, sf).select(
        F.concat(F.lit("A"), F.col("group_id").cast("string")).alias("macroarea_id"), *grid.BBOX
    )


def microarea_grid(spark: SparkSession, sf: str) -> DataFrame:
    areas = grid.microarea_grid(_macroareas(spark, sf), proxies.MICROAREA_KM2)
    return serving.rounded(areas, grid.BBOX)


def cell_grid(spark: SparkSession, sf: str) -> DataFrame:
    areas = grid.microarea_grid(_macroareas(spark, sf), proxies.MICROAREA_KM2)
    cells = grid.labelled_cells(areas.select("microarea_id", *grid.BBOX), 20.0)
    return serving.rounded(
        cells.select("microarea_id", "cell_no", "grid_row", "grid_col", "center_long", "center_lat", "label"),
        ["center_long", "center_lat"],
    )


def geojson_bbox(spark: SparkSession, sf: str) -> DataFrame:
    """Polygon text written from each nation's box, parsed back into a box."""
    texts = _macroareas(spark, sf).select("macroarea_id", F.to_json(grid.bbox_polygon()).alias("geojson"))
    parsed = texts.select("macroarea_id", F.from_json("geojson", grid.GEOJSON_POLYGON).alias("geometry"))
    return grid.polygon_bbox(parsed, "geometry").drop("geometry")


def bbox_envelope(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    boxes = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("n_nationkey"),
        (F.lit(-122.0) + (key % 37) * 0.01).alias("min_long"),
        (F.lit(38.0) + (key % 31) * 0.01).alias("min_lat"),
        (F.lit(-121.5) + (key % 29) * 0.01).alias("max_long"),
        (F.lit(38.4) + (key % 23) * 0.01).alias("max_lat"),
    )
    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    return grid.bbox_envelope(boxes.join(nations, "n_nationkey"), ["n_regionkey"])


def children_per_parent(spark: SparkSession, sf: str) -> DataFrame:
    levels = [("nation", "n_regionkey", "region"), ("supplier", "s_nationkey", "nation"), ("customer", "c_nationkey", "nation")]
    parts = [
        dims.children_per_parent(table(spark, sf, name), key).select(
            F.lit(name).alias("child"), F.lit(parent).alias("parent"), F.col(key).alias("parent_key"), "n_children"
        )
        for name, key, parent in levels
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dim_upsert_lww(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, then a load that changes a third, adds new keys and names some keys twice."""
    current, first, second = _customer_loads(spark, sf)
    return dims.upsert(current, first.unionByName(second), ["c_custkey"], "load_seq")


def _customer_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, and two loads over them: new and changed keys, then every second one of those once more."""
    current = table(spark, sf, "customer")
    moved = current.withColumn("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey")).otherwise(F.col("c_custkey") + 1000000000))
    first = moved.withColumn("c_acctbal", F.col("c_acctbal") + 1.0).withColumn("load_seq", F.lit(1))
    second = moved.filter("c_custkey % 2 = 0").withColumn("c_mktsegment", F.lit("CHANGED")).withColumn("load_seq", F.lit(2))
    return current, first, second


def dim_upsert_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same loads into a stored table, then both once more, the older one last; read back."""
    current, first, second = _customer_loads(spark, sf)
    stored = KeyedTable(scratch_dir(spark, "customers"), current.schema, ["c_custkey"], buckets=16)
    stored.load(current)
    for load in (first, second, second, first):
        stored.upsert(load, "load_seq")
    return stored.read(spark)


def dim_point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return dims.point_lookup(table(spark, sf, "customer"), "c_custkey", 42)


def dim_key_value(spark: SparkSession, sf: str) -> DataFrame:
    """Stations and areas as key/value rows."""
    return dims.station_key_values(proxies.stations(spark, sf)).unionByName(dims.microarea_key_values(proxies.microareas(spark)))


# ------------------------------------------------------------------ oracle SQL
V_MESSAGE = """v_message AS (
  SELECT conv_id || '-' || turn AS unique_msg_id, text AS message, ["""+ ", ".join(f"'{c}'" for c in proxies.ALL_CATEGORIES) + """]
         [CAST((conv_id + turn) % 7 + 1 AS INTEGER)] AS category, 'A1' AS macroarea_id, 'M' || (conv_id % 9 + 1) AS microarea_id,
         38.5::DOUBLE + (conv_id % 100)*0.01::DOUBLE AS latitude, (-122.1::DOUBLE) + (conv_id % 100)*0.02::DOUBLE AS longitude,
         make_timestamp((1704067200 + conv_id*60 + turn)*1000000) AS ts
  FROM conversations
)"""
_STREAMS = f"""streams AS (
  SELECT 'iot' AS stream, event_id::VARCHAR AS record_id, ts FROM events
  UNION ALL SELECT 'social', unique_msg_id, ts FROM v_message
  UNION ALL SELECT 'satellite', o_orderkey::VARCHAR, o_orderdate FROM orders
)"""
_PLACES = f"""places AS (
  SELECT c_custkey AS point_id, c_nationkey AS group_id,
         ({proxies.CASE_STUDY_BBOX[0]}::DOUBLE) + (c_custkey % 21)*{(proxies.CASE_STUDY_BBOX[2] - proxies.CASE_STUDY_BBOX[0]) / 18!r}::DOUBLE AS longitude,
         {proxies.CASE_STUDY_BBOX[1]}::DOUBLE + (c_custkey % 17)*{(proxies.CASE_STUDY_BBOX[3] - proxies.CASE_STUDY_BBOX[1]) / 14!r}::DOUBLE AS latitude
  FROM customer
)"""
_BOXES = """boxes AS (
  SELECT 'A' || group_id AS macroarea_id, min(longitude) AS min_long, min(latitude) AS min_lat,
         max(longitude) + group_id*0.05::DOUBLE + 0.1::DOUBLE AS max_long, max(latitude) + group_id*0.02::DOUBLE + 0.1::DOUBLE AS max_lat
  FROM places GROUP BY group_id
)"""


def _grid_sql(name: str, source: str, keys: str, max_km2: float) -> str:
    return f"""{name}_shape AS (
  SELECT *, CAST(ceil(n/n_cols) AS BIGINT) AS n_rows FROM (
    SELECT *, CAST(ceil(sqrt(n*(w/h))) AS BIGINT) AS n_cols FROM (
      SELECT *, ceil(w*h/{max_km2}::DOUBLE) AS n FROM (
        SELECT *, (max_long-min_long)*(cos(radians((min_lat+max_lat)/2.0::DOUBLE))*111.0::DOUBLE) AS w, (max_lat-min_lat)*111.0::DOUBLE AS h
        FROM {source})))
), {name} AS (
  SELECT {keys}, i*n_cols + j + 1 AS cell_no, i AS grid_row, j AS grid_col, n_rows, n_cols,
         min_long + j*((max_long-min_long)/n_cols) AS min_long, min_lat + i*((max_lat-min_lat)/n_rows) AS min_lat,
         min_long + j*((max_long-min_long)/n_cols) + (max_long-min_long)/n_cols AS max_long,
         min_lat + i*((max_lat-min_lat)/n_rows) + (max_lat-min_lat)/n_rows AS max_lat
  FROM (SELECT *, unnest(range(n_cols)) AS j FROM (SELECT *, unnest(range(n_rows)) AS i FROM {name}_shape))
)"""


_AREAS = _grid_sql("areas", "boxes", "macroarea_id", 500.0)
_MICRO = "micro AS (SELECT macroarea_id || '-M' || cell_no AS microarea_id, macroarea_id, min_long, min_lat, max_long, max_lat FROM areas)"
_CELLS = _grid_sql("cells", "micro", "microarea_id", 20.0)
_SNAPPED_BOX = ", ".join(f"{sql.snap(name)} AS {name}" for name in grid.BBOX)

_UPSERTED = """WITH moved AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE c_custkey + 1000000000 END AS k, * FROM customer),
loads AS (
  SELECT k, c_name, c_nationkey, c_acctbal + 1.0::DOUBLE AS c_acctbal, c_mktsegment, 1 AS seq FROM moved
  UNION ALL SELECT k, c_name, c_nationkey, c_acctbal, 'CHANGED', 2 FROM moved WHERE k % 2 = 0
  UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0 FROM customer)
SELECT k AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM loads) WHERE rn = 1"""

QUERIES = {
    "recent_per_stream": (
        recent_per_stream,
        sql.with_views(V_MESSAGE, _STREAMS)
        + f"""SELECT stream, record_id, {sql.ms("ts")} AS ts_ms, CAST(rn AS INTEGER) AS recency
FROM (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY ts DESC, record_id DESC) AS rn FROM streams)
WHERE rn <= CASE stream WHEN 'social' THEN 20 ELSE 10 END""",
    ),
    "latest_per_key": (
        latest_per_key,
        sql.with_views(sql.V_SENSOR)
        + f"""SELECT station_id, reading_id AS record_id, {sql.ms("ts")} AS ts_ms, temperature_c, humidity_percent
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, reading_id DESC) AS rn FROM v_sensor) WHERE rn = 1""",
    ),
    "recent_feed": (
        recent_feed,
        sql.with_views(V_MESSAGE)
        + f"""SELECT unique_msg_id, category, CASE category {" ".join(f"WHEN '{c}' THEN '{c.replace('_', ' ').title()}'" for c in proxies.ALL_CATEGORIES)} END
  AS category_label, CAST(rn AS INTEGER) AS "position", CASE WHEN length(message) > 110 THEN substr(message, 1, 110) || '...' ELSE message END
  AS short_text, {sql.ms("ts")} AS ts_ms
FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ts DESC, unique_msg_id DESC) AS rn
      FROM (SELECT * FROM v_message ORDER BY ts DESC, unique_msg_id DESC LIMIT 30)) WHERE rn <= 5""",
    ),
    "dedup_messages": (
        dedup_messages,
        sql.with_views(V_MESSAGE) + f"SELECT unique_msg_id, category, latitude, {sql.ms('ts')} AS ts_ms FROM v_message",
    ),
    "category_counts_delta": (
        category_counts_delta,
        """SELECT strftime(bucket, '%Y-%m-%d') AS bucket, event_type, n,
  coalesce(n - lag(n) OVER (PARTITION BY event_type ORDER BY bucket), 0) AS delta
FROM (SELECT CAST(ts AS DATE) AS bucket, event_type, count(*) AS n FROM events GROUP BY ALL)""",
    ),
    "source_status": (
        source_status,
        sql.with_views(V_MESSAGE, _STREAMS)
        + f"SELECT stream, count(*) AS n_records, {sql.ms('max(ts)')} AS last_ms FROM streams GROUP BY stream",
    ),
    "metric_unpivot": (
        metric_unpivot,
        sql.with_views(*sql.SAT_TO_ASSESSED)
        + " UNION ALL ".join(f"SELECT image_pointer, '{m}' AS metric, {m} AS value FROM assessed" for m in _METRICS),
    ),
    "at_risk_assets": (
        at_risk_assets,
        sql.with_views(*sql.IOT_TO_SCORED)
        + """SELECT event_id, asset, details, distance, priority FROM scored, (VALUES
  ('Population Center - Highland Park', '12500 people', '2500 m', 'High priority'),
  ('Infrastructure - Highland Substation', 'Type: Power_Substation', '1800 m', 'High priority'),
  ('Infrastructure - Eagle Rock Reservoir', 'Type: Water_Reservoir', '3200 m', 'Medium priority')) t(asset, details, distance, priority)
WHERE is_fire""",
    ),
    "station_map": (
        station_map,
        sql.with_views(*sql.IOT_TO_ENRICHED)
        + f"""SELECT station_id, microarea_id, {sql.ms("w_end")} AS window_end_ms, latitude, longitude,
  CASE WHEN is_anomaly THEN 'red' ELSE 'blue' END AS colour FROM enriched WHERE latitude IS NOT NULL""",
    ),
    "region_outline": (
        region_outline,
        sql.with_views(*sql.IOT_TO_AREAS, sql.V_GRID, sql.V_MICROAREA)
        + f"""SELECT region_id, response_timestamp, {sql.snap("(min_lat+max_lat)/2.0::DOUBLE")} AS center_lat,
  {sql.snap("(min_long+max_long)/2.0::DOUBLE")} AS center_long, corner,
  {sql.snap("CASE WHEN corner IN (2, 3) THEN max_lat ELSE min_lat END")} AS lat,
  {sql.snap("CASE WHEN corner IN (1, 2) THEN max_long ELSE min_long END")} AS long
FROM (SELECT microarea_id AS region_id, max({sql.ms("w_end")}) AS response_timestamp FROM area_windows GROUP BY microarea_id) e
JOIN v_microarea m ON e.region_id = m.microarea_id, (SELECT CAST(c AS INTEGER) AS corner FROM range(5) t(c))""",
    ),
    "near_station_match": (
        near_station_match,
        sql.with_views(
            sql.V_STATION,
            """clicks AS (SELECT event_id AS click_id, 38.66::DOUBLE + (user_id % 25)*0.008::DOUBLE + (event_id % 3)*0.00007::DOUBLE AS lat,
  (-122.14::DOUBLE) + (user_id % 23)*0.009::DOUBLE - (event_id % 3)*0.00003::DOUBLE AS long FROM events)""",
            "places AS (SELECT latitude, longitude, min(station_id) AS station_id FROM v_station GROUP BY ALL)",
        )
        + """SELECT c.click_id, min(s.station_id) AS station_id FROM clicks c LEFT JOIN places s
  ON abs(c.lat - s.latitude) < 0.0001::DOUBLE AND abs(c.long - s.longitude) < 0.0001::DOUBLE GROUP BY c.click_id""",
    ),
    "point_in_cell": (
        point_in_cell,
        sql.with_views(sql.V_GRID, _PLACES)
        + """SELECT p.point_id, coalesce(min(g.cell_no), 0) AS cell_no FROM places p LEFT JOIN v_grid g
  ON p.longitude BETWEEN g.min_long AND g.max_long AND p.latitude BETWEEN g.min_lat AND g.max_lat GROUP BY p.point_id""",
    ),
    "microarea_grid": (
        microarea_grid,
        sql.with_views(_PLACES, _BOXES, _AREAS, _MICRO) + f"SELECT microarea_id, macroarea_id, {_SNAPPED_BOX} FROM micro",
    ),
    "cell_grid": (
        cell_grid,
        sql.with_views(_PLACES, _BOXES, _AREAS, _MICRO, _CELLS)
        + f"""SELECT microarea_id, cell_no, grid_row, grid_col, {sql.snap("(min_long+max_long)/2.0::DOUBLE")} AS center_long,
  {sql.snap("(min_lat+max_lat)/2.0::DOUBLE")} AS center_lat,
  CASE WHEN grid_row >= n_rows // 3 AND grid_row < 2*n_rows // 3 AND grid_col >= n_cols // 3 AND grid_col < 2*n_cols // 3
       THEN 'wildfire' ELSE 'vegetation' END AS label FROM cells""",
    ),
    "geojson_bbox": (geojson_bbox, sql.with_views(_PLACES, _BOXES) + "SELECT * FROM boxes"),
    "bbox_envelope": (
        bbox_envelope,
        """SELECT n_regionkey, min(-122.0::DOUBLE + (s_suppkey % 37)*0.01::DOUBLE) AS min_long, min(38.0::DOUBLE + (s_suppkey % 31)*0.01::DOUBLE)
  AS min_lat, max(-121.5::DOUBLE + (s_suppkey % 29)*0.01::DOUBLE) AS max_long, max(38.4::DOUBLE + (s_suppkey % 23)*0.01::DOUBLE) AS max_lat
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey""",
    ),
    "children_per_parent": (
        children_per_parent,
        """SELECT 'nation' AS child, 'region' AS parent, n_regionkey AS parent_key, count(*) AS n_children FROM nation GROUP BY ALL
UNION ALL SELECT 'supplier', 'nation', s_nationkey, count(*) FROM supplier GROUP BY ALL
UNION ALL SELECT 'customer', 'nation', c_nationkey, count(*) FROM customer GROUP BY ALL""",
    ),
    "dim_upsert_lww": (dim_upsert_lww, _UPSERTED),
    "dim_upsert_stored": (dim_upsert_stored, _UPSERTED),
    "dim_point_lookup": (dim_point_lookup, "SELECT * FROM customer WHERE c_custkey = 42"),
    "dim_key_value": (
        dim_key_value,
        sql.with_views(sql.V_STATION, sql.V_GRID, sql.V_MICROAREA)
        + """SELECT 'station:' || station_id AS "key", '{"microarea_id":"' || microarea_id || '","latitude":' || latitude || ',"longitude":' || longitude
  || ',"install_date":"' || strftime(install_date, '%Y-%m-%d') || '","model":"' || model || '","temp_sens":"' || temp_sens || '","hum_sens":"'
  || hum_sens || '","co2_sens":"' || co2_sens || '","pm25_sens":"' || pm25_sens || '","smoke_sens":"' || smoke_sens || '","ir_sens":"' || ir_sens
  || '","elevation_m":' || elevation_m || ',"battery_type":"' || battery_type || '"}' AS "value" FROM v_station
UNION ALL SELECT 'microarea:' || microarea_id, '{"min_long":' || min_long || ',"min_lat":' || min_lat || ',"max_long":' || max_long
  || ',"max_lat":' || max_lat || '}' FROM v_microarea""",
    ),
}
