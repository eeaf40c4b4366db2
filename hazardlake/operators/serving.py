"""Small result sets for displays: newest records, feeds, counts and long-form tables.

Every per-stream limit is ``row_number() <= N``; Spark turns it into a group limit before the exchange,
so each task ships at most N rows per stream however hot the stream is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.functions.numeric import snap
from hazardlake.functions.text import title_parts, title_words, truncated


def recent_per_stream(
    records: DataFrame, keep: Mapping[str, int], stream: str = "stream", time: str = "ts", tie: str = "record_id"
) -> DataFrame:
    """The newest ``keep[stream]`` records of every stream, numbered from the newest."""
    newest = Window.partitionBy(stream).orderBy(F.col(time).desc(), F.col(tie).desc())
    limits = F.create_map(*[F.lit(x) for pair in keep.items() for x in pair])
    ranked = records.withColumn("recency", F.row_number().over(newest)).filter(
        F.col("recency") <= max(keep.values())
    )
    return ranked.filter(F.col("recency") <= F.coalesce(F.try_element_at(limits, F.col(stream)), F.lit(0)))


def latest_per_key(records: DataFrame, key: str, time: str = "ts", tie: str = "record_id") -> DataFrame:
    """The newest record of every key, by one aggregate with map-side combine."""
    values = [name for name in records.columns if name not in (key, time, tie)]
    newest = F.max(F.struct(time, tie, *values)).alias("_newest")
    return records.groupBy(key).agg(newest).select(key, "_newest.*")


def recent_feed(
    messages: DataFrame, last: int = 30, show: int = 5, width: int = 110, time: str = "ts", tie: str = "unique_msg_id"
) -> DataFrame:
    """Per category, the newest ``show`` among the ``last`` newest messages of all, text cut to ``width``."""
    recent = messages.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(last)
    order = Window.partitionBy("category").orderBy(F.col(time).desc(), F.col(tie).desc())
    return (
        recent.withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= show)
        .withColumn("category_label", title_words(F.col("category")))
        .withColumn("short_text", truncated(F.col("message"), width))
    )


def dedup_messages(messages: DataFrame, time: str = "ts") -> DataFrame:
    """One row per message id: the first to arrive."""
    values = [name for name in messages.columns if name not in ("unique_msg_id", time)]
    first = F.min(F.struct(time, *values)).alias("_first")
    return messages.groupBy("unique_msg_id").agg(first).select("unique_msg_id", "_first.*")


def category_counts_delta(records: DataFrame, bucket: Column, category: str) -> DataFrame:
    """Count per bucket and category, and its change since the category's previous bucket (0 at first)."""
    counts = records.groupBy(bucket.alias("bucket"), category).agg(F.count(F.lit(1)).alias("n"))
    previous = F.lag("n").over(Window.partitionBy(category).orderBy("bucket"))
    return counts.withColumn("delta", F.coalesce(F.col("n") - previous, F.lit(0)))


def source_status(records: DataFrame, source: str = "stream", time: str = "ts") -> DataFrame:
    return records.groupBy(source).agg(F.count(F.lit(1)).alias("n_records"), F.max(time).alias("last_ts"))


def metric_table(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Wide to long: one ``metric, value`` row per metric."""
    return df.unpivot(ids, metrics, "metric", "value")


def at_risk_assets(events: DataFrame) -> DataFrame:
    """Labelled population centres and infrastructure of every event, from one pass over the events."""
    assets = F.col("system_response.at_risk_assets")

    def row(asset: Column, details: Column, distance: Column, priority: Column) -> Column:
        return F.struct(
            asset.alias("asset"),
            details.alias("details"),
            F.concat(distance.cast("string"), F.lit(" m")).alias("distance"),
            F.concat(title_words(priority), F.lit(" priority")).alias("priority"),
        )

    centers = F.transform(
        assets["population_centers"],
        lambda c: row(
            F.concat(F.lit("Population Center - "), c["name"]),
            F.concat(c["population"].cast("string"), F.lit(" people")),
            c["distance_meters"],
            c["evacuation_priority"],
        ),
    )
    infrastructure = F.transform(
        assets["critical_infrastructure"],
        lambda i: row(
            F.concat(F.lit("Infrastructure - "), i["name"]),
            F.concat(F.lit("Type: "), title_parts(i["type"])),
            i["distance_meters"],
            i["priority"],
        ),
    )
    return events.select("event_id", F.explode(F.concat(centers, infrastructure)).alias("_a")).select("event_id", "_a.*")


def station_map(stations: DataFrame) -> DataFrame:
    """Marker rows: position and colour of every station window with a known position."""
    return stations.filter(F.col("latitude").isNotNull()).select(
        "station_id",
        "microarea_id",
        "w",
        "latitude",
        "longitude",
        F.when(F.col("is_anomaly"), "red").otherwise("blue").alias("colour"),
    )


def region_outline(events: DataFrame, microareas: DataFrame) -> DataFrame:
    """Centre and closed outline (latitude, longitude) of the area of each region's newest event."""
    newest = events.groupBy("region_id").agg(F.max("response_timestamp").alias("response_timestamp"))
    south, west, north, east = (F.col(name) for name in ("min_lat", "min_long", "max_lat", "max_long"))
    corners = [(south, west), (south, east), (north, east), (north, west), (south, west)]
    areas = microareas.withColumnRenamed("microarea_id", "region_id")
    return newest.join(areas, "region_id").select(
        "region_id",
        "response_timestamp",
        ((south + north) / 2.0).alias("center_lat"),
        ((west + east) / 2.0).alias("center_long"),
        F.array(*[F.struct(lat.alias("lat"), lon.alias("long")) for lat, lon in corners]).alias("ring"),
    )


def near_station_match(clicks: DataFrame, stations: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """First station (by id) closer than ``tolerance`` in both axes to each click; no match gives NULL.

    An equi-join on tolerance-sized tiles instead of a range join. Stations at one position are reduced to
    the first before the join, since all of them match the same clicks. Clicks are unique rows.
    """

    def tile(value: Column) -> Column:
        return F.floor(value / tolerance)

    around = F.sequence(F.lit(-1), F.lit(1))
    positions = (
        stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("latitude", "longitude")
        .agg(F.min("station_id").alias("station_id"))
        .select(
            F.col("station_id"),
            F.col("latitude").alias("_lat"),
            F.col("longitude").alias("_long"),
            F.explode(F.transform(around, lambda i: tile(F.col("latitude")) + i)).alias("_row"),
        )
        .select("*", F.explode(F.transform(around, lambda i: tile(F.col("_long")) + i)).alias("_col"))
    )
    near = (F.abs(F.col("latitude") - F.col("_lat")) < tolerance) & (F.abs(F.col("longitude") - F.col("_long")) < tolerance)
    tiled = clicks.withColumn("_click_row", tile(F.col("latitude"))).withColumn("_click_col", tile(F.col("longitude")))
    same_tile = (F.col("_click_row") == F.col("_row")) & (F.col("_click_col") == F.col("_col"))
    return tiled.join(positions, same_tile & near, "left").groupBy(*clicks.columns).agg(F.min("station_id").alias("station_id"))


def rounded(df: DataFrame, names: list[str]) -> DataFrame:
    for name in names:
        df = df.withColumn(name, snap(F.col(name)))
    return df
