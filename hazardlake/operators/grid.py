"""Rectangular grids over regions, and the lookup of points in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.constants import KM_PER_DEGREE

GEOJSON_POLYGON = "type string, coordinates array<array<array<double>>>"
BBOX = ["min_long", "min_lat", "max_long", "max_lat"]


# ------------------------------------------------------------------ bounding boxes
def polygon_bbox(df: DataFrame, geometry: str) -> DataFrame:
    """Adds the bounding box of a parsed GeoJSON polygon column; other geometry types raise an error."""
    ring = F.col(f"{geometry}.coordinates")[0]
    checked = F.when(F.col(f"{geometry}.type") == "Polygon", ring).otherwise(
        F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(F.col(f"{geometry}.type"), F.lit("no type"))))
        .cast("array<array<double>>")
    )

    def axis(i: int) -> Column:
        return F.transform(checked, lambda point: point[i])

    return df.select(
        "*",
        F.array_min(axis(0)).alias("min_long"),
        F.array_min(axis(1)).alias("min_lat"),
        F.array_max(axis(0)).alias("max_long"),
        F.array_max(axis(1)).alias("max_lat"),
    )


def bbox_envelope(boxes: DataFrame, by: list[str]) -> DataFrame:
    """The box around all boxes of a group."""
    return boxes.groupBy(*by).agg(
        F.min("min_long").alias("min_long"),
        F.min("min_lat").alias("min_lat"),
        F.max("max_long").alias("max_long"),
        F.max("max_lat").alias("max_lat"),
    )


def bbox_polygon() -> Column:
    """GeoJSON polygon struct of the row's box: closed ring from the north-west corner, clockwise."""
    west, south, east, north = (F.col(name) for name in BBOX)
    corners = [(west, north), (east, north), (east, south), (west, south), (west, north)]
    return F.struct(
        F.lit("Polygon").alias("type"),
        F.array(F.array(*[F.array(x, y) for x, y in corners])).alias("coordinates"),
    )


# ------------------------------------------------------------------ grids
def with_grid_shape(regions: DataFrame, max_km2: float) -> DataFrame:
    """Adds ``n_cols, n_rows, lon_step, lat_step`` so that a cell covers about ``max_km2``."""
    km = float(KM_PER_DEGREE)
    width = (F.col("max_long") - F.col("min_long")) * (
        F.cos(F.radians((F.col("min_lat") + F.col("max_lat")) / 2.0)) * km
    )
    height = (F.col("max_lat") - F.col("min_lat")) * km
    return (
        regions.withColumn("_w", width)
        .withColumn("_h", height)
        .withColumn("_n", F.ceil(F.col("_w") * F.col("_h") / max_km2))
        .withColumn("n_cols", F.ceil(F.sqrt(F.col("_n") * (F.col("_w") / F.col("_h")))).cast("int"))
        .withColumn("n_rows", F.ceil(F.col("_n") / F.col("n_cols")).cast("int"))
        .withColumn("lon_step", (F.col("max_long") - F.col("min_long")) / F.col("n_cols"))
        .withColumn("lat_step", (F.col("max_lat") - F.col("min_lat")) / F.col("n_rows"))
        .drop("_w", "_h", "_n")
    )


def grid_cells(regions: DataFrame, max_km2: float) -> DataFrame:
    """One row per cell, numbered from 1, row-major from the south-west corner; region columns stay."""
    shaped = with_grid_shape(regions, max_km2)
    kept = [name for name in regions.columns if name not in BBOX]
    cells = shaped.withColumn("grid_row", F.explode(F.sequence(F.lit(0), F.col("n_rows") - 1))).withColumn(
        "grid_col", F.explode(F.sequence(F.lit(0), F.col("n_cols") - 1))
    )
    west = F.col("min_long") + F.col("grid_col") * F.col("lon_step")
    south = F.col("min_lat") + F.col("grid_row") * F.col("lat_step")
    return cells.select(
        *kept,
        (F.col("grid_row") * F.col("n_cols") + F.col("grid_col") + 1).alias("cell_no"),
        "grid_row",
        "grid_col",
        "n_rows",
        "n_cols",
        west.alias("min_long"),
        south.alias("min_lat"),
        (west + F.col("lon_step")).alias("max_long"),
        (south + F.col("lat_step")).alias("max_lat"),
    )


def microarea_grid(macroareas: DataFrame, max_km2: float) -> DataFrame:
    """The areas ``<macro>-M<n>`` of every macro-area."""
    return grid_cells(macroareas.select("macroarea_id", *BBOX), max_km2).select(
        F.concat(F.col("macroarea_id"), F.lit("-M"), F.col("cell_no").cast("string")).alias("microarea_id"),
        "macroarea_id",
        *BBOX,
    )


def labelled_cells(areas: DataFrame, max_km2: float, first_row_share: float | None = None) -> DataFrame:
    """Cells with their centre and the label of the central block.

    Rows and columns from a third up to two thirds are labelled ``wildfire``. ``first_row_share`` starts
    the block at row ``floor(rows * share)`` instead, the layout used for stations.
    """
    cells = grid_cells(areas, max_km2)
    first_row = (
        F.expr("n_rows div 3") if first_row_share is None else F.floor(F.col("n_rows") * float(first_row_share))
    )
    central = (
        (F.col("grid_row") >= first_row)
        & (F.col("grid_row") < F.expr("2 * n_rows div 3"))
        & (F.col("grid_col") >= F.expr("n_cols div 3"))
        & (F.col("grid_col") < F.expr("2 * n_cols div 3"))
    )
    return cells.select(
        "*",
        ((F.col("min_long") + F.col("max_long")) / 2.0).alias("center_long"),
        ((F.col("min_lat") + F.col("max_lat")) / 2.0).alias("center_lat"),
        F.when(central, "wildfire").otherwise("vegetation").alias("label"),
    )


# ------------------------------------------------------------------ point lookup
def _axis_cell(value: Column, origin: Column, step: Column, count: Column) -> Column:
    """Smallest cell index whose inclusive range holds ``value``, NULL outside.

    The division gives the index up to one cell of float error, so its neighbours are tested against
    the very bounds the grid publishes and the first one that holds wins.
    """
    guess = F.floor((value - origin) / step)
    candidates = F.array(*[guess + i for i in (-1, 0, 1)])
    holds = F.filter(
        candidates,
        lambda i: (i >= 0) & (i < count) & (value >= origin + i * step) & (value <= origin + i * step + step),
    )
    return F.get(holds, F.lit(0))


def locate_points(
    points: DataFrame, regions: DataFrame, max_km2: float, on: str | None = None
) -> DataFrame:
    """Adds ``cell_no`` of the first (row-major) grid cell holding each point, NULL outside the region.

    The cell is computed, not searched: no range join and no shuffle of the points beyond the equi-join
    that brings in the region's grid parameters (one row per region, not one per cell).
    """
    grid = with_grid_shape(regions, max_km2).select(
        F.col(on).alias(on), *[F.col(name).alias(f"_{name}") for name in (*BBOX, "n_cols", "n_rows", "lon_step", "lat_step")]
    )
    column = _axis_cell(F.col("longitude"), F.col("_min_long"), F.col("_lon_step"), F.col("_n_cols"))
    row = _axis_cell(F.col("latitude"), F.col("_min_lat"), F.col("_lat_step"), F.col("_n_rows"))
    located = points.join(grid, on, "left").withColumn("grid_col", column).withColumn("grid_row", row)
    return located.withColumn("cell_no", F.col("grid_row") * F.col("_n_cols") + F.col("grid_col") + 1).drop(
        *[name for name in located.columns if name.startswith("_")]
    )
