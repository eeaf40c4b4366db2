"""Exact nearest neighbours within classes: a metric index of pivots, cells and radii.

Equal vectors of a class are one point with its smallest keys. A few points of a class are pivots, and every point
belongs to the cell of its nearest pivot. A first pass searches each asking point's own cell, which bounds the distance
of its last neighbour from above. By the triangle inequality another cell can only hold a nearer point when the
distance to its pivot, less the cell's radius, is within that bound; the second pass sends the point to those cells
alone. Cells and askers are dealt into groups of bounded size, and only candidates leave a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.session import stored

#: Most points, and most askers, of one group.
BLOCK = 4096
#: Points a cell should have, most pivots of a class, and of all classes together (they travel with the tasks).
CELL, PIVOTS, ALL_PIVOTS = 512, 256, 16384
#: Distances are compared with this relative slack, so that rounding never hides a cell.
SLACK = 1e-9
_SQUARES = 1 << 20


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def _rows_at_once(width: int) -> int:
    return max(1, _SQUARES // max(1, width))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _points(rows: DataFrame, k: int) -> DataFrame:
    """``_class, _v, _keys, _asks``: distinct vectors with their k + 1 smallest keys, and whether any row asks."""
    first = Window.partitionBy("_class", "_v").orderBy("_key")
    few = rows.select("_class", "_v", "_key").withColumn("_no", F.row_number().over(first)).filter(F.col("_no") <= k + 1)
    keys = few.groupBy("_class", "_v").agg(F.array_sort(F.collect_list("_key")).alias("_keys"))
    asks = rows.groupBy("_class", "_v").agg(F.max("_asks").alias("_asks"))
    return keys.join(asks, ["_class", "_v"])


def _pivots(points: DataFrame) -> dict[object, np.ndarray]:
    """Pivot vectors of every class: the points of lowest hash, as many as its size asks for."""
    sizes = {r["_class"]: r["n"] for r in points.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = max(1, min(PIVOTS, ALL_PIVOTS // max(1, len(sizes))))
    order = Window.partitionBy("_class").orderBy(F.xxhash64("_v"), "_v")
    chosen: dict[object, list] = {c: [] for c in sizes}
    for r in points.select("_class", "_v").withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= most).collect():
        if r["_no"] <= max(1, -(-sizes[r["_class"]] // CELL)):
            chosen[r["_class"]].append(r["_v"])
    return {c: np.array(v, dtype=float) for c, v in chosen.items()}


def nearest(rows: DataFrame, k: int, compared: Accumulator | None = None) -> DataFrame:
    """``_class, _key, _near``: the ``k`` nearest other rows of the class (``d`` squared distance, ``k`` key, ``v`` vector).

    ``rows``: ``_class``, ``_key`` (unique), ``_v`` (complete vectors of one length) and ``_asks``, whether a row wants
    neighbours; a row a class asks for. Ties go by key. A class of fewer rows gives fewer neighbours. ``compared``, an
    accumulator, counts the compared pairs.
    """
    key_kind, class_kind = (rows.schema[c].dataType.simpleString() for c in ("_key", "_class"))
    spark = rows.sparkSession
    points = stored(_points(rows, k), "points")
    pivots = _pivots(points)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("_class"):
                vectors, own = _matrix(part["_v"]), pivots[name]
                cell, far = np.empty(len(part), np.int32), np.empty(len(part))
                step = _rows_at_once(own.size)
                for at in range(0, len(part), step):
                    squares = _squared(vectors[at : at + step], own)
                    cell[at : at + step] = squares.argmin(axis=1)
                    far[at : at + step] = np.sqrt(squares.min(axis=1))
                yield part.assign(_cell=cell, _far=far)

    kind = f"_class {class_kind}, _v array<double>, _keys array<{key_kind}>, _asks boolean, _cell int, _far double"
    dealt = stored(points.mapInPandas(assign, kind).withColumn("_id", F.monotonically_increasing_id()), "cells")
    cells = dealt.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_far").alias("radius"))
    radius: dict[object, np.ndarray] = {c: np.zeros(len(p)) for c, p in pivots.items()}
    splits = []
    for r in cells.collect():  # a row a pivot
        radius[r["_class"]][r["_cell"]] = r["radius"]
        splits.append((r["_class"], r["_cell"], -(-r["n"] // BLOCK)))
    splits = F.broadcast(spark.createDataFrame(splits, f"_class {class_kind}, _cell int, _splits int"))

    entry = f"array<struct<d: double, k: {key_kind}, v: array<double>>>"

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asking, every = group[group["_asks"]], group[~group["_asks"]]
        found = [[] for _ in range(len(asking))]
        if len(asking) and len(every):
            have, wanted = _matrix(every["_v"]), _matrix(asking["_v"])
            keys = [list(x) for x in every["_keys"]]
            step = _rows_at_once(have.size)
            for at in range(0, len(asking), step):
                squares = _squared(wanted[at : at + step], have)
                for i, row in enumerate(squares):
                    last = np.partition(row, k)[k] if len(row) > k else np.inf
                    near = np.flatnonzero(row <= last)
                    entries = sorted((row[j], key, j) for j in near.tolist() for key in keys[j])[: k + 1]
                    found[at + i] = [{"d": d, "k": key, "v": have[j].tolist()} for d, key, j in entries]
            if compared is not None:
                compared.add(len(asking) * len(every))
        return pd.DataFrame({"_class": asking["_class"], "_id": asking["_id"], "_v": asking["_v"], "_found": found})

    def searched(asked: DataFrame) -> DataFrame:
        """Candidates of ``asked`` (``_class, _id, _v, _cell``, stored) from the cells they name, k + 1 a group."""
        chunks = asked.groupBy("_class", "_cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_chunks"))
        shape = splits.join(chunks, ["_class", "_cell"])
        left = asked.join(F.broadcast(shape), ["_class", "_cell"]).select(
            "_class", "_cell", F.lit(True).alias("_asks"), "_id", "_v", F.lit(None).cast(f"array<{key_kind}>").alias("_keys"),
            F.explode(F.sequence(F.lit(0), F.col("_splits") - 1)).alias("_split"),
            F.pmod(F.xxhash64("_id"), F.col("_chunks")).cast("int").alias("_chunk"),
        )
        right = dealt.join(F.broadcast(shape), ["_class", "_cell"]).select(
            "_class", "_cell", F.lit(False).alias("_asks"), "_id", "_v", "_keys",
            F.pmod(F.xxhash64("_id"), F.col("_splits")).cast("int").alias("_split"),
            F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"),
        )
        both = left.unionByName(right).groupBy("_class", "_cell", "_split", "_chunk")
        return both.applyInPandas(compare, f"_class {class_kind}, _id bigint, _v array<double>, _found {entry}")

    def best(found: DataFrame) -> DataFrame:
        entries = F.slice(F.array_sort(F.flatten(F.collect_list("_found"))), 1, k + 1)
        return found.groupBy("_class", "_id").agg(F.first("_v").alias("_v"), entries.alias("_found"))

    own = stored(best(searched(dealt.filter("_asks").select("_class", "_id", "_v", "_cell"))), "own-cell")
    last = F.when(F.size("_found") > k, F.sqrt(F.element_at("_found", -1)["d"])).otherwise(F.lit(float("inf")))

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, part in batch.groupby("_class"):
                vectors, centres = _matrix(part["_v"]), pivots[name]
                step = _rows_at_once(centres.size)
                for at in range(0, len(part), step):
                    far = np.sqrt(_squared(vectors[at : at + step], centres))
                    bound = part["_last"].to_numpy()[at : at + step, None]
                    near = far - radius[name][None, :] <= bound + SLACK * (far + radius[name][None, :])
                    near[np.arange(len(far)), far.argmin(axis=1)] = False  # the own cell is searched
                    i, cell = np.nonzero(near)
                    yield part.iloc[at + i][["_class", "_id", "_v"]].assign(_cell=cell.astype(np.int32))

    others = own.select("_class", "_id", "_v", last.alias("_last")).mapInPandas(reach, f"_class {class_kind}, _id bigint, _v array<double>, _cell int")
    every = best(own.unionByName(searched(stored(others, "asks"))))
    asking = rows.filter("_asks").select("_class", "_key", "_v")
    return asking.join(every.select("_class", "_v", "_found"), ["_class", "_v"]).select(
        "_class", "_key", F.slice(F.filter("_found", lambda x: x["k"] != F.col("_key")), 1, k).alias("_near")
    )
