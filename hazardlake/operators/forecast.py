"""Fire-risk forecast: split, balance, train, score, date remap, gate."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.constants import FEATURES
from hazardlake.operators import ranks
from hazardlake.operators.neighbours import nearest

_RANK_BITS = 31
MAX_CLASSES = 1000


def drop_incomplete(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Rows whose features are all present.

    One test per column, not ``dropna``: its single predicate over all columns makes constraint
    propagation try every combination of aliases, 2^12 here, and planning takes minutes.
    """
    return df.filter(_complete(features))


def _complete(features: Sequence[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in features])


# ------------------------------------------------------------------ stratified split
def hash_rank(*keys: str, seed: int = 42) -> Column:
    """Pseudo-random rank in [0, 2^31) fixed by the row's key, not by its partition."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << _RANK_BITS))


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class. More than MAX_CLASSES classes is an error: ``label`` is then no class column."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return {row[0]: row[1] for row in rows}


def _training_quotas(counts: dict[int, int], test_share: float) -> dict[int, int]:
    """Training rows per class: proportional parts, the remainder to the largest fractions."""
    total = sum(counts.values())
    train = total - math.ceil(total * test_share)
    parts = {c: divmod(train * n, total) for c, n in counts.items()}
    spare = train - sum(whole for whole, _ in parts.values())
    first = sorted(parts, key=lambda c: (-parts[c][1], c))[:spare]
    return {c: whole + (c in first) for c, (whole, _) in parts.items()}


def _per_class(label: str, values: dict[int, float], kind: str) -> Column:
    """The value of the row's class, as an expression; no join."""
    found = F.lit(None).cast(kind)
    for c, value in values.items():
        found = F.when(F.col(label) == c, F.lit(value).cast(kind)).otherwise(found)
    return found


def _class_places(df: DataFrame, label: str, key: str, rank: Column) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """``_class, _rank, _key, _place`` in the order of the first three, and size and first place of each class.

    One pass over three columns. Rows without a class are left out. More than MAX_CLASSES classes are an error.
    """
    narrow = df.select(F.col(label).alias("_class"), rank.alias("_rank"), F.col(key).alias("_key")).filter("_class IS NOT NULL")
    placed = ranks.positions(narrow, ["_class", "_rank", "_key"], "_place")
    rows = placed.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("first")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return placed, {r["_class"]: (r["n"], r["first"]) for r in rows}


def _lowest_ranked(
    df: DataFrame, label: str, key: str, places: tuple[DataFrame, dict[int, tuple[int, int]]], quotas: dict[int, int], name: str, rank: Column
) -> DataFrame:
    """Adds ``name``: whether a row is among the ``quotas[class]`` rows of lowest rank (ties by key) of its class.

    The last row within the quota is looked up by its place; one row per class is broadcast (``_class_places`` has
    checked how many) and all rows are compared with it in one pass.
    """
    placed, classes = places
    last = [first + min(quotas.get(c, 0), n) - 1 for c, (n, first) in classes.items() if quotas.get(c, 0) > 0]
    edge = placed.filter(F.col("_place").isin(last)).select("_class", F.struct("_rank", "_key").alias("_edge"))
    here = F.struct(F.col("_row_rank").alias("_rank"), F.col(key).alias("_key"))
    located = df.withColumn("_row_rank", rank).join(F.broadcast(edge), F.col(label) == F.col("_class"), "left")
    return located.withColumn(name, F.coalesce(here <= F.col("_edge"), F.lit(False))).drop("_row_rank", "_class", "_edge")


def stratified_split(
    df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42, rank: Column | None = None
) -> DataFrame:
    """Adds ``is_train``: an exact split that keeps class shares, whatever the class sizes.

    The test part has ceil(n * share) rows. Within a class the rows of lowest rank train. Rows without a class do not.
    """
    rank = hash_rank(key, seed=seed) if rank is None else rank
    places = _class_places(df, label, key, rank)
    quotas = _training_quotas({c: n for c, (n, _) in places[1].items()}, test_share)
    return _lowest_ranked(df, label, key, places, quotas, "is_train", rank)


# ------------------------------------------------------------------ class balance
def class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Adds a weight that gives every class the total of the largest one."""
    counts = class_counts(df, label)
    most = max(counts.values())
    return df.withColumn(weight, _per_class(label, {c: most / n for c, n in counts.items()}, "double"))


def _uniform(salt: int, seed: int) -> Column:
    """Uniform [0, 1) per (row, synthetic row), independent of partitioning."""
    return F.pmod(F.xxhash64("_key", "_i", F.lit(seed), F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def smote(
    df: DataFrame, label: str, features: Sequence[str] = FEATURES, k: int = 5, seed: int = 42, key: str = "row_id", pair: bool = False
) -> DataFrame:
    """Original rows plus synthetic ones until every class is as large as the largest.

    A synthetic row lies between a row of its class and one of that row's ``k`` nearest neighbours in the class.
    Every row of a class gets the same number of synthetic rows, and those of lowest rank one more, so the total is
    exact. Neighbours are exact (``neighbours.nearest``); the method is the same for classes of every size and any kind of
    label. ``key`` is unique; a row without neighbours is repeated. ``pair`` keeps where a synthetic row comes from: the
    row and its neighbour.
    """
    names = list(features)
    counts = class_counts(df, label)
    most = max(counts.values(), default=0)
    small = {c: n for c, n in counts.items() if c is not None and n < most}
    none = F.lit(None).cast(df.schema[key].dataType)
    original = df.select(label, *names, F.lit(False).alias("synthetic"), *([none.alias("near_a"), none.alias("near_b")] if pair else []))
    if not small:
        return original
    wanted = {c: divmod(most - n, n) for c, n in small.items()}
    vector = F.array(*[F.col(name).cast("double") for name in names])
    minority, rank = df.filter(F.col(label).isin(list(small))), hash_rank(key, seed=seed)
    more = {c: rest for c, (_, rest) in wanted.items()}
    ranked = _lowest_ranked(minority, label, key, _class_places(minority, label, key, rank), more, "_more", rank)
    rows = ranked.select(
        F.col(label).alias("_class"),
        F.col(key).alias("_key"),
        vector.alias("_v"),
        (_per_class(label, {c: each for c, (each, _) in wanted.items()}, "int") + F.col("_more").cast("int")).alias("_times"),
    ).withColumn("_asks", F.col("_times") > 0)
    plan = rows.filter("_asks").join(nearest(rows.drop("_times"), k), ["_class", "_key"])
    plan = plan.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    place = F.floor(_uniform(2, seed) * F.size("_near")).cast("int")
    chosen = F.when(F.size("_near") > 0, F.get("_near", place)).otherwise(F.struct(F.lit(0.0).alias("d"), F.col("_key").alias("k"), F.col("_v").alias("v")))
    ends = plan.select("_class", "_key", "_v", chosen.alias("_chosen"), _uniform(3, seed).alias("_gap"))
    between = F.zip_with("_v", F.col("_chosen.v"), lambda a, b: a + (b - a) * F.col("_gap"))
    synthetic = ends.select("_class", between.alias("_x"), F.col("_key").alias("near_a"), F.col("_chosen.k").alias("near_b"))
    return original.unionByName(
        synthetic.select(
            F.col("_class").alias(label),
            *[F.col("_x")[i].alias(name) for i, name in enumerate(names)],
            F.lit(True).alias("synthetic"),
            *(["near_a", "near_b"] if pair else []),
        )
    )


def balance(
    df: DataFrame, label: str, features: Sequence[str] = FEATURES, seed: int = 42, key: str = "row_id"
) -> DataFrame:
    """Training rows with classes filled up by synthetic ones, and a ``weight`` of 1."""
    return smote(df, label, features, seed=seed, key=key).drop("synthetic").withColumn("weight", F.lit(1.0))


# ------------------------------------------------------------------ forest
def train_forest(
    training: DataFrame,
    label: str = "fire_class",
    features: Sequence[str] = FEATURES,
    trees: int = 100,
    depth: int = 15,
    seed: int = 42,
) -> PipelineModel:
    """Random forest over the feature columns; uses a ``weight`` column when there is one."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, predictionCol="_prediction", numTrees=trees, maxDepth=depth, seed=seed
    )
    if "weight" in training.columns:
        forest = forest.setWeightCol("weight")
    return Pipeline(stages=[assembler, forest]).fit(training)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Adds ``fire_prediction``; rows with an incomplete feature keep NULL. No join, one pass."""
    complete = _complete(features)
    scored = model.transform(df)
    return scored.withColumn("fire_prediction", F.when(complete, F.col("_prediction"))).select(
        *df.columns, "fire_prediction"
    )


# ------------------------------------------------------------------ dates and gate
def remap_times(df: DataFrame, time: str, start: Column) -> DataFrame:
    """Replaces distinct times, in order, by consecutive dates from ``start``; NULL stays.

    The distinct times are numbered by ranges (``ranks.positions``), so nothing is sorted or numbered in one task.
    """
    times = df.select(F.col(time).alias("_t")).filter("_t IS NOT NULL").distinct()
    mapping = ranks.positions(times, ["_t"], "_place").select("_t", F.date_add(start, F.col("_place").cast("int")).alias("_date"))
    return df.join(mapping, F.col(time) == F.col("_t"), "left").withColumn(time, F.col("_date")).drop("_t", "_date")


def gate(predictions: DataFrame, prediction: str = "fire_prediction") -> DataFrame:
    """One row: the worst predicted class, and whether it starts monitoring (class 1 or 2; NULL does not)."""
    worst = predictions.agg(F.max(prediction).cast("int").alias("max_class"))
    return worst.withColumn("start_monitoring", F.coalesce(F.col("max_class").isin(1, 2), F.lit(False)))
