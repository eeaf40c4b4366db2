import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.operators import forecast, neighbours, ranks
from hazardlake.plans import early_warning, proxies

from .conftest import SF

XY = ["x", "y"]


def table(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((i, *map(float, rng.normal(label * 3, 1, 2)), label))
            i += 1
    return spark.createDataFrame(rows, "row_id int, x double, y double, fire_class int")


@pytest.mark.parametrize("sizes", [{0: 50, 1: 30, 2: 20}, {0: 7, 1: 3, 2: 1}, {0: 101}, {0: 33, 1: 33, 2: 33}])
def test_split_sizes_are_exact_and_stratified(spark, sizes):
    split = forecast.stratified_split(table(spark, sizes), "fire_class", "row_id")
    rows = split.collect()
    n = sum(sizes.values())
    assert len(rows) == len({r.row_id for r in rows}) == n
    train = -(-n * 2 // 10)
    assert sum(not r.is_train for r in rows) == train  # ceil(0.2 n) test rows
    for label, size in sizes.items():
        share = sum(r.is_train for r in rows if r.fire_class == label)
        assert abs(share - (n - train) * size / n) < 1


def test_split_takes_the_lowest_ranks(spark):
    df = table(spark, {0: 40, 1: 20})
    rank = F.pmod(F.col("row_id") * 7919, F.lit(997))
    rows = forecast.stratified_split(df, "fire_class", "row_id", rank=rank).collect()
    for label in (0, 1):
        ordered = sorted((r.row_id * 7919 % 997, r.row_id, r.is_train) for r in rows if r.fire_class == label)
        flags = [flag for *_, flag in ordered]
        assert flags == sorted(flags, reverse=True)


def test_smote_balances_and_stays_on_segments(spark):
    df = table(spark, {0: 30, 1: 12, 2: 2})
    rows = forecast.smote(df, "fire_class", XY, k=3).collect()
    counts = {c: sum(r.fire_class == c for r in rows) for c in (0, 1, 2)}
    assert counts == {0: 30, 1: 30, 2: 30}
    assert sum(not r.synthetic for r in rows) == 44
    originals = {c: np.array([(r.x, r.y) for r in df.collect() if r.fire_class == c]) for c in (1, 2)}
    for r in (r for r in rows if r.synthetic):
        points, p = originals[r.fire_class], np.array([r.x, r.y])
        on_segment = False
        for i, a in enumerate(points):
            distance = ((points - a) ** 2).sum(axis=1)
            distance[i] = np.inf
            for j in np.argsort(distance)[: min(3, len(points) - 1)]:
                b = points[j]
                gap = np.dot(p - a, b - a) / np.dot(b - a, b - a)
                on_segment |= -1e-9 <= gap <= 1 + 1e-9 and np.allclose(a + gap * (b - a), p)
        assert on_segment


def test_smote_is_repeatable_across_partitionings(spark):
    df = table(spark, {0: 12, 1: 5})
    a = sorted(forecast.smote(df, "fire_class", XY).collect())
    assert a == sorted(forecast.smote(df.repartition(7), "fire_class", XY).collect())


def test_single_row_class_is_repeated(spark):
    rows = forecast.smote(table(spark, {0: 4, 1: 1}), "fire_class", XY).filter("fire_class = 1").collect()
    assert len(rows) == 4 and len({(r.x, r.y) for r in rows}) == 1


def clustered(spark, n=500, label="a"):
    """Points of a few tight clusters, a third of them one and the same, in two classes."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 3)) * 40
    points = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, 3))
    points[: n // 3] = points[0]
    rows = [(label if i % 5 else "b", i, [float(x) for x in p], i % 4 > 0) for i, p in enumerate(points)]
    return rows, spark.createDataFrame(rows, "_class string, _key int, _v array<double>, _asks boolean")


def test_pruned_neighbours_equal_all_pairs(spark, monkeypatch):
    for name, value in {"BLOCK": 16, "CELL": 12, "PIVOTS": 24}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows, df = clustered(spark)
    compared = spark.sparkContext.accumulator(0)
    found = {r["_key"]: [(x["d"], x["k"]) for x in r["_near"]] for r in neighbours.nearest(df, 4, compared).collect()}
    pairs = 0
    for label, key, v, asks in rows:
        others = [(sum((a - b) ** 2 for a, b in zip(v, w, strict=True)), k) for c, k, w, _ in rows if c == label and k != key]
        pairs += len(others)
        if asks:
            best = sorted(others)[:4]
            assert [k for _, k in found[key]] == [k for _, k in best] and np.allclose([d for d, _ in found[key]], [d for d, _ in best])
    assert len(found) == sum(r[3] for r in rows) and 0 < compared.value < pairs / 5


def test_balance_takes_text_classes_and_names_its_neighbours(spark):
    df = table(spark, {0: 60, 1: 25, 2: 1}).withColumn("fire_class", F.concat(F.lit("c"), F.col("fire_class").cast("string")))
    balanced = forecast.balance(df, "fire_class", XY)
    assert {r[0]: r[1] for r in balanced.groupBy("fire_class").sum("weight").collect()} == {"c0": 60.0, "c1": 60.0, "c2": 60.0}
    place = {r.row_id: np.array([r.x, r.y]) for r in df.collect()}
    for r in forecast.smote(df, "fire_class", XY, pair=True).filter("synthetic").collect():
        a, b, p = place[r.near_a], place[r.near_b], np.array([r.x, r.y])
        assert abs(np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) < 1e-9


def test_positions_count_through_ranges(spark):
    values = [(i * 7919) % 1009 for i in range(1009)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    placed = ranks.positions(df, ["v"])
    assert all(r.v == r.position for r in placed.collect()) and placed.count() == 1009
    assert ranks.positions(df.limit(0), ["v"]).count() == 0


def test_forest_learns_and_leaves_incomplete_rows_open(spark):
    df = table(spark, {0: 60, 1: 60, 2: 20})
    model = forecast.train_forest(forecast.balance(df, "fire_class", XY), features=XY, trees=10, depth=5)
    holes = table(spark, {0: 60, 1: 60, 2: 20}, seed=5).withColumn("y", F.when(F.col("row_id") != 3, F.col("y")))
    rows = forecast.predict(model, holes, XY).collect()
    assert [r.row_id for r in rows if r.fire_prediction is None] == [3]
    right = np.mean([r.fire_class == r.fire_prediction for r in rows if r.row_id != 3])
    assert right > 0.85  # the majority class alone is 0.43


def test_gate(spark):
    def worst(*classes):
        df = spark.createDataFrame([(c,) for c in classes], "fire_prediction double")
        return tuple(forecast.gate(df).first())

    assert worst(0.0, 2.0, None) == (2, True)
    assert worst(0.0) == (0, False)
    assert worst(None) == (None, False)


def test_times_become_consecutive_dates(spark):
    times = [dt.datetime(2024, 5, 1, 6, 0, 0, 500000), dt.datetime(2024, 5, 1, 6), dt.datetime(2024, 4, 30, 23, 59, 59),
             dt.datetime(2024, 5, 1, 7), dt.datetime(2024, 5, 1, 6), None]
    df = spark.createDataFrame(list(enumerate(times)), "i int, time timestamp")
    got = [r.time for r in forecast.remap_times(df, "time", F.lit(dt.date(2025, 1, 1))).orderBy("i").collect()]
    day = lambda n: dt.date(2025, 1, n)
    assert got == [day(3), day(2), day(1), day(4), day(2), None]


def test_whole_flow_appends_and_gates_its_own_run(spark, tmp_path):
    history = proxies.weather_history(spark, SF)
    coming = history.drop("fire_class").withColumn("time", F.timestamp_seconds(F.col("row_id") * 3600))
    out = str(tmp_path / "predictions")
    run = lambda rows, day: early_warning.run(history, rows, dt.date(2024, 6, day), out, trees=5, depth=4).first()
    assert run(coming, 1).start_monitoring
    assert spark.read.parquet(out).count() == history.count()
    run(coming, 1)  # a replay of the same run replaces its rows
    assert spark.read.parquet(out).count() == history.count()
    blind = coming.withColumn("sst", F.lit(None).cast("double"))
    assert tuple(run(blind, 2)) == (None, False)  # the run before does not count
    predictions = spark.read.parquet(out)
    assert predictions.count() == 2 * history.count()
    assert predictions.filter("sst IS NULL AND fire_prediction IS NOT NULL").count() == 0


def test_runs_of_one_date_stay_apart(spark, tmp_path):
    """Another forecast of the same date appends; a replay, in any order of rows, replaces only itself."""
    history = proxies.weather_history(spark, SF)
    model = early_warning.train(history, trees=3, depth=3)
    coming = history.drop("fire_class").withColumn("time", F.timestamp_seconds(F.col("row_id") * 3600))
    out, day = str(tmp_path / "predictions"), dt.date(2024, 6, 1)
    parts = [coming.filter("row_id % 3 = 0"), coming.filter("row_id % 3 <> 0")]
    sizes = [part.count() for part in parts]
    for part in parts:
        early_warning.score(model, part, day, out)
    early_warning.score(model, parts[0].repartition(5), day, out)
    stored = early_warning.predictions(spark, out)
    assert sorted(r["count"] for r in stored.groupBy("run_token").count().collect()) == sorted(sizes)
    assert stored.count() == sum(sizes) == stored.select("row_id").distinct().count()
    early_warning.score(model, parts[0], day, out, token="007")  # a name of its own appends equal rows
    stored = early_warning.predictions(spark, out)
    assert stored.count() == sum(sizes) + sizes[0] and stored.filter("run_token = '007'").count() == sizes[0]
    tokens = {early_warning.run_token(part, day) for part in parts} | {early_warning.run_token(parts[0], dt.date(2024, 6, 2))}
    assert len(tokens) == 3 and early_warning.run_token(parts[0].limit(0), day) not in tokens
