"""Centroid models in label blocks against brute force and against the model with a column per label."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.operators import label_blocks as lb
from hazardlake.operators import text_model as tm

from .test_text import TESTS, TRAIN, py_model

SCHEMA = "id int, label string, text string"


def brute_force(train, texts, limit):
    vector, centroids = py_model(train, limit)
    best = {}
    for key, text in texts:
        v = vector(text)
        scores = [(-round(sum(v.get(t, 0.0) * w for t, w in c.items()), 8), label) for label, c in centroids.items()]
        best[key] = min(scores)[::-1]
    return {k: (label, -minus) for k, (label, minus) in best.items()}


@pytest.mark.parametrize("width", [1, 2, 64])
def test_blocks_equal_brute_force(spark, width, tmp_path):
    model = lb.fit(spark.createDataFrame(TRAIN, SCHEMA), "id", max_features=20, width=width).save(str(tmp_path / "model"))
    texts = spark.createDataFrame(TESTS, "msg int, text string")
    got = {r.msg: (r.category, r.score) for r in lb.BlockModel.load(spark, str(tmp_path / "model")).classify(texts, "msg").collect()}
    want = brute_force(TRAIN, TESTS, 20)
    assert {k: c for k, (c, _) in got.items()} == {k: c for k, (c, _) in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-7) for k in want)
    plain = tm.fit_centroids(spark.createDataFrame(TRAIN, SCHEMA), "id", max_features=20)
    assert sorted(model.classify(texts, "msg").collect()) == sorted(plain.classify(texts, "msg").collect())
    only = [plain.labels[-1]]
    assert {r.category for r in model.classify(texts, "msg", labels=only).collect()} == set(only)


def test_five_thousand_labels(spark):
    """Every label has a word of its own and shares others; a label column of this many is refused by the plain model."""
    rng = random.Random(5)
    shared = [f"w{i}" for i in range(200)]
    train = [(i, f"label {i:05d}", f"own{i} own{i} {rng.choice(shared)} {rng.choice(shared)}") for i in range(5000)]
    rows = spark.createDataFrame(train, SCHEMA)
    with pytest.raises(ValueError, match="label_blocks"):
        tm.fit_centroids(rows, "id")
    model = lb.fit(rows, "id", max_features=100_000)
    assert model.labels.count() == 5000 and model.weights.select("block").distinct().count() == math.ceil(5000 / lb.WIDTH)
    probes = [(i, f"own{i} {rng.choice(shared)}") for i in range(0, 5000, 7)]
    got = {r.msg: r.category for r in model.classify(spark.createDataFrame(probes, "msg int, text string"), "msg").collect()}
    assert got == {i: f"label {i:05d}" for i, _ in probes}


def test_awkward_training_rows(spark):
    rows = spark.createDataFrame([(1, None, "fire fire"), (2, "a", None), (3, "b", "calm sea"), (4, "b", "")], SCHEMA)
    texts = spark.createDataFrame([(1, "fire"), (2, "calm"), (3, None)], "msg int, text string")
    got = {r.msg: (r.category, round(r.score, 6) > 0) for r in lb.fit(rows, "id").classify(texts, "msg").collect()}
    assert got == {1: ("a", False), 2: ("b", True), 3: ("a", False)}  # a label without terms is a label
    empty = lb.fit(rows.limit(0), "id").classify(texts, "msg").collect()
    assert {(r.msg, r.category, r.score) for r in empty} == {(i, None, 0.0) for i in (1, 2, 3)}


@pytest.mark.parametrize("width", [1, 7, 64])
def test_vector_blocks_equal_numpy(spark, width):
    rng = np.random.default_rng(3)
    labels = [f"l{i:02d}" for i in range(40)]
    data = [(i, [float(x) for x in rng.normal(size=6)], labels[i % 40]) for i in range(200)]
    data += [data[0], (200, [0.0] * 6, "l39"), (201, [1.0] * 6, "l39")]
    vectors = spark.createDataFrame(data, "vec_id int, v array<double>, label string")
    blocks = lb.vector_blocks(tm.vector_centroids(vectors, vector="v"), width=width)
    assert blocks.count() == math.ceil(40 / width)
    with_broadcast = sorted(lb.vector_classify(vectors, blocks, "vec_id", "v").collect())
    sent = lb.vector_classify(vectors, blocks, "vec_id", "v", spread=3, broadcast_bytes=0)
    assert "BroadcastHashJoin" not in sent._jdf.queryExecution().toString() and sorted(sent.collect()) == with_broadcast
    means = np.array([np.mean([v for _, v, own in data if own == label], axis=0) for label in labels])
    means /= np.linalg.norm(means, axis=1, keepdims=True)
    want = []
    for i, v, _ in data:
        scores = means @ np.array(v) / (np.linalg.norm(v) or 1.0)
        best = int(np.argmax(np.round(scores, 8)))
        want.append((i, labels[best], pytest.approx(scores[best], abs=1e-7)))
    assert [tuple(r) for r in with_broadcast] == sorted(want, key=lambda r: r[0])


def test_vector_awkward_rows(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0], None), (2, [0.0, 1.0], "b"), (3, None, "b")], "vec_id int, v array<double>, label string")
    blocks = lb.vector_blocks(tm.vector_centroids(vectors, vector="v"))
    got = {r.vec_id: (r.category, r.score) for r in lb.vector_classify(vectors, blocks, "vec_id", "v").collect()}
    assert got[1] == (None, 1.0) and got[2] == ("b", 1.0) and set(got) == {1, 2, 3}
    none = lb.vector_blocks(tm.vector_centroids(vectors.filter(F.lit(False)), vector="v"))
    assert lb.vector_classify(vectors, none, "vec_id", "v").count() == 0
