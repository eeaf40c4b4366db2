"""Whitening and vector codes against plain versions."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardlake.llm import embedding_whitening, vector_codes, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def flat_and_hot(seed, n, d):
    """Vectors of a nearly flat spectrum with two strong directions, a third of them equal."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + 3 * rng.normal(size=(n, 1)) * np.eye(d)[0] + 2 * rng.normal(size=(n, 1)) * np.ones(d) / math.sqrt(d)
    x[: n // 3] = x[0]
    return (x / 8).astype(np.float32)


def plain_whitening(x, k):
    x = np.floor(1024 * x.astype(np.float64)) + 100_000
    apart = x - x.mean(axis=0)
    value, vector = np.linalg.eigh(apart.T @ apart / len(x))
    value, vector = value[::-1], vector[:, ::-1]
    n, total = len(x), [int(s) for s in x.sum(axis=0)]
    far = [sum((n * int(v) - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x]
    return value[:k], apart @ vector[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum(), far


@pytest.mark.parametrize(("n", "d"), [(400, 12), (300, 40)])
def test_whitening_equals_a_full_decomposition(spark, n, d):
    x = flat_and_hot(n, n, d)
    found = embedding_whitening.whitening(table(spark, [(i, v.tolist(), "a") for i, v in enumerate(x)])).toPandas()
    k = min(8, d)
    value, white, share, far = plain_whitening(x, k)
    assert len(found) == n * k
    mine = found.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * sign - white).max() < 1e-9
    assert np.abs(found.groupby("component")["explained"].first().to_numpy() / share - 1).max() < 1e-10
    assert found["identity_error"].max() < 1e-10 and found["residual"].max() < 1e-11
    assert [int(v) for v in found.groupby("vec_id")["deviation"].first()] == far


def test_whitening_uses_few_passes_and_leaves_no_direction_out(spark):
    """A wide flat spectrum: the block is filtered in far fewer passes than one a dimension and round."""
    x = flat_and_hot(1, 900, 96)
    rows, d = vectors.whole_vectors(table(spark, [(i, v.tolist(), None) for i, v in enumerate(x)]), 1024.0, 100_000, 1 << 40)
    model = embedding_whitening.fit(rows, d)
    value, white, _, _ = plain_whitening(x, 8)
    assert 4 < model.passes < 120
    assert np.abs(model.values / value - 1).max() < 1e-12 and (np.diff(model.values) <= 0).all()
    assert np.abs(model.basis.T @ model.basis - np.eye(8)).max() < 1e-13


def test_filter_bound_nears_the_lower_end():
    rng = np.random.default_rng(5)
    value = np.linspace(3.0, 9.0, 40)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    v = turn * value @ turn.T
    probe = embedding_whitening.Lanczos(40)
    bounds = []
    for _ in range(45):
        probe.step(v @ probe.vector)
        bounds.append(probe.floor())
    assert bounds[0] == 0.0 and max(bounds) < 3.1 and abs(bounds[-1] - 3.0) < 1e-9


def test_whitening_awkward(spark):
    good = [[1.0, 2.0, 0.5], [0.0, -1.0, 0.25], [3.0, 1.0, -2.0], [0.5, 0.5, 0.5]]
    bad = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [], [1.0, 2.0]]
    rows = [(i, v, None) for i, v in enumerate(good)] + [(None, good[0], "x"), (2, good[2], "y")] + [(90 + i, v, "z") for i, v in enumerate(bad)]
    frame = table(spark, rows).withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).withColumn("component", F.lit(0))
    found = embedding_whitening.whitening(frame).toPandas()
    used = np.array([*good, good[0], good[2]], np.float32)
    value, white, share, far = plain_whitening(used, 3)
    assert len(found) == 6 * 3 and set(found["n"]) == {6}
    assert sorted(int(v) for v in found["deviation"]) == sorted(far * 3)
    one = found[found["component"] == 1]["whitened"].to_numpy()
    assert np.allclose(np.sort(np.abs(one)), np.sort(np.abs(white[:, 0])))
    same = table(spark, [(1, [1.0, 1.0], None), (2, [1.0, 1.0], None)])
    columns = found.columns.tolist()
    for nothing in (table(spark, []), same, table(spark, [(1, [1.0, 2.0], "a")]), table(spark, [(1, None, "a"), (2, [], "a")])):
        result = embedding_whitening.whitening(nothing)
        assert result.columns == columns and result.count() == 0
    lower = table(spark, [(i, [float(i), 2.0 * i, 7.0], None) for i in range(5)])
    assert {r["component"] for r in embedding_whitening.whitening(lower).collect()} == {1}


def test_deviation_beyond_machine_numbers():
    x = np.array([[1 << 40, 0], [-(1 << 40), 5]], np.int64)
    whole, rest = np.array([0, 2]), np.array([0, 1])
    n = 1_000_003
    expected = [sum((n * int(v - w) - int(r)) ** 2 for v, w, r in zip(row, whole, rest, strict=True)) for row in x]
    assert embedding_whitening.deviation(x, whole, rest, n) == expected


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Books and codes of (vec_id, vector, label) rows with distinct ids, by loops."""
    kept = sorted((i, [math.floor(4096 * c) for c in v], label) for i, v, label in rows)
    d = len(kept[0][1])
    bounds = [(d * p // parts, d * (p + 1) // parts) for p in range(parts)]
    books = [[v[a:b] for _, v, _ in kept[:entries]] for a, b in bounds]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(bounds):
            held = {}
            for _, v, _ in kept:
                held.setdefault(near(v[a:b], books[p])[1], []).append(v[a:b])
            for entry, own in held.items():
                books[p][entry] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found, errors = {}, {}
    for i, v, label in kept:
        best = [near(v[a:b], books[p]) for p, (a, b) in enumerate(bounds)]
        found[i] = ("".join(f"{e:02x}" for _, e in best), sum(far for far, _ in best))
        errors[label] = errors.get(label, 0) + found[i][1]
    flat = ",".join(str(c) for book in books for e in book for c in e)
    return found, errors, hashlib.sha256(flat.encode()).hexdigest()


@pytest.mark.parametrize(("n", "d"), [(150, 16), (60, 13), (9, 8), (40, 5)])
def test_codes_equal_plain_loops(spark, n, d):
    rng = np.random.default_rng(n)
    x = np.round(rng.normal(size=(n, d)), 1 if d > 8 else 3).astype(np.float32)
    x[: n // 3, : d // 2] = x[0, : d // 2]
    rows = [(3 * i - 20, [float(c) for c in v], "ab"[i % 2] if i % 5 else None) for i, v in enumerate(x)]
    coded, books = vector_codes.compress(table(spark, rows))
    found, _, digest = plain_codes(rows)
    assert {r["vec_id"]: (r["code"], r["error"]) for r in coded.collect()} == found
    assert vector_codes.books_digest(books) == digest


def test_codes_query(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in v], "ab"[i % 2] if i % 5 else None) for i, v in enumerate(rng.normal(size=(50, 16)))]
    bad = [(100, None, "a"), (101, [1.0] * 15 + [float("nan")], "a"), (102, [1.0] * 15 + [None], None), (103, [1.0], "a")]
    table(spark, rows + bad).withColumn("error", F.lit(1)).withColumn("part", F.lit(1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    found, errors, digest = plain_codes(rows)
    result = vector_codes.op13_vector_codes(spark, str(tmp_path)).collect()
    label = {i: name for i, _, name in rows}
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in result} == {i: (*v, errors[label[i]]) for i, v in found.items()}
    assert {r["codebooks_sha256"] for r in result} == {digest}


def test_codes_awkward(spark):
    rows = [(1, [1.0, 2.0], "a"), (1, [0.5, 9.0], "a"), (None, [7.0, 7.0], None), (2, [1.0, 2.0], "b"), (2, [1.0, 2.0], "b")]
    coded, books = vector_codes.compress(table(spark, rows))
    found = sorted((r["vec_id"] or 0, r["code"], r["error"]) for r in coded.collect())
    assert len(found) == 5 and found[-1] == found[-2]
    # with 8 parts of 2 dimensions, only parts 3 and 7 hold one; three distinct ids are three entries
    assert [book.shape for book in books] == [(3, 0)] * 3 + [(3, 1)] + [(3, 0)] * 3 + [(3, 1)]
    empty, none = vector_codes.compress(table(spark, []))
    assert empty.columns == coded.columns and empty.count() == 0 and none == []
    huge, _ = vector_codes.compress(table(spark, [(1, [1e30, -1e30], "a"), (2, [0.0, 1.0], "a")]))
    assert huge.count() == 2
    with pytest.raises(ValueError, match="entries"):
        vector_codes.compress(table(spark, rows), entries=257)


def test_walk_shares_prefixes_across_runs(monkeypatch):
    monkeypatch.setattr(vector_codes, "RUN", 7)
    rng = np.random.default_rng(9)
    leaves = rng.integers(-3, 4, size=(200, 4))
    leaves = leaves[vector_codes.sorted_rows(leaves)]
    entries = rng.integers(-3, 4, size=(16, 4))
    far = np.square(leaves[:, None, :] - entries[None]).sum(axis=2)
    nearest, distance = vector_codes.walk(leaves, entries)
    assert (nearest == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def test_packed_rows_keep_the_order():
    rng = np.random.default_rng(4)
    rows = rng.integers(-(1 << 40), 1 << 40, size=(300, 3))
    rows[::3, 0] = rows[0, 0]
    column = vectors.packed(rows.ravel(), np.full(300, 3))
    assert (vectors.matrix(column, 3) == rows).all()
    assert (vectors.matrix(column.slice(7, 5), 3) == rows[7:12]).all()
    assert sorted(range(300), key=lambda i: column[i].as_py()) == vector_codes.sorted_rows(rows).tolist()


def test_decode_gives_the_entries():
    books = [np.array([[4096, -8192], [0, 2048]]), np.array([[1024], [4096]])]
    assert vector_codes.decode("0100", books) == [0.0, 0.5, 0.25]
