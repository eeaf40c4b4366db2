"""Connected components, MinHash near-dedup and embedding near-dedup against all pairs."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from hazardlake.llm import common, embedding_dedup, minhash_dedup

from . import fixtures as fx


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1300)]
    links = [(a, b) for a, b in links if a != b]
    expected = fx.components({x for link in links for x in link}, links)
    rng.shuffle(links)
    edges = spark.createDataFrame(links, "a bigint, b bigint").repartition(16)
    assert {r.node: r.component for r in common.components(edges).collect()} == expected
    assert common.components(edges.limit(0)).count() == 0


def plain_near(rows, share=85):
    sets = {i: fx.words5(text) for i, text in rows}
    ids = list(sets)
    links = []
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both):
                links.append((i, j))
    found = fx.components(ids, links)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in ids}


@pytest.mark.parametrize("block", [256, 4])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    docs = fx.documents(spark)
    expected = plain_near([(r.doc_id, r.text) for r in docs.collect()])
    rows = minhash_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == expected
    assert sum(not x[2] for x in expected.values()) > 10


def test_members_that_miss_their_leader(spark, monkeypatch):
    """A group in which most pairs are just below the similarity: links run through members, not the leader."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    rng = random.Random(9)
    base = [fx.word(rng) + str(i) for i in range(400)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.sample(range(400), 8 if i else 12):
            words[at] = f"w{i}x{at}"
        rows.append((i, " ".join(words)))
    for i in range(60, 80):
        words = rows[i - 40][1].split()
        words[i] = "changed"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == plain_near(rows)


def test_near_duplicates_awkward(spark):
    rows = minhash_dedup.near_duplicates(fx.awkward(spark)).collect()
    assert len(rows) == 8
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id in (1, 4)} == {1}
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id in (2, 3)) == [(0, 2, True), (0, 3, True)]
    assert minhash_dedup.near_duplicates(fx.empty(spark)).count() == 0


def test_pipeline_links_from_four_fifths(spark):
    """Copies with scattered edits, at 0.84, 0.82 and just below 0.8 of their base."""
    import corpus_pipeline as pipeline

    rng = random.Random(12)
    rows = []
    for i in range(30):
        words = [fx.word(rng) + str(j) for j in range(400)]
        rows.append((2 * i, " ".join(words), "en", "s", 1))
        for j in range(7 + i % 3):
            words[20 + 40 * j] = f"edit{i}x{j}"
        rows.append((2 * i + 1, " ".join(words), "en", "s", 1))
    plain = [plain_near([r[:2] for r in rows], share) for share in (80, 85)]
    kept = pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, fx.DOCUMENTS), "")
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, x in plain[0].items() if x[2]]
    assert [sum(not x[2] for x in found.values()) for found in plain] == [20, 0]


def test_pipeline_keeps_one_row_of_each_group_and_all_other_texts(spark):
    import corpus_pipeline as pipeline

    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (1, a), (None, a), (7, ""), (7, ""), (8, None), (None, ""), (None, ""), (9, "one two")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], fx.DOCUMENTS)
    kept = pipeline.drop_near_duplicates(spark, docs.withColumn("row", F.lit(1)), "")
    assert kept.columns == list(pipeline.COLUMNS)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (7, ""), (8, None), (None, ""), (9, "one two")], key=repr)
    assert pipeline.drop_near_duplicates(spark, fx.empty(spark), "").count() == 0


def test_bands_follow_the_similarity():
    assert [minhash_dedup.n_bands(s) for s in (0.85, 0.8, 1.0)] == [20, 29, 1]
    for s in (0.95, 0.85, 0.8, 0.6, 0.5):
        n = minhash_dedup.n_bands(s)
        assert (1 - s**minhash_dedup.ROWS) ** n <= 1e-5 < (1 - s**minhash_dedup.ROWS) ** (n - 1)
    for s in (0.49, 0.0, 1.01):
        with pytest.raises(ValueError, match="similarity"):
            minhash_dedup.n_bands(s)


def test_pruning_bounds():
    steps = minhash_dedup.least_matches(0.85, 1e-5, 64, 16)
    assert [n for n, _ in steps] == [16, 32, 48, 64] and all(a < b for (_, a), (_, b) in zip(steps, steps[1:]))
    for n, least in steps:
        tail = lambda m: sum(math.comb(n + 1, j) * 0.85**j * 0.15 ** (n + 1 - j) for j in range(m + 1))
        assert tail(least) >= 1e-5 > tail(least - 1)


# ------------------------------------------------------------------ embeddings
def vectors(seed=6, n=300, d=24):
    rng = np.random.default_rng(seed)
    rows = []
    centre = rng.normal(size=d)
    for i in range(n):
        kind = i % 4
        v = rng.normal(size=d) if kind < 2 else centre + rng.normal(size=d) * (0.27 if kind == 2 else 0.05)
        rows.append((i * 2 + 1, v.astype(np.float32).tolist(), int(i % 3)))
    rows += [(9000 + i, rows[3][1], rows[3][2]) for i in range(5)] + [(9100, (np.array(rows[3][1]) * 4).tolist(), rows[3][2])]
    rows += [(9200, None, 1), (9201, [0.0] * d, 1), (9202, [float("nan")] + [1.0] * (d - 1), 1), (9203, [None] + [1.0] * (d - 1), 1)]
    rows += [(9204, rows[3][1], None), (9205, [float("inf")] * d, 1), (9206, [1.0, 2.0], 1), (9207, [1.0, 2.0], 1), (9208, [], 1), (None, rows[3][1], 0)]
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_near_vectors(spark, block):
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, label int, rep int, n_links int")
    usable = {
        i: (np.array(v, np.float32).astype(float), y)
        for i, v, y in rows
        if i is not None and v and y is not None and None not in v and np.isfinite(v).all() and any(v)
    }
    links = [
        (i, j)
        for i, (v, y) in usable.items()
        for j, (w, z) in usable.items()
        if j < i and y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93
    ]
    ids = [r[0] for r in rows if r[0] is not None]
    found = fx.components(ids, links)
    count = {i: sum(i in link for link in links) for i in ids}
    got = embedding_dedup.near_vectors(table, block=block).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == {
        i: (count[i], found[i], found[i] == i) for i in ids
    }
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert len(links) > 500 and embedding_dedup.near_vectors(table.limit(0)).count() == 0


def test_repeated_ids_count_their_own_links(spark):
    """One id with three vectors and labels: each row has the links of its own vector."""
    a, b = [1.0, 0.0, 0.2], [0.0, 1.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (1, a, 1), (2, a, 0), (3, a, 1), (4, b, 2), (4, a, 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(table).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 0, 4), (4, 2, 1)]


@pytest.mark.parametrize(("d", "seed"), [(64, 1), (768, 2)])
def test_recall_of_the_bound_near_the_threshold(d, seed):
    """Pairs whose cosine lies just above and below 0.93, where only six deviations stand between them and the cut."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(1500, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=(1500, d))
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = rng.uniform(0.925, 0.94, size=(1500, 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * off
    turn = embedding_dedup.rotation(d)
    bits, factor, _ = embedding_dedup.codes(x, turn)
    found = embedding_dedup.linked(x, bits, factor, y, y @ turn.T, 0.93, embedding_dedup.DEVIATIONS)
    assert (found == (np.einsum("nd,md->nm", x, y) >= 0.93)).all() and 500 < found.sum() < 1500


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    d = 64
    turn = embedding_dedup.rotation(d)
    assert np.allclose(turn @ turn.T, np.eye(d))
    x = rng.normal(size=(2000, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    bits, factor, rotated = embedding_dedup.codes(x, turn)
    signs = (np.unpackbits(bits, axis=1)[:, :d] * 2.0 - 1) / math.sqrt(d)
    estimate, truth = signs @ rotated.T / factor[:, None], x @ x.T
    off = (estimate - truth)[np.triu_indices(2000, 1)]
    assert abs(off.mean()) < 0.005
    bound = embedding_dedup.margins(factor, d, 0.93, math.inf)
    assert (estimate >= bound[:, None])[truth >= 0.93].all()
