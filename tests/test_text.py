import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hazardlake.functions import text as tx
from hazardlake.operators import label_blocks as lb
from hazardlake.operators import text_model as tm

TRAIN = [
    (1, "help", "Fire near the school! Send help, send water."),
    (2, "help", "We need help now: smoke and fire everywhere"),
    (3, "promo", "Buy cheap water filters at fire-safe-info.now"),
    (4, "promo", "Cheap filters, cheap filters!!! Buy now."),
    (5, "promo", "the and of"),
]
TESTS = [(10, "Send help, fire!"), (11, "cheap cheap filters"), (12, "zzz qqq"), (13, ""), (14, "firesafeinfonow")]


def py_terms(text, stop=tx.STOP_WORDS):
    words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in stop]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def py_clean(text):
    return re.sub(r"[^\w\s]", "", text.lower())


def py_model(rows, limit):
    raw = [py_terms(t) for _, _, t in rows]
    corpus = Counter(t for doc in raw for t in doc)
    vocab = sorted(corpus, key=lambda t: (-corpus[t], t))[:limit]
    df = Counter(t for doc in raw for t in set(doc))
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocab}

    def vector(text):
        counts = Counter(t for t in py_terms(py_clean(text)) if t in idf)
        raw_weights = {t: n * idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw_weights.values()))
        return {t: v / norm for t, v in raw_weights.items()} if norm else {}

    centroids = {}
    for label in sorted({label for _, label, _ in rows}):
        total = Counter()
        for _, other, text in rows:
            if other == label:
                total.update(vector(text))
        norm = math.sqrt(sum(v * v for v in total.values()))
        centroids[label] = {t: v / norm for t, v in total.items()}
    return vector, centroids


@pytest.fixture(scope="module")
def training(spark):
    return spark.createDataFrame(TRAIN, "id int, label string, text string")


@pytest.fixture(scope="module")
def model(training):
    return tm.fit_centroids(training, "id", max_features=20)


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(TESTS, "msg int, text string")


@pytest.mark.parametrize("text", ["Hello, World! It's 5 o'clock.", "a  b\tc d", "naïve café — déjà_vu", "", "!!!", "x"])
def test_clean_and_terms_follow_the_rules(spark, text):
    row = tm.terms(spark.createDataFrame([(text,)], "t string").withColumn("c", tx.clean(F.col("t"))), F.col("t")).first()
    assert row.c == py_clean(text) and row.terms == py_terms(text)


def test_scores_equal_brute_force(model, messages):
    vector, centroids = py_model(TRAIN, 20)
    for row in model.score(messages, "msg").collect():
        text = dict(TESTS)[row.msg]
        v = vector(text)
        expected = {label: sum(v.get(t, 0.0) * w for t, w in c.items()) for label, c in centroids.items()}
        got = {e.label: e.score for e in row.ranked}
        assert got == pytest.approx(expected, abs=1e-8)
        assert [e.score for e in row.ranked] == sorted(got.values(), reverse=True)


def test_every_text_gets_a_row_and_ties_go_by_label(model, messages):
    got = {r.msg: (r.category, r.score) for r in model.classify(messages, "msg").collect()}
    assert set(got) == {m for m, _ in TESTS}
    assert got[12] == got[13] == got[14] == ("help", 0.0)
    assert got[10][0] == "help" and got[11][0] == "promo"


def test_vocabulary_sees_raw_text_but_scoring_sees_clean_text(training):
    found = {r.term for r in tm.vocabulary(training).collect()}
    assert {"fire safe", "safe info"} <= found and "firesafeinfonow" not in found


def test_vocabulary_counts_terms_and_texts_in_one_generated_stage(spark, training):
    found = tm.vocabulary(spark.createDataFrame([*TRAIN, (6, "promo", None), (6, "promo", "")], training.schema))
    texts = [text for _, _, text in TRAIN] + ["", ""]
    corpus, docs = Counter(), Counter()
    for text in texts:
        corpus.update(py_terms(text))
        docs.update(set(py_terms(text)))
    assert {r.term: (r.corpus_count, r.doc_count) for r in found.collect()} == {t: (n, docs[t]) for t, n in corpus.items()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and plan.count("zip_with(") == 1, plan  # the bigrams; repeats are found after the explode


def test_candidate_labels_limit_the_answer(model, messages):
    assert {r.category for r in model.classify(messages, "msg", labels=["promo"]).collect()} == {"promo"}


def test_saved_model_scores_the_same(model, messages, tmp_path):
    path = str(tmp_path / "model")
    model.save(path)
    loaded = tm.CentroidModel.load(messages.sparkSession, path)
    assert loaded.labels == model.labels
    assert sorted(loaded.classify(messages, "msg").collect()) == sorted(model.classify(messages, "msg").collect())


def test_too_many_labels_is_an_error(training, monkeypatch):
    monkeypatch.setattr(tm, "MAX_LABELS", 1)
    with pytest.raises(ValueError, match="distinct labels"):
        tm.fit_centroids(training, "id")


def test_vector_centroids(spark):
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0], 0), (2, [0.8, 0.2], 0), (3, [0.0, 2.0], 1), (4, [0.0, 0.0], 1)],
        "vec_id int, embedding array<float>, label int",
    )
    centroids = {r.label: r.centroid for r in tm.vector_centroids(vectors).collect()}
    assert centroids[1] == pytest.approx([0.0, 1.0])
    norm = math.hypot(0.9, 0.1)
    assert centroids[0] == pytest.approx([0.9 / norm, 0.1 / norm], abs=1e-7)
    got = {r.vec_id: (r.category, r.score) for r in lb.vector_classify(vectors, lb.vector_blocks(tm.vector_centroids(vectors)), "vec_id").collect()}
    assert got[3] == (1, 1.0) and got[4] == (0, 0.0) and got[1][0] == 0


def test_display_forms(one, spark):
    row = spark.createDataFrame([("deep_orange", "power_substation", "x" * 111)], "a string, b string, c string").select(
        tx.title_words(F.col("a")), tx.title_parts(F.col("b")), tx.truncated(F.col("c"), 110)
    ).first()
    assert tuple(row) == ("Deep Orange", "Power_Substation", "x" * 110 + "...")
