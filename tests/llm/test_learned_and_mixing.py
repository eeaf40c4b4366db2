"""Toxicity, language identification, mixing and the pipeline."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from hazardlake.llm import bpe, language_id, mixing, toxicity
from hazardlake.llm.catalog import QUERIES

from . import fixtures as fx

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ toxicity
@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    bad = ["vilox", "scumbra", "trashel", "nastor"]
    rows = []
    for i in range(500):
        words = fx.prose(rng, rng.randint(1, 120)).split()
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_gradients_match_differences():
    net = toxicity.Network(np.arange(1, 6, dtype=np.uint64), np.zeros(5, np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    gates, size = rng.normal(size=(5, 3, 6 * toxicity.HIDDEN)), np.array([5, 3, 1])
    weights = rng.normal(size=3)
    keep = {}
    net.forward(gates, size, keep)
    grad, of_gates = net.backward(weights, keep)
    for name in ("ahead", "back", "look", "weigh", "out"):
        flat = net.p[name].reshape(-1)
        at = 1 % len(flat)
        for sign in (1,):
            flat[at] += 1e-3
            up = (net.forward(gates, size) * weights).sum()
            flat[at] -= 2e-3
            down = (net.forward(gates, size) * weights).sum()
            flat[at] += 1e-3
        assert abs((up - down) / 2e-3 - grad[name].reshape(-1)[at]) < 2e-3, name
    shifted = gates.copy()
    shifted[0, 0, 0] += 1e-3
    up = (net.forward(shifted, size) * weights).sum()
    shifted[0, 0, 0] -= 2e-3
    assert abs((up - (net.forward(shifted, size) * weights).sum()) / 2e-3 - of_gates[0, 0, 0]) < 2e-3


def test_windows_cover_every_word():
    bounds = np.array([0, 0, 1, 33, 34, 200, 264])
    start, size, doc = toxicity.windows(bounds)
    covered = {(d, w) for s, n, d in zip(start, size, doc) for w in range(s, s + n)}
    assert covered == {(d, w) for d in range(6) for w in range(bounds[d], bounds[d + 1])}
    assert (size > 0).all() and (size <= toxicity.LENGTH).all()


def test_toxicity_held_out(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled] + [(None, 1), (3, None), (99999, 1)], "doc_id bigint, toxic int")
    net = toxicity.fit(docs, labels)
    score = {r.doc_id: r.score for r in toxicity.score(docs, net).collect()}
    held = [(score[i] >= 0.5) == bool(y) for i, _, y in labelled if fx.fold(i, 5) == 0]
    assert np.mean(held) > 0.9 and all(0 <= x <= 1 for x in score.values())
    # The worst window decides: a long clean text with one bad stretch counts.
    rng = random.Random(1)
    long = fx.prose(rng, 800) + " vilox scumbra vilox trashel " + fx.prose(rng, 800)
    extra = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "!! ..")], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in toxicity.score(extra, net).collect()}
    assert got[1] >= 0.5 and got[2] == got[3] == got[4] == 0.0


def test_toxicity_sample_is_bounded(spark):
    """One row an id, whole texts, the longest left out beyond the bound."""
    def sample(rows, max_bytes):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
        plan = toxicity.fit_sample(docs, labels, 100, 100, 5, 0, max_bytes)
        return {r.doc_id: r.text for r in plan.collect()}, plan.rdd.getNumPartitions()

    rows = [(i, f"word{i} " * (i + 1)) for i in range(40)]
    whole, parts = sample(rows + [(7, "a"), (7, "a")] * 50 + [(9, None)], 1 << 20)
    assert parts == 1 and whole[7] == "a" and whole[9] == "" and all(whole[i] == rows[i][1] for i in whole if i not in (7, 9))
    few, _ = sample(rows, sum(len(t) for t in whole.values()) // 2)
    assert set(few) < set(whole) and max(few) < min(set(whole) - set(few)) and all(few[i] == rows[i][1] for i in few)
    assert sample(rows[:0], 1 << 20)[0] == {}


def test_toxicity_awkward(spark):
    assert [r.score for r in toxicity.score(fx.awkward(spark), None).collect()] == [0.0] * 8
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.fit(fx.awkward(spark), nothing) is None
    assert toxicity.score(fx.empty(spark), None).count() == 0


# ------------------------------------------------------------------ language
def test_language_mixture(spark):
    rng = random.Random(2)
    vocab = {"xx": ["ako", "mawa", "tinga", "olo", "wasi"], "yy": ["streng", "kraft", "sprit", "blod", "gryn"], "zz": ["éta", "ùne", "çal", "où", "lèn"]}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang]) + rng.choice(["", "s", "en"]) for _ in range(n))
    rows = [(i, text(lang, rng.randint(3, 60)), lang) for i, lang in enumerate(list(vocab) * 60)]
    known = language_id.learn(spark.createDataFrame(rows + [(900, None, "xx"), (901, "ako", None)], "doc_id bigint, text string, lang string"))
    assert known.names == ["xx", "yy", "zz"]
    fresh = [(i, text(lang, 30), lang) for i, lang in enumerate(list(vocab) * 10)]
    mixed = text("xx", 70) + ". " + text("yy", 30)
    cases = [(i, t, lang) for i, t, lang in fresh] + [(500, mixed, "xx"), (501, None, "und"), (502, "", "und"), (503, "12 34 !", "und")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t, _ in cases], "doc_id bigint, text string, lang int, score int")
    got = {r.doc_id: r for r in language_id.identify(docs, known).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in cases)
    shares = {x.lang: x.share for x in got[500].languages}
    assert set(shares) == {"xx", "yy"} and abs(shares["xx"] - 0.7) < 0.07
    assert all(len(got[i].languages) == 1 for i, _, _ in fresh) and got[501].score == 0.0


def plain_mixture(text, known):
    """Chosen languages and proportions of one text, word by word."""
    data = text.lower().encode()
    logs = []
    for found in re.finditer(rb"[A-Za-z\x80-\xff]+", data):
        log = np.zeros(len(known.names))
        for at in range(max(0, found.start() - 1), found.end()):
            three = int.from_bytes((data[at : at + 3] + b"  ")[:3], "little")
            log += known.log_share[:, (three * 0x9E3779B1 & 0xFFFFFFFF) >> 17]
        logs.append(log - log.max())
    likely = np.exp(np.array(logs)) + language_id.NOISE

    def fitted(allowed):
        share = np.array([1 / len(allowed) if i in allowed else 0.0 for i in range(len(known.names))])
        for _ in range(language_id.STEPS):
            share = (likely * share / (likely @ share)[:, None]).mean(axis=0)
        return share, np.log(likely @ share).sum()

    allowed = list(range(len(known.names)))
    share, fit = fitted(allowed)
    while len(allowed) > 1:
        fewer = [i for i in allowed if i != min(allowed, key=lambda i: share[i])]
        share2, fit2 = fitted(fewer)
        if fit - fit2 >= language_id.PENALTY * np.log(len(logs) + 1) / 2:
            break
        allowed, share, fit = fewer, share2, fit2
    return {known.names[i]: share[i] for i in allowed}


def test_language_equals_plain_mixture_in_any_layout(spark):
    rng = random.Random(6)
    vocab = [["ako", "mawa", "tinga", "olo"], ["streng", "kraft", "sprit", "blod"], ["éta", "ùne", "çal", "où"]]
    text = lambda i, n: " ".join(rng.choice(vocab[i]) + rng.choice(["", "s", "en"]) for _ in range(n))
    rows = [(i, text(i % 3, 20), "xyz"[i % 3]) for i in range(90)]
    known = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = [" ".join(text(i, rng.randint(0, 8)) for i in range(3)).strip() or "ol" for _ in range(60)]
    texts += ["a", "és", "ol", "s\n", "é"] + [text(0, 40) + " " + text(2, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    layouts = [language_id.identify(docs.repartition(n), known).collect() for n in (1, 13)]
    for layout in layouts:
        for row in layout:
            expected = plain_mixture(texts[row.doc_id], known)
            got = {x.lang: x.share for x in row.languages}
            assert set(got) == set(expected) and all(abs(got[k] - expected[k]) < 1e-3 for k in got)
            assert row.lang_pred in got and got[row.lang_pred] == max(got.values())
    assert max(len(r.languages) for r in layouts[0]) > 1


def test_language_awkward(spark):
    assert {r.lang_pred for r in language_id.identify(fx.awkward(spark), None).collect()} == {"und"}
    assert language_id.learn(fx.empty(spark)) is None and language_id.identify(fx.empty(spark), None).count() == 0


# ------------------------------------------------------------------ mixing
def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, found, left = share * sum(sizes.values()), {}, set(sizes)
    while left:
        level = (budget - sum(found.values())) / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * level > cap * sizes[s]]
        if not over:
            return {**found, **{s: weight[s] * level for s in left}}
        for s in over:
            found[s] = cap * sizes[s]
            left.discard(s)
    return found


@pytest.mark.parametrize("block", [5000, 20])
def test_mixing(spark, block):
    docs = fx.documents(spark, n=400).where("text IS NULL OR length(text) < 3000")
    rows = mixing.mix(docs, block=block).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    aims = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.size * r.copies <= 2 * r.size and abs(r.target - aims[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        taken[r.source] += r.size * r.copies
    assert len(rows) == docs.count()
    for s in aims:
        assert abs(taken[s] - aims[s]) <= max(60, 0.01 * aims[s]), s
    again = mixing.mix(docs.repartition(5), block=block).collect()
    key = lambda r: (r.doc_id, r.text_key, r.copies)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_flight_keeps_totals_and_probabilities():
    rng = np.random.default_rng(4)
    size = rng.integers(1, 500, 400).astype(float)
    share = np.full(400, 0.37)
    mean = np.zeros(400)
    for seed in range(150):
        done = mixing.flight(share, size, np.random.default_rng(seed))
        assert ((done > 0) & (done < 1)).sum() <= 2
        assert abs(done.sum() - share.sum()) < 1e-6 and abs(done @ size - share @ size) < 1e-3
        mean += done / 150
    assert abs(mean.mean() - 0.37) < 1e-6 and np.abs(mean - 0.37).max() < 0.2


def test_mixing_awkward(spark):
    assert mixing.mix(fx.awkward(spark)).count() == 8
    assert mixing.mix(fx.empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], fx.DOCUMENTS)
    assert {(r.size, r.target, r.copies) for r in mixing.mix(blank).collect()} == {(0, 0.0, 0)}


# ------------------------------------------------------------------ pipeline and queries
def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for _, stage in pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).cache())
    for before, after in zip(kept[:-2], kept[1:-1]):
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        assert after.select("doc_id").distinct().join(before, "doc_id", "left_anti").isEmpty()
    ids = [[r[0] for r in x.select("doc_id").collect()] for x in kept]
    assert len(ids[0]) >= len(ids[1]) == len(ids[2]) >= len(ids[3]) > 0 and len(ids[5]) == len(ids[4])
    assert max(Counter(ids[4]).values()) == 2
    rows = pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in rows) == sorted((r.doc_id, r.ids_sha256) for r in kept[5].collect())


def test_pipeline_awkward(spark):
    import corpus_pipeline as pipeline

    for docs in (fx.awkward(spark), fx.empty(spark)):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        docs.collect()


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_queries_cover_their_table(spark, name):
    rows = QUERIES[name][0](spark, SF)
    source = "embeddings" if name.split("_")[0] in ("op1", "op11", "op13") else "documents"
    each = 8 if name.startswith("op11_") else 1  # components
    assert rows.count() == each * spark.read.parquet(f"{SF}/{source}.parquet").count()
    assert rows.columns[0] in ("doc_id", "vec_id")


def test_line_dedup_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    query, sql = QUERIES["op3_line_dedup"]
    rows = query(spark, SF)
    assert sorted(map(tuple, rows.collect())) == sorted(con.sql(f"SELECT {', '.join(rows.columns)} FROM ({sql})").fetchall())


def test_bpe_special_tokens(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id bigint, text string")
    row = bpe.round_trip(docs, bpe.tokenizer_path(), with_ids=True).first()
    assert list(row.ids)[1] == 49407 and row.decoded == "a</w> <|endoftext|> b</w>"
