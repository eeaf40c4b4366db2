"""Quality rules against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazardlake.llm import quality_rules, textnum
from tests.llm import fixtures

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
COUNTED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    repeated = len(lines) - len(set(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def class_name(c):
    if ord(c) > 127:
        return ("two bytes", "three bytes", "four bytes")[len(c.encode()) - 2]
    for name, chars in (("blank", " \t\n\x0b\x0c\r"), ("stop", ".,;:!?'\"()-")):
        if c in chars:
            return name
    if ord(c) < 32 or ord(c) == 127:
        return "control"
    return "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "symbol"


def js(p, q):
    cells = set(p) | set(q)
    total = 0.0
    for c in cells:
        a, b = p.get(c, 0.0), q.get(c, 0.0)
        total += sum(x * math.log2(2 * x / (a + b)) for x in (a, b) if x > 0)
    return math.sqrt(min(1.0, max(0.0, total / 2)))


def shares(counts):
    total = sum(counts.values())
    return {k: v / total for k, v in counts.items()}


def plain_verdicts(rows):
    """Class and word distance to the nearest language of (text, lang) rows, or None."""
    classes, words = {}, {}
    for text, lang in rows:
        if lang is not None and text is not None:
            classes.setdefault(lang, Counter()).update(map(class_name, text))
            words.setdefault(lang, Counter()).update(COUNTED.findall(text.translate(fixtures.LOWER)))
    refs = {}
    for lang, found in words.items():
        total = sum(found.values())
        if total >= quality_rules.REFERENCE_WORDS:
            short = [(-n, w) for w, n in found.items() if len(w.encode()) <= 32]
            top = {w: -n / total for n, w in sorted(short)[:100]}
            refs[lang] = shares(classes[lang]), top | {None: 1 - sum(top.values())}
    verdicts = []
    for text, _ in rows:
        text = text or ""
        own = Counter(COUNTED.findall(text.translate(fixtures.LOWER)))
        best = None
        for lang in sorted(refs, key=lambda name: (-sum(words[name].values()), name)):
            class_ref, word_ref = refs[lang]
            far = [None, None]
            if len(text) >= 200:
                far[0] = js(shares(Counter(map(class_name, text))), class_ref)
            if sum(own.values()) >= 60:
                p = {w: n / sum(own.values()) for w, n in own.items() if w in word_ref}
                far[1] = js(p | {None: 1 - sum(p.values())}, word_ref)
            ratio = max([0.0] + [f / limit for f, limit in zip(far, (0.3, 0.7), strict=True) if f is not None])
            if best is None or ratio < best[0]:
                best = ratio, *far
        verdicts.append(best or (0.0, None, None))
    return verdicts


def corpus(seed=6):
    """Two languages with common words of their own, junk of several kinds, awkward texts."""
    rng = random.Random(seed)
    stock = {"aa": ["the", "of", "und", "ja"], "bb": ["é", "le", "ça", "où"]}

    def prose(lang, n):
        return " ".join(rng.choice(stock[lang]) if rng.random() < 0.4 else fixtures.word(rng).capitalize()[:6] + "." for _ in range(n))

    rows = [(prose(lang, rng.randint(15, 220)), lang) for lang in ("aa", "bb") for _ in range(60)]
    rows += [(prose("aa", 120), None), (prose("bb", 120), "aa"), (prose("bb", 90), "cc")]
    rows += [(prose("aa", 100).upper(), "aa"), (" ".join(w + "#$%" * 2 for w in prose("aa", 90).split()), "aa")]
    rows += [(" ".join(fixtures.word(rng) for _ in range(200)), "bb"), ("spam eggs " * 60, "aa"), ("一二三 " * 100, None)]
    rows += [(text, rng.choice(["aa", None])) for text in (None, "", "  \n ", "a", "same line of words\n" * 30, "x" * 5000)]
    return rows


def test_rules_equal_plain_version(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in quality_rules.judge(frame).collect()}
    verdicts = plain_verdicts(rows)
    assert len(found) == len(rows)
    for i, (text, _) in enumerate(rows):
        r = found[i]
        counts = plain_counts(text)
        assert (*(r[c] for c in quality_rules.COUNTS), r["base_failed"]) == counts
        ratio, *far = verdicts[i]
        for mine, plain in zip((r["class_distance"], r["word_distance"]), far, strict=True):
            assert (mine is None) == (plain is None) and (plain is None or abs(mine - plain) < 1e-9)
        assert r["kept"] == (not counts[-1] and ratio <= 1)
    prose = [i for i in range(123) if not found[i]["base_failed"]]
    assert all(found[i]["kept"] for i in prose) and len(prose) > 100
    assert not any(found[i]["kept"] for i in (123, 124, 125, 126, 127))


def test_rules_awkward(spark):
    same = "one two three " * 10
    rows = [(1, same, "aa"), (1, same, "aa"), (None, same, None), (None, None, "aa"), (2, "", "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    frame = frame.withColumn("n_words", F.lit(-1)).withColumn("kind", F.lit("x")).withColumn("kept", F.lit("x"))
    found = quality_rules.judge(frame)
    assert sorted(r["n_words"] for r in found.collect()) == [0, 0, 30, 30, 30]
    assert not any(r["kept"] for r in found.where("n_words = 0").collect())
    none = quality_rules.judge(fixtures.empty(spark))
    assert none.columns == found.columns and none.count() == 0


def test_references_count_all_rows_and_break_ties(spark):
    rows = [(i, f"w{i % 150:03d} " * 20, "aa") for i in range(300)] + [(900, "z " * 1999, "bb"), (901, "q " * 2000, "cc")]
    refs = quality_rules.references(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [len(c) for c in refs.columns] == [100, 1]  # bb is one word short of a reference
    assert np.allclose(refs.shares[0], 40 / 6000) and len(refs.hashes) == 101
    data, offsets = textnum.text_bytes(pa.array([f"w{i:03d}" for i in range(100)]))
    assert set(refs.hashes[refs.columns[0]]) == set(textnum.Prefix(data).spans(offsets[:-1], offsets[1:]))


def test_common_words_are_exact_when_buckets_are_shared(spark, monkeypatch):
    """With 16 buckets and 2 taken first, the bound fails until all are taken."""
    monkeypatch.setattr(quality_rules, "BUCKET_BITS", 4)
    monkeypatch.setattr(quality_rules, "BUCKETS", 16)
    monkeypatch.setattr(quality_rules, "FIRST_BUCKETS", 2)
    rows = [(i, text, lang) for i, (text, lang) in enumerate(corpus())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    counted = quality_rules.histograms(docs).cache()
    found = quality_rules.common_words(docs, counted, ["aa", "bb"])
    for lang in ("aa", "bb"):
        times = Counter(w for _, text, own in rows if own == lang and text for w in COUNTED.findall(text.translate(fixtures.LOWER)))
        assert sorted(found[lang], key=lambda x: (-x[1], x[0])) == sorted(
            ((w, n) for w, n in times.items() if len(w.encode()) <= 32), key=lambda x: (-x[1], x[0])
        )[:100]


@pytest.mark.parametrize("step", [1, 2, 7, 64, 1 << 20])
def test_words_do_not_depend_on_the_step(step):
    texts = ["", "a", "aa bb  cc", " lead", "trail ", None, "x" * 200, "é" * 30 + " ö", "ab", "cd", "the same the same"]
    data, offsets = textnum.text_bytes(pa.array(texts))
    start, end, bounds = textnum.words(data, offsets, textnum.NOT_WHITE)
    found = textnum.hashed_words(data, offsets, textnum.NOT_WHITE, step)
    assert (found[0] == start).all() and (found[1] == end).all() and (found[3] == bounds).all()
    assert (found[2] == textnum.Prefix(data).spans(start, end)).all()


def test_counts_do_not_depend_on_the_step(monkeypatch):
    texts = fixtures.texts(n=30)
    data, offsets = textnum.text_bytes(pa.array(texts))
    whole = quality_rules.base_counts(data, offsets)
    monkeypatch.setattr(textnum, "SLICE_BYTES", 97)
    monkeypatch.setattr(textnum.hashed_words, "__defaults__", (97,))
    stepped = quality_rules.base_counts(data, offsets)
    for name, values in whole.items():
        assert (values == stepped[name]).all(), name
