"""Line dedup, fingerprints, license scan, suffix-array dedup and BPE against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hazardlake.llm import bpe, fingerprints, license_scan, line_dedup, substring_dedup, suffix_array

from . import fixtures as fx


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# ------------------------------------------------------------------ line dedup
def plain_lines(rows, min_chars=10, min_docs=2):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(fx.LOWER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and min(holders[key(x)]) != i)]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_dedup(spark, min_docs):
    docs = fx.documents(spark)
    expected = plain_lines([(r.doc_id, r.text) for r in docs.collect()], min_docs=min_docs)
    rows = line_dedup.dedup_lines(docs, min_docs=min_docs, carry=("lang", "source")).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in rows} == expected
    assert len(rows) == len(expected) and any(x[1] for x in expected.values())


def test_line_dedup_awkward(spark):
    rows = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in line_dedup.dedup_lines(fx.awkward(spark)).collect()]
    assert len(rows) == 8
    assert [r[2] for r in rows if r[0] == 1] == [0, 0, 0]
    assert sorted(r[1:] for r in rows if r[0] is None) == [(1, 0, ""), (3, 3, "")]
    assert line_dedup.dedup_lines(fx.empty(spark)).count() == 0


# ------------------------------------------------------------------ fingerprints
def plain_sketch(text, k):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fx.LOWER))
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def of(numbers):
        seed = 42
        for x in numbers:
            seed = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
        return signed(seed)

    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in found]
    runs = [hashes] if 0 < len(hashes) < 5 else [hashes[i : i + 5] for i in range(len(hashes) - 4)]
    return sorted({of(r) for r in runs})[:k]


def plain_likeness(a, b, k):
    both = sorted(set(a) | set(b))[:k]
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_fingerprints(spark, buckets):
    docs = fx.documents(spark)
    plain = sorted((r.doc_id, r.text or "") for r in docs.collect())
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs, buckets=buckets).collect()}
    assert len(rows) == len(plain)
    for (i, text), (_, following) in zip(plain, plain[1:] + plain[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert rows[i].edited_text == edited
        assert list(rows[i].sketch) == plain_sketch(text, fingerprints.K)
        assert list(rows[i].edited_sketch) == plain_sketch(edited, fingerprints.K)
        assert list(rows[i].next_sketch) == plain_sketch(following, fingerprints.K)


def test_fingerprint_query(spark, tmp_path):
    fx.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    plain = sorted((r.doc_id, r.text or "") for r in fx.documents(spark).collect())
    rows = {r.doc_id: r for r in fingerprints.op10_document_fingerprints(spark, str(tmp_path)).collect()}
    digits = lambda sketch: "".join(f"{x % (1 << 64):016X}" for x in sketch)
    assert len(rows) == len(plain)
    for (i, text), (_, following) in zip(plain, plain[1:] + plain[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = (plain_sketch(x, fingerprints.K) for x in (text, edited, following))
        got = rows[i]
        assert (got.n_chars, got.edited_sha256) == (len(text), sha(edited))
        assert (got.fingerprint, got.edited_fingerprint) == (digits(own), digits(changed))
        assert got.near_edited == plain_likeness(own, changed, fingerprints.K)
        assert got.near_next == plain_likeness(own, after, fingerprints.K)


def test_sketch_estimates(spark):
    rng = random.Random(1)
    a = " ".join(fx.word(rng) + str(i) for i in range(3000))
    b = " ".join(a.split()[1000:]) + " " + " ".join(f"new{i}" for i in range(1000))
    pair = spark.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
    rows = {r.doc_id: list(r.sketch) for r in fingerprints.fingerprints(pair).collect()}
    both = spark.createDataFrame([(rows[1], rows[2])], "a array<bigint>, b array<bigint>")
    got = both.select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("r"),
        fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
        fingerprints.shingle_count(F.col("a")).alias("n"),
        fingerprints.merge(F.col("a"), F.col("b")).alias("m"),
    ).first()
    assert abs(got.r - 0.5) < 0.15 and abs(got.c - 2 / 3) < 0.2 and abs(got.n - 2996) < 900
    assert list(got.m) == sorted(set(rows[1]) | set(rows[2]))[: fingerprints.K]
    assert plain_likeness(rows[1], rows[2], fingerprints.K) == got.r


def test_fingerprints_awkward(spark):
    rows = fingerprints.edited_fingerprints(fx.awkward(spark)).collect()
    assert len(rows) == 8
    lost = [r for r in rows if r.doc_id is None and r.text]
    assert len(lost) == 1 and lost[0].edited_text == lost[0].text[: len(lost[0].text) - len(lost[0].text) // 2]
    assert all(list(r.sketch) == [] for r in rows if not r.text)
    assert fingerprints.edited_fingerprints(fx.empty(spark)).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id bigint, text string")
    assert fingerprints.edited_fingerprints(one).first().edited_text == "a b c d a b c d"[:8] + "a b c d"[:7]


# ------------------------------------------------------------------ license scan
def plain_phrases(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(fx.LOWER))
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        want = phrase.split()
        for i in range(len(found) - len(want) + 1):
            if found[i : i + len(want)] == want:
                places.append(i)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_scan(spark):
    rng = random.Random(2)
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [
        "MIT License", "mit licence", "Apache License, Apache\nLICENSE; the apache license", "CC-BY CC BY cc by cc", "GNU General Public License",
        f"{fx.prose(rng, 300)} {notice} {fx.prose(rng, 20)} mit license", notice.replace("hereby ", "").replace("charge", "any charge"),
        "permission is granted to nobody", "gnu general public gnu general public license", None, "", "é license", "cc by " * 300,
    ]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for i, text in enumerate(rows):
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) == plain_phrases(text), text
    assert got[5].labels == "mit,mit-notice" and got[6].labels == "mit-notice" and got[7].labels == ""
    assert 0.8 <= got[6].score < 1 and got[0].score == 1.0 and got[9].score == 0.0
    assert [(s.label, s.start) for s in got[5].spans if s.label == "mit-notice"] == [("mit-notice", 300)]


def test_license_scan_awkward(spark):
    assert license_scan.scan(fx.awkward(spark)).count() == 8
    assert license_scan.scan(fx.empty(spark)).count() == 0
    twice = spark.createDataFrame([(1, "mit license")] * 3 + [(None, "mit license")], "doc_id bigint, text string")
    assert [(r.n_base, r.labels) for r in license_scan.scan(twice).collect()] == [(1, "mit")] * 4


# ------------------------------------------------------------------ suffix arrays
def test_suffix_arrays():
    rng = np.random.default_rng(1)
    for _ in range(60):
        strings = [np.append(rng.integers(1, rng.integers(2, 6), rng.integers(0, 50)), 0) for _ in range(rng.integers(1, 20))]
        strings.append(np.append(np.ones(40, np.int64), 0))
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in strings])])
        got = suffix_array.suffix_arrays(np.concatenate(strings), bounds)
        for j, s in enumerate(strings):
            assert (got[bounds[j] : bounds[j + 1]] - bounds[j]).tolist() == sorted(range(len(s)), key=lambda i: tuple(s[i:]))


def plain_removed(rows, length=100):
    seen, out = set(), {}
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if data[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(data[k : k + length])
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out[i] = (len(data), sum(gone), runs, bytes(c for c, g in zip(data, gone) if not g))
    return out


@pytest.mark.parametrize("warm, contexts", [(2000, 32), (3, 32), (2000, 2)])
def test_substring_dedup(spark, monkeypatch, warm, contexts):
    monkeypatch.setattr(substring_dedup, "WARM", warm)
    monkeypatch.setattr(substring_dedup, "ARRAY_CONTEXTS", contexts)
    docs = fx.documents(spark)
    expected = plain_removed(sorted((r.doc_id, r.text) for r in docs.collect()))
    rows = substring_dedup.dedup_substrings(docs.repartition(3)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert {i for i in expected if got[i] != expected[i]} == set()
    assert sum(x[1] for x in expected.values()) > 10_000


def test_substring_dedup_awkward(spark):
    rows = substring_dedup.dedup_substrings(fx.awkward(spark)).collect()
    assert len(rows) == 8
    first = [r for r in rows if r.doc_id == 1 and r.n_bytes > 50]
    # Equal rows are one document; its own repetitions go, the rest stays.
    assert len(first) == 2 and first[0] == first[1] and 0 < first[0].n_removed < first[0].n_bytes
    assert [r.n_removed == r.n_bytes for r in rows if r.doc_id is None and r.n_bytes] == [True]
    assert substring_dedup.dedup_substrings(fx.empty(spark)).count() == 0


@pytest.mark.parametrize("warm", [2000, 1])
def test_substring_dedup_equal_rows_in_one_batch(spark, monkeypatch, warm):
    """Equal rows do not remove each other, whatever batch they are in."""
    monkeypatch.setattr(substring_dedup, "WARM", warm)
    rng = random.Random(8)
    fresh, passage, lone = fx.prose(rng, 60), fx.prose(rng, 50), fx.prose(rng, 70)
    rows = [(1, fresh)] * 3 + [(2, f"{fx.prose(rng, 9)} {passage}")] + [(5, f"{passage} {fx.prose(rng, 40)}")] * 2 + [(None, lone)] * 2
    expected = plain_removed(list(dict.fromkeys(rows)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for table in (docs.coalesce(1), docs.repartition(len(rows), F.monotonically_increasing_id())):
        got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in substring_dedup.dedup_substrings(table).collect()]
        assert sorted(got, key=repr) == sorted(((i, expected[i]) for i, _ in rows), key=repr)
    assert [expected[i][1] > 0 for i in (1, 2, 5, None)] == [False, False, True, False]
    apart, together = (sorted(map(repr, substring_dedup.dedup_substrings(x).collect())) for x in (fx.awkward(spark), fx.awkward(spark).coalesce(1)))
    assert apart == together


# ------------------------------------------------------------------ BPE
@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    found = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


def test_bpe_equals_the_library(library):
    with open(bpe.tokenizer_path(), encoding="utf-8") as file:
        mine = bpe.WordBpe(file.read())
    rng = random.Random(4)
    letters = list("aAbBzZ019 \t\n\r\x0b\x85\xa0　'’!#<>|&éÉßẞİIıʼǅΣςσ̣́ﬁ①½\U0001f600\U0001d400한글‍﻿\x00")
    letters += ["<|endoftext|>", "<|startoftext|>", "'ll", "'S", "ΟΔΟΣ ", "the ", "<|"]
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    cases += [x or "" for x in fx.texts()] + ["a" * 3000, "ab" * 999]
    ids = mine.encode(cases)
    decoded = mine.decode(ids)
    for case, got, back in zip(cases, ids, decoded):
        want = library.encode(case, add_special_tokens=False).ids
        assert got.tolist() == want, case
        assert back == library.decode(want, skip_special_tokens=False)


def test_bpe_operator(spark, library):
    docs = fx.documents(spark)
    rows = {r.doc_id: r for r in bpe.round_trip(docs, bpe.tokenizer_path(), carry=("source",), with_ids=True).collect()}
    for r in docs.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        got = rows[r.doc_id]
        assert got.n_tokens == len(want) and list(got.ids) == want and got.source == r.source
        assert got.ids_sha256 == sha(np.array(want, "<u4").tobytes())
        assert got.decoded_sha256 == sha(library.decode(want, skip_special_tokens=False)) == sha(got.decoded)
    assert bpe.round_trip(fx.awkward(spark), bpe.tokenizer_path()).count() == 8
    assert bpe.round_trip(fx.empty(spark), bpe.tokenizer_path()).count() == 0
