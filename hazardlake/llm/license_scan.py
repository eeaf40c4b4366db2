"""License scans by diagonal voting.

All rolling word k-gram hashes of all texts are joined to the positions of the same grams in license templates. A
template that stands in a text at some place makes hits on one diagonal (text position minus template position),
so hits are counted by diagonal. Neighbouring diagonals of a template, which insertions and deletions shift, are
merged into spans, and each span's words are then compared with the template's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.llm import common, textnum

GRAM = 2
#: Most words by which diagonals of one span may differ, and words between their hits.
SLACK, GAP = 4, 12
#: Share of a template's words that a span must hold in order.
COVER = 0.8

# The phrases that name a license, with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Sentences by which licenses are declared, in words, with their labels.
TEMPLATES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-notice"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("licensed under the apache license version 2 0", "apache-notice"),
    ("you may not use this file except in compliance with the license", "apache-notice"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd-notice"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-notice"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-notice"),
    ("licensed under cc by nc 4 0", "cc-by-nc-notice"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-notice"),
    ("this is free and unencumbered software released into the public domain", "unlicense-notice"),
]

IS_WORD = textnum.byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def _grams(lowered: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, word position and hash of every run of ``k`` words."""
    start, end, bounds = textnum.words(lowered, offsets, IS_WORD)
    hashes = textnum.Prefix(lowered).spans(start, end)
    n = np.maximum(np.diff(bounds) - k + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    total = np.zeros(len(doc), np.uint64)
    for j in range(k):
        total = textnum.mix(total ^ hashes[bounds[doc] + place + j])
    return doc, place, total


def _words(text: str) -> list[bytes]:
    data = textnum.TO_LOWER[np.frombuffer(text.encode(), np.uint8)]
    start, end, _ = textnum.words(data, np.array([0, len(data)]), IS_WORD)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def text_grams(rows: DataFrame, k: int = GRAM) -> DataFrame:
    """``doc_id``, ``text_key``, ``pos``, ``gram`` for all word k-grams of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textnum.text_bytes(batch.column("text"))
            for low, high, part, at in textnum.slices(data, offsets):
                doc, place, total = _grams(textnum.TO_LOWER[part], at, k)
                own = pa.array(doc)
                keys = [batch.column(c).slice(low, high - low).take(own) for c in ("doc_id", "text_key")]
                columns = [*keys, pa.array(place.astype(np.int32)), pa.array(total.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "pos", "gram"])

    return rows.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id bigint, text_key bigint, pos int, gram bigint")


def template_grams(spark: SparkSession, texts: list[str], k: int = GRAM) -> DataFrame:
    """``template``, ``tpos``, ``gram``; a fixed list, so its size is known."""
    data, offsets = textnum.text_bytes(pa.array(texts))
    doc, place, total = _grams(textnum.TO_LOWER[data], offsets, k)
    rows = zip(doc.tolist(), place.tolist(), total.view(np.int64).tolist(), strict=True)
    return spark.createDataFrame(list(rows), "template int, tpos int, gram bigint")


def spans(rows: DataFrame, texts: list[str], k: int = GRAM) -> DataFrame:
    """``doc_id``, ``text_key``, ``template``, ``start``, ``stop`` (words), ``votes``: merged diagonals.

    A group holds the diagonals of one template in one text.
    """
    hits = text_grams(rows, k).join(F.broadcast(template_grams(rows.sparkSession, texts, k)), "gram")
    diagonals = (
        hits.groupBy("doc_id", "text_key", "template", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.count_distinct("tpos").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    )
    one = ["doc_id", "text_key", "template"]
    order = Window.partitionBy(*one).orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SLACK) | (F.col("first") - F.lag("last").over(order) > GAP)
    numbered = diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(order))
    # The diagonals stay listed, for each may be a place of a short phrase.
    return numbered.groupBy(*one, "span").agg(
        F.min("first").alias("start"),
        (F.max("last") + k).alias("stop"),
        F.sum("votes").alias("votes"),
        F.sort_array(F.collect_set("diagonal")).alias("diagonals"),
    )


def in_order(words: list[bytes], template: list[bytes]) -> int:
    """Length of the longest common subsequence of words."""
    row = [0] * (len(template) + 1)
    for word in words:
        before = 0
        for j, other in enumerate(template):
            before, row[j + 1] = row[j + 1], before + 1 if word == other else max(row[j + 1], row[j])
    return row[-1]


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``spans``.

    Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z. ``n_base`` counts the places where
    the words of a phrase stand consecutively; ``first_word`` and ``last_word`` are the smallest and largest start,
    null without any. ``labels`` adds those of templates that a span holds to ``COVER`` at least; ``score`` is the
    highest share held (1 for a phrase, 0 without spans). Null and empty texts have no words. Equal rows get equal
    results, each row its own; no rows give none.
    """
    texts = [x for x, _ in phrases + templates]
    labels = [x for _, x in phrases + templates]
    wanted = [_words(x) for x in texts]
    rows = common.text_rows(docs)
    listed = (
        spans(rows, texts)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("template", "start", "stop", "diagonals")).alias("spans"))
    )
    joined = rows.join(listed, common.same_row(rows, listed, ["doc_id", "text_key"]), "left").select(rows["doc_id"], rows["text"], "spans")

    def judge(text: np.ndarray, start: np.ndarray, end: np.ndarray, found: list[dict]) -> tuple[dict, list[dict]]:
        data = text.tobytes()

        def words(low: int, high: int) -> list[bytes]:
            low = max(low, 0)
            return [data[a:b] for a, b in zip(start[low:high].tolist(), end[low:high].tolist(), strict=True)]

        places: set[int] = set()
        count, base, own, best, real = 0, set(), set(), 0.0, []
        for span in found:
            t = span["template"]
            if t < len(phrases):
                for at in span["diagonals"]:
                    if at >= 0 and words(at, at + len(wanted[t])) == wanted[t]:
                        count += 1
                        places.add(at)
                        base.add(labels[t])
                        best = 1.0
                        real.append({"label": labels[t], "start": at, "stop": at + len(wanted[t]), "share": 1.0})
                continue
            low, high = min(span["start"], span["diagonals"][0]), max(span["stop"], span["diagonals"][-1] + len(wanted[t]))
            share = in_order(words(low, high), wanted[t]) / len(wanted[t])
            best = max(best, share)
            if share >= COVER:
                own.add(labels[t])
                real.append({"label": labels[t], "start": max(low, 0), "stop": min(high, len(start)), "share": share})
        return {
            "n_base": count,
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | own)),
            "score": best,
        }, sorted(real, key=lambda x: (x["start"], x["label"]))

    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64())]
        + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
        + [("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("share", pa.float64())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("spans").to_pylist()
            out: list[dict] = []
            data, offsets = textnum.text_bytes(batch.column("text"))
            for low, _, part, at in textnum.slices(data, offsets):
                lowered = textnum.TO_LOWER[part]
                start, end, bounds = textnum.words(lowered, at, IS_WORD)
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    row, real = judge(lowered, start[a:b], end[a:b], found[low + i]) if found[low + i] else (EMPTY, [])
                    out.append({**row, "n_words": int(b - a), "spans": real})
            columns = {name: [row[name] for row in out] for name in kind.names[1:]}
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(columns[f.name], f.type) for f in list(kind)[1:]], schema=kind)

    return joined.mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string,"
        " score double, spans array<struct<label:string,start:bigint,stop:bigint,share:double>>",
    )


EMPTY = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0}


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
