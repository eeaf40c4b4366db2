"""Language identification as inference of a mixture of languages.

Every language has a distribution over byte trigrams. A word's likelihood under a language is that of its trigrams;
a document is a mixture whose proportions expectation-maximisation estimates from all of its words. The set of
languages is chosen by penalised likelihood: the weakest one goes while the fit loses less than the penalty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardlake.llm import common, textnum

BINS = 1 << 15
SMOOTHING = 0.5
STEPS = 8
#: Share of a word's likelihood that may come from noise, so that no single word decides.
NOISE = 1e-4
#: Penalty for one more language, in units of log(words) / 2.
PENALTY = 2.0

IS_WORD = textnum.byte_class([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def trigram_bins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bin of the three bytes from each position on; every text is followed by blanks, not by its neighbour."""
    wide = np.full(len(data) + 2, 0x20, np.uint32)
    wide[: len(data)] = data
    second, third = wide[1:-1].copy(), wide[2:].copy()
    last = offsets[1:][np.diff(offsets) > 0] - 1
    second[last] = third[last] = 0x20
    third[last[last > 0] - 1] = 0x20
    three = wide[:-2] | second << np.uint32(8) | third << np.uint32(16)
    return (three * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)


@dataclass
class Languages:
    """Names and log probabilities (language x bin)."""

    names: list[str]
    log_share: np.ndarray


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-last trigram position of each word, from the blank before it (if it has one) on, and bounds."""
    start, end, bounds = textnum.words(data, offsets, IS_WORD)
    document_start = np.zeros(len(data) + 1, bool)
    document_start[offsets] = True
    return start - (~document_start[start]).astype(start.dtype), end, bounds


def learn(docs: DataFrame) -> Languages | None:
    """Trigram counts of all rows of ``docs`` with a ``lang``; None without any. A vector per language reaches the driver."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.lower("text").alias("_lower"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, offsets = textnum.text_bytes(batch.column("_lower"))
            for low, high, part, at in textnum.slices(data, offsets):
                first, past, bounds = _spans(part, at)
                inside = np.zeros(len(part) + 1, np.int8)
                np.add.at(inside, first, 1)
                np.add.at(inside, past, -1)
                inside = np.cumsum(inside[:-1]) > 0
                bins = trigram_bins(part, at)
                for name in set(langs[low:high]):
                    own = np.repeat(langs[low:high] == name, np.diff(at)) & inside
                    totals.setdefault(name, np.zeros(BINS, np.int64))
                    totals[name] += np.bincount(bins[own], minlength=BINS)
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "bin", "n"])

    counts = rows.mapInArrow(count, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    vectors = counts.groupBy("lang").agg(F.collect_list("bin").alias("bin"), F.collect_list("n").alias("n"))
    found = sorted(vectors.collect(), key=lambda r: r["lang"])
    if not found:
        return None
    table = np.zeros((len(found), BINS))
    for i, row in enumerate(found):
        table[i, row["bin"]] = row["n"]
    share = (table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * BINS)
    return Languages([r["lang"] for r in found], np.log(share))


def _mixture(likely: np.ndarray, bounds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (document x language) over the allowed languages, and the log likelihood of each document.

    ``likely``: language x word; ``bounds``: n + 1 places of the documents' words, all documents with words.
    """
    n_words = np.diff(bounds).astype(np.float64)
    share = allowed / allowed.sum(axis=1, keepdims=True)
    fit = np.zeros(len(n_words))
    for step in range(STEPS + 1):
        spread = np.repeat(share.astype(np.float32), np.diff(bounds), axis=0).T
        joint = likely * spread
        total = joint.sum(axis=0)
        if step == STEPS:
            fit = np.add.reduceat(np.log(total.astype(np.float64)), bounds[:-1])
            break
        joint /= total
        share = np.add.reduceat(joint, bounds[:-1], axis=1).T.astype(np.float64) / n_words[:, None]
    return share, fit


def infer(data: np.ndarray, offsets: np.ndarray, known: Languages) -> np.ndarray:
    """Proportions of the chosen languages in each document; all zero for documents without words."""
    n, count = len(offsets) - 1, len(known.names)
    shares = np.zeros((n, count))
    first, past, bounds = _spans(data, offsets)
    held = np.flatnonzero(np.diff(bounds) > 0)
    if len(held) == 0:
        return shares
    bins = trigram_bins(data, offsets)
    log_word = np.empty((count, len(first)))
    for i in range(count):
        sums = np.zeros(len(data) + 1)
        np.cumsum(known.log_share[i][bins], out=sums[1:])
        log_word[i] = sums[past] - sums[first]
    likely = (np.exp(log_word - log_word.max(axis=0)) + NOISE).astype(np.float32)
    bounds = np.append(bounds[held], bounds[-1])
    price = PENALTY * np.log(np.diff(bounds) + 1) / 2
    allowed = np.ones((len(held), count))
    share, fit = _mixture(likely, bounds, allowed)
    for _ in range(count - 1):
        fewer = allowed.copy()
        weakest = np.where(allowed > 0, share, np.inf).argmin(axis=1)
        many = allowed.sum(axis=1) > 1
        fewer[np.flatnonzero(many), weakest[many]] = 0
        share2, fit2 = _mixture(likely, bounds, fewer)
        better = many & (fit - fit2 < price)
        if not better.any():
            break
        allowed[better], share[better], fit[better] = fewer[better], share2[better], fit2[better]
    shares[held] = share * (allowed > 0)
    return shares


def identify(docs: DataFrame, known: Languages | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (proportion of that language), ``languages`` of every document row.

    ``languages`` lists the chosen set with proportions. Null, empty and letterless texts, and all texts when nothing
    was learned, are ``und`` with score 0. Rows are judged one by one over their whole texts; repeated rows need no
    rule and columns other than ``doc_id`` and ``text`` are ignored. Ties go to the first name in order. An empty table
    gives no row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.lower(text).alias("_lower"), text.rlike(r"\p{L}").alias("_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, listed = ["und"] * batch.num_rows, np.zeros(batch.num_rows), [[]] * batch.num_rows
            letters = batch.column("_letters").to_pylist()
            data, offsets = textnum.text_bytes(batch.column("_lower"))
            for low, _, part, at in textnum.slices(data, offsets) if known is not None else ():
                for i, share in enumerate(infer(part, at, known), low):
                    if letters[i] and share.any():
                        top = int(share.argmax())
                        names[i], scores[i] = known.names[top], min(1.0, share[top])
                        listed[i] = [{"lang": known.names[j], "share": float(share[j])} for j in np.flatnonzero(share)]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            columns = [batch.column("doc_id"), pa.array(names), pa.array(scores), pa.array(listed, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "languages"])

    found = StructType.fromDDL("lang_pred string, score double, languages array<struct<lang:string,share:double>>")
    return rows.mapInArrow(run, StructType([*rows.select("doc_id").schema, *found]))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(True))
    found = identify(docs, learn(docs.where(~held)))
    shown = F.array_join(F.transform("languages", lambda x: x["lang"]), ",")
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", shown.alias("languages"))
