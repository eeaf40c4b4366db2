"""Quality rules by distribution divergence.

Every language has two reference histograms, counted over all its documents: shares of character classes, and shares of
its most common words with one cell for the rest. A document is compared with the references by the Jensen-Shannon
distance (square root of the divergence in bits, 0 to 1) and goes when even its nearest language is too far. Histograms
of few characters or words say little, so either comparison is made from a minimum length on.

Plain counts stand beside it: words, code points in words, symbols, repeated lines, and words in repeated windows of
eight words. Documents that fail their limits go whatever their histograms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.llm import common, textnum

#: Base limits: fewest words, and most words in repeated windows, in percent.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"

#: Character classes, by byte: the first byte of a character beyond ASCII tells its class.
CLASSES = ("lower", "upper", "digit", "blank", "stop", "symbol", "control", "two bytes", "three bytes", "four bytes")
#: Common words a language has, and their greatest length in bytes.
COMMON, WORD_BYTES = 100, 32
#: Languages of fewer words are no reference, and beyond this many languages those of fewest words are none.
REFERENCE_WORDS, LANGUAGES = 2000, 256
#: Minimum lengths for a comparison (characters, words), and greatest distances.
LEAST_CHARS, LEAST_COUNTED = 200, 60
FAR_CLASSES, FAR_WORDS = 0.3, 0.7

#: Buckets of word hashes, and how many of a language's fullest ones are looked into first.
BUCKET_BITS = 16
BUCKETS, FIRST_BUCKETS = 1 << BUCKET_BITS, 1024
#: Bytes of whole texts whose arrays fit the cache.
PIECE = 1 << 17

IS_COMMON = textnum.byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
NOT_BREAK = textnum.byte_class([(0x0A, 0x0A)])


#: Cells of the byte table beyond the classes: the counted symbols, and bytes that continue a character.
MARKED, INNER = len(CLASSES), len(CLASSES) + 1


def _class_table() -> np.ndarray:
    """Cell of each byte."""
    table = np.full(256, CLASSES.index("symbol"), np.uint8)
    table[:32] = table[127] = CLASSES.index("control")
    table[list(b" \t\n\x0b\x0c\r")] = CLASSES.index("blank")
    table[list(b".,;:!?'\"()-")] = CLASSES.index("stop")
    table[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    table[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    table[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    table[list(SYMBOLS)] = MARKED
    table[0x80:0xC0] = INNER
    table[0xC0:0xE0] = CLASSES.index("two bytes")
    table[0xE0:0xF0] = CLASSES.index("three bytes")
    table[0xF0:] = CLASSES.index("four bytes")
    return table


CELL_OF = _class_table()


def _sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``edges``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[edges])


def class_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters by class (document x class), and counted symbols, a step of bytes at a time."""
    n, cells = len(offsets) - 1, INNER + 1
    found = np.zeros(n * cells, np.int64)
    for low in range(0, len(data), textnum.SLICE_BYTES):
        piece = data[low : low + textnum.SLICE_BYTES]
        first, last = np.searchsorted(offsets, [low, low + len(piece) - 1], "right") - 1
        lengths = np.diff(np.clip(offsets[first : last + 2], low, low + len(piece)))
        at = np.repeat(np.arange(last + 1 - first) * cells, lengths)
        at += CELL_OF[piece]
        found[first * cells : (last + 1) * cells] += np.bincount(at, minlength=(last + 1 - first) * cells)
    found = found.reshape(n, cells)
    classes = found[:, : len(CLASSES)]
    classes[:, CLASSES.index("symbol")] += found[:, MARKED]
    return classes, found[:, MARKED]


def _repeated(key: np.ndarray) -> np.ndarray:
    """Places of the keys that occur more than once, in turn."""
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    return np.flatnonzero(np.isin(key, twice)) if len(twice) else np.empty(0, np.int64)


def _own_key(document: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keys of different documents differ."""
    return textnum.mix(key + document.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The plain counts of each document, and its character classes."""
    n = len(offsets) - 1
    start, end, hashes, bounds = textnum.hashed_words(data, offsets, textnum.NOT_WHITE)
    n_words = np.diff(bounds)
    classes, n_symbols = class_counts(data, offsets)
    blank = CLASSES.index("blank")

    line_start, line_end, line_hash, line_bounds = textnum.hashed_words(data, offsets, NOT_BREAK)
    worded = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_doc = np.repeat(np.arange(n), np.diff(line_bounds))[worded]
    line_key = _own_key(line_doc, line_hash[worded])
    shared = _repeated(line_key)
    n_dup_lines = np.bincount(line_doc[shared], minlength=n)
    first = shared[np.unique(line_key[shared], return_index=True)[1]]  # the first of equal lines is no repeat
    n_dup_lines -= np.bincount(line_doc[first], minlength=n)

    count = np.maximum(n_words - WINDOW + 1, 0)
    window_doc = np.repeat(np.arange(n), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[:-1], count)
    total = np.zeros(len(first), np.uint64)
    for j in range(WINDOW):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[first + j]
    covered = np.zeros(len(start) + 1, np.int32)
    for place in first[_repeated(_own_key(window_doc, total))][None, :] + np.arange(WINDOW)[:, None]:
        covered[place] = 1
    return {
        "n_words": n_words,
        "word_chars": classes.sum(axis=1) - classes[:, blank],
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": _sums(covered[:-1], bounds),
        "classes": classes,
    }


@dataclass
class References:
    """Language x class shares; word hashes, sorted, and for each language the column (-1: none) and share of its words."""

    classes: np.ndarray
    hashes: np.ndarray
    columns: list[np.ndarray]
    shares: list[np.ndarray]


def _language_rows(docs: DataFrame) -> DataFrame:
    own = F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.where(own).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def _word_pieces(batch: pa.RecordBatch) -> Iterator[tuple]:
    """First and past-last row, bytes, lower-cased bytes, offsets, and the common words, a cache-sized piece at a time."""
    data, offsets = textnum.text_bytes(batch.column("text"))
    for low, high, part, at in textnum.slices(data, offsets, PIECE):
        lowered = textnum.TO_LOWER[part]
        yield low, high, part, lowered, at, textnum.hashed_words(lowered, at, IS_COMMON)


def histograms(docs: DataFrame) -> DataFrame:
    """``lang``, ``kind``, ``item``, ``n`` over all rows with a language.

    Kind 0 counts characters by class number, 1 all words, 2 words of at most ``WORD_BYTES`` by bucket of their hash.
    Tasks add up their own rows first, so a hot language or word is one row a task, whatever the size of the table.
    """
    width = len(CLASSES) + 1 + BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names, own = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
            for low, high, part, _, at, (start, end, hashes, bounds) in _word_pieces(batch):
                classes, _ = class_counts(part, at)
                lang = own[low:high]
                word_lang = np.repeat(lang, np.diff(bounds))
                bucket = np.where(end - start <= WORD_BYTES, (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), -1)
                for i in np.unique(lang):
                    total = totals.setdefault(names[i], np.zeros(width, np.int64))
                    total[: len(CLASSES)] += classes[lang == i].sum(axis=0)
                    mine = bucket[word_lang == i]
                    total[len(CLASSES)] += len(mine)
                    total[len(CLASSES) + 1 :] += np.bincount(mine[mine >= 0], minlength=BUCKETS)
            if len(totals) > LANGUAGES:  # a vector a language: keep few
                yield from emit(totals)
                totals = {}
        yield from emit(totals)

    def emit(totals: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, total in totals.items():
            at = np.flatnonzero(total)
            kind = np.where(at < len(CLASSES), 0, np.where(at == len(CLASSES), 1, 2)).astype(np.int32)
            item = np.where(kind == 0, at, np.where(kind == 1, 0, at - len(CLASSES) - 1)).astype(np.int32)
            columns = [pa.array([name] * len(at), pa.string()), pa.array(kind), pa.array(item), pa.array(total[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "item", "n"])

    counted = _language_rows(docs).mapInArrow(count, "lang string, kind int, item int, n bigint")
    return counted.groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


def counted_words(docs: DataFrame, langs: list[str], chosen: np.ndarray) -> DataFrame:
    """``lang``, ``item``, ``n``: every word of ``langs`` whose bucket is ``chosen`` (language x bucket), counted over all rows."""
    index = {name: i for i, name in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([index.get(name, -1) for name in batch.column("lang").to_pylist()], np.int64)
            parts = []
            for low, high, _, lowered, _, (start, end, hashes, bounds) in _word_pieces(batch):
                word_lang = np.repeat(own[low:high], np.diff(bounds))
                wanted = (word_lang >= 0) & (end - start <= WORD_BYTES)
                wanted &= chosen[word_lang, (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                place = np.flatnonzero(wanted)
                key, one, times = np.unique(_own_key(word_lang[place], hashes[place]), return_index=True, return_counts=True)
                place = place[one]
                parts.append((key, times, word_lang[place], textnum.span_bytes(lowered, start[place], end[place])))
            if not parts:
                continue
            key, times, word_lang = (np.concatenate([x[i] for x in parts]) for i in range(3))
            _, one, group = np.unique(key, return_index=True, return_inverse=True)
            total = np.zeros(len(one), np.int64)
            np.add.at(total, group, times)
            spelled = pa.concat_arrays([x[3] for x in parts]).take(pa.array(one))
            columns = [pa.array(langs, pa.string()).take(pa.array(word_lang[one])), spelled, pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "item", "n"])

    rows = _language_rows(docs).where(F.col("lang").isin(langs))
    return rows.mapInArrow(count, "lang string, item string, n bigint").groupBy("lang", "item").agg(F.sum("n").alias("n"))


def common_words(docs: DataFrame, counted: DataFrame, langs: list[str]) -> dict[str, list[tuple[str, int]]]:
    """The ``COMMON`` most frequent words of each language with their counts; equal counts in code point order.

    A bucket's count bounds the count of any word in it. Words of the fullest buckets are counted themselves, and the
    result stands for a language once its last word occurs more often than the fullest bucket left out has words; else
    more of its buckets are taken.
    """
    found: dict[str, list[tuple[str, int]]] = {}
    taken = FIRST_BUCKETS
    while open_langs := [name for name in langs if name not in found]:
        fullest = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
        rows = counted.where("kind = 2").where(F.col("lang").isin(open_langs)).withColumn("at", fullest).where(F.col("at") <= taken + 1)
        chosen = np.zeros((len(open_langs), BUCKETS), bool)
        left_out = dict.fromkeys(open_langs, 0)
        for r in rows.collect():
            if r["at"] <= taken:
                chosen[open_langs.index(r["lang"]), r["item"]] = True
            else:
                left_out[r["lang"]] = r["n"]
        best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "item"))
        words: dict[str, list[tuple[str, int]]] = {name: [] for name in open_langs}
        for r in counted_words(docs, open_langs, chosen).withColumn("at", best).where(F.col("at") <= COMMON).collect():
            words[r["lang"]].append((r["item"], r["n"]))
        for name, own in words.items():
            if left_out[name] == 0 or (len(own) == COMMON and min(n for _, n in own) > left_out[name]):
                found[name] = own
        taken *= 8
    return found


def references(docs: DataFrame) -> References:
    """The reference histograms: at most ``LANGUAGES`` languages of ``COMMON`` words, most words first, ties by name."""
    counted = common.stored(histograms(docs), "histograms")
    totals = counted.where("kind = 1").where(F.col("n") >= REFERENCE_WORDS).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    index = {r["lang"]: i for i, r in enumerate(totals)}
    classes = np.zeros((len(index), len(CLASSES)))
    if not index:
        return References(classes, np.empty(0, np.uint64), [], [])
    for r in counted.where("kind = 0").where(F.col("lang").isin(list(index))).collect():
        classes[index[r["lang"]], r["item"]] = r["n"]
    by_name = common_words(docs, counted, list(index))
    words = [by_name[r["lang"]] for r in totals]
    spelled = sorted({w for found in words for w, _ in found})
    data, offsets = textnum.text_bytes(pa.array(spelled, pa.string()))
    hashes = textnum.Prefix(data).spans(offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    place = {spelled[i]: at for at, i in enumerate(order.tolist())}
    columns = [np.array([place[w] for w, _ in found], np.int64) for found in words]
    shares = [np.array([n for _, n in found], np.float64) / r["n"] for found, r in zip(words, totals, strict=True)]
    return References(classes / classes.sum(axis=1, keepdims=True), hashes[order], columns, shares)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` to ``q``; both sum to 1."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0.0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / middle), 0.0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0.0, 1.0))


def nearest(found: References, classes: np.ndarray, word_doc: np.ndarray, word_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and word distance (NaN below the minimum length) to the nearest language, and whether it is near enough.

    The nearest language is that whose larger ratio of distance to limit is smallest.
    """
    n, width = len(classes), len(found.hashes)
    far = [np.full(n, np.nan), np.full(n, np.nan)]
    if not len(found.classes) or n == 0:
        return far[0], far[1], np.ones(n, bool)
    chars, n_words = classes.sum(axis=1), np.bincount(word_doc, minlength=n)
    at = np.minimum(np.searchsorted(found.hashes, word_hash), max(width - 1, 0))
    known = found.hashes[at] == word_hash if width else np.zeros(len(word_hash), bool)
    counts = np.bincount(word_doc[known] * width + at[known], minlength=n * width).reshape(n, width) if width else np.zeros((n, 0))
    best = np.full(n, np.inf)
    for language in range(len(found.classes)):
        d_class = distance(classes / np.maximum(chars, 1)[:, None], found.classes[language][None])
        own = counts[:, found.columns[language]] / np.maximum(n_words, 1)[:, None]
        share = found.shares[language]
        p = np.column_stack([own, 1 - own.sum(axis=1)])
        d_word = distance(np.maximum(p, 0.0), np.append(share, max(0.0, 1 - share.sum()))[None])
        d_class = np.where(chars >= LEAST_CHARS, d_class, np.nan)
        d_word = np.where(n_words >= LEAST_COUNTED, d_word, np.nan)
        ratio = np.fmax(np.fmax(d_class / FAR_CLASSES, d_word / FAR_WORDS), 0.0)
        nearer = ratio < best
        best = np.where(nearer, ratio, best)
        far = [np.where(nearer, d_class, far[0]), np.where(nearer, d_word, far[1])]
    return far[0], far[1], best <= 1.0


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_CELLS = 1 << 21


def judge(docs: DataFrame, found: References | None = None) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed``, ``class_distance``, ``word_distance`` and ``kept`` of every row.

    References come from ``docs`` (``lang``, ``text``) unless given. The language of a document plays no part in its own
    verdict: it is compared with all references, so rows without one are judged alike, and a wrong one does no harm.
    Distances are null below the minimum lengths and where no language has a reference; then the histograms speak for
    the document. Null texts are empty and fail the base limits. Repeated rows each get the same result, rows without an
    id too; other columns are not read; an empty table gives no rows. Long texts are read in steps: beside a text, some
    50 bytes a word are held.
    """
    found = references(docs) if found is None else found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textnum.text_bytes(batch.column("text"))
            for low, high, part, at in textnum.slices(data, offsets, PIECE):
                base = base_counts(part, at)
                _, _, hashes, bounds = textnum.hashed_words(textnum.TO_LOWER[part], at, IS_COMMON)
                step = max(1, _CELLS // max(1, len(found.hashes)))
                verdicts = []
                for first in range(0, high - low, step):
                    last = min(first + step, high - low)
                    own = np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))
                    verdicts.append(nearest(found, base["classes"][first:last], own, hashes[bounds[first] : bounds[last]]))
                d_class, d_word, near = (np.concatenate(v) for v in zip(*verdicts, strict=True))
                failed = (base["n_words"] < LEAST_WORDS) | (100 * base["n_repeat_words"] > MOST_REPEATED * base["n_words"])
                columns = [batch.column("doc_id").slice(low, high - low)]
                columns += [pa.array(base[c].astype(np.int64)) for c in COUNTS]
                columns += [pa.array(failed), *(pa.array(d, mask=np.isnan(d)) for d in (d_class, d_word)), pa.array(near & ~failed)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "class_distance", "word_distance", "kept"])

    kind = ", ".join(f"{c} bigint" for c in ("doc_id", *COUNTS)) + ", base_failed boolean, class_distance double, word_distance double, kept boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, kind)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def _js(p: str, q: str) -> str:
    """One cell of twice the divergence; p and q are SQL expressions."""
    return f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"


_CLASS_CHARS = {
    "lower": "a-z", "upper": "A-Z", "digit": "0-9", "blank": r"\x20\x09-\x0D", "stop": r""".,;:!?'"()\-""",
    "control": r"\x00-\x08\x0E-\x1F\x7F", "two bytes": r"\x{80}-\x{7FF}", "three bytes": r"\x{800}-\x{FFFF}",
    "four bytes": r"\x{10000}-\x{10FFFF}",
}


def _sql() -> str:
    """The same rules in DuckDB SQL."""

    def count(chars: str) -> str:
        chars = chars.replace("'", "''")
        return f"length(regexp_replace(t, '[^{chars}]', '', 'g'))"

    order = [c for c in CLASSES if c != "symbol"]
    cells = ", ".join(f"{count(_CLASS_CHARS[c])} AS c{i}" for i, c in enumerate(order))
    rest = " - ".join(f"c{i}" for i in range(len(order)))
    every = [f"c{i}" for i in range(len(order))] + ["c_symbol"]
    shares = ", ".join(f"sum({c}) / sum(chars)::DOUBLE AS q_{c}" for c in every)
    class_distance = " + ".join(_js(f"(d.{c} / d.chars::DOUBLE)", f"r.q_{c}") for c in every)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, text IS NULL AS none, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
  SELECT r, place, list_aggregate(w[place : place + {WINDOW - 1}], 'string_agg', ' ') AS win
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - {WINDOW - 2})) AS place)
),
twice AS (SELECT r, place FROM windows QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(DISTINCT place + k) AS n FROM twice, range({WINDOW}) AS o(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
repeats AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(repeats.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words USING (r) LEFT JOIN repeats USING (r) LEFT JOIN covered USING (r)
),
classes AS (SELECT *, chars - {rest} AS c_symbol FROM (SELECT r, lang, none, length(t) AS chars, {cells} FROM docs)),
counted AS (
  SELECT r, lang, none, unnest(regexp_extract_all(translate(t, '{common.UPPER}', '{common.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM docs
),
own AS (SELECT r, w, count(*) AS n FROM counted GROUP BY r, w),
sizes AS (SELECT r, sum(n) AS n FROM own GROUP BY r),
langs AS (
  SELECT lang, count(*) AS total FROM counted WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= {REFERENCE_WORDS}
  ORDER BY total DESC, lang LIMIT {LANGUAGES}
),
top AS (
  SELECT lang, w, n / total::DOUBLE AS q FROM (SELECT lang, w, count(*) AS n FROM counted WHERE strlen(w) <= {WORD_BYTES} GROUP BY lang, w)
  JOIN langs USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) <= {COMMON}
),
class_refs AS (SELECT lang, {shares} FROM classes JOIN langs USING (lang) WHERE NOT none GROUP BY lang),
word_cells AS (
  SELECT s.r, top.lang, coalesce(own.n, 0) / s.n::DOUBLE AS p, q
  FROM (SELECT * FROM sizes WHERE n >= {LEAST_COUNTED}) s CROSS JOIN top LEFT JOIN own ON own.r = s.r AND own.w = top.w
),
word_far AS (
  SELECT r, lang, sqrt((cells + {_js("p0", "q0")}) / 2) AS far FROM (
    SELECT r, lang, sum({_js("p", "q")}) AS cells, greatest(0, 1 - sum(p)) AS p0, greatest(0, 1 - sum(q)) AS q0 FROM word_cells GROUP BY r, lang)
),
class_far AS (
  SELECT d.r, r.lang, CASE WHEN chars >= {LEAST_CHARS} THEN sqrt(({class_distance}) / 2) END AS far FROM classes d CROSS JOIN class_refs r
),
verdict AS (
  SELECT c.r, min(coalesce(greatest(c.far / {FAR_CLASSES}, w.far / {FAR_WORDS}), 0)) <= 1 AS near
  FROM class_far c LEFT JOIN word_far w ON c.r = w.r AND c.lang = w.lang GROUP BY c.r
),
failing AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(near, true) AS kept
FROM failing LEFT JOIN verdict USING (r)
"""


SQL = _sql()
