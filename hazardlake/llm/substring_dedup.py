"""Suffix-array dedup: bytes in a string of ``LENGTH`` bytes that also starts earlier are removed.

Suffixes are sorted where equal ones can meet. Every window of ``LENGTH`` bytes has an anchor, the gram of ``GRAM``
bytes with the smallest hash in it, which depends on the window's bytes alone. So windows with the same bytes have the
same anchor gram at the same place. The windows of one anchor with few bytes before it, and those with many, make a
context each, a string that is routed by the 66 or 67 bytes around the anchor which all of its windows hold (its key
gram). Grams that occur once are dropped; the contexts of any other gram go to one task, which builds their suffix array (``suffix_array``), where equal windows are neighbours, and compares neighbours byte by byte.

Hot grams. Equal contexts are reduced to the earliest one before they travel and again on arrival. Many different
contexts of a gram are split by longer grams around the anchor until the suffix arrays are short. Grams with more than
``WARM`` occurrences send single windows instead, whose hashes are counted with partial sums, so that no gram gathers
in a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common, textnum
from hazardlake.llm.suffix_array import suffix_arrays

LENGTH, GRAM = 100, 32
#: Bytes before the anchor from which on a window belongs to the upper half of its anchor's windows.
MIDDLE = (LENGTH - GRAM + 1) // 2
WARM = 2000
#: Size of the two bit sets of gram hashes that tasks get, whatever the corpus holds. A full set lets more rows
#: through, which costs time and changes no result.
FILTER_BITS = 26
#: Contexts in a suffix array, rows and symbols handled at once.
ARRAY_CONTEXTS, ROWS, SYMBOLS = 32, 10_000, 200_000
#: Text within which equal contexts are reduced before they travel, and text whose anchors are found at once.
COMBINED_BYTES, SLICE_BYTES = 4 << 20, 1 << 18
#: How often contexts are split by longer grams in any case; what occurs once goes before suffixes are sorted.
SPLITS = 1
NO_ID = np.iinfo(np.int64).max

CONTEXT, WINDOW, SPAN = 0, 1, 2


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """The contexts of some documents, by place: ``gram`` (hash of the bytes around the anchor that all its windows
    hold), ``doc``, ``low`` (first window's place in all bytes), ``left`` (bytes before the anchor in that window) and
    ``windows`` (how many windows). The windows of an anchor make two contexts at most, split at ``MIDDLE``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.prefix = textnum.Prefix(data)
        n = len(data)
        if n < LENGTH:
            self.gram, empty = np.empty(0, np.uint64), np.empty(0, np.int64)
            self.doc = self.low = self.left = self.windows = empty
            return
        places = np.arange(n - GRAM + 1)
        hashes = self.prefix.spans(places, places + GRAM)
        # The place breaks ties to the left; 24 bits of the hash give way to it, in every text alike.
        packed = (hashes & ~np.uint64((1 << 24) - 1)) if n < 1 << 24 else hashes
        if n < 1 << 24:
            best = (_least_in_windows(packed | places.astype(np.uint64), LENGTH - GRAM + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        else:
            best = _leftmost(packed & ~np.uint64((1 << 24) - 1), LENGTH - GRAM + 1)
        start = np.arange(n - LENGTH + 1)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(start)]
        whole = start + LENGTH <= offsets[doc + 1]
        start, best, doc = start[whole], best[whole], doc[whole]
        if len(start) == 0:
            first = last = np.empty(0, np.int64)
        else:
            first = np.flatnonzero(np.append(True, (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])))
            last = np.append(first[1:], len(start)) - 1
        anchor, doc = best[first], doc[first]
        most, least = anchor - start[first], anchor - start[last]  # bytes before the anchor in a window
        # Windows with many bytes before the anchor share more of them, the others more of what follows.
        upper, lower = np.flatnonzero(most >= MIDDLE), np.flatnonzero(least < MIDDLE)
        left = np.append(most[upper], np.minimum(most[lower], MIDDLE - 1))
        right = np.append(np.maximum(least[upper], MIDDLE), least[lower])
        key = np.append(
            self.prefix.spans(anchor[upper] - MIDDLE, anchor[upper] + GRAM),
            self.prefix.spans(anchor[lower], anchor[lower] + LENGTH - MIDDLE + 1),
        )
        low = np.append(anchor[upper], anchor[lower]) - left
        order = np.argsort(low, kind="stable")
        self.gram, self.doc, self.low = key[order], np.append(doc[upper], doc[lower])[order], low[order]
        self.left, self.windows = left[order], (left - right + 1)[order]


def _leftmost(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``width`` neighbours, for texts too long for packed places."""
    part = 1 << 22
    found = []
    for at in range(0, len(values) - width + 1, part):
        piece = values[at : at + part + width - 1]
        packed = piece | np.arange(len(piece), dtype=np.uint64)
        found.append(at + (_least_in_windows(packed, width) & np.uint64((1 << 24) - 1)).astype(np.int64))
    return np.concatenate(found)


def _in_filter(bits: np.ndarray, gram: np.ndarray) -> np.ndarray:
    at = gram >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def _filter_of(grams: DataFrame) -> np.ndarray:
    """The bit set of ``gram``; at most 2 ** FILTER_BITS / 64 words reach the driver."""
    at = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    words = (
        grams.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int")).alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def _gram_counts(rows: DataFrame) -> DataFrame:
    """``gram``, ``n`` for anchor grams that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textnum.text_bytes(batch.column("text"))
            for _, _, part, at in textnum.slices(data, offsets, SLICE_BYTES):
                grams, n = np.unique(Anchors(part, at).gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return rows.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")


FIELDS = "kind tinyint, gram bigint, digest bigint, doc bigint, text_key bigint, low int, left int, windows int, bytes binary"
NAMES = ["kind", "gram", "digest", "doc", "text_key", "low", "left", "windows", "bytes"]


def _rows(kind: int, gram: np.ndarray, digest: np.ndarray, doc: np.ndarray, key: np.ndarray, low: np.ndarray, left: np.ndarray, windows: np.ndarray, content: pa.Array | None) -> pa.RecordBatch:
    n = len(doc)
    columns = [pa.array(np.full(n, kind, np.int8)), *(pa.array(x.view(np.int64)) for x in (gram, digest)), pa.array(doc), pa.array(key)]
    columns += [pa.array(x.astype(np.int32)) for x in (low, left, windows)]
    return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.binary()) if content is None else content], names=NAMES)


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """Spans of bytes as a binary array."""
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _merged(doc: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each document, overlapping and touching ones joined."""
    if len(doc) == 0:
        return doc, key, low, high
    order = np.lexsort((low, key, doc))
    doc, key, low, high = doc[order], key[order], low[order], high[order]
    new_doc = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))
    base = np.cumsum(new_doc) * (int(high.max()) + 2)
    reach = np.maximum.accumulate(high + base)
    first = np.flatnonzero(np.append(True, (low + base)[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], key[first], low[first], (reach - base)[last]


def _repeated(gram: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Which rows have an equal one before them."""
    order = np.lexsort((content, gram))
    again = np.zeros(len(gram), bool)
    again[order[1:]] = (gram[order][1:] == gram[order][:-1]) & (content[order][1:] == content[order][:-1])
    return again


def _gather(rows: DataFrame, repeated: np.ndarray, warm: np.ndarray) -> DataFrame:
    """Contexts, windows of warm grams, and spans that an earlier context of the same batch already shows to repeat."""
    sent = rows.sparkSession.sparkContext.broadcast((repeated, warm))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, warm = sent.value
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            texts, order = batch.column("text"), np.lexsort((keys, ids))
            # Equal rows of the table are one document: two in a batch would repeat each other.
            same = (ids[order][1:] == ids[order][:-1]) & (keys[order][1:] == keys[order][:-1])
            order = np.delete(order, np.flatnonzero(same) + 1)
            if len(order) < len(ids) or (order != np.arange(len(order))).any():
                texts, ids, keys = texts.take(pa.array(order)), ids[order], keys[order]
            data, offsets = textnum.text_bytes(texts)
            for first, last, _, _ in textnum.slices(data, offsets, COMBINED_BYTES):
                base = offsets[first]
                yield from combined(data[base : offsets[last]], offsets[first : last + 1] - base, ids[first:last], keys[first:last], repeated, warm)

    def combined(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, keys: np.ndarray, repeated: np.ndarray, warm: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The rows of some documents in order, equal contexts and windows reduced to the earliest."""
        parts, hot = [], []
        for first, _, part, at in textnum.slices(data, offsets, SLICE_BYTES):
            found = Anchors(part, at)
            use = np.flatnonzero(_in_filter(repeated, found.gram))
            gram, doc, low, left, windows = (x[use] for x in (found.gram, found.doc, found.low, found.left, found.windows))
            digest = textnum.mix(found.prefix.spans(low, low + windows + LENGTH - 1) ^ textnum.mix((left * 256 + windows).astype(np.uint64)))
            parts.append((gram, digest, doc + first, low + offsets[first], left, windows))
            pick = np.flatnonzero(_in_filter(warm, gram))
            step = np.arange(windows[pick].sum()) - np.repeat(np.cumsum(windows[pick]) - windows[pick], windows[pick])
            start = np.repeat(low[pick], windows[pick]) + step
            hot.append((np.repeat(gram[pick], windows[pick]), found.prefix.spans(start, start + LENGTH), np.repeat(doc[pick], windows[pick]) + first, start + offsets[first]))
        gram, digest, doc, low, left, windows = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Documents and places are in order, so the first row of equal ones is the earliest.
        again, is_warm = _repeated(gram, digest), _in_filter(warm, gram)
        spans = [(doc[again], low[again], low[again] + windows[again] + LENGTH - 1)]
        pick = np.flatnonzero(~again & ~is_warm)
        for at in range(0, len(pick), ROWS):
            p = pick[at : at + ROWS]
            content = _cut(data, low[p], windows[p] + LENGTH - 1)
            yield _rows(CONTEXT, gram[p], digest[p], ids[doc[p]], keys[doc[p]], low[p] - offsets[doc[p]], left[p], windows[p], content)
        gram, whole, doc, low = (np.concatenate(x) for x in zip(*hot, strict=True))
        again = _repeated(gram, whole)
        spans.append((doc[again], low[again], low[again] + LENGTH))
        pick = np.flatnonzero(~again)
        nothing = np.zeros(len(pick), np.int64)
        if len(pick):
            # Dealt by content, not by gram, so that a gram's windows spread.
            yield _rows(WINDOW, textnum.mix(gram[pick] ^ whole[pick]), whole[pick], ids[doc[pick]], keys[doc[pick]], low[pick] - offsets[doc[pick]], nothing, nothing + 1, None)
        doc, low, high = (np.concatenate(x) for x in zip(*spans, strict=True))
        doc, _, low, high = _merged(doc, doc, low - offsets[doc], high - offsets[doc])
        if len(doc):
            # A span needs no company: it is dealt by document and place.
            nothing = np.zeros(len(doc), np.int64)
            yield _rows(SPAN, textnum.mix((doc * 64 + low).astype(np.uint64)), nothing, ids[doc], keys[doc], low, nothing, high - low - LENGTH + 1, None)

    return rows.select("doc", "text_key", "text").mapInArrow(run, FIELDS)


class _Contexts:
    """Contexts of whole grams, in order of grams, documents and places; finds the windows that start earlier too."""

    def __init__(self, gram: np.ndarray, left: np.ndarray, windows: np.ndarray, data: np.ndarray, at: np.ndarray) -> None:
        self.left, self.windows, self.data, self.at = left, windows, data, at
        self.prefix = textnum.Prefix(data)
        self.first_window = np.append(0, np.cumsum(windows))
        self.seen = np.zeros(self.first_window[-1] + 1, np.int32)
        # An item is a context with a range of windows, named by the bytes before the anchor: low..high.
        row = np.arange(len(gram))
        group = np.unique(gram, return_inverse=True)[1]
        upper = left >= MIDDLE
        nominal = np.stack([np.where(upper, MIDDLE, 0), np.where(upper, LENGTH - GRAM, MIDDLE - 1)], axis=1)
        small: list[tuple[np.ndarray, ...]] = []
        low, high = left - windows + 1, left.copy()
        splits = 0
        while len(row):
            row, group, low, high, nominal = self._collapse(row, group, low, high, nominal)
            size = np.bincount(group)[group]
            ready = (size > 1) & (size <= (ARRAY_CONTEXTS if splits >= SPLITS else 0))
            small.append((row[ready], group[ready], low[ready], high[ready]))
            row, group, low, high, nominal = (x[(size > 1) & ~ready] for x in (row, group, low, high, nominal))
            row, group, low, high, nominal = self._halve(row, group, low, high, nominal)
            splits += 1
        for part in small:
            self._sort(*part)
        self.repeats = np.cumsum(self.seen[:-1]) > 0

    def _anchor(self, row: np.ndarray) -> np.ndarray:
        return self.at[row] + self.left[row]

    def _mark(self, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        first = self.first_window[row] + self.left[row]
        np.add.at(self.seen, first - high, 1)
        np.add.at(self.seen, first - low + 1, -1)

    def _collapse(self, row: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, nominal: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of items with the same bytes and windows in a group, the first stays; the windows of the others repeat."""
        anchor = self._anchor(row)
        content = self.prefix.spans(anchor - high, anchor - low + LENGTH)
        order = np.lexsort((row, content, high, low, group))
        same = np.zeros(len(row), bool)
        if len(row):
            a, b = order[1:], order[:-1]
            same[a] = (group[a] == group[b]) & (low[a] == low[b]) & (high[a] == high[b]) & (content[a] == content[b])
        self._mark(row[same], low[same], high[same])
        return tuple(x[~same] for x in (row, group, low, high, nominal))

    def _halve(self, row: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray, nominal: np.ndarray) -> tuple[np.ndarray, ...]:
        """Split items at the middle of their group's range of windows; bytes that all windows of a half hold are its key."""
        middle = (nominal[:, 0] + nominal[:, 1] + 1) // 2
        parts = []
        for side in (0, 1):
            bounds = nominal.copy()
            bounds[:, 1 - side] = middle - (1 - side)
            item_low, item_high = np.maximum(low, bounds[:, 0]), np.minimum(high, bounds[:, 1])
            held = (item_low <= item_high) & (nominal[:, 0] < nominal[:, 1])
            anchor = self._anchor(row[held])
            core = self.prefix.spans(anchor - bounds[held, 0], anchor + LENGTH - bounds[held, 1])
            key = textnum.mix(core ^ textnum.mix((group[held] * 2 + side).astype(np.uint64)))
            parts.append((row[held], key, item_low[held], item_high[held], bounds[held]))
        row, key, low, high, nominal = (np.concatenate(x) for x in zip(*parts, strict=True))
        return row, np.unique(key, return_inverse=True)[1], low, high, nominal

    def _sort(self, row: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Suffix arrays of the groups, shortest first, so that strings handled in step are of like length."""
        size = high - low + LENGTH + 1
        total = np.bincount(group, size + 0.0).astype(np.int64)[group] if len(group) else group
        order = np.lexsort((row, group, total))
        starts = np.append(0, np.cumsum(size[order]))
        cut = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else []
        begin = 0
        for i, at in enumerate(cut):
            after = cut[i + 1] if i + 1 < len(cut) else len(order)
            if starts[after] - starts[begin] >= SYMBOLS or after == len(order):
                pick = order[begin:after]
                self._array(row[pick], group[pick], low[pick], high[pick])
                begin = after

    def _array(self, row: np.ndarray, group: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        size = high - low + LENGTH
        new = np.append(True, np.diff(group) != 0)
        # Each item is followed by 1, the last one of a string by 0; bytes start at 2.
        ends = np.cumsum(size + 1)
        at = ends - size - 1
        offset = np.arange(ends[-1]) - np.repeat(at, size + 1)
        item = np.repeat(np.arange(len(row)), size + 1)
        source = self._anchor(row)[item] - high[item] + offset
        symbols = np.where(offset < size[item], self.data[np.minimum(source, len(self.data) - 1)].astype(np.int64) + 2, 1)
        symbols[np.append(at[new][1:], ends[-1]) - 1] = 0
        order = suffix_arrays(symbols, np.append(at[new], ends[-1]))
        order = order[offset[order] + LENGTH <= size[item[order]]]
        views = np.lib.stride_tricks.sliding_window_view(symbols.astype(np.uint16), LENGTH)
        string = np.cumsum(new)[item[order]]
        equal = string[1:] == string[:-1]
        near = np.flatnonzero(equal)
        for part in np.array_split(near, len(near) // 100_000 + 1):
            equal[part] = (views[order[part]] == views[order[part + 1]]).all(axis=1)
        first = np.flatnonzero(np.append(True, ~equal))
        place = row[item[order]] * (2 * LENGTH) + offset[order] - high[item[order]] + LENGTH
        earliest = np.repeat(np.minimum.reduceat(place, first), np.diff(np.append(first, len(order))))
        late = order[place != earliest]
        before = high[item[late]] - offset[late]
        self._mark(row[item[late]], before, before)


def _resolve(gathered: DataFrame) -> DataFrame:
    """Spans that repeat among the contexts of each gram; windows and known spans pass through."""

    def judged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kind = rows["kind"].to_numpy()
        other = rows.filter(pa.array(kind != CONTEXT))
        yield from other.combine_chunks().to_batches()
        rows = rows.filter(pa.array(kind == CONTEXT)).combine_chunks()
        if rows.num_rows == 0:
            return
        gram, doc, key, low, left, windows = (rows[c].to_numpy() for c in ("gram", "doc", "text_key", "low", "left", "windows"))
        one = np.ones(len(gram), bool)  # equal rows of the table are one document
        one[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (low[1:] != low[:-1])
        size = np.bincount(np.cumsum(np.append(True, gram[1:] != gram[:-1])) - 1, one)
        one &= np.repeat(size > 1, np.diff(np.append(np.flatnonzero(np.append(True, gram[1:] != gram[:-1])), len(gram))))
        pick = np.flatnonzero(one)
        if len(pick) == 0:
            return
        content = rows["bytes"].take(pa.array(pick)).combine_chunks()
        content = content.chunk(0) if isinstance(content, pa.ChunkedArray) else content
        _, offsets, data = content.buffers()
        at = np.frombuffer(offsets, np.int32)[content.offset : content.offset + len(content) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
        gram, doc, key, low, left, windows = (x[pick].astype(np.int64) for x in (gram, doc, key, low, left, windows))
        found = _Contexts(gram, left, windows, data, at[:-1] - at[0])
        owner = np.repeat(np.arange(len(gram)), windows)[found.repeats]
        start = low[owner] + np.flatnonzero(found.repeats) - found.first_window[owner]
        doc, key, low, high = _merged(doc[owner], key[owner], start, start + LENGTH)
        nothing = np.zeros(len(doc), np.int64)
        yield _rows(SPAN, nothing, nothing, doc, key, low, nothing, high - low - LENGTH + 1, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= ROWS:
                rows = pa.Table.from_batches(held)
                gram = rows["gram"].to_numpy()
                whole = int(np.searchsorted(gram, gram[-1], "left"))
                yield from judged(rows.slice(0, whole))
                rows = rows.slice(whole).combine_chunks()
                held, count = rows.to_batches(), rows.num_rows
        if count:
            yield from judged(pa.Table.from_batches(held))

    return gathered.repartition("gram").sortWithinPartitions("gram", "doc", "text_key", "low").mapInArrow(run, FIELDS)


def _window_spans(windows: DataFrame) -> DataFrame:
    """Spans of warm grams' windows that start earlier too, from ``gram``, ``digest``, ``doc``, ``text_key``, ``low``."""
    first = common.stored(
        windows.groupBy("gram", "digest")
        .agg(F.min(F.struct("doc", "text_key", "low")).alias("first"), F.max(F.struct("doc", "text_key", "low")).alias("last"))
        .where("first <> last")
        .select("gram", "digest", "first"),
        "first-windows",
    )
    here = F.struct("doc", "text_key", "low")
    later = windows.join(first, ["gram", "digest"]).where(here != F.col("first"))
    return later.select("doc", "text_key", "low", (F.col("low") + LENGTH).alias("high"))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc``, ``text_key``, ``spans`` (array of low, high in bytes, to be joined where they overlap)."""
    counts = common.stored(_gram_counts(rows), "gram-counts")
    repeated, warm = _filter_of(counts), _filter_of(counts.where(F.col("n") > WARM))
    found = common.stored(_resolve(_gather(rows, repeated, warm)).drop("bytes", "left"), "repeats")
    known = found.where(F.col("kind") == SPAN).select("doc", "text_key", "low", (F.col("low") + F.col("windows") + LENGTH - 1).alias("high"))
    every = known.union(_window_spans(found.where(F.col("kind") == WINDOW)))
    return every.groupBy("doc", "text_key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``n_spans``, one row per document row.

    Texts are UTF-8 bytes, null ones empty. Each byte covered by a string of ``LENGTH`` bytes that also starts earlier
    (at a smaller doc_id, or before in the same text) is removed, judged on the input. Texts shorter than that stay
    whole. Rows with the same id and text are one document and get the same result; rows with the same id and other
    texts are ordered by a hash of the text; rows without an id come last. Other columns are ignored.
    """
    rows = common.text_rows(docs).withColumn("doc", F.coalesce("doc_id", F.lit(int(NO_ID))))
    found = repeated_spans(rows)
    joined = rows.join(found, ["doc", "text_key"], "left").select("doc_id", "text", "spans")
    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textnum.text_bytes(batch.column("text"))
            kept, sizes, removed, counts = [], [], [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                parts, last, n = [], 0, 0
                for low, high in sorted((x["low"], x["high"]) for x in spans or ()):
                    if low > last or n == 0:
                        parts.append(text[last:low])
                        n += 1
                        last = high
                    else:
                        last = max(last, high)
                parts.append(text[last:])
                kept.append(b"".join(parts))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(sizes), pa.array(removed), pa.array(counts)], names=names)

    return joined.mapInArrow(run, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
