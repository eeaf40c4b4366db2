"""Whole texts as numpy arrays: words, word hashes and shingle hashes of many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(spans: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 booleans that is true outside ``spans`` (inclusive byte ranges)."""
    inside = np.ones(256, bool)
    for low, high in spans:
        inside[low : high + 1] = False
    return inside


NOT_WHITE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets of the documents in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about ``limit`` bytes: first, past-last row, their bytes and offsets."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over 64 bits."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefix:
    """Hashes of any spans of some bytes, from one running sum."""

    _powers: dict[str, np.ndarray] = {}

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        if len(self._powers.get("up", ())) <= n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(max(n + 1, SLICE_BYTES + 1), base, np.uint64)
                steps[0] = 1
                self._powers[name] = np.multiply.accumulate(steps)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self._powers["up"][:n], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Sums of spans as if each stood at the beginning; such sums can be put together from pieces."""
        return (self.sums[end] - self.sums[start]) * self._powers["down"][start]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end) + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where each document's words begin among them (n + 1 numbers)."""
    inside = is_word[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, offsets)


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words within documents, and each document's bounds among them.

    A document of fewer words is one run; one without words has none.
    """
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=out[1:])
    first = np.repeat(bounds[:-1] - out[:-1], count) + np.arange(out[-1])
    last = np.repeat(bounds[1:], count)
    padded = np.append(hashes, np.zeros(k, np.uint64))
    total = np.zeros(len(first), np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + np.where(first + j < last, padded[first + j], np.uint64(0))
    return mix(total), out


def hashed_words(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, step: int = SLICE_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and document bounds of all words, as ``words`` and ``Prefix.spans`` give them.

    The bytes are read ``step`` at a time, and a word that goes on behind a step is put together from its pieces, so
    beside the words themselves only a step's arrays are held, however long a text or a word is.
    """
    if len(data) <= step:
        start, end, bounds = words(data, offsets, is_word)
        return start, end, Prefix(data).spans(start, end), bounds
    starts, ends, raws = [], [], []
    cuts = np.unique(offsets)
    for low in range(0, len(data), step):
        piece = data[low : low + step]
        inner = cuts[np.searchsorted(cuts, low, "right") : np.searchsorted(cuts, low + len(piece), "left")] - low
        start, end, _ = words(piece, np.concatenate([[0], inner, [len(piece)]]).astype(np.int64), is_word)
        if not len(start):
            continue
        raw = Prefix(piece).raw(start, end)
        start, end = start + low, end + low
        if ends and start[0] == low == ends[-1][-1] and cuts[np.searchsorted(cuts, low)] != low:
            before = int(ends[-1][-1] - starts[-1][-1])
            raws[-1][-1:] += raw[:1] * np.uint64(pow(_BASE, before, 1 << 64))
            ends[-1][-1] = end[0]
            start, end, raw = start[1:], end[1:], raw[1:]
            if not len(start):
                continue
        starts.append(start)
        ends.append(end)
        raws.append(raw)
    if not starts:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(offsets), np.int64)
    start, end, raw = np.concatenate(starts), np.concatenate(ends), np.concatenate(raws)
    return start, end, mix(raw + (end - start).astype(np.uint64)), np.searchsorted(start, offsets)


def span_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of spans as a string column, without a loop over them."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    at = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[at].tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(start), buffers).cast(pa.string())
