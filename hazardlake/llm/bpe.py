"""BPE encoding and decoding with the merges of a public word-level vocabulary.

Merging works on all distinct words of a batch at once through a pair occurrence index: every adjacent pair of
symbols maps to all its positions, active pairs are applied in ascending rank, and a merge updates the lists of the
neighbouring pairs it breaks and makes. Encoded words are remembered within a task, up to a bound on their number.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hazardlake.llm import common

#: Encoded words that a task remembers; then it starts afresh.
REMEMBERED = 400_000
TEXTS_AT_ONCE = 256


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}


class WordBpe:
    """Vocabulary, merges and the normalisation of a tokenizer file; the file's kinds of steps are checked."""

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or byte_level["type"] != "ByteLevel" or model["type"] != "BPE":
            raise ValueError("this tokenizer file needs steps that are not built here")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")")
        vocab = model["vocab"]
        self.names = {i: x for x, i in [*vocab.items(), *self.special.items()]}
        self.suffix = model.get("end_of_word_suffix") or ""
        letters = _byte_letters()
        self.inner = [vocab.get(letters[b], -1) for b in range(256)]
        self.last = [vocab.get(letters[b] + self.suffix, -1) for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.known: dict[str | tuple[str], bytes] = {}

    def merge(self, words: list[str]) -> list[bytes]:
        """Token ids of each word as bytes, all words merged together over one pair occurrence index."""
        symbol: list[int] = []
        bounds = [0]
        for word in words:
            data = word.encode()
            inner = self.inner
            symbol.extend([inner[b] for b in data[:-1]])
            symbol.append(self.last[data[-1]])
            bounds.append(len(symbol))
        n = len(symbol)
        following = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            before[low], following[high - 1] = -1, -1
        merges = self.merges
        places: dict[tuple[int, int], list[int]] = {}
        for i in range(n):
            j = following[i]
            if j >= 0:
                pair = (symbol[i], symbol[j])
                if pair in places:
                    places[pair].append(i)
                elif pair in merges:
                    places[pair] = [i]
        active = [(merges[pair][0], pair) for pair in places]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            a, b = pair
            made = merges[pair][1]
            for i in sorted(places.pop(pair, ())):
                if symbol[i] != a:
                    continue
                j = following[i]
                if j < 0 or symbol[j] != b:
                    continue
                k, h = following[j], before[i]
                symbol[i], symbol[j], following[i] = made, -1, k
                if k >= 0:
                    before[k] = i
                    fresh = (made, symbol[k])
                    if fresh in merges:
                        if fresh not in places:
                            places[fresh] = []
                            heapq.heappush(active, (merges[fresh][0], fresh))
                        places[fresh].append(i)
                if h >= 0:
                    fresh = (symbol[h], made)
                    if fresh in merges:
                        if fresh not in places:
                            places[fresh] = []
                            heapq.heappush(active, (merges[fresh][0], fresh))
                        places[fresh].append(h)
        left = np.array(symbol, np.int64)
        stays = left >= 0
        ends = (4 * np.append(0, np.cumsum(stays))[bounds]).tolist()
        data = left[stays].astype("<u4").tobytes()
        return [data[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]

    def pieces(self, text: str) -> list[str | tuple[str]]:
        """Words, and special tokens as tuples, of a text after its normalisation.

        White space is dropped by the word pattern, so replacing runs of it by a blank changes nothing. Letters are
        lower-cased one by one, so a capital sigma never becomes the form for word ends.
        """
        if not any(x in text for x in self.special):
            return self._words(text)
        found: list[str | tuple[str]] = []
        for i, part in enumerate(self.cut.split(text)):
            found.extend([(part,)] if i % 2 else self._words(part))
        return found

    def _words(self, text: str) -> list[str]:
        plain = text if text.isascii() else unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return self.word.findall(plain.lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        split = [self.pieces(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        if not known:
            known.update({(x,): np.array([i], "<u4").tobytes() for x, i in self.special.items()})
        new = [x for x in set().union(*split) if x not in known]
        for word, ids in zip(new, self.merge(new), strict=True):
            known[word] = ids
        return [np.frombuffer(b"".join([known[x] for x in words]), "<u4") for words in split]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids: the tokens' names with a space between, as the file names no decoder."""
        names = self.names
        return [" ".join([names[i] for i in x.tolist() if i in names]) for x in ids]


def round_trip(docs: DataFrame, path: str, carry: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """``doc_id``, columns of ``carry``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of every document row.

    ``path`` is a tokenizer file that the driver reads; its text travels with the tasks. ``with_ids`` adds ``ids``
    and ``decoded``. Null and empty texts have no tokens. Rows are independent of each other, so repeated rows and
    ids need no rule.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    rows = docs.select("doc_id", *carry, docs["text"].cast("string").alias("_text"))
    kept = ["doc_id", *carry]
    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    kind = StructType([*rows.select(*kept).schema, *StructType.fromDDL(added)])
    names = [*kept, "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        names += ["ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(definition)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                ids = bpe.encode([x or "" for x in batch.column("_text").to_pylist()])
                decoded = bpe.decode(ids)
                columns = [batch.column(c) for c in kept]
                columns.append(pa.array([len(x) for x in ids], pa.int64()))
                columns.append(pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in ids]))
                columns.append(pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]))
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    columns.append(pa.array(decoded))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, kind)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(common.table(spark, sf_dir, "documents"), tokenizer_path())
