"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word enters as the vector of the word itself (words of the training sample) plus vectors of its first and last
characters (hashed, so unseen words have them too). Windows of ``LENGTH`` words, half overlapping, cover every text
to its end; a text's score is that of its most toxic window. Training is multiple-instance: labels belong to texts,
so each round scores all windows of the sample and learns from the strongest window of every text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.llm import common, textnum

#: Most labelled rows of each class that a fit may use; the documents of that many rows fit in one task.
MAX_TOXIC, MAX_CLEAN = 2500, 3500
#: Bytes of text the fit takes at most, whole texts, shortest first.
MAX_BYTES = 128 << 20
LENGTH, STRIDE = 32, 16
HIDDEN, EMBED, ATTEND = 8, 8, 8
CHAR_BINS = 1 << 13
#: First and last bytes of a word that make its character input: (from the start, bytes).
PIECES = ((True, 3), (True, 5), (True, 7), (False, 4))
ROUNDS, EPOCHS, BATCH, RATE = 4, 3, 128, 0.01
#: Deviations of a word that count as one, and the share of texts that only set the threshold.
LEAN, CHECKED = 3.0, 0.2
#: Largest share of the clean ones among them that may be flagged.
FLAGGED = 0.03
#: Weight decay of the word and character vectors, and the share of words that training hides.
DECAY, HIDE = 0.02, 0.1
CHUNK = 4096

IS_WORD = textnum.byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def word_inputs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, character bins (words x pieces) and word bounds of lower-cased documents."""
    start, end, bounds = textnum.words(data, offsets, IS_WORD)
    prefix = textnum.Prefix(data)
    bins = np.empty((len(start), len(PIECES)), np.int32)
    for j, (front, size) in enumerate(PIECES):
        low, high = (start, np.minimum(end, start + size)) if front else (np.maximum(start, end - size), end)
        bins[:, j] = (prefix.spans(low, high) >> np.uint64(50)).astype(np.int32) % CHAR_BINS + j * CHAR_BINS
    return prefix.spans(start, end), bins, bounds


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and document of all windows; every word is in one at least."""
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(0, -((LENGTH - n) // STRIDE)) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[doc] + place * STRIDE
    return start, np.minimum(LENGTH, bounds[doc + 1] - start), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Network:
    """The parameters and both directions of computation."""

    def __init__(self, known: np.ndarray, lean: np.ndarray) -> None:
        """``known``: sorted hashes of words that have a vector; ``lean``: how toxic each looks by counts alone."""
        rng = np.random.default_rng(11)
        draw = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        self.known = known
        self.p = {
            "word": draw(len(known) + 1, EMBED, scale=0.05),
            "char": draw(len(PIECES) * CHAR_BINS, EMBED, scale=0.02),
            "into": draw(2 * EMBED, 6 * HIDDEN, scale=0.3),
            "bias": np.zeros(6 * HIDDEN, np.float32),
            "ahead": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
            "back": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
            "look": draw(2 * HIDDEN, ATTEND, scale=0.3),
            "weigh": draw(ATTEND, scale=0.3),
            "out": draw(2 * HIDDEN, scale=0.3),
            "level": np.zeros(1, np.float32),
        }
        self.p["word"][1:, 0] = lean
        self.shift = 0.0

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word's vector; 0 for unknown words."""
        if len(self.known) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What each word vector and each character bin adds to the gates."""
        p = self.p
        return p["word"] @ p["into"][:EMBED] + p["bias"], p["char"] @ p["into"][EMBED:]

    def forward(self, gates: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``gates``: steps x windows x 6 hidden. ``keep`` gets what ``backward`` needs."""
        p, (steps, n, _) = self.p, gates.shape
        seen = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        inside = np.arange(steps)[:, None] < size[None, :]
        for side, name in enumerate(("ahead", "back")):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if side == 0 else reversed(range(steps)):
                x = gates[t, :, 3 * HIDDEN * side : 3 * HIDDEN * (side + 1)]
                g = h @ p[name]
                zr = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                fresh = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                new = np.where(inside[t][:, None], fresh + z * (h - fresh), h)
                if keep is not None:
                    keep[side, t] = (h, g[:, 2 * HIDDEN :], z, r, fresh)
                h = new
                seen[t, :, HIDDEN * side : HIDDEN * (side + 1)] = h
        looked = np.tanh(seen @ p["look"])
        weight = np.where(inside, looked @ p["weigh"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, seen)
        if keep is not None:
            keep.update(seen=seen, looked=looked, weight=weight, pooled=pooled, inside=inside)
        return pooled @ p["out"] + p["level"][0]

    def backward(self, slope: np.ndarray, keep: dict) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the recurrent part and of the gates, from the slope of the loss in each logit."""
        p, seen, looked, weight = self.p, keep["seen"], keep["looked"], keep["weight"]
        steps, n, _ = seen.shape
        grad = {"out": keep["pooled"].T @ slope, "level": slope.sum(keepdims=True)}
        pooled = slope[:, None] * p["out"]
        of_weight = np.einsum("tnh,nh->tn", seen, pooled)
        score = weight * (of_weight - (weight * of_weight).sum(axis=0))
        grad["weigh"] = np.einsum("tn,tna->a", score, looked)
        of_look = score[:, :, None] * p["weigh"] * (1 - looked**2)
        grad["look"] = np.einsum("tnh,tna->ha", seen, of_look)
        of_seen = weight[:, :, None] * pooled + of_look @ p["look"].T
        gates = np.zeros((steps, n, 6 * HIDDEN), np.float32)
        for side, name in enumerate(("ahead", "back")):
            later, total = np.zeros((n, HIDDEN), np.float32), np.zeros_like(p[name])
            for t in reversed(range(steps)) if side == 0 else range(steps):
                h, g, z, r, fresh = keep[side, t]
                d = later + of_seen[t, :, HIDDEN * side : HIDDEN * (side + 1)]
                here = np.where(keep["inside"][t][:, None], d, np.float32(0))
                of_fresh = here * (1 - z) * (1 - fresh**2)
                of_z = here * (h - fresh) * z * (1 - z)
                of_r = of_fresh * g * r * (1 - r)
                into = np.concatenate([of_z, of_r, of_fresh * r], axis=1)
                total += h.T @ into
                later = (d - here) + here * z + into @ p[name].T
                gates[t, :, 3 * HIDDEN * side : 3 * HIDDEN * (side + 1)] = np.concatenate([of_z, of_r, of_fresh], axis=1)
            grad[name] = total
        return grad, gates

    def logits(self, word: np.ndarray, bins: np.ndarray, start: np.ndarray, size: np.ndarray, tables: tuple | None = None) -> np.ndarray:
        """Logits of the windows at ``start`` (ascending) over words given by vector place and character bins."""
        by_word, by_char = tables or self.tables()
        out = np.empty(len(start), np.float32)
        for at in range(0, len(start), CHUNK):
            s, n = start[at : at + CHUNK], size[at : at + CHUNK]
            # Windows are in order of words, so a chunk of them needs the gates of one stretch of words.
            low, high = int(s[0]), int(s[-1] + n[-1])
            gates = by_word[word[low:high]]
            for j in range(bins.shape[1]):
                gates += by_char[bins[low:high, j]]
            index = np.minimum(s[None, :] - low + np.arange(int(n.max()))[:, None], high - low - 1)
            out[at : at + CHUNK] = self.forward(gates[index], n)
        return out

    def fit(self, word: np.ndarray, bins: np.ndarray, start: np.ndarray, size: np.ndarray, label: np.ndarray, state: dict, rng: np.random.Generator) -> None:
        """One epoch of Adam over the given windows."""
        p = self.p
        positive = max(1.0, float(label.sum()))
        balance = np.where(label > 0, len(label) / (2 * positive), len(label) / (2 * max(1.0, len(label) - positive)))
        order = rng.permutation(len(start))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            n, y = size[pick], label[pick]
            index = np.minimum(start[pick][None, :] + np.arange(int(n.max()))[:, None], len(word) - 1)
            w, c = np.where(rng.random(index.shape) < HIDE, 0, word[index]), bins[index]
            embedded = np.concatenate([p["word"][w], p["char"][c].sum(axis=2)], axis=2)
            keep: dict = {}
            logit = self.forward(embedded @ p["into"] + p["bias"], n, keep)
            slope = ((_sigmoid(logit) - y) * balance[pick] / len(pick)).astype(np.float32)
            grad, gates = self.backward(slope, keep)
            grad["into"] = np.einsum("tne,tng->eg", embedded, gates)
            grad["bias"] = gates.sum(axis=(0, 1))
            of_embedded = gates @ p["into"].T
            grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(grad["word"], w.ravel(), of_embedded[:, :, :EMBED].reshape(-1, EMBED))
            for j in range(c.shape[2]):
                np.add.at(grad["char"], c[:, :, j].ravel(), of_embedded[:, :, EMBED:].reshape(-1, EMBED))
            grad["word"][0] = 0
            state["t"] = state.get("t", 0) + 1
            for name, g in grad.items():
                m, v = state.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.001) * (g * g - v)
                step = RATE * np.sqrt(1 - 0.999 ** state["t"]) / (1 - 0.9 ** state["t"])
                p[name] -= (step * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
                if name in ("word", "char"):
                    p[name] *= np.float32(1 - RATE * DECAY)


def strongest(logits: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's highest window logit (-inf without windows) and that window."""
    best = np.full(n, -np.inf, np.float32)
    np.maximum.at(best, doc, logits)
    place = np.full(n, -1)
    hit = np.flatnonzero(logits == best[doc])[::-1]
    place[doc[hit]] = hit
    return best, place


def train(texts: list[str], label: np.ndarray) -> Network | None:
    """Fit the network on lower-cased texts; None unless both classes are there."""
    label = np.asarray(label, np.float32)
    if len(label) == 0 or label.min() == label.max():
        return None
    data, offsets = textnum.text_bytes(pa.array(texts, pa.large_string()))
    parts = [word_inputs(part, at) for _, _, part, at in textnum.slices(data, offsets)]
    hashes, bins = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[2]) for x in parts]))])
    del parts, data
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    rng = np.random.default_rng(5)
    check = rng.random(len(texts)) < CHECKED
    values, places = np.unique(hashes, return_inverse=True)
    once = np.unique(doc * np.int64(len(values)) + places)
    once = once[~check[once // len(values)]]
    held = label[once // len(values)] > 0
    toxic = np.bincount(once[held] % len(values), minlength=len(values))
    clean = np.bincount(once[~held] % len(values), minlength=len(values))
    known = np.flatnonzero(toxic + clean > 2)
    # Each word starts with its excess over chance in toxic texts, in deviations: rare words start near nothing.
    chance = (toxic + clean) * label[~check].mean()
    lean = np.clip((toxic - chance) / np.sqrt(chance + 1) / LEAN, -1, 2)
    net = Network(values[known], lean[known])
    word = net.word_ids(hashes)
    start, size, owner = windows(bounds)
    by_word = np.where(word > 0, np.maximum(net.p["word"][word, 0], 0), 0).astype(np.float64)
    total = np.concatenate([[0], np.cumsum(by_word)])
    logits = (total[start + size] - total[start]).astype(np.float32)
    state: dict = {}
    for _ in range(ROUNDS):
        _, place = strongest(logits, owner, len(texts))
        pick = place[(place >= 0) & ~check]
        spare = np.flatnonzero((label[owner] == 0) & ~check[owner])
        pick = np.concatenate([pick, rng.choice(spare, min(len(spare), len(pick)))]) if len(spare) else pick
        for _ in range(EPOCHS):
            net.fit(word, bins, start[pick], size[pick], label[owner[pick]], state, rng)
        logits = net.logits(word, bins, start, size)
    best, _ = strongest(logits, owner, len(texts))
    use = check & np.isfinite(best)
    if len(np.unique(label[use])) < 2:
        use = np.isfinite(best)
    net.shift = _threshold(best[use], label[use])
    return net


def _threshold(best: np.ndarray, label: np.ndarray) -> float:
    """The middle of the cut that gives the highest F score; wrongly flagged texts weigh twice as much as missed ones.

    Few toxic texts say little about the cut, so it never flags more than a few hundredths of the clean ones.
    """
    order = np.argsort(-best)
    hits = np.cumsum(label[order])
    score = 1.25 * hits / (np.arange(1, len(hits) + 1) + 0.25 * label.sum())
    at = int(np.argmax(score))
    following = best[order[at + 1]] if at + 1 < len(order) else best[order[at]] - 1
    clean = best[label == 0]
    least = np.quantile(clean, 1 - FLAGGED) if len(clean) else -np.inf
    return float(max((best[order[at]] + following) / 2, least))


def fit_sample(
    docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int, folds: int, held: int, max_bytes: int
) -> DataFrame:
    """``doc_id, text, toxic``: the rows of ``fit``, in one partition."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold != held))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    texts = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("_n")).select("doc_id")
    known = known.join(texts, "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("toxic") == y).orderBy(*order).limit(n) for y, n in ((1, max_toxic), (0, max_clean))]
    sample = picked[0].union(picked[1])
    rows = common.text_rows(docs).join(F.broadcast(sample), "doc_id").select("doc_id", F.lower("text").alias("text"), "toxic")
    shortest = F.min(F.struct(F.octet_length("text").cast("bigint").alias("n"), "text"))
    single = rows.groupBy("doc_id", "toxic").agg(shortest.alias("r")).select("doc_id", "r.n", "r.text", "toxic")
    # The sample is a bounded number of rows; the running sum bounds the bytes that one Python worker gets of it.
    so_far = F.sum("n").over(Window.orderBy("n", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return single.withColumn("_so_far", so_far).where(F.col("_so_far") <= max_bytes).select("doc_id", "text", "toxic").coalesce(1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    folds: int = 5,
    held: int = 0,
    max_bytes: int = MAX_BYTES,
) -> Network | None:
    """Train on at most ``max_toxic`` and ``max_clean`` labelled documents outside the held-out fold, ``max_bytes`` of text together.

    The rows are those with the smallest hashes of their ids, so a rerun takes the same ones. Of an id with several rows
    the shortest text is taken (ties: the smallest). Should whole texts exceed ``max_bytes``, the longest are left out of
    the fit. Rows without id or label are left out; an id with several labels counts as toxic if one says so. Other
    columns are not read. Returns None (every text scores 0) when no labelled row is left or all have the same label.
    """
    sample = fit_sample(docs, labels, max_toxic, max_clean, folds, held, max_bytes)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((tuple(r.values()) for batch in batches for r in batch.to_pylist()), key=lambda r: r[:2])
        net = train([r[1] for r in found], np.array([r[2] for r in found]))
        if net is not None:
            whole = pickle.dumps((net.known, net.p, net.shift))
            yield pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["net"])

    # One task holds the sample, bounded in rows and bytes; the driver gets the fitted numbers only.
    fitted = sample.mapInArrow(learn, "net binary").first()
    if fitted is None:
        return None
    known, parameters, shift = pickle.loads(fitted["net"])
    net = Network(known, np.zeros(len(known), np.float32))
    net.p, net.shift = parameters, shift
    return net


def score(docs: DataFrame, net: Network | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, columns of ``carry``, ``score`` (0 to 1) of every document row, over all windows of its whole text.

    A text without words, a null text, and every text when there is no network score 0. Rows are scored one by one,
    so repeated rows and ids need no rule.
    """
    rows = docs.select("doc_id", *carry, F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_lower"))
    kept = ["doc_id", *carry]
    kind = rows.select(*kept).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net is not None else None
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            if net is not None:
                data, offsets = textnum.text_bytes(batch.column("_lower"))
                for low, high, part, at in textnum.slices(data, offsets):
                    hashes, bins, bounds = word_inputs(part, at)
                    start, size, doc = windows(bounds)
                    best, _ = strongest(net.logits(net.word_ids(hashes), bins, start, size, tables), doc, high - low)
                    scores[low:high] = 1 / (1 + np.exp(np.clip(net.shift - best.astype(np.float64), -50, 50)))
                    scores[low:high][~np.isfinite(best)] = 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores)], names=[*kept, "score"])

    return rows.mapInArrow(run, kind.add("score", "double"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    net = fit(docs, common.table(spark, sf_dir, "labels"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    return score(docs, net).select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(True)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
