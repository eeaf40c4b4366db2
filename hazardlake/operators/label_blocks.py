"""Centroid classifiers for any number of labels.

Labels are numbered in their order and cut into blocks of ``WIDTH``. A block of a model is as wide as its block and no
wider, so plans keep their size however many labels there are, and no row, task or driver holds the whole model. A text
meets every block its terms occur in; a block gives its best label, and the best of the blocks is the answer. Ties go to
the first label, as in ``text_model``.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import VOCABULARY_SIZE
from hazardlake.functions.numeric import ratio, snap
from hazardlake.functions.text import STOP_WORDS
from hazardlake.operators import ranks
from hazardlake.operators.text_model import NO_TERM, term_counts, tfidf_vectors, vocabulary
from hazardlake.session import stored

#: Labels of a block, and so columns of a block of texts' weights.
WIDTH = 64
#: Centroids of at most this many bytes are broadcast. Beyond, vectors are sent to the blocks, and each block is copied
#: ``SPREAD`` times so that its vectors do not gather in one task.
BROADCAST_BYTES = 8 << 20
SPREAD = 64


def _block(width: int) -> Column:
    return F.floor(F.col("position") / width).cast("int")


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``label, position``: the distinct labels that are not null, numbered in their order."""
    return ranks.positions(rows.select(F.col(label).alias("label")).filter("label IS NOT NULL").distinct(), ["label"])


# ------------------------------------------------------------------ texts
@dataclass(frozen=True)
class BlockModel:
    """``weights``: ``block, term, w_0 .. w_k`` for the terms a block's labels hold; ``vocab``: ``term, idf``; ``labels``: ``label, position``."""

    weights: DataFrame
    vocab: DataFrame
    labels: DataFrame
    stop_words: Sequence[str] = STOP_WORDS

    def save(self, path: str) -> BlockModel:
        """Write the model as Parquet and return the stored one."""
        for name in ("weights", "vocab", "labels"):
            getattr(self, name).write.mode("errorifexists").parquet(os.path.join(path, name))
        return BlockModel.load(self.weights.sparkSession, path, self.stop_words)

    @staticmethod
    def load(spark: SparkSession, path: str, stop_words: Sequence[str] = STOP_WORDS) -> BlockModel:
        return BlockModel(*(spark.read.parquet(os.path.join(path, name)) for name in ("weights", "vocab", "labels")), stop_words)

    def classify(self, texts: DataFrame, key: str, text: str = "text", labels: Sequence[str] | None = None) -> DataFrame:
        """``key, category, score`` of the best label, for one text a key.

        A text without known terms scores 0 and goes to the first label, as does one that no label's terms meet. With
        ``labels`` only those are candidates. Without any label the category is null and the score 0.
        """
        width = len(self.weights.columns) - 2
        counts = term_counts(texts, [key], self.vocab, text, self.stop_words)
        raw = F.col("tf") * F.col("idf")
        norms = counts.groupBy(key).agg(F.sqrt(F.sum(raw * raw)).alias("_norm"))
        known = counts.filter(F.col("term") != NO_TERM).select(key, "term", raw.alias("_raw"))
        sums = known.join(self.weights, "term").groupBy(key, "block").agg(*[F.sum(F.col("_raw") * F.col(f"w_{i}")).alias(f"_s{i}") for i in range(width)])
        chosen = self.labels if labels is None else self.labels.filter(F.col("label").isin(list(labels)))
        entries = F.array(*[F.struct((-F.col(f"_s{i}")).alias("minus"), (F.col("block") * width + i).alias("position")) for i in range(width)])
        if labels is None:
            each = sums.select(key, "block", entries.alias("e"))
        else:
            open_ = chosen.groupBy(_block(width).alias("block")).agg(F.collect_list("position").alias("_open"))  # at most ``width``
            each = sums.join(open_, "block").select(key, "block", F.filter(entries, lambda e: F.array_contains("_open", e["position"])).alias("e"))
        # Scores are cut to their printed digits before they are compared, so equal ones tie whatever the order of their sums.
        scored = each.join(norms, key).select(
            key, F.transform("e", lambda e: F.struct((-snap(ratio(-e["minus"], F.col("_norm")))).alias("minus"), e["position"].alias("position"))).alias("e")
        )
        met = scored.select(key, F.array_min("e").alias("b")).groupBy(key).agg(F.min("b").alias("b")).filter("b.minus < 0")
        first = chosen.agg(F.min("position").alias("p"))
        best = norms.select(key).join(met, key, "left").select(
            key, F.coalesce("b.position", first.scalar()).alias("position"), F.coalesce(F.lit(0.0) - F.col("b.minus"), F.lit(0.0)).alias("score")
        )
        return best.join(self.labels, "position", "left").select(key, F.col("label").alias("category"), "score")


def fit(
    training: DataFrame,
    key: str,
    label: str = "label",
    text: str = "text",
    vocab: DataFrame | None = None,
    max_features: int = VOCABULARY_SIZE,
    stop_words: Sequence[str] = STOP_WORDS,
    width: int = WIDTH,
) -> BlockModel:
    """Mean TF-IDF vector per label, L2-normalised, of any number of labels.

    Texts without a label count for the vocabulary only. The sums per label and term are combined before they travel;
    the model is written once, in blocks.
    """
    vocab = vocabulary(training, text, max_features, stop_words) if vocab is None else vocab
    vocab = stored(vocab.select("term", "idf"), "vocabulary")
    labels = numbered(training, label)
    vectors = tfidf_vectors(term_counts(training, [key, label], vocab, text, stop_words), [key, label])
    sums = stored(
        vectors.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label"), "term").agg(F.sum("weight").alias("_sum")).filter("_sum <> 0"), "sums"
    )
    norms = sums.groupBy("label").agg(F.sqrt(F.sum(F.col("_sum") ** 2)).alias("_norm")).join(labels, "label")
    long = sums.join(norms, "label").select(_block(width).alias("block"), F.pmod("position", F.lit(width)).alias("place"), "term", ratio(F.col("_sum"), F.col("_norm")).alias("w"))
    wide = [F.coalesce(F.sum(F.when(F.col("place") == i, F.col("w"))), F.lit(0.0)).alias(f"w_{i}") for i in range(width)]
    return BlockModel(stored(long.groupBy("block", "term").agg(*wide), "weights"), vocab, labels, stop_words)


# ------------------------------------------------------------------ dense vectors
def vector_blocks(centroids: DataFrame, label: str = "label", width: int = WIDTH) -> DataFrame:
    """``block, entries``: the centroids of ``text_model.vector_centroids`` in stored blocks of ``width`` labels.

    A label that is null is a label like others and comes first.
    """
    rows = ranks.positions(centroids.select(F.col(label).alias("label"), "centroid"), ["label"])
    entries = F.sort_array(F.collect_list(F.struct("position", "label", "centroid"))).alias("entries")
    return stored(rows.groupBy(_block(width).alias("block")).agg(entries), "blocks")


def vector_classify(
    vectors: DataFrame, blocks: DataFrame, key: str, vector: str = "embedding", spread: int = SPREAD, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``key, category, score`` of every vector by cosine to the centroids in ``vector_blocks``, ties to the lowest label.

    One row per row of ``vectors``, repeated ones too; a null vector scores 0; without centroids there is no row. The
    measured size of the blocks chooses the join, not the result: vectors stay where they are or go to each block once.
    """
    numbers = F.aggregate("entries", F.lit(0).cast("bigint"), lambda n, e: n + F.coalesce(F.size(e["centroid"]), F.lit(0)))
    n_blocks, n_numbers = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(numbers), F.lit(0))).first()
    x = F.transform(vector, lambda v: v.cast("double"))
    rows = vectors.select(key, F.xxhash64(vector).alias("_hash"), x.alias("_x"))
    sent = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))) if n_blocks else rows.withColumn("block", F.lit(0)).limit(0)
    if 8 * n_numbers <= broadcast_bytes:
        met = sent.join(F.broadcast(blocks), "block")
    else:
        salted = sent.withColumn("_salt", F.pmod(F.xxhash64(key, "_hash"), F.lit(spread)).cast("int"))
        met = salted.join(blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).hint("merge"), ["block", "_salt"])
    norm = F.sqrt(F.aggregate("_x", F.lit(0.0), lambda acc, v: acc + v * v))
    scores = F.transform(
        "entries",
        lambda e: F.struct(
            F.aggregate(F.zip_with("_x", e["centroid"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v).alias("dot"),
            e["position"].alias("position"),
            e["label"].alias("label"),
        ),
    )
    dots = met.select(key, "_hash", norm.alias("_norm"), scores.alias("_dots"))
    minus = F.transform(
        "_dots", lambda d: F.struct((-snap(ratio(d["dot"], F.col("_norm")))).alias("minus"), d["position"].alias("position"), d["label"].alias("label"))
    )
    best = dots.select(key, "_hash", F.array_min(minus).alias("b")).groupBy(key, "_hash").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n"))
    repeated = best.withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("n") / max(n_blocks, 1)).cast("int"))))
    return repeated.select(key, F.col("b.label").alias("category"), (F.lit(0.0) - F.col("b.minus")).alias("score"))
