"""TF-IDF centroid classifier as grouped aggregates and equi-joins on terms.

The only broadcast side is the fitted model, at most ``max_features`` rows by construction. Texts are
tokenised in the scan's tasks and reduced to known terms there. Only (id, term, count) rows travel, and none at all where the
texts come partitioned by their id: every aggregate and window over them takes that partitioning.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.constants import VOCABULARY_SIZE
from hazardlake.functions.numeric import ratio, snap
from hazardlake.functions.text import STOP_WORDS, clean, tokens, with_bigrams

MAX_LABELS = 1000
# Every text carries this term with weight zero, so a text without known terms still gets a row.
NO_TERM = ""


def terms(df: DataFrame, text: Column, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Adds ``terms``: words and bigrams of a text, repeats kept."""
    return df.withColumn("_words", tokens(text, stop_words)).withColumn("terms", with_bigrams(F.col("_words"))).drop(
        "_words"
    )


def term_rows(texts: DataFrame, keep: list[str], text: Column, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """One row per word and per bigram of each text, and one NO_TERM row per text.

    Neighbouring words are paired by position and joined after the explode, inside generated code.
    ``explode_outer`` matters: Spark adds a ``size(array) > 0`` filter below a plain explode of a computed
    array, and that would tokenise every text a second time.
    """
    words = texts.select(*keep, tokens(text, stop_words).alias("_w"))
    shifted = F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1)))
    pairs = words.select(*keep, F.posexplode_outer(F.arrays_zip(F.col("_w").alias("a"), shifted.alias("b"))).alias("_i", "_p"))
    first = F.when(F.coalesce(F.col("_i"), F.lit(0)) == 0, F.lit(NO_TERM))
    pair = F.when(F.col("_p.b").isNotNull(), F.concat_ws(" ", "_p.a", "_p.b"))
    return pairs.select(*keep, F.explode(F.array(F.col("_p.a"), pair, first)).alias("term")).filter("term IS NOT NULL")


def vocabulary(
    texts: DataFrame, text: str = "text", max_features: int = VOCABULARY_SIZE, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``term, corpus_count, doc_count, idf`` of the most frequent terms of the raw (uncleaned) texts.

    One pass and one exchange of map-side combined counts: sorting each text's terms puts repeats side by
    side, so the first of each run counts the document. The look at the term before is taken after the explode,
    inside generated code. The cut is a top-k, ties by term.
    """
    n_docs = texts.agg(F.count(F.lit(1)).alias("n"))
    sorted_terms = terms(texts.select(text), F.col(text), stop_words).select(F.sort_array("terms").alias("s"))
    first = ~F.col("term").eqNullSafe(F.get("s", F.col("i") - 1))
    counts = (
        sorted_terms.select("s", F.posexplode_outer("s").alias("i", "term"))
        .filter("term IS NOT NULL")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("corpus_count"), F.count_if(first).alias("doc_count"))
        .orderBy(F.col("corpus_count").desc(), "term")
        .limit(max_features)
    )
    idf = F.log((n_docs.scalar() + 1.0) / (F.col("doc_count") + 1.0)) + 1.0
    return counts.withColumn("idf", idf)


def term_counts(
    texts: DataFrame, ids: list[str], vocab: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """``ids.., term, idf, tf`` of the cleaned texts' known terms, plus one NO_TERM row per text."""
    known = vocab.select("term", "idf").unionByName(_no_term(vocab.sparkSession))
    rows = term_rows(texts, ids, clean(F.col(text)), stop_words)
    # At most max_features + 1 rows: vocabulary() ends in a limit.
    return rows.join(F.broadcast(known), "term").groupBy(*ids, "term", "idf").agg(F.count(F.lit(1)).alias("tf"))


def _no_term(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(NO_TERM).alias("term"), F.lit(0.0).alias("idf"))


def tfidf_vectors(counts: DataFrame, ids: list[str]) -> DataFrame:
    """L2-normalised TF-IDF weights of each text."""
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(*ids)))
    return counts.select(*ids, "term", "tf", ratio(raw, norm).alias("weight")).filter(F.col("term") != NO_TERM)


@dataclass(frozen=True)
class CentroidModel:
    """``weights`` holds ``term, idf, w_0 .. w_n``: one normalised centroid column per label."""

    weights: DataFrame
    labels: list[str]
    stop_words: Sequence[str] = STOP_WORDS

    def save(self, path: str) -> CentroidModel:
        """Write the model as Parquet and return the stored one."""
        _check_labels(self.labels)
        spark = self.weights.sparkSession
        self.weights.coalesce(1).write.mode("errorifexists").parquet(os.path.join(path, "weights"))
        names = [(i, label) for i, label in enumerate(self.labels)]
        spark.createDataFrame(names, "position int, label string").coalesce(1).write.mode("errorifexists").parquet(
            os.path.join(path, "labels")
        )
        return CentroidModel(spark.read.parquet(os.path.join(path, "weights")), self.labels, self.stop_words)

    @staticmethod
    def load(spark: SparkSession, path: str, stop_words: Sequence[str] = STOP_WORDS) -> CentroidModel:
        rows = spark.read.parquet(os.path.join(path, "labels")).orderBy("position").limit(MAX_LABELS + 1).collect()
        _check_labels(rows)
        weights = spark.read.parquet(os.path.join(path, "weights"))
        return CentroidModel(weights, [row.label for row in rows], stop_words)

    def score(self, texts: DataFrame, key: str, text: str = "text", labels: Sequence[str] | None = None) -> DataFrame:
        """``key, ranked``: candidate labels with cosine scores, best first, ties in label order.

        A text without known terms scores 0 for every label.
        """
        chosen = [i for i, label in enumerate(self.labels) if labels is None or label in labels]
        counts = term_counts(texts, [key], self.weights, text, self.stop_words).drop("idf")
        none = _no_term(self.weights.sparkSession).select("*", *[F.lit(0.0).alias(f"w_{i}") for i in chosen])
        model = self.weights.select("term", "idf", *[f"w_{i}" for i in chosen]).unionByName(none)
        raw = F.col("tf") * F.col("idf")
        sums = (
            counts.join(F.broadcast(model), "term")
            .groupBy(key)
            .agg(
                F.sqrt(F.sum(raw * raw)).alias("_norm"),
                *[F.sum(raw * F.col(f"w_{i}")).alias(f"_s{i}") for i in chosen],
            )
        )
        entries = [
            F.struct(
                (-snap(ratio(F.col(f"_s{i}"), F.col("_norm")))).alias("minus"),
                F.lit(i).alias("position"),
                F.lit(self.labels[i]).alias("label"),
            )
            for i in chosen
        ]
        ranked = F.transform(
            F.sort_array(F.array(*entries)),
            lambda e: F.struct(e["label"].alias("label"), (F.lit(0.0) - e["minus"]).alias("score")),
        )
        return sums.select(key, ranked.alias("ranked"))

    def classify(self, texts: DataFrame, key: str, text: str = "text", labels: Sequence[str] | None = None) -> DataFrame:
        """``key, category, score`` of the best label."""
        best = F.col("ranked")[0]
        return self.score(texts, key, text, labels).select(key, best["label"].alias("category"), best["score"].alias("score"))


def _check_labels(labels: Sequence) -> None:
    """This model has a column per label; above MAX_LABELS it is ``label_blocks.fit``'s work. Labels are never cut."""
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} distinct labels: fit the model with label_blocks.fit")


def training_labels(training: DataFrame, label: str) -> list[str]:
    """The distinct labels, in order. More than MAX_LABELS is an error, never a cut."""
    rows = training.select(label).distinct().limit(MAX_LABELS + 1).collect()
    _check_labels(rows)
    return sorted(row[0] for row in rows if row[0] is not None)


def fit_centroids(
    training: DataFrame,
    key: str,
    label: str = "label",
    text: str = "text",
    labels: Sequence[str] | None = None,
    vocab: DataFrame | None = None,
    max_features: int = VOCABULARY_SIZE,
    stop_words: Sequence[str] = STOP_WORDS,
) -> CentroidModel:
    """Mean TF-IDF vector per label, L2-normalised. Vocabulary from raw texts, vectors from cleaned ones.

    Dividing by the label's text count cancels in the normalisation, so sums are enough.
    """
    names = list(labels) if labels is not None else training_labels(training, label)
    _check_labels(names)
    vocab = vocabulary(training, text, max_features, stop_words) if vocab is None else vocab
    vectors = tfidf_vectors(term_counts(training, [key, label], vocab, text, stop_words), [key, label])
    sums = vectors.groupBy("term").agg(
        *[F.sum(F.when(F.col(label) == name, F.col("weight"))).alias(f"_s{i}") for i, name in enumerate(names)]
    )
    norms = sums.agg(*[F.sqrt(F.sum(F.col(f"_s{i}") ** 2)).alias(f"n{i}") for i in range(len(names))])
    packed = norms.select(F.array(*[F.coalesce(f"n{i}", F.lit(0.0)) for i in range(len(names))]).alias("n"))
    scaled = sums.withColumn("_n", packed.scalar())
    centroids = scaled.select(
        "term",
        *[ratio(F.coalesce(f"_s{i}", F.lit(0.0)), F.col("_n")[i]).alias(f"w_{i}") for i in range(len(names))],
    )
    weights = vocab.select("term", "idf").join(centroids, "term", "left").na.fill(0.0)
    return CentroidModel(weights, names, stop_words)


def vector_centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """``label, centroid``: the normalised mean of each label's dense vectors.

    The means are combined per (label, dimension), so a hot label costs one partial row per task and
    dimension; only the means themselves, one array per label, are gathered.
    """
    means = (
        vectors.select(label, F.posexplode(vector).alias("dim", "x"))
        .groupBy(label, "dim")
        .agg(F.avg(F.col("x").cast("double")).alias("mean"))
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x))
    return (
        means.groupBy(label)
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "mean"))), lambda e: e["mean"]).alias("v"))
        .select(label, F.transform("v", lambda x: ratio(x, norm)).alias("centroid"))
    )
