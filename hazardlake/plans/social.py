"""The message flow as one declarative plan, and its registered queries."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.constants import ALL_CATEGORIES, SIGNAL_CATEGORIES, VOCABULARY_SIZE
from hazardlake.functions.text import PUNCTUATION_PATTERN, STOP_WORDS, TOKEN_PATTERN, clean
from hazardlake.functions.timefmt import date_parts, iso_millis
from hazardlake.operators import label_blocks, text_model
from hazardlake.operators.text_model import CentroidModel
from hazardlake.plans import oracle as sql
from hazardlake.plans import proxies
from hazardlake.plans.proxies import spread_table, spread_texts, table
from hazardlake.plans.serving import V_MESSAGE
from hazardlake.session import scratch_dir, stored
from hazardlake.sources.sinks import KEEP_NULLS

LANGUAGES = ["de", "en", "es", "fr"]
# The languages stand in for message categories when documents train the classifier.
LANGUAGE_CATEGORY = dict(zip(LANGUAGES, [*SIGNAL_CATEGORIES[:2], *ALL_CATEGORIES[4:6]]))


# ------------------------------------------------------------------ plan stages
def split_errors(messages: DataFrame, text: str = "message") -> tuple[DataFrame, DataFrame]:
    """Messages with text, and error rows ``error, input`` for those without."""
    missing = F.col(text).isNull() | (F.col(text) == "")
    errors = messages.filter(missing).select(
        F.lit("Missing 'text' field").alias("error"), F.to_json(F.struct("*"), KEEP_NULLS).alias("input")
    )
    return messages.filter(~missing), errors


def signals_only(classified: DataFrame, signals: list[str] = SIGNAL_CATEGORIES) -> DataFrame:
    return classified.filter(F.col("category").isin(signals))


def gold_social_columns(signals: DataFrame, time: Column) -> DataFrame:
    """The gold message layout plus date parts; the sink adds ``response_timestamp``."""
    return signals.select(
        "message",
        "category",
        "unique_msg_id",
        iso_millis(time).alias("timestamp"),
        "macroarea_id",
        "microarea_id",
        "latitude",
        "longitude",
        *date_parts(time),
    )


def classify_stage(messages: DataFrame, model: CentroidModel, labels: list[str] | None = None) -> DataFrame:
    """Messages with their best category and its score."""
    scored = model.classify(messages.select("unique_msg_id", "message"), "unique_msg_id", "message", labels)
    return messages.join(scored, "unique_msg_id")


# ------------------------------------------------------------------ registered queries
def _model(spark: SparkSession, documents: DataFrame, labels: list[str]) -> CentroidModel:
    """Fit once, store, and score with the stored tables."""
    path = scratch_dir(spark, "centroids")
    vocabulary_path = os.path.join(path, "vocabulary")
    text_model.vocabulary(documents).write.parquet(vocabulary_path)
    vocab = spark.read.parquet(vocabulary_path)
    return text_model.fit_centroids(documents, "doc_id", labels=labels, vocab=vocab).save(path)


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return spread_texts(spark, sf, table(spark, sf, "documents"), "documents", "doc_id")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("doc_id", "text", F.col("lang").alias("label"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    """All documents and benchmark passages."""
    documents = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item"), "text")
    passages = table(spark, sf, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("item"), "text")
    return spread_texts(spark, sf, documents.unionByName(passages), "documents", "item")


def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    return spread_table(spark, sf, "documents").select("doc_id", clean(F.col("text")).alias("clean_text"))


def ngram_terms(spark: SparkSession, sf: str) -> DataFrame:
    found = text_model.terms(spread_table(spark, sf, "documents").select("doc_id", "text"), F.col("text"))
    return found.select(
        "doc_id",
        F.size("terms").cast("bigint").alias("n_terms"),
        F.size(F.array_distinct("terms")).cast("bigint").alias("n_distinct"),
        F.md5(F.array_join("terms", "|").cast("binary")).alias("terms_md5"),
    )


def vocabulary_terms(spark: SparkSession, sf: str) -> DataFrame:
    return text_model.vocabulary(_texts(spark, sf).select("doc_id", "text")).withColumn(
        "idf", F.round("idf", 8)
    )


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    documents = _texts(spark, sf).select("doc_id", "text")
    vocab = stored(text_model.vocabulary(documents), "vocabulary")  # a broadcast of it waits for no pass over the texts
    counts = text_model.term_counts(documents, ["doc_id"], vocab)
    return text_model.tfidf_vectors(counts, ["doc_id"]).withColumn("weight", F.round("weight", 8))


def centroid_classify(spark: SparkSession, sf: str) -> DataFrame:
    model = _model(spark, _documents(spark, sf), LANGUAGES)
    return model.classify(_items(spark, sf), "item")


def centroid_rank(spark: SparkSession, sf: str) -> DataFrame:
    model = _model(spark, _documents(spark, sf), LANGUAGES)
    ranked = F.col("ranked")
    return model.score(_items(spark, sf), "item").select(
        "item",
        F.array_join(F.transform(ranked, lambda e: e["label"]), ",").alias("labels"),
        *[ranked[i]["score"].alias(f"score_{i + 1}") for i in range(len(LANGUAGES))],
    )


def embedding_centroid(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    blocks = label_blocks.vector_blocks(text_model.vector_centroids(vectors))
    return label_blocks.vector_classify(vectors, blocks, "vec_id")


def centroid_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """All documents and passages by the nearest source and language, a model of several label blocks."""
    documents = _texts(spark, sf).select("doc_id", "text", F.concat("source", F.lit(":"), "lang").alias("label"))
    return label_blocks.fit(documents, "doc_id").classify(_items(spark, sf), "item")


def social_signal_filter(spark: SparkSession, sf: str) -> DataFrame:
    return signals_only(proxies.messages(spark, sf)).select("unique_msg_id", "category")


def gold_social(spark: SparkSession, sf: str) -> DataFrame:
    return gold_social_columns(signals_only(proxies.messages(spark, sf)), F.col("ts"))


def social_error_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of which some lost their text, split into classifier input and error rows."""
    sent = proxies.messages(spark, sf).withColumn(
        "message", F.when(F.col("message").contains("e"), F.col("message")).otherwise(F.lit(""))
    )
    good, errors = split_errors(sent.select("unique_msg_id", "microarea_id", "message"))
    return good.select(F.lit("ok").alias("route"), "unique_msg_id", F.lit(None).cast("string").alias("input")).unionByName(
        errors.select(F.col("error").alias("route"), F.lit(None).cast("string").alias("unique_msg_id"), "input")
    )


def category_model(spark: SparkSession, sf: str) -> CentroidModel:
    """The classifier of message categories, trained on documents."""
    label = F.element_at(F.create_map(*[F.lit(x) for pair in LANGUAGE_CATEGORY.items() for x in pair]), F.col("lang"))
    documents = _texts(spark, sf).select("doc_id", "text", label.alias("label"))
    return _model(spark, documents, list(LANGUAGE_CATEGORY.values()))


def gold_social_classified(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow: train, classify every message, keep signals, gold layout."""
    model = category_model(spark, sf)
    sent = spread_texts(spark, sf, proxies.messages(spark, sf).drop("category"), "conversations", "unique_msg_id")
    good, _ = split_errors(sent)
    return gold_social_columns(signals_only(classify_stage(good, model)), F.col("ts"))


# ------------------------------------------------------------------ oracle SQL
_STOPS = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _terms_sql(name: str, source: str, keys: str, text: str) -> str:
    return f"""{name}_words AS (
  SELECT {keys}, list_filter(regexp_extract_all(lower({text}), '{TOKEN_PATTERN}'), lambda x: x NOT IN ({_STOPS})) AS w FROM {source}
), {name} AS (
  SELECT {keys}, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) AS terms FROM {name}_words
)"""


_CLEAN = f"regexp_replace(lower(text), '{PUNCTUATION_PATTERN}', '', 'g')"
_RAW_TERMS = _terms_sql("raw_terms", "documents", "doc_id", "text")
_VOCAB = f"""vocab AS (
  SELECT *, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE)/(doc_count + 1.0::DOUBLE)) + 1.0::DOUBLE AS idf FROM (
    SELECT term, count(*) AS corpus_count, count(DISTINCT doc_id) AS doc_count
    FROM (SELECT doc_id, unnest(terms) AS term FROM raw_terms) GROUP BY term
    ORDER BY corpus_count DESC, term LIMIT {VOCABULARY_SIZE})
)"""


def _vectors_sql(name: str, source: str, key: str, text: str = _CLEAN) -> str:
    return (
        _terms_sql(f"{name}_terms", source, key, text)
        + f""", {name} AS (
  SELECT {key}, term, tf, raw/sqrt(sum(raw*raw) OVER (PARTITION BY {key})) AS weight FROM (
    SELECT {key}, t.term, tf, tf*idf AS raw
    FROM (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(terms) AS term FROM {name}_terms) GROUP BY ALL) t
    JOIN vocab ON t.term = vocab.term)
)"""
    )


_CENTROIDS = """centroids AS (
  SELECT label, term, s/sqrt(sum(s*s) OVER (PARTITION BY label)) AS w
  FROM (SELECT lang AS label, term, sum(weight) AS s FROM vectors JOIN documents USING (doc_id) GROUP BY ALL)
)"""
_ITEMS = "items AS (SELECT 'd' || doc_id AS item, text FROM documents UNION ALL SELECT 'b' || item_id, text FROM benchmark)"
_SCORES = """scores AS (
  SELECT item, label, coalesce(score, 0.0::DOUBLE) AS score
  FROM (SELECT item, label FROM items, (SELECT DISTINCT lang AS label FROM documents))
  LEFT JOIN (SELECT item, label, round_even(sum(weight*w)*1e8, 0)/1e8 AS score FROM item_vectors JOIN centroids USING (term) GROUP BY ALL)
  USING (item, label)
)"""
_CLASSIFIER = [
    _RAW_TERMS,
    _VOCAB,
    _vectors_sql("vectors", "documents", "doc_id"),
    _CENTROIDS,
]
_MESSAGE_ITEMS = "items AS (SELECT unique_msg_id AS item, message AS text FROM v_message WHERE message <> '')"
_GOLD = f"""SELECT message, category, unique_msg_id, {sql.iso("ts")} AS "timestamp", macroarea_id, microarea_id, latitude, longitude,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day"""
_SIGNALS = ", ".join(f"'{c}'" for c in SIGNAL_CATEGORIES)
_CATEGORY_OF = "CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_CATEGORY.items()) + " END"

QUERIES = {
    "text_clean": (text_clean, f"SELECT doc_id, {_CLEAN} AS clean_text FROM documents"),
    "ngram_terms": (
        ngram_terms,
        sql.with_views(_RAW_TERMS)
        + "SELECT doc_id, len(terms) AS n_terms, len(list_distinct(terms)) AS n_distinct, md5(array_to_string(terms, '|')) AS terms_md5"
        " FROM raw_terms",
    ),
    "vocabulary_terms": (
        vocabulary_terms,
        sql.with_views(_RAW_TERMS, _VOCAB) + "SELECT term, corpus_count, doc_count, round(idf, 8) AS idf FROM vocab",
    ),
    "tfidf_weights": (
        tfidf_weights,
        sql.with_views(_RAW_TERMS, _VOCAB, _vectors_sql("vectors", "documents", "doc_id"))
        + "SELECT doc_id, term, tf, round(weight, 8) AS weight FROM vectors",
    ),
    "centroid_classify": (
        centroid_classify,
        sql.with_views(*_CLASSIFIER, _ITEMS, _vectors_sql("item_vectors", "items", "item"), _SCORES)
        + "SELECT item, label AS category, score FROM (SELECT *, row_number() OVER (PARTITION BY item"
        " ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1",
    ),
    "centroid_rank": (
        centroid_rank,
        sql.with_views(*_CLASSIFIER, _ITEMS, _vectors_sql("item_vectors", "items", "item"), _SCORES)
        + "SELECT item, string_agg(label, ',' ORDER BY rn) AS labels, "
        + ", ".join(f"max(score) FILTER (WHERE rn = {i}) AS score_{i}" for i in range(1, 5))
        + " FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, label) AS rn FROM scores) GROUP BY item",
    ),
    "centroid_blocks": (
        centroid_blocks,
        sql.with_views(*_CLASSIFIER, _ITEMS, _vectors_sql("item_vectors", "items", "item"), _SCORES).replace(
            "SELECT lang AS label, term, sum(weight)", "SELECT source || ':' || lang AS label, term, sum(weight)"
        ).replace("SELECT DISTINCT lang AS label FROM documents", "SELECT DISTINCT source || ':' || lang AS label FROM documents")
        + "SELECT item, label AS category, score FROM (SELECT *, row_number() OVER (PARTITION BY item"
        " ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1",
    ),
    "embedding_centroid": (
        embedding_centroid,
        """WITH parts AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, d, avg(x) AS m FROM parts GROUP BY ALL),
centroids AS (SELECT label, d, m/sqrt(sum(m*m) OVER (PARTITION BY label)) AS c FROM means),
scores AS (SELECT p.vec_id, c.label, round_even(sum(p.x*c.c)/sqrt(sum(p.x*p.x))*1e8, 0)/1e8 AS score
           FROM parts p JOIN centroids c ON p.d = c.d GROUP BY ALL)
SELECT vec_id, label AS category, score
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS rn FROM scores) WHERE rn = 1""",
    ),
    "social_signal_filter": (
        social_signal_filter,
        sql.with_views(V_MESSAGE) + f"SELECT unique_msg_id, category FROM v_message WHERE category IN ({_SIGNALS})",
    ),
    "gold_social": (gold_social, sql.with_views(V_MESSAGE) + f"{_GOLD} FROM v_message WHERE category IN ({_SIGNALS})"),
    "social_error_rows": (
        social_error_rows,
        sql.with_views(V_MESSAGE)
        + """SELECT CASE WHEN contains(message, 'e') THEN 'ok' ELSE 'Missing ''text'' field' END AS route,
  CASE WHEN contains(message, 'e') THEN unique_msg_id END AS unique_msg_id,
  CASE WHEN NOT contains(message, 'e') THEN '{"unique_msg_id":"' || unique_msg_id || '","microarea_id":"' || microarea_id || '","message":""}' END
  AS input FROM v_message""",
    ),
    "gold_social_classified": (
        gold_social_classified,
        sql.with_views(
            V_MESSAGE, *_CLASSIFIER, _MESSAGE_ITEMS, _vectors_sql("item_vectors", "items", "item"), _SCORES,
            f"best AS (SELECT item, {_CATEGORY_OF} AS cat FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, label)"
            " AS rn FROM scores) WHERE rn = 1)",
        )
        + _GOLD.replace("category", "cat AS category")
        + f" FROM v_message JOIN best ON unique_msg_id = item WHERE cat IN ({_SIGNALS})",
    ),
}
