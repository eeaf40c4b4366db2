"""Line dedup: lines that several documents share stay only in the first of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common

MIN_CHARS = 10
MIN_DOCS = 2


def _keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line with a key of at least ``min_chars`` code points; the key is 128 bits of hash."""
    key = common.ascii_lower(common.white_strip(F.col("line")))
    return (
        rows.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "text_key", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "text_key", "pos", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(7), "key").alias("k2"))
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``kept_text``, ``n_lines``, ``n_dropped`` and the columns named in ``carry``, one row per document row.

    A line's key is the line without white space at its ends and with A-Z lower-cased. A key of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold loses all its lines but those of the smallest
    doc_id. Null and empty texts are one empty line. Rows that repeat a doc_id are one document for the count and
    each keep their own lines. Rows without an id count as one document that comes last. A text whose lines all go
    is empty. No rows give no rows. Columns not named in ``carry`` are ignored.

    Only hashes travel for the count: it is combined before each exchange, so a line that a third of the documents
    hold is one row per task. The shared keys are stored, and the join back to the lines is a plain shuffled join
    of two exchanges, whose skewed partitions Spark splits. Texts are shuffled once, for reassembly by position.
    """
    rows = common.text_rows(docs)
    lines = _keyed_lines(rows, min_chars)
    shared = common.stored(
        lines.groupBy("k1", "k2")
        .agg(
            (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("long"))).alias("n_docs"),
            F.min("doc_id").alias("first_id"),
        )
        .where((F.col("n_docs") >= min_docs) & F.col("first_id").isNotNull())
        .select("k1", "k2", "first_id"),
        "shared-lines",
    )
    dropped = (
        lines.join(shared, ["k1", "k2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("pos").alias("gone"))
    )
    whole = common.text_rows(docs) if not carry else _with_carried(docs, carry)
    split = F.split("text", "\n", -1)
    kept = F.filter(F.col("split"), lambda line, pos: ~F.array_contains(F.col("gone"), pos))
    return (
        whole.join(dropped, common.same_row(whole, dropped, ["doc_id", "text_key"]), "left")
        .select(whole["doc_id"], *carry, split.alias("split"), "gone", "text")
        .select(
            "doc_id",
            *carry,
            F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
            F.size("split").cast("long").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )


def _with_carried(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"), *carry)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = dedup_lines(common.table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
judged AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.first_id AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
