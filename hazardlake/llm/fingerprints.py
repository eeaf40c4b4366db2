"""Document fingerprints: bottom-k sketches of word shingle hashes, as column expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.llm import common

WORDS = 5
K = 128


def shingle_hashes(df: DataFrame, text_col: str, out_col: str, words: int = WORDS) -> DataFrame:
    """Add ``out_col``: the distinct 64-bit hashes of a text's word shingles.

    Words are runs without white space, A-Z lower-cased. A text of fewer than ``words`` words is one shingle; one
    without words, or null, has none.
    """
    text = common.white_strip(common.ascii_lower(F.coalesce(F.col(text_col), F.lit(""))))
    listed = F.split(F.col("_stripped"), common.WHITE_RUN)
    n = F.size("_words")
    spans = F.transform(
        F.sequence(F.lit(1), n - (words - 1)),
        lambda i: F.xxhash64(*(F.element_at("_words", i + j) for j in range(words))),
    )
    short = F.array(F.xxhash64(F.col("_words")))
    return (
        df.withColumn("_stripped", text)
        .withColumn("_words", F.transform(listed, lambda w: F.xxhash64(w)))
        .withColumn(
            out_col,
            F.when(F.col("_stripped") == "", F.array().cast("array<bigint>"))
            .when(n < words, short)
            .otherwise(F.array_distinct(spans)),
        )
        .drop("_stripped", "_words")
    )


def bottom_k(hashes: Column, k: int = K) -> Column:
    """The sketch of a set of hashes: its ``k`` smallest, ascending."""
    return F.slice(F.sort_array(hashes), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return bottom_k(F.array_union(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold. Two empty sets are alike (1)."""
    both = merge(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def shingle_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    largest = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second holds; 1 for an empty first set."""
    size = shingle_count(a, k)
    shared = resemblance(a, b, k) * shingle_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / size))


def encoded(sketch: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprints(docs: DataFrame, words: int = WORDS, k: int = K) -> DataFrame:
    """``doc_id``, ``text``, ``text_key``, ``sketch``, ``n_shingles_estimate`` for every document row.

    Null texts count as empty and have an empty sketch. Rows are independent, so repeated ids and ties need no rule;
    other columns are ignored.
    """
    rows = shingle_hashes(common.text_rows(docs), "text", "_hashes", words)
    rows = rows.withColumn("sketch", bottom_k(F.col("_hashes"), k)).drop("_hashes")
    return rows.withColumn("n_shingles_estimate", shingle_count(F.col("sketch"), k))


def with_next(rows: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Add ``next``: a struct of ``columns`` of the row that follows by ``doc_id``, ``text_key``; the first follows the last.

    Rows are dealt over id ranges whose bounds are ids of the table (approximate quantiles, at most ``buckets``
    numbers on the driver). Each bound's rows also go to the range before, and those of the smallest id to the last
    range, so one exchange and a window per range find every successor, whatever the ids' distribution. Rows without
    an id have no successor (null) and are dealt by their text.
    """
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(
        F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, 20 * buckets).alias("cuts")
    ).first()
    if found is None or found["least"] is None:
        kinds = rows.select(F.struct(*columns).alias("next")).schema["next"].dataType
        return rows.withColumn("next", F.lit(None).cast(kinds))
    bounds = sorted({found["least"], *(found["cuts"] or [])})
    step = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = common.constant_array([b[0] for b in blocks], "array<bigint>")
    fine = common.constant_array(blocks, "array<array<bigint>>")
    doc_id = F.col("doc_id")
    dealt = (
        rows.withColumn("_block", F.size(F.filter(coarse, lambda x: x <= doc_id)))
        .withColumn("_bounds", F.when(doc_id.isNotNull(), F.element_at(fine, F.col("_block"))))
        .withColumn("_own", (F.col("_block") - 1) * step + F.size(F.filter("_bounds", lambda x: x <= doc_id)))
        .withColumn("_before", F.when(doc_id == bounds[0], F.lit(len(bounds))).otherwise(F.col("_own") - 1))
        .withColumn(
            "_range",
            F.when(doc_id.isNull(), F.array(-1 - F.pmod("text_key", F.lit(buckets)).cast("int")))
            .when(F.array_contains("_bounds", doc_id), F.array("_own", "_before"))
            .otherwise(F.array("_own")),
        )
        .select(*rows.columns, F.posexplode("_range").alias("_copy", "_range"))
    )
    order = Window.partitionBy("_range").orderBy("_copy", "doc_id", "text_key")
    following = F.when(doc_id.isNotNull(), F.lead(F.struct(*columns)).over(order))
    return dealt.withColumn("next", following).where("_copy = 0").drop("_copy", "_range")


def edited_fingerprints(docs: DataFrame, words: int = WORDS, k: int = K, buckets: int | None = None) -> DataFrame:
    """Sketches of every text and of its edited text, whose second half comes from the start of the next document.

    The last floor(n / 2) code points are replaced by as many from the next document's start, or all of them. A row
    without an id has no next document, so its second half goes. A single document is its own next one. Columns:
    ``doc_id``, ``text``, ``edited_text``, ``sketch``, ``edited_sketch``, ``next_sketch``.
    """
    buckets = buckets or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(fingerprints(docs, words, k), ["text", "sketch"], buckets)
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    following = F.coalesce(F.col("next.text"), F.lit(""))
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(following, F.lit(1), half))
    rows = rows.select(
        "doc_id",
        "text",
        "sketch",
        edited.alias("edited_text"),
        F.coalesce(F.col("next.sketch"), F.array().cast("array<bigint>")).alias("next_sketch"),
    )
    rows = shingle_hashes(rows, "edited_text", "_hashes", words)
    return rows.withColumn("edited_sketch", bottom_k(F.col("_hashes"), k)).drop("_hashes")


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_fingerprints(common.table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        encoded(F.col("sketch")).alias("fingerprint"),
        encoded(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        shingle_count(F.col("sketch")).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )
