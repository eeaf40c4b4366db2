"""Corpus pipeline: toxicity, line dedup, near-dedup, mixing, BPE, each stage on all that the one before kept.

``STAGES`` lists (name, function); a function takes the session, the documents so far and the folder of tables and
returns documents (the last one token digests). ``run`` writes every stage as Parquet and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import bpe, common, line_dedup, minhash_dedup, mixing, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of five-word shingles from which documents are near duplicates here; operator 7 has its own.
SIMILARITY = (80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below a half. The network learns from labels outside the held-out fold."""
    net = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, net, carry=("text", "lang", "source", "n_chars"))
    return scored.where("score < 0.5").select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one holds too; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs, carry=("lang", "source"))
    text = F.col("kept_text")
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, linked from ``SIMILARITY`` on: that of the smallest doc_id.

    Every row stands for itself: of an id with several texts, only those go that are near a row of a smaller id (null
    is the largest). Rows with the same id and text are one document, blank ones too. No rows give none.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key")
    rows = common.stored(docs.select(*COLUMNS, key, F.monotonically_increasing_id().alias("row")), "numbered")
    found = minhash_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), similarity=SIMILARITY)
    linked = found.select(F.col("doc_id").alias("row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    blank = F.col("group").isNull()
    group = ["group", F.when(blank, F.col("doc_id")).alias("blank_id"), F.when(blank, F.col("text_key")).alias("blank_key")]
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "row"))["row"].alias("row")
    kept = rows.select("row", "doc_id", "text_key").join(linked, "row").groupBy(*group).agg(first).select("row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times)."""
    keyed = docs.select(*COLUMNS, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"))
    copies = mixing.mix(docs).where("copies > 0").select("doc_id", "text_key", "source", "copies").distinct()
    same = common.same_row(keyed, copies, ["doc_id", "text_key", "source"])
    taken = keyed.join(copies, same).select(*(keyed[c] for c in COLUMNS), "copies")
    return taken.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every row."""
    return bpe.round_trip(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Training, verification by hash and balanced sampling have no SQL. The tests hold near-dedup against all pairs; of the
#: other stages they check columns, ids and row counts, and the operators below them have brute-force tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
