"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size gives the expected copies of each of its documents. The whole part of that
number is taken at once; the fraction is an inclusion probability. Within blocks of a source, the flight phase moves
these probabilities through the null space of the balancing constraints (documents and tokens), so both totals
stay put while all but two documents of a block become 0 or 1. What is left of all blocks is dealt into new blocks,
until one block a source is left, whose last few documents are landed: of all ways to round them, the nearest one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hazardlake.llm import common

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CAP = 1.5, 2.0
BLOCK = 5000
#: Documents of a source's last block that stay out of the flight, so that the landing has choices. Half of them are
#: the largest ones: others cannot make up for them, so a flight would leave them open to the end.
LANDING = 14
#: More sources than this are joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 100_000


def size_of(text: Column) -> Column:
    """Number of white-space words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """``source``, ``source_size``, ``n_docs``, ``target`` from ``source``, ``size``.

    Sources in code-point order, null last, weigh ``weights`` in turn. They share ``share`` of all sizes by weight,
    none more than ``cap`` times its own size; what that cuts is shared again until nothing is above. Sources that
    reach their cap are those with the smallest cap for their weight, so one running sum over the sources finds the
    level. This table has a row per source; documents were summed before.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = common.constant_array(list(weights), "array<double>")
    per = per.withColumn("weight", F.element_at(listed, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ratio = cap * F.col("source_size") / F.col("weight")
    rising = Window.orderBy("ratio", "weight", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    left = F.least(F.lit(share), F.lit(cap)) * F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("ratio", ratio).withColumn("level", left / rest)
    per = per.withColumn("place", F.row_number().over(rising))
    first_open = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("place", "level"))).over(everything)
    per = per.withColumn("open_level", first_open["level"])
    capped = cap * F.col("source_size")
    return per.select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("open_level").isNull(), capped)
        .otherwise(F.least(capped.cast("double"), F.col("weight") * F.col("open_level")))
        .alias("target"),
    )


def flight(share: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight phase: at most two stay strictly between 0 and 1.

    The constraints are the sums of ``share`` and of ``share * size``. Three open documents at a time have one
    direction that changes neither sum; a random step along it, whose mean is zero, closes at least one of them.
    """
    share = share.astype(float).copy()
    size = size.astype(float)
    draws = rng.random(len(share) + 1).tolist()
    values, sizes = share.tolist(), size.tolist()
    open_rows: list[int] = []
    drawn = 0
    for i, start in enumerate(values):
        if not 0.0 < start < 1.0:
            continue
        open_rows.append(i)
        if len(open_rows) < 3:
            continue
        a, b, c = open_rows
        u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up, down = 1e300, 1e300
        for row, step in zip(open_rows, u, strict=True):
            if step > 0:
                up, down = min(up, (1.0 - values[row]) / step), min(down, values[row] / step)
            elif step < 0:
                up, down = min(up, values[row] / -step), min(down, (1.0 - values[row]) / -step)
        move = up if draws[drawn] * (up + down) < down else -down
        drawn += 1
        for row, step in zip(open_rows, u, strict=True):
            moved = values[row] + move * step
            values[row] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        still = [row for row in open_rows if 0.0 < values[row] < 1.0]
        open_rows = still if len(still) < 3 else still[:2]
        for row in still[2:]:
            values[row] = float(round(values[row]))
    return np.array(values)


def landing(share: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the open documents, ``LANDING`` and two at most, so that tokens and then documents move least."""
    share = share.copy()
    rows = np.flatnonzero((share > 0) & (share < 1))
    choices = np.arange(1 << len(rows))[:, None] >> np.arange(len(rows)) & 1
    off_tokens = np.abs(choices @ size[rows] - (share[rows] * size[rows]).sum())
    off_count = np.abs(choices.sum(axis=1) - share[rows].sum())
    share[rows] = choices[np.lexsort((off_count, off_tokens.round(6)))[0]]
    return share


def _fly(open_rows: DataFrame, n_blocks: Column, level: int, land: bool, seed: int) -> DataFrame:
    """One flight over all blocks; ``open_rows``: ``source``, ``doc_id``, ``text_key``, ``size``, ``share``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text_key"], kind="stable", na_position="last")
        source = group["source"].iloc[0]
        rng = common.digest_rng(seed, level, None if pd.isna(source) else str(source), int(group["block"].iloc[0]))
        order = rng.permutation(len(group))
        if land:
            largest = np.argsort(-group["size"].to_numpy()[order], kind="stable")[: LANDING // 2]
            order = np.append(np.delete(order, largest), order[largest])
        group = group.iloc[order]
        size = group["size"].to_numpy(float)
        share = group["share"].to_numpy(float)
        flying = len(group) - (LANDING if land else 0)
        if flying > 0:
            share = np.append(flight(share[:flying], size[:flying], rng), share[flying:])
        group = group.assign(share=landing(share, size) if land else share)
        return group[["source", "doc_id", "text_key", "size", "share"]]

    kind = "source string, doc_id bigint, text_key bigint, size bigint, share double"
    block = F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "text_key"), n_blocks).cast("int")
    return open_rows.withColumn("block", block).groupBy("source", "block").applyInPandas(run, kind)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block: int = BLOCK,
    seed: int = 0,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` for every document row.

    ``copies`` is how often the mix takes the document, at most ``cap`` rounded up. Null and blank texts have size 0
    and are taken 0 times if their source has no words. Rows without a source form a source of their own, last in
    order. Rows that agree in id, text and source are drawn together and get the same number of copies. The draw
    depends on ids, texts, sizes and ``seed`` alone, so reruns agree. Other columns are ignored; no rows give none.

    Blocks have about ``block`` rows whatever the source's size, so a source with a third of all rows is many groups.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sizes = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("text_key"), size_of(text).alias("size")
    )
    sizes = common.stored(sizes, "sizes")
    aims = common.stored(targets(sizes, weights, share, cap), "targets")
    small = aims.count() <= BROADCAST_SOURCES
    aim = aims.withColumnRenamed("source", "_source")
    rows = sizes.join(F.broadcast(aim) if small else aim, sizes["source"].eqNullSafe(aim["_source"])).drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(expected + 1e-12)
    rows = rows.withColumn("whole", whole).withColumn("share", F.greatest(F.lit(0.0), expected - whole))
    keys = ["doc_id", "text_key", "source"]
    open_rows = (
        rows.where("share > 0")
        .groupBy("source", "doc_id", "text_key", "share")
        .agg(F.sum("size").alias("size"))
        .select("source", "doc_id", "text_key", "size", "share")
    )
    counts = aims.select(F.col("source").alias("_source"), F.col("n_docs").alias("n_open"))
    closed, level = [], 0
    while True:
        sized = open_rows.join(F.broadcast(counts) if small else counts, F.col("source").eqNullSafe(F.col("_source")))
        n_blocks = F.ceil(F.col("n_open") / block)
        most = counts.agg(F.max("n_open")).first()[0] or 0
        last = most <= block
        flown = common.stored(_fly(sized.drop("_source"), n_blocks, level, last, seed), f"flight-{level}")
        closed.append(flown.where("share = 1").select(*keys))
        if last:
            break
        open_rows = flown.where("share > 0 AND share < 1")
        counts = open_rows.groupBy(F.col("source").alias("_source")).agg(F.count("*").alias("n_open"))
        counts = common.stored(counts, "open-counts")
        level += 1
    taken = closed[0]
    for part in closed[1:]:
        taken = taken.union(part)
    taken = taken.withColumn("extra", F.lit(1))
    return rows.join(taken, common.same_row(rows, taken, keys), "left").select(
        *(rows[c] for c in ("doc_id", "text_key", "source", "size", "source_size", "target")),
        (F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int").alias("copies"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source"
    )
