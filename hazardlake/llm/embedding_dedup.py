"""Embedding near-dedup with randomly rotated binary codes and stored correction factors.

A unit vector is rotated at random and its signs are stored as bits, with the factor <code, rotated vector>. For
another unit vector q, <code, rotated q> / factor is an unbiased estimate of their inner product c. Its error is
sqrt(1 - c^2) * sqrt(1 - factor^2) / factor times a projection of q's remainder on a random direction, which has mean 0
and standard deviation 1 / sqrt(d - 1) and is never above 1. So a pair can only reach the threshold when its estimate
is within that bound below it; those pairs alone are computed again in double precision.

Vectors of one label and length are dealt into blocks, and each pair of blocks is one task of bounded size. A task
returns link counts and a star forest, as many rows as vectors, however many pairs link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common

THRESHOLD = 0.93
BLOCK = 2048
#: Standard deviations of the confidence bound; 6 leave a pair out with a chance of about 1e-9.
DEVIATIONS = 6.0
ROWS_AT_ONCE, PAIRS_AT_ONCE = 256, 1 << 15
SALTS = 64


def rotation(d: int) -> np.ndarray:
    """A fixed random rotation of ``d`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits (packed), correction factors and rotated vectors of unit rows."""
    rotated = unit @ turn.T
    return np.packbits(rotated >= 0, axis=1), np.abs(rotated).sum(axis=1) / math.sqrt(unit.shape[1]), rotated


def margins(factor: np.ndarray, d: int, threshold: float, deviations: float) -> np.ndarray:
    """Lowest estimate at which a pair can still reach the threshold."""
    spread = min(1.0, deviations / math.sqrt(max(d - 1, 1)))
    return threshold - spread * math.sqrt(1 - threshold**2) * np.sqrt(np.maximum(0, 1 - factor**2)) / factor - 1e-4


def linked(
    left: np.ndarray, bits: np.ndarray, factor: np.ndarray, right: np.ndarray, rotated: np.ndarray, threshold: float, deviations: float
) -> np.ndarray:
    """Which of ``left`` x ``right`` (unit rows) reach the threshold."""
    d = left.shape[1]
    signs = (np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1) / np.float32(math.sqrt(d))
    least = margins(factor, d, threshold, deviations)
    found = np.zeros((len(left), len(right)), bool)
    rotated = rotated.astype(np.float32).T
    for at in range(0, len(left), ROWS_AT_ONCE):
        rows = slice(at, at + ROWS_AT_ONCE)
        i, j = np.nonzero((signs[rows] @ rotated) / factor[rows, None] >= least[rows, None])
        for first in range(0, len(i), PAIRS_AT_ONCE):
            a, b = at + i[first : first + PAIRS_AT_ONCE], j[first : first + PAIRS_AT_ONCE]
            close = np.einsum("nd,nd->n", left[a], right[b]) >= threshold
            found[a[close], b[close]] = True
    return found


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, deviations: float = DEVIATIONS, block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``, one row per row of ``vectors`` (vec_id, embedding, label).

    Vectors of the same label and length whose cosine is at least ``threshold`` link. ``n_links`` counts the other
    rows linked directly; ``component_id`` is the smallest vec_id reachable. Vectors that are null, zero, or hold
    null or non-finite components, and rows without a label, link with nothing; rows without an id do neither, have
    no component and are kept. Equal vectors, repeated rows too, link with each other: they are one class from the
    start, and a class is a node of its own, so an id that repeats with other vectors or labels counts each row's own
    links. Other columns are ignored; no rows give none.
    """
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), value.alias("embedding"))
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moving = F.exists("embedding", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound & moving, F.lit(False))
    rows = rows.withColumn("usable", usable)
    digest = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2")]
    keyed = rows.where("usable").select("vec_id", "label", *digest, "embedding")
    classes = common.stored(
        keyed.groupBy("label", "h1", "h2").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("n_rows"), F.first("embedding").alias("embedding")
        ).withColumn("node", F.monotonically_increasing_id()),
        "vector-classes",
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["embedding"].map(len)
            for d, part in batch.groupby(sizes):
                x = np.array(part["embedding"].tolist(), np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                bits, factor, _ = codes(x, rotation(int(d)))
                yield pd.DataFrame(
                    {"node": part["node"], "label": part["label"], "n_rows": part["n_rows"], "d": int(d)}
                    | {"unit": [r.tobytes() for r in x], "code": [r.tobytes() for r in bits], "factor": factor}
                )

    kind = "node bigint, label string, n_rows bigint, d int, unit binary, code binary, factor double"
    coded = common.stored(classes.select("node", "label", "n_rows", "embedding").mapInPandas(encode, kind), "codes")
    sizes = common.stored(coded.groupBy("label", "d").agg(F.ceil(F.count("*") / block).cast("int").alias("n_blocks")), "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    dealt = (
        coded.join(sizes, ["label", "d"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("other", "n_blocks")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        d, low, high = (int(group[c].iloc[0]) for c in ("d", "low", "high"))
        turn = rotation(d)
        sides = []
        for part in [group[group["own"] == low]] + ([group[group["own"] == high]] if high != low else []):
            unit = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(-1, d)
            bits = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1)
            sides.append((part["node"].to_numpy(), part["n_rows"].to_numpy(), unit, bits, part["factor"].to_numpy()))
        (ids, weight, unit, bits, factor), (ids2, weight2, unit2, _, _) = sides[0], sides[-1]
        if len(ids) == 0 or len(ids2) == 0:
            return pd.DataFrame({"node": [], "n_links": [], "top": []}, dtype="int64")
        met = linked(unit, bits, factor, unit2, unit2 @ turn.T, threshold, deviations)
        if low == high:
            met = np.triu(met, 1)
            met |= met.T
        top, top2 = ids.copy(), ids2.copy()
        far = np.iinfo(np.int64).max
        while True:
            new = np.minimum(top, np.where(met, top2[None, :], far).min(axis=1))
            new2 = np.minimum(top2, np.where(met, new[:, None], far).min(axis=0))
            if (new == top).all() and (new2 == top2).all():
                break
            top, top2 = new, new2
        found = [pd.DataFrame({"node": ids, "n_links": met @ weight2, "top": top})]
        if low != high:
            found.append(pd.DataFrame({"node": ids2, "n_links": weight @ met, "top": top2}))
        out = pd.concat(found)
        return out[(out["n_links"] > 0) | (out["top"] != out["node"])]

    met = common.stored(
        dealt.groupBy("label", "d", "low", "high").applyInPandas(compare, "node bigint, n_links bigint, top bigint"), "vector-links"
    )
    counts = met.groupBy("node").agg(F.sum("n_links").alias("met"))
    joined = common.components(met.where("node <> top").select(F.col("node").alias("a"), F.col("top").alias("b")))
    smallest = joined.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    # A component may hold a third of all classes, so its rows meet its one row in several places.
    spread = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = joined.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    joined = joined.join(spread, ["component", "salt"]).select("node", "least")
    named = (
        classes.select("label", "h1", "h2", "node", "rep", "n_rows")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            "label", "h1", "h2",
            (F.coalesce("met", F.lit(0)) + F.col("n_rows") - 1).alias("n_links"),
            F.coalesce("least", "rep").alias("component_id"),
        )
    )
    linked_rows = keyed.select("vec_id", "label", "h1", "h2").join(common.stored(named, "vector-components"), ["label", "h1", "h2"])
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        linked_rows.select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(common.table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93
),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN lowest ON vec_id = lowest.a LEFT JOIN degree ON vec_id = degree.a
"""
