"""Helpers shared by the operators of this subpackage.

A document row is identified by its id together with a hash of its text, compared null-safe, so that null and
repeated ids are legal: repeated identical rows get the same result, each of them once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` is far faster and equal where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def white_strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``text_key``, a hash of the text; every other column stays out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def same_row(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: lineage ends here, any executor can read it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def constant_array(values: list, kind: str) -> Column:
    """A constant array of any length as one expression."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _forest(pairs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over one partition of edges: every node with the smallest id of its part."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in pairs:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for at in range(0, len(nodes), 100_000):
        part = nodes[at : at + 100_000]
        yield pd.DataFrame({"node": part, "top": [root(x) for x in part]}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for undirected edges ``a``, ``b`` of bigint.

    Each partition of edges is reduced to a star forest first. Nodes that came out under several tops link these
    tops; the same is done to those links until no node has two. Links shrink each time, since every link names a
    top that is not smallest, and nothing but a row count reaches the driver.
    """
    stars = stored(edges.select("a", "b").mapInPandas(_forest, "node bigint, top bigint"), "stars")
    least = stars.groupBy("node").agg(F.min("top").alias("least"))
    links = stored(
        stars.join(least, "node").where("top <> least").select(F.col("least").alias("a"), F.col("top").alias("b")).distinct(),
        "links",
    )
    if links.isEmpty():
        return least.withColumnRenamed("least", "component")
    upper = components(links).select(F.col("node").alias("least"), F.col("component").alias("upper"))
    return stored(
        least.join(upper, "least", "left").select("node", F.coalesce("upper", "least").alias("component")), "components"
    )


def digest_rng(*parts: object) -> np.random.Generator:
    """A generator that depends on its arguments alone."""
    import zlib

    return np.random.default_rng(zlib.crc32(repr(parts).encode()))
