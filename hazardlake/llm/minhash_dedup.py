"""MinHash near-dedup with sequential Bayesian verification of banded candidates.

Equal shingle sets are one class from the start, stood for by its smallest id. Class representatives get band keys
and a separate verification signature. In every bucket the smallest member, its leader, is paired with the others;
pairs pass through signature batches that drop them once the posterior chance of reaching the similarity is below
the miss probability, and survivors are compared on their whole sets. That links nearly all there is to link with as
many pairs as memberships. Buckets where members other than the leader are still in different components are then
compared in blocks, inside tasks of bounded size, skipping what is connected already. Only links leave such a task,
so a bucket of any size makes no square number of rows, and no pair that shares a band is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common, textnum

WORDS = 5
SIMILARITY = (85, 100)
#: Values in a band. ``n_bands`` gives 20 bands for a similarity of 0.85 and 29 for 0.8.
ROWS = 5
#: Lowest similarity served: it takes 363 bands.
LEAST = 0.5
#: Values compared after banding, in batches, and the chance of dropping a pair that reaches the similarity, which
#: holds for the bands and again for the batches.
SIGNATURE, BATCH, MISS = 64, 16, 1e-5
BLOCK = 256


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = textnum.text_bytes(column)
    for _, _, part, at in textnum.slices(data, offsets):
        lowered = textnum.TO_LOWER[part]
        start, end, bounds = textnum.words(lowered, at, textnum.NOT_WHITE)
        runs, cuts = textnum.shingles(textnum.Prefix(lowered).spans(start, end), bounds, words)
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield np.unique(runs[low:high])


def min_values(hashes: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One minimum for each multiplier; long sets are taken in parts."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        np.minimum(least, (multipliers[:, None] * hashes[None, at : at + 4096]).min(axis=1), out=least)
    return least


def n_bands(similarity: float) -> int:
    """Fewest bands that all miss a pair at the similarity with a chance of ``MISS`` at most."""
    if not LEAST <= similarity <= 1:
        raise ValueError(f"similarity {similarity} is not between {LEAST} and 1")
    return 1 if similarity == 1 else math.ceil(math.log(MISS) / math.log1p(-(similarity**ROWS)))


def least_matches(similarity: float, miss: float, signature: int, batch: int) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on): below, P(similarity reached | matches) < miss under a flat prior."""
    found = []
    for n in range(batch, signature + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        found.append((n, m))
    return found


def passes(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature matrices survive all batches; each batch looks at the rows still in."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in steps:
        matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
        alive, done = alive[matches[alive] >= least], n
    kept = np.zeros(len(left), bool)
    kept[alive] = True
    return kept


def signed(docs: DataFrame, words: int, n: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest1``, ``digest2`` (of the set), ``bands`` (``n`` keys), ``signature`` of every row."""
    multipliers = _multipliers(n * ROWS + SIGNATURE)
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest1", pa.int64()), ("digest2", pa.int64())]
        + [("bands", pa.list_(pa.int64())), ("signature", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, bands, signatures = [], [], [], []
            for found in shingle_sets(batch.column("text"), words):
                counts.append(len(found))
                digests.append((textnum.mix(found).sum(), textnum.mix(~found).sum()))
                if len(found) == 0:
                    bands.append(None)
                    signatures.append(None)
                    continue
                least = min_values(found, multipliers)
                rows = least[: n * ROWS].reshape(n, ROWS)
                key = np.zeros(n, np.uint64)
                for j in range(ROWS):
                    key = textnum.mix(key ^ rows[:, j])
                bands.append(key.view(np.int64))
                signatures.append((least[n * ROWS :] >> np.uint64(32)).astype("<u4").tobytes())
            both = np.array(digests, np.uint64).reshape(-1, 2).view(np.int64)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])]
            columns += [pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.record_batch(columns, schema=kind)

    rows = common.text_rows(docs).select("doc_id", "text")
    return rows.mapInArrow(
        run,
        "doc_id bigint, n_shingles bigint, digest1 bigint, digest2 bigint, bands array<bigint>, signature binary",
    )


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``hashes`` for the texts of ``ids``."""
    kind = pa.schema([("doc_id", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.view(np.int64) for x in shingle_sets(batch.column("text"), words)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], schema=kind)

    wanted = common.text_rows(docs).select("doc_id", "text").join(ids, "doc_id", "left_semi")
    return wanted.mapInArrow(run, "doc_id bigint, hashes array<bigint>")


def _surviving(pairs: DataFrame, reps: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs ``a``, ``b`` whose sizes and signature batches allow the similarity."""
    share, whole = similarity
    steps = least_matches(share / whole, MISS, SIGNATURE, BATCH)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                left, right = (
                    np.frombuffer(b"".join(batch[c]), "<u4").reshape(-1, SIGNATURE) for c in ("signature_a", "signature_b")
                )
                yield batch.loc[passes(left, right, steps), ["a", "b"]]

    side = [reps.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"signature_{x}")) for x in "ab"]
    sized = (
        pairs.join(side[0], "a")
        .join(side[1], "b")
        .where(F.least("n_a", "n_b") * whole >= F.greatest("n_a", "n_b") * share)
    )
    return sized.select("a", "b", "signature_a", "signature_b").mapInPandas(run, "a bigint, b bigint")


def _linked(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs that reach the similarity on their whole sets."""
    share, whole = similarity
    left, right = (sets.select(F.col("doc_id").alias(x), F.col("hashes").alias(f"hashes_{x}")) for x in "ab")
    both = F.size(F.array_intersect("hashes_a", "hashes_b")).cast("long")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("both", both)
        .where(F.col("both") * whole >= (F.size("hashes_a") + F.size("hashes_b") - F.col("both")) * share)
        .select("a", "b")
    )


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def _blockwise(docs: DataFrame, reps: DataFrame, members: DataFrame, words: int, similarity: tuple[int, int]) -> DataFrame:
    """Links between members of the same bucket that are in different components.

    ``members``: ``band``, ``key``, ``doc_id``, ``label``, ``n_members``. Members are dealt into blocks by hash and
    each pair of blocks is one group of about ``2 * BLOCK`` rows at most. A pair is compared only in its first
    common band.
    """
    share, whole = similarity
    steps = least_matches(share / whole, MISS, SIGNATURE, BATCH)
    n_blocks = F.ceil(F.col("n_members") / BLOCK).cast("int")
    dealt = (
        members.withColumn("block", F.pmod(F.xxhash64("doc_id", "band"), n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .select("band", "key", "doc_id", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    mixed = (
        dealt.groupBy("band", "key", "low", "high")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least <> most")
        .select("band", "key", "low", "high")
    )
    open_rows = common.stored(dealt.join(mixed, ["band", "key", "low", "high"]), "open-buckets")
    sets = common.stored(_sets(docs, open_rows.select("doc_id").distinct(), words), "open-sets")
    whole_rows = open_rows.join(reps.select("doc_id", "bands", "signature"), "doc_id").join(sets, "doc_id")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        label = group["label"].to_numpy()
        block, ids, band = group["block"].to_numpy(), group["doc_id"].to_numpy(), int(group["band"].iloc[0])
        bands = np.array(group["bands"].tolist(), np.int64).reshape(len(group), -1)
        signature = np.frombuffer(b"".join(group["signature"]), "<u4").reshape(-1, SIGNATURE)
        sets = [np.asarray(x, np.int64) for x in group["hashes"]]
        sizes = np.array([len(x) for x in sets])
        within = group["low"].iloc[0] == group["high"].iloc[0]
        links = []
        values, counts = np.unique(label, return_counts=True)
        common_label = values[counts.argmax()]
        current = label.copy()
        for x in np.flatnonzero(label != common_label):
            other = current != current[x]
            if not within:
                other &= block != block[x]
            other &= np.minimum(sizes, sizes[x]) * whole >= np.maximum(sizes, sizes[x]) * share
            other &= ~(bands[:, :band] == bands[x, :band]).any(axis=1)
            near = np.flatnonzero(other)
            near = near[passes(signature[near], np.broadcast_to(signature[x], (len(near), SIGNATURE)), steps)]
            for y in near:
                if current[y] == current[x]:
                    continue
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if both * whole >= (sizes[x] + sizes[y] - both) * share:
                    links.append((ids[x], ids[y]))
                    current[current == current[y]] = current[x]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return whole_rows.groupBy("band", "key", "low", "high").applyInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, one row per document row.

    Two documents link when the intersection of their sets of ``words``-word shingles (white-space words, A-Z
    lower-cased) is at least ``similarity`` of the union. ``component_id`` is the smallest doc_id reachable, itself
    included. Fewer words than ``words`` make one shingle. Null, empty and blank texts have no shingles and link with
    nothing. Rows that repeat a doc_id are one document with several texts; equal rows share their component. Rows
    without an id link with nothing, have no component and are kept. Other columns are ignored; no rows give none.
    """
    sign = common.stored(signed(docs, words, n_bands(similarity[0] / similarity[1])), "signed")
    full = sign.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = common.stored(
        full.groupBy("digest1", "digest2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_rows")), "classes"
    )
    reps = common.stored(
        full.join(
            classes.select(F.col("rep").alias("doc_id"), "digest1", "digest2"), ["doc_id", "digest1", "digest2"], "left_semi"
        ).dropDuplicates(["doc_id", "digest1", "digest2"]),
        "representatives",
    )
    copies = full.join(classes, ["digest1", "digest2"]).select("doc_id", "rep").where("doc_id <> rep").distinct()
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    buckets = common.stored(
        banded.groupBy("band", "key")
        .agg(F.min("doc_id").alias("leader"), F.count("*").alias("n_members"))
        .where("n_members > 1"),
        "buckets",
    )
    members = common.stored(banded.join(buckets, ["band", "key"]), "members")
    pairs = members.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct()
    survivors = common.stored(_surviving(pairs, reps, similarity), "survivors")
    sets = common.stored(_sets(docs, _ids(survivors), words), "sets")
    links = common.stored(_linked(survivors, sets, similarity), "near-links")
    found = components(links)
    labelled = (
        members.where("n_members > 2 AND doc_id <> leader")
        .join(found, "doc_id", "left")
        .select("band", "key", "n_members", "doc_id", F.coalesce("component", "doc_id").alias("label"))
    )
    unresolved = common.stored(
        labelled.groupBy("band", "key")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least <> most")
        .select("band", "key"),
        "unresolved",
    )
    if not unresolved.isEmpty():
        rest = _blockwise(docs, reps, labelled.join(unresolved, ["band", "key"]), words, similarity)
        links = links.union(common.stored(rest, "block-links"))
    every = components(links.union(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    rows = sign.select("doc_id", "n_shingles")
    component = F.coalesce("component", "doc_id")
    return rows.join(every, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def components(edges: DataFrame) -> DataFrame:
    return common.components(edges).select(F.col("node").alias("doc_id"), "component")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest ON d.doc_id = a LEFT JOIN sizes ON d.doc_id = sizes.doc_id
"""
