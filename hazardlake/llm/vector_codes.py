"""Vector code compression: product codes whose distances come from a lexicographic trie over distinct parts.

A vector of whole numbers is cut into parts, and every part position has a codebook of up to 16 entries. The distinct
parts of a position, in lexicographic order, are the leaves of a trie whose node at depth j is a prefix of j + 1
components. A node's distances to all entries are its parent's plus one squared difference each, so parts with a common
prefix share all that was added up along it. The traversal is depth-first in runs of leaves: within a run, the nodes of
one depth are one numpy step, and the next run starts from the root, so memory is bounded by a run. At a leaf, the
nearest entry is taken and the part, weighted by how often it occurs, is added to that entry's sums.

Distinct parts are counted once (combined in each task before the shuffle), range-partitioned and sorted, so that
neighbours share long prefixes; each round is one pass over them, and only codebook-sized sums reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import common, vectors

SCALE = 4096.0
#: Scaled components are held within this (entries of about 32,768), so that squared distances stay exact.
LIMIT = 1 << 27
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Leaves of the trie walked at once.
RUN = 8192


def part_bounds(d: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts; equal where ``parts`` divides ``d``, else their lengths differ by at most one."""
    return [(d * p // parts, d * (p + 1) // parts) for p in range(parts)]


def walk(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lower index) and squared distance of every leaf, for leaves in lexicographic order."""
    n, m = leaves.shape
    nearest, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for at in range(0, n if m else 0, RUN):
        run = leaves[at : at + RUN]
        changed = np.ones(run.shape, bool)
        changed[1:] = run[1:] != run[:-1]
        fresh = np.logical_or.accumulate(changed, axis=1)  # is the row's prefix of j + 1 components a new node?
        above = np.zeros((1, len(entries)), np.int64)
        parent = np.zeros(len(run), np.int64)
        for j in range(m):
            first = np.flatnonzero(fresh[:, j])
            above = above[parent[first]] + np.square(run[first, j, None] - entries[None, :, j])
            parent = np.cumsum(fresh[:, j]) - 1
        best = above.argmin(axis=1)
        nearest[at : at + RUN] = best[parent]
        distance[at : at + RUN] = above[np.arange(len(best)), best][parent]
    return nearest, distance


def sorted_rows(parts: np.ndarray) -> np.ndarray:
    return np.lexsort(parts.T[::-1]) if parts.shape[1] else np.arange(len(parts))


def distinct_parts(rows: DataFrame, d: int, parts: int = PARTS) -> DataFrame:
    """``pos``, ``part`` (binary), ``n``: every distinct part with its number of rows, sorted within its partition."""
    bounds = part_bounds(d, parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(batch.column("x"), d)
            for pos, (low, high) in enumerate(bounds):
                if low == high or len(x) == 0:
                    continue
                part = x[:, low:high]
                part = part[sorted_rows(part)]
                first = np.flatnonzero(np.append(True, (part[1:] != part[:-1]).any(axis=1)))
                times = np.diff(np.append(first, len(part)))
                packed = vectors.packed(part[first].ravel(), np.full(len(first), high - low))
                columns = [pa.array(np.full(len(first), pos, np.int32)), packed, pa.array(times)]
                yield pa.RecordBatch.from_arrays(columns, names=["pos", "part", "n"])

    found = rows.select("x").mapInArrow(count, "pos int, part binary, n bigint")
    counted = found.groupBy("pos", "part").agg(F.sum("n").alias("n"))
    return common.stored(counted.repartitionByRange("pos", "part").sortWithinPartitions("pos", "part"), "parts")


def first_entries(rows: DataFrame, d: int, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors of the smallest ids: a bounded number of vectors reaches the driver."""
    order = F.col("vec_id").asc_nulls_last()
    ids = [r["vec_id"] for r in rows.select("vec_id").distinct().orderBy(order).limit(entries).collect()]
    own = F.col("vec_id").isin([i for i in ids if i is not None]) | (F.col("vec_id").isNull() & F.lit(None in ids))
    smallest = rows.where(own).groupBy("vec_id").agg(F.min("x").alias("x")).orderBy(order)
    found = vectors.matrix(pa.array([bytes(r["x"]) for r in smallest.collect()], pa.binary()), d)
    return [found[:, low:high].copy() for low, high in part_bounds(d, parts)]


def refine(counted: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: each distinct part to its nearest entry, each entry to the floor of its parts' mean."""
    k = len(books[0])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((k, book.shape[1] + 1), np.int64) for book in books]
        for batch in batches:
            pos = batch.column("pos").to_numpy()
            times = batch.column("n").to_numpy()
            for p in np.unique(pos):
                own = np.flatnonzero(pos == p)
                part = vectors.matrix(batch.column("part").take(pa.array(own)), books[p].shape[1])
                nearest, _ = walk(part, books[p])
                weight = times[own]
                np.add.at(sums[p], nearest, np.column_stack([part * weight[:, None], weight]))
        for p, total in enumerate(sums):
            entry, place = np.nonzero(total)
            columns = [np.full(len(entry), p), entry, place, total[entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pos", "entry", "place", "value"])

    cells = counted.mapInArrow(share, "pos bigint, entry bigint, place bigint, value bigint")
    total = [np.zeros((k, book.shape[1] + 1), np.int64) for book in books]
    for r in cells.groupBy("pos", "entry", "place").agg(F.sum("value").alias("value")).collect():
        total[r["pos"]][r["entry"], r["place"]] = r["value"]
    for book, found in zip(books, total, strict=True):
        used = found[:, -1] > 0
        book[used] = found[used, :-1] // found[used, -1:]  # rounds down
    return books


def encode(rows: DataFrame, d: int, books: list[np.ndarray]) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` of every row."""
    bounds = part_bounds(d, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(batch.column("x"), d)
            code = np.zeros((len(x), len(books)), np.uint8)
            error = np.zeros(len(x), np.int64)
            for p, (low, high) in enumerate(bounds):
                order = sorted_rows(x[:, low:high])
                nearest, distance = walk(x[order, low:high], books[p])
                code[order, p] = nearest
                error[order] += distance
            text = pa.array([row.tobytes().hex() for row in code], pa.string())
            columns = [batch.column("vec_id"), batch.column("label"), text, pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "x").mapInArrow(run, "vec_id bigint, label string, code string, error bigint")


def books_digest(books: list[np.ndarray]) -> str:
    flat = ",".join(str(v) for book in books for v in book.ravel().tolist())
    return hashlib.sha256(flat.encode()).hexdigest()


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id``, ``label``, ``code``, ``error`` of every usable row, and the codebooks (entries x part length).

    Components are floor(4096 * component). Null vectors, null or non-finite components and vectors of another than the
    most frequent length go. The codebooks start from the smallest distinct ids (null last; of an id's vectors the
    lexicographically smallest), fewer than ``entries`` of them where there are fewer. Repeated rows count as often as
    they stand and get the same code. An empty table has no rows and no codebooks. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: entries must lie in 1..256")
    rows, d = vectors.whole_vectors(embeddings, SCALE, 0, LIMIT)
    if d == 0:
        none = embeddings.sparkSession.createDataFrame([], "vec_id bigint, label string, code string, error bigint")
        return none, []
    books = first_entries(rows, d, parts, entries)
    counted = distinct_parts(rows, d, parts)
    for _ in range(rounds):
        books = refine(counted, books)
    return encode(rows, d, books), books


def decode(code: str, books: list[np.ndarray]) -> list[float]:
    """The vector a code stands for: its entries, back on the scale of the components."""
    return [v / SCALE for p, index in enumerate(bytes.fromhex(code)) for v in books[p][index].tolist()]


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(common.table(spark, sf_dir, "embeddings"))
    coded = common.stored(coded, "vector-codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    same = coded["label"].eqNullSafe(sums["label"])
    return coded.join(sums, same).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books) if books else None).cast("string").alias("codebooks_sha256")
    )


def _sql() -> str:
    """All rounds in DuckDB SQL; a list is a part, ``pos`` counts parts and ``entry`` codebook entries from 0."""
    steps = [
        f"""v AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor({SCALE:.0f} * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
)""",
        f"parts AS (SELECT vec_id, label, pos, x[len(x) * pos // {PARTS} + 1 : len(x) * (pos + 1) // {PARTS}] AS part FROM v, range({PARTS}) AS r(pos))",
        f"b0 AS (SELECT pos, entry, part FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (vec_id) WHERE entry < {ENTRIES})",
    ]
    near = "list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for i in range(ROUNDS + 1):
        steps.append(
            f"d{i} AS (SELECT p.vec_id, p.label, p.pos, p.part, b.entry, {near} AS far FROM parts p JOIN b{i} b ON p.pos = b.pos), "
            f"a{i} AS (SELECT * FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id, pos ORDER BY far, entry) = 1)"
        )
        if i < ROUNDS:
            steps.append(
                f"c{i} AS (SELECT pos, entry, place, floor(sum(part[place]) / count(*))::BIGINT AS value "
                f"FROM a{i}, LATERAL (SELECT unnest(range(1, len(part) + 1)) AS place) GROUP BY pos, entry, place), "
                f"m{i} AS (SELECT pos, entry, list(value ORDER BY place) AS part FROM c{i} GROUP BY pos, entry), "
                f"b{i + 1} AS (SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part FROM b{i} b LEFT JOIN m{i} m ON b.pos = m.pos AND b.entry = m.entry)"
            )
    steps.append(
        f"digest AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b{ROUNDS})"
    )
    steps.append(
        f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, sum(far)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label)"
    )
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"


SQL = _sql()
