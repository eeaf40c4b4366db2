"""Vectors as rows of whole numbers, shared by the operators that fit something on all vectors.

A row's numbers are one binary value, 8 bytes each, whose byte order is the lexicographic order of the numbers. Passes
over it copy bytes between Spark and numpy, where an array column would be converted number by number each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from hazardlake.llm import common

_SIGN = np.uint64(1 << 63)


def packed(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows hold ``counts`` of ``numbers`` each, in turn."""
    wide = (numbers.astype(np.int64).view(np.uint64) ^ _SIGN).astype(">u8")
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * 8, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(wide.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers).cast(pa.binary())


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """A binary column of ``d`` numbers a row as a matrix; no row is null."""
    if len(column) == 0:
        return np.empty((0, d), np.int64)
    _, _, data = column.buffers()
    if column.offset or data.size != len(column) * d * 8:
        data = b"".join(column.to_pylist())
    return (np.frombuffer(data, ">u8").astype(np.uint64) ^ _SIGN).view(np.int64).reshape(len(column), d)


def whole_vectors(vectors: DataFrame, scale: float, shift: int, limit: int) -> tuple[DataFrame, int]:
    """``vec_id``, ``label``, ``x`` (packed floor(scale * component) + shift) of all usable rows, stored, and their length.

    Null vectors and such with null or non-finite components go. One table has one length: the most frequent one, the
    larger of two equally frequent; vectors of another length go too, as do those without components. ``scale *
    component`` is held within ``limit`` on both sides. A table without usable rows has length 0.
    """
    value = F.col("embedding")
    kind = vectors.schema["embedding"].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, (FloatType, DoubleType))):
        value = value.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), value.alias("embedding"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            numbers = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            owner = np.repeat(np.arange(len(counts)), counts)
            usable = counts > 0
            usable[owner[~np.isfinite(numbers)]] = False
            numbers = np.clip(numbers[usable[owner]] * scale, -float(limit), float(limit))
            own = pa.array(np.flatnonzero(usable))
            columns = [batch.column("vec_id").take(own), batch.column("label").take(own)]
            x = packed(np.floor(numbers).astype(np.int64) + shift, counts[usable])
            yield pa.RecordBatch.from_arrays([*columns, x], names=["vec_id", "label", "x"])

    kept = common.stored(rows.mapInArrow(pack, "vec_id bigint, label string, x binary"), "whole-vectors")
    length = (F.octet_length("x") / 8).cast("int")
    lengths = kept.groupBy(length.alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d"))
    most = lengths.first()
    d = most["d"] if most else 0
    return kept.where(length == d), d
