"""Places in a total order by distributed prefix sums: no task sorts or numbers more than one range of it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.session import stored

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition; the others number the partitions.
_INDEX_BITS = 33


def positions(rows: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``rows`` and ``name``, their place (from 0) in the order of the columns ``order``; written once.

    The rows are dealt into ranges of the order and sorted there, which gives a range and a place in it. A range's offset
    is the sum of the sizes of the ranges before; one number a range reaches the driver. Select what is needed first, and
    let the order tell all rows apart: equal rows lie in one range.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_id", _INDEX_BITS).cast("int")
    sizes = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for i in range(max(sizes, default=0) + 1):
        offsets.append(total)
        total += sizes.get(i, 0)
    offset = F.element_at(F.from_json(F.lit(json.dumps(offsets)), "array<bigint>"), part + 1)
    return kept.withColumn(name, offset + F.col("_id").bitwiseAND((1 << _INDEX_BITS) - 1)).drop("_id")
