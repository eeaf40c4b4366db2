"""Fan-out of one stream into several tables, safe to replay."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from hazardlake.sources.sinks import DATE_PARTITIONS, compact_layer


@dataclass(frozen=True)
class Output:
    """One table cut from a micro-batch."""

    path: str
    build: Callable[[DataFrame], DataFrame]
    partitions: Sequence[str] = field(default_factory=lambda: tuple(DATE_PARTITIONS))
    stamp: str | None = None  # column to receive the wall clock of the write
    pieces: int | None = None  # partitions the rows are dealt out to by ``partitions``; None: as the session shuffles
    dealt: bool = False  # ``build`` has dealt the rows out already


#: Partition levels that keep the files of one micro-batch apart.
BATCH_PARTITIONS = ["query_id", "batch_id"]


def keep(batch: DataFrame) -> DataFrame:
    """Persist a micro-batch that is read more than once; the caller unpersists what this returns.

    A batch that ends in a sort-merge join carries an order by columns of the join's sides that are no columns of its
    own, and Spark cannot plan over a cached relation of such an order. A coalesce that keeps every partition has none.
    """
    return batch.coalesce(max(batch.rdd.getNumPartitions(), 1)).persist()


def fan_out(
    df: DataFrame,
    outputs: Sequence[Output],
    checkpoint: str,
    mode: str = "append",
    kept: bool = True,
) -> DataStreamWriter:
    """Write every output of each micro-batch.

    A batch of several outputs is persisted, unless ``kept`` is false: for batches that are large in a cache and cheap to
    make again from where the stream's own exchange left them.

    The stream's id (kept in its checkpoint) and the batch number are the last partition levels, and only those
    partitions are overwritten: a batch that is run again after a failure replaces its own files, and a stream
    with another checkpoint, whose batches are numbered from 0 again, never touches older rows. The rebalance
    hint leaves a batch few files per partition; ``compaction.compact_closed`` packs closed dates in place.
    """
    known: list[str] = []

    def query_id(batch: DataFrame) -> str:
        if not known:  # the stream has written its metadata before the first batch
            text = batch.sparkSession.read.text(os.path.join(checkpoint, "metadata")).first()
            known.append(json.loads(text[0])["id"])
        return known[0]

    def write(batch: DataFrame, number: int) -> None:
        held = kept and len(outputs) > 1
        if held:
            batch = keep(batch)
        try:
            for output in outputs:
                rows = output.build(batch).withColumns({"query_id": F.lit(query_id(batch)), "batch_id": F.lit(number)})
                if output.stamp:
                    rows = rows.withColumn(output.stamp, F.current_timestamp())
                keys = [*output.partitions, *BATCH_PARTITIONS]
                if not output.dealt:
                    rows = rows.hint("rebalance", *([output.pieces] if output.pieces else []), *keys)
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(output.path)
        finally:
            if held:
                batch.unpersist()

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)


def compact(spark: SparkSession, path: str, into: str, partitions: Sequence[str] = tuple(DATE_PARTITIONS)) -> None:
    """Rewrite a whole table of many batches into a new folder, while its stream rests, with few large files per partition."""
    compact_layer(spark.read.parquet(path).drop(*BATCH_PARTITIONS), into, list(partitions))


def merge_into(df: DataFrame, change: Callable[[DataFrame, int], object], checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Apply ``change(rows, batch number)`` to a stored table for every micro-batch, e.g. ``KeyedTable.upsert``.

    A batch may run again after a failure, so the change must give the same table when it is applied twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = keep(batch)  # a change reads it twice: for the buckets it touches and for the rows
        try:
            change(batch, number)
        finally:
            batch.unpersist()

    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_and_drain(start: Callable[[], DataStreamWriter], closing: DataFrame, folder: str) -> None:
    """Process what is there now, then close the windows that are still open.

    ``start`` builds the stream's writer; its source includes the files below ``folder``, which must have been made
    (empty) before. After the first run ``closing``, a row whose time lies beyond every window, is written there and
    a second run from the same checkpoint moves the watermark past all of them. The closing row's own window stays
    open and is never written.
    """
    run_available(start())
    closing.write.mode("append").parquet(folder)
    run_available(start())


def run_continuously(writer: DataStreamWriter, every: str) -> StreamingQuery:
    """Keep running with a micro-batch (and checkpoint) every ``every``, e.g. ``30 seconds``."""
    return writer.trigger(processingTime=every).start()
