"""Closed dates of a fan-out table rewritten in place, while its stream goes on."""

from __future__ import annotations

import datetime
import json
import os
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazardlake.sources.sinks import DATE_PARTITIONS
from hazardlake.streaming.sinks import BATCH_PARTITIONS

#: Hidden folder of a compaction below the table: the packed rows and, written after them, the journal of the swap.
WORK = "_compaction"


class _Folder:
    """Files below a table's path, in any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._root = self._paths.Path(path)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, relative: str):
        return self._paths.Path(self._root, relative)

    def matching(self, pattern: str, depth: int) -> list[str]:
        """The last ``depth`` levels of every path that fits."""
        found = self._files.globStatus(self._at(pattern)) or []
        return ["/".join(status.getPath().toString().split("/")[-depth:]) for status in found]

    def has(self, relative: str) -> bool:
        return self._files.exists(self._at(relative))

    def delete(self, relative: str) -> None:
        self._files.delete(self._at(relative), True)

    def move(self, relative: str, to: str) -> None:
        if not self._files.rename(self._at(relative), self._at(to)):
            raise OSError(f"cannot move {relative} to {to}")


def compact_closed(
    spark: SparkSession, path: str, checkpoint: str, before: datetime.date, partitions: Sequence[str] = tuple(DATE_PARTITIONS)
) -> int:
    """Give every date earlier than ``before`` few large files; returns the number of folders packed.

    Run it beside the stream of ``checkpoint`` that writes ``path`` (``fan_out``); one compaction of a table at a time.
    Only folders of committed batches are packed. Such a batch never runs again, and a batch that does run again finds
    its own folder as it left it, so neither loses nor repeats a row. A date that gets late rows afterwards is packed
    again by the next call. Rows whose date is null stay where they are.

    The packed rows are written to a hidden folder and counted, then the swap is written down, then done: packed folders
    move in, their sources go. A compaction that dies before the journal is complete has changed nothing; one that dies
    later is finished by the next call. A reader that lists a date in between can see its rows twice, and one that
    listed it before can miss files, as with any overwritten folder.
    """
    folder = _Folder(spark, path)
    _finish(spark, folder, path)
    query = json.loads(spark.read.text(os.path.join(checkpoint, "metadata")).first()[0])["id"]
    commits = _Folder(spark, checkpoint).matching("commits/*", 1)
    last = max((int(name) for name in commits if name.isdigit()), default=-1)
    levels = [*partitions, *BATCH_PARTITIONS]
    groups: dict[str, list[str]] = defaultdict(list)
    pattern = "/".join([*(f"{name}=*" for name in partitions), f"query_id={query}", "batch_id=*"])
    for leaf in folder.matching(pattern, len(levels)):
        parent, batch = leaf.rsplit("/", 1)
        if int(batch.split("=")[1]) <= last and _closed(parent, before):
            groups[parent].append(leaf)
    sources = sorted(leaf for leaves in groups.values() if len(leaves) > 1 for leaf in leaves)
    if not sources:
        return 0
    packed = -1 - last  # below every batch and every earlier packed folder
    staging = os.path.join(path, WORK, "data")
    rows = _rows(spark, path, sources, levels)
    moved = rows.withColumn("batch_id", F.lit(str(packed)))
    moved.hint("rebalance", *levels[:-1]).write.mode("overwrite").partitionBy(*levels).parquet(staging)
    parents = sorted({leaf.rsplit("/", 1)[0] for leaf in sources})
    targets = [f"{parent}/batch_id={packed}" for parent in parents]
    if _rows(spark, staging, targets, levels).count() != rows.count():
        raise RuntimeError(f"packed rows of {path} differ in number from their sources")
    steps = [("move", target) for target in targets] + [("delete", leaf) for leaf in sources]
    journal = spark.createDataFrame(steps, "step string, folder string").coalesce(1)
    journal.write.mode("overwrite").parquet(os.path.join(path, WORK, "journal"))
    _finish(spark, folder, path)
    return len(sources)


def _rows(spark: SparkSession, path: str, leaves: list[str], levels: Sequence[str]) -> DataFrame:
    """Rows of some folders; the values of the levels stay the texts of their names."""
    found = spark.read.parquet(os.path.join(path, leaves[0])).schema.fields
    schema = StructType([*found, *(StructField(name, StringType()) for name in levels)])
    return spark.read.schema(schema).option("basePath", path).parquet(*(os.path.join(path, leaf) for leaf in leaves))


def _closed(folder: str, before: datetime.date) -> bool:
    values = dict(level.split("=", 1) for level in folder.split("/"))
    parts = [values.get(name, "") for name in DATE_PARTITIONS]
    return all(part.isdigit() for part in parts) and datetime.date(*map(int, parts)) < before


def _finish(spark: SparkSession, folder: _Folder, path: str) -> None:
    """Do what a complete journal says and forget it. Each step can be done again."""
    if folder.has(f"{WORK}/journal/_SUCCESS"):
        steps = spark.read.parquet(os.path.join(path, WORK, "journal")).collect()  # a row a folder
        for row in steps:
            if row.step == "move" and folder.has(f"{WORK}/data/{row.folder}"):
                folder.move(f"{WORK}/data/{row.folder}", row.folder)
        for row in steps:
            if row.step == "delete":
                folder.delete(row.folder)
    if folder.has(WORK):
        folder.delete(WORK)
