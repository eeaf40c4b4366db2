"""Stored tables with one state per key, changed bucket by bucket and read as snapshots.

A key's hash names its bucket, a folder. A change rewrites only the buckets that hold its keys, each into a folder of
the new version; a manifest, one small file written last, then lists the version of every bucket. So a change appears
all at once, a change that fails halfway is never seen, a reader (a running stream, say) keeps a whole snapshot, and an
old version lies untouched until ``vacuum``. One writer at a time.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from hazardlake.operators import dims

#: Place of a row's last write in the order of loads; rows of the first load have none.
WRITTEN = "_written"


@dataclass(frozen=True)
class KeyedTable:
    """``schema`` lists the columns; rows of equal ``keys`` lie in one of ``buckets`` hash buckets."""

    path: str
    schema: StructType
    keys: Sequence[str]
    buckets: int = 64

    # ------------------------------------------------------------------ versions
    def _listed(self, spark: SparkSession, pattern: str) -> list:
        """Hadoop paths below the table that match; none where there are none."""
        paths = spark.sparkContext._jvm.org.apache.hadoop.fs
        root = paths.Path(self.path)
        files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return [status.getPath() for status in files.globStatus(paths.Path(root, pattern)) or []]

    def _delete(self, spark: SparkSession, found: list) -> int:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        return sum(bool(path.getFileSystem(conf).delete(path, True)) for path in found)

    def versions(self, spark: SparkSession, at: int | None = None) -> tuple[int, dict[int, int]]:
        """Number of the newest snapshot (or of ``at``), and the version of each bucket in it; 0 and none at first."""
        written = self._listed(spark, "manifests/manifest=*/_SUCCESS")
        newest = at if at is not None else max((_number(path.getParent()) for path in written), default=0)
        if newest == 0:
            return 0, {}
        rows = spark.read.schema("bucket int, version int").parquet(os.path.join(self.path, "manifests", f"manifest={newest}"))
        return newest, {r["bucket"]: r["version"] for r in rows.collect()}  # a row a bucket

    def _full(self) -> StructType:
        return StructType([*self.schema.fields, StructField(WRITTEN, LongType()), StructField("_bucket", IntegerType()), StructField("_version", IntegerType())])

    def _rows(self, spark: SparkSession, versions: dict[int, int]) -> DataFrame:
        data = os.path.join(self.path, "data")
        paths = [os.path.join(data, f"_bucket={b}", f"_version={v}") for b, v in sorted(versions.items())]
        if not paths:
            return spark.createDataFrame([], self._full()).drop("_version")
        return spark.read.schema(self._full()).option("basePath", data).parquet(*paths).drop("_version")

    def read(self, spark: SparkSession, at: int | None = None) -> DataFrame:
        """The rows of the newest snapshot, or of snapshot ``at``."""
        return self._rows(spark, self.versions(spark, at)[1]).select(*self.schema.names)

    # ------------------------------------------------------------------ changes
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def change(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """A new snapshot in which every bucket that ``changes`` falls into holds ``merge(its rows, its changes)``.

        Both sides and the result have the table's columns and ``_written``. Returns the snapshot's number; without
        changes that of the snapshot there is.
        """
        spark = changes.sparkSession
        newest, versions = self.versions(spark)
        dealt = changes.select(*self.schema.names, F.col(WRITTEN).cast("bigint").alias(WRITTEN), self.bucket().alias("_bucket"))
        touched = sorted(r[0] for r in dealt.select("_bucket").distinct().collect())  # at most ``buckets``
        if not touched:
            return newest
        old = self._rows(spark, {b: v for b, v in versions.items() if b in touched})
        merged = merge(old.drop("_bucket"), dealt.drop("_bucket"))
        following = newest + 1
        self._delete(spark, self._listed(spark, f"data/_bucket=*/_version={following}"))  # of a change that failed
        full = merged.select(*self.schema.names, WRITTEN, self.bucket().alias("_bucket"), F.lit(following).alias("_version"))
        full.repartition("_bucket").write.mode("append").partitionBy("_bucket", "_version").parquet(os.path.join(self.path, "data"))
        held = {_number(path.getParent()) for path in self._listed(spark, f"data/_bucket=*/_version={following}")}
        after = {b: v for b, v in versions.items() if b not in touched} | {b: following for b in held}
        listed = spark.createDataFrame(sorted(after.items()), "bucket int, version int").coalesce(1)
        listed.write.mode("overwrite").parquet(os.path.join(self.path, "manifests", f"manifest={following}"))
        return following

    # ------------------------------------------------------------------ common changes
    def upsert(self, changes: DataFrame, order: str) -> int:
        """Last write wins by ``order``: a load that runs again, or late, never undoes a newer one."""

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            return dims.newest_write(old.unionByName(new), list(self.keys), WRITTEN)

        return self.change(changes.withColumn(WRITTEN, F.col(order)), merge)

    def load(self, rows: DataFrame) -> int:
        """The first rows; any later upsert beats them."""
        return self.upsert(rows.withColumn("_first", F.lit(None).cast("bigint")), "_first")

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete folders that none of the ``keep`` newest snapshots holds; returns how many. Not while ``change`` runs."""
        newest, _ = self.versions(spark)
        kept = range(max(1, newest - keep + 1), newest + 1)
        used = {item for n in kept for item in self.versions(spark, n)[1].items()}
        folders = self._listed(spark, "data/_bucket=*/_version=*")
        gone = self._delete(spark, [path for path in folders if (_number(path.getParent()), _number(path)) not in used])
        self._delete(spark, [path for path in self._listed(spark, "manifests/manifest=*") if _number(path) not in kept])
        return gone


def _number(path) -> int:
    """The value in the last level of a partition path."""
    return int(path.getName().split("=")[1])
