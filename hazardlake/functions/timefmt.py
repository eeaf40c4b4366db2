"""Conversions between ISO text, timestamps and epoch milliseconds, and date partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp, with or without a fraction; unreadable text gives NULL."""
    return F.try_to_timestamp(text)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, ISO_MILLIS)


def millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def file_stamp(ts: Column) -> Column:
    """Compact stamp used in file names, e.g. ``20240101_060000_000``."""
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSS")


def date_parts(ts: Column) -> list[Column]:
    """The ``year, month, day`` columns every lake layer is partitioned by."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]


def event_id(area: Column, ms: Column) -> Column:
    """``<area>_<ms>_<8 hex>``; the suffix is a digest, so a replayed window keeps its id."""
    digest = F.sha2(F.concat(area, ms.cast("string")), 256)
    return F.concat_ws("_", area, ms.cast("string"), F.substring(digest, 1, 8))
