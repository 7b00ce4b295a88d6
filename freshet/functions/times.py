"""Timestamps: literals that push down, cut-off arithmetic, ISO text, partition numbers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_naive(value: datetime) -> datetime:
    """Naive values are taken as UTC already."""
    if value.tzinfo is None:
        return value
    return value.astimezone(timezone.utc).replace(tzinfo=None)


def utc_now() -> datetime:
    return utc_naive(datetime.now(timezone.utc))


def ts_literal(value: datetime, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """A constant of the compared column's own type, so that no cast wraps the column and the
    comparison reaches the Parquet scan."""
    text = utc_naive(value).isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "+00:00").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def cutoff_before(now: datetime, hours: int | None) -> datetime | None:
    """Start of the look-back window; no hours means no lower bound."""
    if hours is None:
        return None
    if hours < 1:
        raise ValueError(f"hours must be at least 1, got {hours}")
    return utc_naive(now) - timedelta(hours=hours)


def iso_timestamp(col: Column, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """ISO-8601 text: no fraction when the microseconds are zero, six digits otherwise.

    A zoned timestamp is shown in UTC with its offset.
    """
    zoned = isinstance(dtype, T.TimestampType)
    wall = F.convert_timezone(None, F.lit("UTC"), col.cast("timestamp_ntz")) if zoned else col
    text = F.replace(wall.cast("string"), F.lit(" "), F.lit("T"))
    seconds, micros = F.substring_index(text, ".", 1), F.substring_index(text, ".", -1)
    padded = F.concat(seconds, F.lit("."), F.rpad(micros, 6, "0"))
    iso = F.when(F.contains(text, F.lit(".")), padded).otherwise(text)
    return F.concat(iso, F.lit("+00:00")) if zoned else iso


def partition_number(col: Column, transform: str) -> Column:
    """Years, months or days since 1970-01-01, as an int."""
    if transform == "year":
        number = F.year(col) - 1970
    elif transform == "month":
        number = (F.year(col) - 1970) * 12 + F.month(col) - 1
    elif transform == "day":
        number = F.date_diff(col.cast("date"), F.lit("1970-01-01").cast("date"))
    else:
        raise ValueError(f"unsupported partition transform: {transform!r}")
    return number.cast("int")
