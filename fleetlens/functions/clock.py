"""Time helpers. No operator reads the clock: ``as_of`` is always a value."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_as_of(df: DataFrame, column: str, as_of: datetime | None) -> datetime | None:
    """``as_of``, or the newest time of the table when it is not given.

    The result is a literal, so a date-partitioned table is pruned statically.
    Production callers pass ``as_of``; the default costs a one-column scan.
    """
    if as_of is not None:
        return as_of
    return df.agg(F.max(column).alias("t")).first()["t"]


def instant(df: DataFrame, column: str, value: datetime | None) -> Column:
    """A literal of the column's own timestamp type, so comparisons push down."""
    if value is None:
        return F.lit(None).cast(df.schema[column].dataType)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def since(df: DataFrame, column: str, as_of: datetime, **span: float) -> Column:
    """``column >= as_of - span``."""
    return F.col(column) >= instant(df, column, as_of - timedelta(**span))


def epoch(column: str | Column) -> Column:
    """Seconds since 1970 as a double, with microseconds."""
    col = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(col.cast("timestamp")) / F.lit(1e6)


def epoch_us(column: str | Column) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(col.cast("timestamp"))


def floor_time(df: DataFrame, column: str, seconds: int) -> Column:
    """Start of the aligned bucket of ``seconds`` that holds the time."""
    us = seconds * 1_000_000
    start = F.expr(f"timestamp_micros(floor(unix_micros(CAST(`{column}` AS TIMESTAMP)) / {us}) * {us})")
    return start.cast(df.schema[column].dataType)
