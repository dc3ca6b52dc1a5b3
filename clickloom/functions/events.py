"""Predicates and expressions over clickstream events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import PURCHASE

# Before year 1, the first that a timestamp can show.
EARLIEST_MICROS = -(10**17)

DateLike = str | date | Column


def named(*names: str) -> Column:
    return F.col("event_name").isin(*names)


def above_watermark(condition: Column, time_col: str = "event_time") -> Column:
    """The same predicate for streams, where it must not move below the watermark node.

    Otherwise events that are filtered out would not advance the watermark. Spark keeps a
    predicate on the event-time column above the node. It has to compare the column's
    value: a mere NULL test is simplified away where the column is never NULL.
    """
    return F.when(condition, F.unix_micros(time_col)) > F.lit(EARLIEST_MICROS)


def is_purchase() -> Column:
    return F.col("event_name") == PURCHASE


def line_amount() -> Column:
    return F.col("price_usd") * F.col("quantity")


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _as_date(value: DateLike) -> Column:
    return value if isinstance(value, Column) else F.to_date(F.lit(str(value)))


def default_range() -> tuple[Column, Column]:
    """The last 30 days up to today."""
    return F.date_sub(F.current_date(), 30), F.current_date()


def within_dates(df: DataFrame, start: DateLike | None, end: DateLike | None) -> DataFrame:
    """Rows dated ``start`` to ``end``, both included.

    A table partitioned by ``event_date`` is pruned to those partitions. A timestamp
    column is compared as a half-open range, which reaches the Parquet scan. A string
    column has to be converted row by row.
    """
    default_start, default_end = default_range()
    lo = default_start if start is None else _as_date(start)
    hi = default_end if end is None else _as_date(end)
    if "event_date" in df.columns:
        return df.where(F.col("event_date").between(lo, hi))
    if isinstance(df.schema["event_time"].dataType, (T.TimestampType, T.TimestampNTZType)):
        kind = df.schema["event_time"].dataType.simpleString()
        return df.where(
            (F.col("event_time") >= lo.cast(kind))
            & (F.col("event_time") < F.date_add(hi, 1).cast(kind))
        )
    return df.where(event_date(df).between(lo, hi))


def event_date(df: DataFrame) -> Column:
    return F.col("event_date") if "event_date" in df.columns else day_of(df)


def day_of(df: DataFrame) -> Column:
    """The date of ``event_time``; NULL for text that is no time."""
    if isinstance(df.schema["event_time"].dataType, T.StringType):
        return F.to_date(F.try_to_timestamp("event_time"))
    return F.to_date("event_time")
