"""The last known value of each field, over messages that need not hold every field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known(name: str, at: str) -> Column:
    """A field's value with its time; NULL where the message does not hold the field."""
    return F.when(F.col(name).isNotNull(), F.struct(F.col(at).alias("at"), F.col(name).alias("value")))


def merged(rows: DataFrame, fields: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """For each field the newest of its ``known`` values, per key or in one row over all.

    Merging is associative and the order of the rows does not matter, so parts may be merged
    with each other and with a stored state. Two values of one time fall to the larger.
    """
    return rows.groupBy(*keys).agg(*[F.max(f).alias(f) for f in fields])


def newest_fields(messages: DataFrame, fields: list[str], at: str,
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys`` and ``fields``: of each field the value of the newest message, by ``at``, that
    holds it. A field that no message holds is NULL."""
    held = messages.select(*keys, *[known(f, at).alias(f) for f in fields])
    return merged(held, fields, keys).select(*keys, *[F.col(f"{f}.value").alias(f) for f in fields])
