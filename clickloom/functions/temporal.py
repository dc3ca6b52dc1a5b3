"""Text forms of dates, timestamps and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import FRACTION, TIME_FORMAT, TIME_OF_DAY_FORMAT


def parse_time(text: Column) -> Column:
    """NULL for text that is not in the message format, with or without a fraction of seconds."""
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT + FRACTION))


def time_text(value: Column) -> Column:
    return F.date_format(value, TIME_FORMAT)


def temporals_as_text(df: DataFrame) -> DataFrame:
    """Every temporal column as text: date and time, or the time of day alone."""
    def as_text(field: T.StructField) -> Column | str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return time_text(F.col(name)).alias(field.name)
        if isinstance(field.dataType, T.TimeType):
            # TIME has no format function; its text begins with HH:mm:ss.
            text = F.col(name).cast("string")
            return F.substring(text, 1, len(TIME_OF_DAY_FORMAT)).alias(field.name)
        return name

    return df.select(*[as_text(field) for field in df.schema.fields])
