"""JSON messages: decode with dead letters, encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.temporal import parse_time, temporals_as_text
from clickloom.schemas import EVENT

# Numbers that JSON does not have but many writers put out; they count as null.
_NO_NUMBER = r'(:\s*)-?(?:NaN|Infinity)(?=\s*[,}])'


def _field(field: T.StructField) -> Column:
    value = F.try_variant_get("_event", f"$['{field.name}']", field.dataType.simpleString())
    return value.alias(field.name)


def parse_messages(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """``value`` (text or bytes) to typed events plus ``error`` and ``raw``.

    A message is good if it is a JSON object with a readable ``event_time``, which becomes a
    timestamp; ``error`` is NULL then. Every other field is taken as it comes: a number may be
    written with a fraction or as text, and what cannot be read as the field's type is NULL,
    as a missing field is. Only the fields that a query uses are taken out of the message.
    """
    raw = F.col("value").cast("string")
    document = F.coalesce(
        F.try_parse_json(raw), F.try_parse_json(F.regexp_replace(raw, _NO_NUMBER, "$1null")))
    # An array or a bare value is no event.
    event = F.when(F.startswith(F.ltrim(raw), F.lit("{")), document)
    # The explode of one element keeps the decoding in one place. As a plain column it would
    # be repeated in every filter and projection that the optimizer moves onto it.
    parsed = messages.select(raw.alias("raw"), F.explode(F.array(event)).alias("_event"))
    fields = [_field(field) for field in schema.fields if field.name != "event_time"]
    time = parse_time(F.try_variant_get("_event", "$.event_time", "string"))
    error = F.when(F.col("_event").isNull(), "bad_json").when(time.isNull(), "bad_event_time")
    typed = parsed.select(*fields, time.alias("event_time"), error.alias("error"), "raw")
    return typed.select(*schema.names, "error", "raw")


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).drop("error", "raw")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("raw", "error")


def encode(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``; temporal columns become text first."""
    return temporals_as_text(df).select(F.to_json(F.struct("*")).alias("value"))
