"""The last known numbers of the live funnel, kept up by a stream of its messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.operators.funnel import STAGES, or_zeros
from clickloom.operators.latest import known, merged
from clickloom.schemas import TIME_FORMAT, schema_of
from clickloom.streaming.state import carried, carry

FIELDS = list(STAGES.values())
# What the stream reads of a message; a message may lack any of the numbers.
MESSAGE = schema_of("window_end TIMESTAMP, " + ", ".join(f"{f} BIGINT" for f in FIELDS))
_STATE = ", ".join(f"{f} STRUCT<at: TIMESTAMP, value: BIGINT>" for f in FIELDS)


def decode(messages: DataFrame) -> DataFrame:
    """The numbers of published funnel messages (``value``); what is missing is NULL."""
    options = {"timestampFormat": TIME_FORMAT}
    return messages.select(F.from_json(F.col("value").cast("string"), MESSAGE, options).alias("m")).select("m.*")


def latest_writer(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Merges each micro-batch into a table of one row (see ``latest_state``).

    A message without a number, or with a null, leaves its last value as it is; so does one
    that arrives behind a newer one. A repeated micro-batch changes nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = batch.select(*[known(f, "window_end").alias(f) for f in FIELDS])
        both = carried(spark, path, _STATE, batch_id).unionByName(held)
        carry(merged(both, FIELDS).withColumn("batch", F.lit(batch_id).cast("bigint")), path, batch_id)

    nothing = [F.lit(None).cast("STRUCT<at: TIMESTAMP, value: BIGINT>").alias(f) for f in FIELDS]
    first = messages.sparkSession.range(1).select(*nothing, F.lit(-1).cast("bigint").alias("batch"))
    first.coalesce(1).write.mode("ignore").parquet(f"{path}/slot=1")
    return messages.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint).foreachBatch(write)


def latest_state(spark: SparkSession, path: str) -> DataFrame:
    """One row, the last known numbers; zeros before the first message."""
    slots = spark.read.schema(f"{_STATE}, batch BIGINT").parquet(path)
    newest = slots.agg(F.max_by(F.struct(*FIELDS), "batch").alias("s"))
    return or_zeros(newest.select(*[F.col(f"s.{f}.value").alias(f) for f in FIELDS]))
