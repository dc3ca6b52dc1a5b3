"""Where rows go: message topics and folders, the history table, metric tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.functions.events import day_of
from clickloom.sources.messages import encode


def publish_folder(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rows as JSON messages, one per line, behind those that are there."""
    encode(rows).write.mode(mode).text(path)


def publish_topic(rows: DataFrame, servers: str, name: str) -> None:
    """Append rows as JSON messages to a Kafka topic; needs the spark-sql-kafka package."""
    writer = encode(rows).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", name).save()


def publish_stream(rows: DataFrame, checkpoint: str, path: str | None = None,
                   servers: str | None = None, name: str | None = None) -> DataStreamWriter:
    """The streaming form: to a folder of messages or to a topic."""
    writer = encode(rows).writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint)
    if path:
        return writer.format("text").option("path", path)
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", name)


def with_event_date(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("event_date", day_of(enriched))


def append_history(enriched: DataFrame, path: str) -> None:
    """Append to the history table; it is created when it is missing.

    The rebalance hint gathers each date into few, evenly sized files, and AQE splits
    a date that holds far more rows than the others.
    """
    rows = with_event_date(enriched).hint("rebalance", "event_date")
    rows.write.mode("append").partitionBy("event_date").parquet(path)


def append_history_stream(enriched: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The file sink's commit log makes each micro-batch appear exactly once."""
    writer = with_event_date(enriched).writeStream.format("parquet").outputMode("append")
    return writer.partitionBy("event_date").option("path", path).option(
        "checkpointLocation", checkpoint)


def append_table_stream(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    writer = rows.writeStream.format("parquet").outputMode("append")
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def append_batches(rows: DataFrame, path: str, checkpoint: str,
                   transform: Callable[[DataFrame], DataFrame]) -> DataStreamWriter:
    """``transform`` every micro-batch and keep its result in its own partition.

    A repeated batch overwrites the partition it wrote before, so a retry adds nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return rows.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint).foreachBatch(write)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
