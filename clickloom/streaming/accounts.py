"""What a stream did with the events it read: on time, late, without a time.

Late events are kept in a side table. For every micro-batch, events on time, late and untimed
add up to the events read. The counts are an aggregation of the micro-batch, not observed
metrics: those count a task's rows again when it is repeated for a lost executor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.functions.events import count_where
from clickloom.streaming.state import prepare

_ACCOUNTS = "batch_id BIGINT, events BIGINT, on_time BIGINT, late BIGINT, untimed BIGINT"


class Accounts:
    """The books of one writer: tables ``late`` and ``accounts`` below ``path``."""

    def __init__(self, rows: DataFrame, path: str, time_col: str) -> None:
        self._path, self._time, self._columns = path, time_col, rows.columns
        spark = rows.sparkSession
        prepare(spark.createDataFrame([], rows.schema), f"{path}/late")
        prepare(spark.createDataFrame([], _ACCOUNTS), f"{path}/accounts")

    def settle(self, batch: DataFrame, late: Column, batch_id: int) -> tuple[DataFrame, int | None]:
        """Books the micro-batch and keeps its late events; returns the events on time and the
        newest event time."""
        rows, timed = batch.select(*self._columns), F.col(self._time).isNotNull()
        seen = rows.agg(
            F.count(F.lit(1)).alias("events"), count_where(timed & ~late).alias("on_time"),
            count_where(timed & late).alias("late"), count_where(~timed).alias("untimed"),
            F.max(F.unix_micros(self._time)).alias("newest")).first()
        spark = batch.sparkSession
        # Most micro-batches have no late events and are not read again for them.
        kept = rows.where(timed & late) if seen["late"] else spark.createDataFrame([], rows.schema)
        kept.write.mode("overwrite").parquet(f"{self._path}/late/batch={batch_id}")
        spark.createDataFrame([(batch_id, *seen[:4])], _ACCOUNTS).coalesce(1).write.mode(
            "overwrite").parquet(f"{self._path}/accounts/batch={batch_id}")
        return rows.where(timed & ~late), seen["newest"]


def read_once(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``write`` for ``foreachBatch`` with its micro-batch cached: the books, the late events
    and the writer's own tables read it, and its messages are parsed once for all of them."""

    def cached(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()

    return cached


def accounts(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: events read, on time, late and untimed."""
    return spark.read.schema(_ACCOUNTS).parquet(f"{path}/accounts").drop("batch")


def engine_accounts(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """For the plain jobs, from Spark's own progress reports: micro-batch, rows read, rows that
    a stateful operator dropped behind the watermark (per operator, so copies count)."""
    return [(p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))
            for p in query.recentProgress]
