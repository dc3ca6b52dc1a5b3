"""Live windows from stored panes, for streams with many sessions or products.

The plain jobs keep every open window of every key in the state store, 360 per key with
the live windows. Here no state store is needed: each micro-batch folds its events into
panes, stores those as additions, and derives the windows that it closed by the batch
operators, from the panes of the last window length. Older panes are dropped.

A window closes with the micro-batch whose events move the watermark (the newest event
time, of any kind of event, less ``delay``) to its end or past it. A late event counts in
every window that is still open and in no other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.operators.funnel import COUNTS, event_counts, funnel_of_panes
from clickloom.operators.sliding import LIVE, MICROS, Sliding, span_of
from clickloom.operators.trending import TOP, product_panes, top_of_panes, totals_of_panes
from clickloom.streaming.accounts import Accounts, read_once
from clickloom.streaming.state import carried, carry, drop_folder, prepare

Fold = Callable[[DataFrame], DataFrame]
Derive = Callable[[DataFrame], DataFrame]

_PROGRESS = "latest BIGINT, closed BIGINT"


def session_panes(events: DataFrame, sliding: Sliding = LIVE,
                  time_col: str = "event_time") -> DataFrame:
    """Event counts per session and pane."""
    pane = sliding.pane_of(F.col(time_col)).alias("pane")
    return events.groupBy("session_id", pane).agg(*event_counts())


def windows_writer(events: DataFrame, fold: Fold, sums: list[str], derive: dict[str, Derive],
                   path: str, checkpoint: str, sliding: Sliding = LIVE, delay: int = 0,
                   time_col: str = "event_time") -> DataStreamWriter:
    """Keeps the panes of ``events`` and writes one table per entry of ``derive`` below
    ``path``, besides ``late`` and ``accounts`` (see ``Accounts``).

    Everything a micro-batch writes carries its id and is overwritten when the batch is
    repeated. Panes lie in stretches of 24 windows' length; those that no later window needs
    are dropped, so what is stored and listed follows the window and not the stream's age.
    """
    n = sliding.panes
    # The number of the last pane of a window.
    window = sliding.pane_of(F.col("window_end")) - 1
    no_events = fold(events.sparkSession.createDataFrame([], events.schema))
    keys = [c for c in no_events.columns if c not in sums]
    summed = [F.sum(c).alias(c) for c in sums]
    for name, windows in derive.items():
        prepare(windows(no_events.groupBy(*keys).agg(*summed)), f"{path}/{name}")
    accounts = Accounts(events, path, time_col)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest, before = carried(spark, f"{path}/progress", _PROGRESS, batch_id).first() or (None, None)
        # An event whose last window is closed counts nowhere.
        late = F.lit(False) if before is None else sliding.pane_of(F.col(time_col)) + (n - 1) <= before
        on_time, newest = accounts.settle(batch, late, batch_id)
        rows = fold(on_time).withColumn(
            "stretch", span_of(F.col("pane"), sliding.span)).withColumn("batch", F.lit(batch_id))
        rows.hint("rebalance", "stretch").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("stretch", "batch").parquet(f"{path}/panes")
        latest = max((t for t in (latest, newest) if t is not None), default=None)
        closed = before
        if latest is not None:
            closed = (latest - delay * MICROS) // (sliding.slide * MICROS) - 1
            closed = closed if before is None else max(before, closed)
        if closed is not None and (batch_id == 0 or closed != before):
            stored = spark.read.schema(rows.schema).parquet(f"{path}/panes")
            recent, fresh = stored.where(F.col("batch") <= batch_id), window <= closed
            recent = recent.where((F.col("stretch") <= closed // sliding.span) & (F.col("pane") <= closed))
            if before is not None:
                oldest = before - n
                recent = recent.where((F.col("stretch") >= oldest // sliding.span) & (F.col("pane") > oldest))
                fresh = fresh & (window > before)
            # a pane has one addition per micro-batch that held events of it
            added_up = recent.groupBy(*keys).agg(*summed)
            for name, windows in derive.items():
                result = windows(added_up).where(fresh)
                result.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        carry(spark.createDataFrame([(latest, closed)], _PROGRESS), f"{path}/progress", batch_id)
        if before is not None:
            _drop_stretches(spark, f"{path}/panes", (before - n) // sliding.span)

    return events.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint).foreachBatch(read_once(write))


def _drop_stretches(spark: SparkSession, path: str, oldest: int) -> None:
    """Drops the stretches before ``oldest``; a repeated micro-batch reads from there on."""
    stored = spark.read.schema("stretch BIGINT").parquet(path)
    for row in stored.where(F.col("stretch") < oldest).select("stretch").distinct().collect():
        drop_folder(spark, f"{path}/stretch={row['stretch']}")


def funnel_writer(events: DataFrame, path: str, checkpoint: str, sliding: Sliding = LIVE,
                  delay: int = 0, time_col: str = "event_time") -> DataStreamWriter:
    """Table ``funnel`` below ``path``."""
    rows = events.select("session_id", "event_name", time_col)
    return windows_writer(
        rows, lambda e: session_panes(e, sliding, time_col), list(COUNTS),
        {"funnel": lambda p: funnel_of_panes(p, sliding)}, path, checkpoint, sliding, delay, time_col)


def trending_writer(events: DataFrame, path: str, checkpoint: str, sliding: Sliding = LIVE,
                    k: int = TOP, rank_by: str = "amount", delay: int = 0,
                    time_col: str = "event_time") -> DataStreamWriter:
    """Tables ``top`` and ``totals`` below ``path``."""
    rows = events.select("event_name", "product_id", "quantity", "price_usd", time_col)
    return windows_writer(rows, lambda e: product_panes(e, sliding, time_col), ["quantity", "revenue"], {
        "top": lambda p: top_of_panes(p, sliding, k, rank_by),
        "totals": lambda p: totals_of_panes(p, sliding),
    }, path, checkpoint, sliding, delay, time_col)
