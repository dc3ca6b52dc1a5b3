"""Live cart abandonment from carried sessions.

The plain jobs keep each cart's session, and each of the 360 windows it then counts in, in the
state store. Here a micro-batch folds its events into pieces of sessions, joins them with the
sessions that are still open, puts out the carts of those that close, and carries the rest:
one row per open cart. Closed carts fold into panes, and only those of the last window length
are carried on for the sliding totals. Nothing else is kept, so what a micro-batch reads
follows its own events and the carts now open.

The watermark is the newest event time, of any kind of event, less ``delay``. A session closes
when the watermark reaches a gap behind its last event, a window when it reaches its end. An
event behind the watermark of the micro-batch before is late: it joins no session, and goes to
a table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.operators.abandonment import (
    CART_KEYS,
    GAP_SECONDS,
    cart_buckets,
    cart_panes,
    carts_of_sessions,
    sessions_of_pieces,
    totals_of_cart_panes,
)
from clickloom.operators.sliding import LIVE, MICROS, Sliding
from clickloom.streaming.accounts import Accounts, read_once
from clickloom.streaming.state import carried, carry, prepare

_PROGRESS = "watermark BIGINT"
_PANES = "pane BIGINT, abandoned_count BIGINT, total_lost_sales DOUBLE"


def abandonment_writer(events: DataFrame, path: str, checkpoint: str, sliding: Sliding = LIVE,
                       gap_seconds: int = GAP_SECONDS, delay: int = 0,
                       time_col: str = "event_time") -> DataStreamWriter:
    """Tables ``carts``, ``totals``, ``late`` and ``accounts`` below ``path``.

    Everything a micro-batch writes carries its id and is overwritten when it is repeated.
    """
    rows = events.select(*dict.fromkeys(
        [*CART_KEYS, "event_name", "event_time", "event_id", "price_usd", "quantity", time_col]))
    empty = events.sparkSession.createDataFrame([], rows.schema)
    open_sessions = cart_buckets(empty, gap_seconds, time_col)
    carts_now = carts_of_sessions(open_sessions, gap_seconds)
    prepare(carts_now, f"{path}/carts")
    prepare(totals_of_cart_panes(cart_panes(carts_now, sliding), sliding), f"{path}/totals")
    accounts = Accounts(rows, path, time_col)
    gap = gap_seconds * MICROS

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = carried(spark, f"{path}/progress", _PROGRESS, batch_id).first()
        before = before[0] if before else None
        late = F.lit(False) if before is None else F.unix_micros(time_col) < before
        on_time, newest = accounts.settle(batch, late, batch_id)
        watermark = max((t for t in (before, newest and newest - delay * MICROS) if t is not None), default=None)
        pieces = carried(spark, f"{path}/open", open_sessions.schema, batch_id).unionByName(
            cart_buckets(on_time, gap_seconds, time_col))
        sessions = sessions_of_pieces(pieces, gap_seconds).select(*open_sessions.columns)
        # Written once, then split into those that close and those that go on.
        sessions.write.mode("overwrite").parquet(f"{path}/sessions")
        sessions = spark.read.schema(open_sessions.schema).parquet(f"{path}/sessions")
        ends = F.unix_micros("last_seen") + gap
        closed = F.lit(False) if watermark is None else ends <= watermark
        carry(sessions.where(~closed), f"{path}/open", batch_id)
        carts = carts_of_sessions(sessions.where(closed), gap_seconds)
        carts.write.mode("overwrite").parquet(f"{path}/carts/batch={batch_id}")
        _sum_up(spark, path, batch_id, sliding, before, watermark)
        carry(spark.createDataFrame([(watermark,)], _PROGRESS), f"{path}/progress", batch_id)

    return events.writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint).foreachBatch(read_once(write))


def _sum_up(spark, path: str, batch_id: int, sliding: Sliding, before: int | None,
            watermark: int | None) -> None:
    """The windows that end between the two watermarks, and the panes that later ones need."""
    carts = spark.read.parquet(f"{path}/carts/batch={batch_id}")
    panes = carried(spark, f"{path}/panes", _PANES, batch_id).unionByName(
        cart_panes(carts, sliding)).groupBy("pane").agg(
        F.sum("abandoned_count").alias("abandoned_count"), F.sum("total_lost_sales").alias("total_lost_sales"))
    step = sliding.slide * MICROS
    # The last pane of the last window that is closed; a session yet open closes behind it.
    last = None if watermark is None else watermark // step - 1
    fresh = F.lit(False)
    if last is not None:
        ended = F.unix_micros("window_end")
        fresh = ended <= watermark
        if before is not None:
            fresh = fresh & (ended > before)
    totals_of_cart_panes(panes, sliding).where(fresh).write.mode("overwrite").parquet(
        f"{path}/totals/batch={batch_id}")
    if last is not None:
        panes = panes.where(F.col("pane") > last + 1 - sliding.panes)
    carry(panes.coalesce(1), f"{path}/panes", batch_id)
