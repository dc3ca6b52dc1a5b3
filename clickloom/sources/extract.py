"""Incremental keyset extract from the click-stream table."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.events import named
from clickloom.schemas import KNOWN_EVENTS

Checkpoint = tuple[datetime | str, str]
PAGE_ROWS = 1000


def after(events: DataFrame, checkpoint: Checkpoint,
          names: Iterable[str] = KNOWN_EVENTS) -> DataFrame:
    """Events behind the checkpoint ``(event_time, event_id)``.

    The row-wise comparison keeps events that share the checkpoint's time; the plain
    lower bound on the time is there for the scan, which can push it down.
    """
    time, event_id = F.lit(checkpoint[0]).cast("timestamp"), F.lit(checkpoint[1])
    return events.where(
        named(*names)
        & (F.col("event_time") >= time)
        & ((F.col("event_time") > time) | (F.col("event_id") > event_id))
    )


def up_to(events: DataFrame, checkpoint: Checkpoint) -> DataFrame:
    """Events up to the checkpoint, itself included."""
    time, event_id = F.lit(checkpoint[0]).cast("timestamp"), F.lit(checkpoint[1])
    return events.where(
        (F.col("event_time") <= time)
        & ((F.col("event_time") < time) | (F.col("event_id") <= event_id))
    )


def next_page(events: DataFrame, checkpoint: Checkpoint,
              names: Iterable[str] = KNOWN_EVENTS, rows: int = PAGE_ROWS) -> DataFrame:
    """The next ``rows`` events in keyset order; the page size is the feature."""
    return after(events, checkpoint, names).orderBy("event_time", "event_id").limit(rows)


def next_checkpoint(page: DataFrame) -> DataFrame:
    """One row: the key of the page's last event (NULLs for an empty page)."""
    last = F.max(F.struct("event_time", "event_id")).alias("last")
    return page.agg(last).select("last.event_time", "last.event_id")
