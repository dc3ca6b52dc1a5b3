"""The replay loop: page after page of the click-stream table, published as messages.

A stored checkpoint holds the key of the last page's last event and the number of the next
page. A page is published into a folder of its own number, which is overwritten, before its
checkpoint is stored; a run that stops in between publishes the same page again, not twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions.temporal import temporals_as_text
from clickloom.schemas import KNOWN_EVENTS
from clickloom.sources.extract import PAGE_ROWS, after

_CHECKPOINT = "page BIGINT, event_time TIMESTAMP, event_id STRING"
_SLOTS = 2


def replay(events: DataFrame, path: str, names: Iterable[str] = KNOWN_EVENTS,
           rows: int = PAGE_ROWS, pages: int | None = None) -> int:
    """Publishes what is left behind the checkpoint below ``path``, ``rows`` events a page, and
    returns the number of pages. ``pages`` stops the run early; the next one goes on there.

    A page is the next ``rows`` events in key order and the others of its last key. Each key's
    place in that order is counted once, by parallel tasks; only the keys of several events can
    move a page's end, so the driver follows the pages from those. All pages of a run are then
    written at once, each into its own folder, before the checkpoint of the last is stored. An
    event without time or id has no place in the key order and is never reached.
    """
    spark, names = events.sparkSession, tuple(names)
    spark.sql("SELECT 0L AS page, CAST(NULL AS TIMESTAMP) AS event_time, '' AS event_id").write.mode(
        "ignore").parquet(f"{path}/checkpoint/slot=1")
    if pages is not None and pages <= 0:
        return 0
    keyed = events.where(F.col("event_time").isNotNull() & F.col("event_id").isNotNull())
    page, time, event_id = checkpoint(spark, path)
    start = (time, event_id) if time else ("0001-01-01 00:00:00", "")
    left = after(keyed, start, names)
    keys = _places(left.groupBy("event_time", "event_id").agg(F.count("*").alias("n")), f"{path}/keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    segments = _segments(keys, total, rows, page, pages)
    if not segments:
        return 0
    first, place = F.col("first"), F.lit(None).cast("long")
    for at, number in segments:  # the last start at or before a key decides
        place = F.when(first >= at, F.lit(number) + F.floor((first - at) / rows)).otherwise(place)
    ending = page + pages if pages is not None else None
    paged = keys.select("event_time", "event_id", place.cast("long").alias("page"))
    if ending is not None:
        paged = paged.where(F.col("page") < ending)
    # A page's events go to one task, so that each page folder holds one file.
    published = left.join(paged, ["event_time", "event_id"]).repartition("page")
    # The messages of encode, with the page beside them.
    messages = temporals_as_text(published).select(F.to_json(F.struct(*left.columns)).alias("value"), "page")
    messages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "page").text(feed(path))
    newest = paged.agg(F.max(F.struct("page", "event_time", "event_id")).alias("c")).select("c.*").first()
    stored = spark.createDataFrame([(newest["page"] + 1, newest["event_time"], newest["event_id"])], _CHECKPOINT)
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/checkpoint/slot={newest['page'] % _SLOTS}")
    return newest["page"] + 1 - page


def _places(keys: DataFrame, at: str) -> DataFrame:
    """``keys`` with ``first``: the events of all keys before each. Each range of keys is
    counted by its own task, and the ranges' totals are summed up in order."""
    ranged = keys.repartitionByRange("event_time", "event_id").withColumn("part", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(at)
    stored = keys.sparkSession.read.parquet(at)
    within = F.sum("n").over(Window.partitionBy("part").orderBy("event_time", "event_id")) - F.col("n")
    totals = stored.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("part", before.alias("before"))
    return stored.select("part", "event_time", "event_id", "n", within.alias("within")).join(
        F.broadcast(offsets), "part").select(
        "event_time", "event_id", "n", (F.col("within") + F.col("before")).alias("first"))


def _segments(keys: DataFrame, total: int, rows: int, page: int, pages: int | None) -> list[tuple[int, int]]:
    """Where runs of pages of exactly ``rows`` events begin, and the number of their first page.

    A run goes on until its nominal page end falls on a key of several events that goes on
    behind it; that page takes the rest of the key, and the next run begins behind it.
    """
    several = keys.where(F.col("n") > 1).select("first", "n")
    segments, at, number = [], 0, page
    while at < total and (pages is None or number < page + pages):
        segments.append((at, number))
        # The first nominal end at or behind a key's first event, and whether the key goes on.
        steps = F.floor((F.col("first") - at + rows) / rows)
        end = F.lit(at - 1) + steps * rows
        hit = several.where(F.col("first") >= at).select(steps.alias("steps"), end.alias("end"), "first", "n").where(
            F.col("end") < F.col("first") + F.col("n") - 1).agg(F.min(F.struct("end", "steps", "first", "n"))).first()[0]
        if hit is None:
            break
        at, number = hit["first"] + hit["n"], number + hit["steps"]
    return segments


def checkpoint(spark: SparkSession, path: str) -> tuple:
    """The next page's number, and time and id of the last event published."""
    stored = spark.read.schema(_CHECKPOINT).parquet(f"{path}/checkpoint")
    newest = stored.agg(F.max(F.struct("page", "event_time", "event_id")).alias("c")).select("c.*")
    return tuple(newest.first())


def feed(path: str) -> str:
    """Where a consumer finds the pages."""
    return f"{path}/feed"
