"""Cart abandonment: sessions per (session, product), carts never booked, lost sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.events import named
from clickloom.functions.temporal import time_text
from clickloom.operators.sliding import LIVE, MICROS, Sliding, whole_parts, window_totals
from clickloom.schemas import ADD_TO_CART, SALES_EVENTS

# Fixed value: a session of cart events ends after five minutes of silence.
GAP_SECONDS = 300

CART_KEYS = ("session_id", "product_id")
_BY_ARRIVAL = ("event_time", "event_id")


def cart_fields(row: str) -> list[Column]:
    """The abandoned cart as its first event tells it."""
    price, quantity = F.col(f"{row}.price_usd"), F.col(f"{row}.quantity")
    return [
        *CART_KEYS,
        time_text(F.col(f"{row}.event_time")).alias("abandoned_time"),
        price.alias("item_price"),
        quantity.alias("quantity"),
        (price * quantity).alias("lost_sale"),
    ]


_SESSION = ("started", "last_seen", "only_adds", "first")


def cart_buckets(events: DataFrame, gap_seconds: int = GAP_SECONDS,
                 time_col: str = "event_time") -> DataFrame:
    """Cart events folded into gap-long buckets with their edges: pieces of sessions.

    Events less than a gap apart share a session, so all events of one bucket do. A hot pair
    is folded on the map side and is at most one row per bucket, however many events it has.
    """
    time = F.col(time_col)
    bucket = whole_parts(F.unix_micros(time), gap_seconds * MICROS)
    first = F.struct("event_time", "event_id", "price_usd", "quantity")
    return (
        events.where(named(*SALES_EVENTS) & time.isNotNull())
        .groupBy(*CART_KEYS, bucket.alias("bucket"))
        .agg(
            F.min(time).alias("started"), F.max(time).alias("last_seen"),
            F.bool_and(F.col("event_name") == ADD_TO_CART).alias("only_adds"),
            F.min(first).alias("first"),
        )
    ).select(*CART_KEYS, *_SESSION)


def sessions_of_pieces(pieces: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Joins pieces of sessions, buckets or sessions so far, less than a gap apart."""
    # One shuffle by a hash of the pair serves the window and the grouping behind it.
    keys = ("pair", *CART_KEYS)
    ordered = Window.partitionBy(*keys).orderBy("started", "last_seen")
    # Sessions so far may be longer than a gap, so the last event is not always the last row's.
    seen = F.max("last_seen").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.unix_micros("started") - F.unix_micros(seen) >= gap_seconds * MICROS, 1).otherwise(0)
    return (
        pieces.withColumn("pair", F.xxhash64(*CART_KEYS)).repartition("pair")
        .withColumn("opens", opens)
        .withColumn("session_no", F.sum("opens").over(
            ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*keys, "session_no")
        .agg(
            F.min("started").alias("started"), F.max("last_seen").alias("last_seen"),
            F.bool_and("only_adds").alias("only_adds"), F.min("first").alias("first"),
        )
    )


def cart_sessions(events: DataFrame, gap_seconds: int = GAP_SECONDS,
                  time_col: str = "event_time") -> DataFrame:
    """One row per session of a (session, product) pair: ``started, last_seen, only_adds,
    first``. Two events a whole gap apart are in different sessions."""
    return sessions_of_pieces(cart_buckets(events, gap_seconds, time_col), gap_seconds)


def carts_of_sessions(sessions: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    # A session ends one gap after its last event; its result is stamped just before.
    closed = F.timestamp_micros(F.unix_micros("last_seen") + (gap_seconds * MICROS - 1))
    return sessions.where("only_adds").select(*cart_fields("first"), closed.alias("closed_at"))


def abandoned_carts(events: DataFrame, gap_seconds: int = GAP_SECONDS,
                    time_col: str = "event_time") -> DataFrame:
    """Sessions with adds and no booking, told by their first add. A booking anywhere in
    the session clears the cart, before the add as well; later adds are not counted."""
    return carts_of_sessions(cart_sessions(events, gap_seconds, time_col), gap_seconds)


def cart_panes(carts: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    """Abandoned carts and lost sales per pane of the carts' closing times."""
    return carts.groupBy(sliding.pane_of(F.col("closed_at")).alias("pane")).agg(
        F.count("*").alias("abandoned_count"), F.sum("lost_sale").alias("total_lost_sales"))


def abandonment_totals(carts: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    """Abandoned carts and lost sales per sliding window over the carts' closing times."""
    return totals_of_cart_panes(cart_panes(carts, sliding), sliding)


def totals_of_cart_panes(panes: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    totals = window_totals(panes, sliding, ["abandoned_count", "total_lost_sales"])
    return totals.select(
        *sliding.bounds(F.col("w")), "abandoned_count",
        F.round("total_lost_sales", 2).alias("total_lost_sales"))


def stamped(totals: DataFrame) -> DataFrame:
    """Adds the time of the run, as the published messages carry it."""
    return totals.withColumn("timestamp", time_text(F.current_timestamp()))


def abandonment_trend(totals: DataFrame) -> DataFrame:
    """The series behind the trend line, oldest window first."""
    return totals.select("window_end", "abandoned_count", "total_lost_sales").orderBy(
        "window_end")
