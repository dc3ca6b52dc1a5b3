"""The live pipelines. Each takes a streaming read of typed events and returns a stream in
append mode: a window comes out once, when the watermark has passed its end.

Late events, those behind the watermark, are dropped; ``delay`` is how long to wait for
them. ``time_col`` may be a publish time instead of the event time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.functions.events import above_watermark, line_amount, named
from clickloom.functions.numbers import settled
from clickloom.operators.abandonment import GAP_SECONDS, cart_fields
from clickloom.operators.enrich import enriched_history
from clickloom.operators.funnel import COUNTS, event_counts, percentages
from clickloom.operators.sliding import LIVE, MICROS, Sliding
from clickloom.operators.trending import TOP, rank_products
from clickloom.schemas import ADD_TO_CART, SALES_EVENTS
from clickloom.sources.sinks import append_batches

NO_DELAY = 0


def _seconds(count: int) -> str:
    return f"{count} seconds"


def spread_over_windows(events: DataFrame, sliding: Sliding, delay: int, time_col: str,
                        wanted: Column | None = None) -> DataFrame:
    """One row per event and window, keyed by ``window_end``, which carries the watermark.

    The last window of an event ends one size after the event's pane began, so a delay
    of one size puts the watermark where the events themselves would put it. Events that
    are not ``wanted`` keep one row up to the watermark and are dropped right above it.
    """
    pane, step = sliding.pane_of(F.col(time_col)), sliding.slide * MICROS
    last = (pane + sliding.panes) * step
    first = (pane + 1) * step
    if wanted is not None:
        first = F.when(wanted, first).otherwise(last)
    ends = F.explode(F.sequence(first, last, F.lit(step)))
    spread = (
        events.withColumn("_end", ends)
        .withColumn("window_end", F.timestamp_micros("_end")).drop("_end")
        .withWatermark("window_end", _seconds(sliding.size + delay))
    )
    if wanted is None:
        return spread
    return spread.where(above_watermark(wanted, "window_end"))


def _with_start(df: DataFrame, sliding: Sliding) -> DataFrame:
    start = F.timestamp_micros(F.unix_micros("window_end") - sliding.size * MICROS)
    return df.select(start.alias("window_start"), *df.columns)


def funnel_stream(events: DataFrame, sliding: Sliding = LIVE, delay: int = NO_DELAY,
                  time_col: str = "event_time") -> DataFrame:
    """Exact distinct sessions by two levels of grouping: sessions, then windows."""
    spread = spread_over_windows(
        events.select("session_id", "event_name", time_col), sliding, delay, time_col)
    per_session = spread.groupBy("window_end", "session_id").agg(*event_counts())
    metrics = per_session.groupBy("window_end").agg(
        F.count("*").alias("session_count"), *[F.sum(c).alias(c) for c in COUNTS])
    return _with_start(metrics.select("*", *percentages()), sliding)


def product_stream(events: DataFrame, sliding: Sliding = LIVE, delay: int = NO_DELAY,
                   time_col: str = "event_time") -> DataFrame:
    """Sums per closed window, event type and product; what trending ranks."""
    rows = events.select("event_name", "product_id", "quantity",
                         line_amount().alias("revenue"), time_col)
    spread = spread_over_windows(rows, sliding, delay, time_col, named(*SALES_EVENTS))
    revenue = settled(F.col("revenue"))
    sums = spread.groupBy("window_end", "event_name", "product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
    return _with_start(sums, sliding).withColumn("revenue", revenue).withColumn(
        "amount", settled(F.col("quantity") * revenue))


def top_products_writer(events: DataFrame, path: str, checkpoint: str,
                        sliding: Sliding = LIVE, k: int = TOP, rank_by: str = "amount",
                        delay: int = NO_DELAY, time_col: str = "event_time") -> DataStreamWriter:
    """Top products of the windows that closed in each micro-batch.

    A window closes for all its products in the same micro-batch, so each batch ranks
    whole windows with an ordinary distributed ranking; no state holds a product list.
    """
    return append_batches(product_stream(events, sliding, delay, time_col), path, checkpoint,
                          lambda closed: rank_products(closed, k, rank_by))


def abandoned_stream(events: DataFrame, gap_seconds: int = GAP_SECONDS, delay: int = NO_DELAY,
                     time_col: str = "event_time") -> DataFrame:
    """Abandoned carts as their sessions close. The gap is a microsecond short because
    Spark's sessions would join two events a whole gap apart."""
    first = F.min(F.struct("event_time", "event_id", "price_usd", "quantity"))
    gap = f"{gap_seconds - 1}.999999 seconds"
    sessions = (
        events.withWatermark(time_col, _seconds(delay))
        .where(above_watermark(named(*SALES_EVENTS), time_col))
        .groupBy("session_id", "product_id", F.session_window(time_col, gap).alias("session"))
        .agg(F.bool_and(F.col("event_name") == ADD_TO_CART).alias("only_adds"),
             first.alias("first"))
    )
    return sessions.where("only_adds").select(*cart_fields("first"), "session")


def abandonment_stream(events: DataFrame, sliding: Sliding = LIVE,
                       gap_seconds: int = GAP_SECONDS, delay: int = NO_DELAY,
                       time_col: str = "event_time") -> DataFrame:
    """Abandoned carts and lost sales per sliding window, behind the sessions."""
    carts = abandoned_stream(events, gap_seconds, delay, time_col)
    window = F.window(F.window_time("session"), _seconds(sliding.size), _seconds(sliding.slide))
    return carts.groupBy(window).agg(
        F.count("*").alias("abandoned_count"),
        F.round(F.sum("lost_sale"), 2).alias("total_lost_sales"),
    ).select(F.col("window.start").alias("window_start"),
             F.col("window.end").alias("window_end"), "abandoned_count", "total_lost_sales")


def enriched_stream(events: DataFrame, customers: DataFrame, products: DataFrame,
                    salts: int = 1, customers_newest_by: str | None = None,
                    products_newest_by: str | None = None, frozen: bool = False) -> DataFrame:
    """Stateless enrichment; the batch function works on a stream as it is. Freeze large
    dimensions first: others are read, made unique and shuffled in every micro-batch."""
    return enriched_history(events, customers, products, salts, customers_newest_by,
                            products_newest_by, frozen=frozen)
