"""Funnel metrics per sliding window with exact distinct sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.events import count_where, named
from clickloom.functions.numbers import percent_or_zero
from clickloom.operators.latest import newest_fields
from clickloom.operators.sliding import LIVE, Sliding, span_of, with_spans
from clickloom.schemas import ADD_TO_CART, PAGE_VIEW, PURCHASE

COUNTS = {
    "page_view_count": PAGE_VIEW,
    "add_to_cart_count": ADD_TO_CART,
    "purchase_count": PURCHASE,
}

# The stages of the funnel chart.
STAGES = {
    "Sessions": "session_count",
    "Added to Cart": "add_to_cart_count",
    "Purchased": "purchase_count",
}


def event_counts() -> list[Column]:
    return [count_where(named(name)).alias(column) for column, name in COUNTS.items()]


def percentages() -> list[Column]:
    """Events per session in percent; above 100 when sessions repeat an event."""
    return [
        percent_or_zero(F.col(c), F.col("session_count")).alias(
            c.replace("_count", "_percentage"))
        for c in COUNTS
    ]


def session_panes(events: DataFrame, sliding: Sliding = LIVE,
                  time_col: str = "event_time") -> DataFrame:
    """Event counts per session and pane; a hot session is folded on the map side."""
    pane = sliding.pane_of(F.col(time_col)).alias("pane")
    return events.select("session_id", "event_name", pane).groupBy(
        "session_id", "pane").agg(*event_counts())


def funnel(events: DataFrame, sliding: Sliding = LIVE, time_col: str = "event_time") -> DataFrame:
    """``window_start, window_end, session_count``, three counts, three percentages."""
    return funnel_of_panes(session_panes(events, sliding, time_col), sliding)


def funnel_of_panes(panes: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    """The funnel from session panes.

    A session counts once per window, in the window's first pane that holds it. So pane
    ``p`` brings the session to the windows ``[max(p, q + n), p + n)``, ``q`` being its
    pane before. Those ranges are disjoint per session and their borders are plain +1
    and -1 marks, which add up across sessions before the counts are run up.
    """
    n = sliding.panes
    pane = F.col("pane")
    earlier = F.lag("pane").over(Window.partitionBy("session_id", "span").orderBy("pane"))
    joined = (
        with_spans(panes, sliding)
        .withColumn("joins", F.greatest(pane, F.coalesce(earlier + n, pane)))
        .where(span_of(pane, sliding.span) == F.col("span"))
    )

    # The counts are run up separately in stretches of n windows. A pane's windows touch
    # two of them, unless they fill exactly one; what is open at the border is carried.
    border = (span_of(pane, n) + 1) * n
    crosses = pane % n != 0

    def mark(at: Column, sessions: Column, sign: int | None) -> Column:
        counts = [F.lit(0).cast("bigint") if sign is None else F.col(c) * sign for c in COUNTS]
        return F.struct(at.alias("w"), sessions.cast("bigint").alias("session_count"),
                        *[v.alias(c) for v, c in zip(counts, COUNTS)])

    joins = F.col("joins")
    marks = F.array(mark(pane, F.lit(0), 1), mark(joins, F.lit(1), None))
    carried = F.array(
        mark(border, F.when(joins < border, 1).otherwise(0), 1),
        mark(pane + n, F.lit(-1), -1),
    )
    measures = ["session_count", *COUNTS]
    changes = (
        joined.select(F.explode(F.when(crosses, F.concat(marks, carried)).otherwise(marks))
                     .alias("m"))
        .groupBy("m.w").agg(*[F.sum(f"m.{c}").alias(c) for c in measures])
    )
    stretch = span_of(F.col("w"), n)
    ordered = Window.partitionBy("stretch").orderBy("w")
    steps = changes.withColumn("stretch", stretch).select(
        "w",
        F.coalesce(F.lead("w").over(ordered), (F.col("stretch") + 1) * n).alias("w_to"),
        *[F.sum(c).over(ordered).alias(c) for c in measures],
    )
    filled = steps.where("session_count > 0").withColumn(
        "w", F.explode(F.sequence(F.col("w"), F.col("w_to") - 1)))
    return filled.select(*sliding.bounds(F.col("w")), *measures, *percentages())


def latest_funnel(metrics: DataFrame) -> DataFrame:
    """One row: of each number the newest window's that holds it, zero before there is one."""
    return or_zeros(newest_fields(metrics, list(STAGES.values()), "window_end"))


def or_zeros(latest: DataFrame) -> DataFrame:
    return latest.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in STAGES.values()])


def funnel_stages(latest: DataFrame) -> DataFrame:
    """Funnel numbers as stages, each with its percent of the first."""
    stages = F.array(*[
        F.struct(F.lit(i).alias("stage_no"), F.lit(label).alias("stage"),
                 F.col(c).alias("value"))
        for i, (label, c) in enumerate(STAGES.items(), start=1)
    ])
    return latest.select("session_count", F.explode(stages).alias("s")).select(
        "s.*",
        percent_or_zero(F.col("s.value"), F.col("session_count")).alias("percent_of_initial"),
    )
