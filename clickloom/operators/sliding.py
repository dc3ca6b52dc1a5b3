"""Sliding windows over panes.

A pane is one slide long. A window is numbered after its last pane, so an event in pane
``p`` belongs to the windows ``p`` to ``p + n - 1``, where a window has ``n`` panes.
Nothing here copies an event ``n`` times: events fold into panes first, and a value that
stays the same over several windows is one row, a *step* ``[w_from, w_to)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def whole_parts(value: Column, length: int) -> Column:
    """``value`` over ``length`` rounded down, in whole numbers throughout."""
    size = F.lit(length).cast("bigint")
    return F.call_function("div", value - F.pmod(value, size), size)


@dataclass(frozen=True)
class Sliding:
    """Window size and slide in whole seconds; the size is a multiple of the slide."""

    size: int
    slide: int

    def __post_init__(self) -> None:
        if self.size <= 0 or self.slide <= 0 or self.size % self.slide:
            raise ValueError("the window size must be a positive multiple of the slide")

    @property
    def panes(self) -> int:
        return self.size // self.slide

    @property
    def span(self) -> int:
        """Windows per time span; per-key work is cut there, so no key outgrows a task."""
        return 24 * self.panes

    def pane_of(self, time: Column) -> Column:
        return whole_parts(F.unix_micros(time), self.slide * MICROS)

    def bounds(self, window: Column) -> list[Column]:
        step = F.lit(self.slide * MICROS)
        return [
            F.timestamp_micros((window + 1 - self.panes) * step).alias("window_start"),
            F.timestamp_micros((window + 1) * step).alias("window_end"),
        ]


# One hour, every ten seconds.
LIVE = Sliding(size=3600, slide=10)


def span_of(index: Column, length: int) -> Column:
    return whole_parts(index.cast("bigint"), length)


def with_spans(panes: DataFrame, sliding: Sliding) -> DataFrame:
    """Adds ``span``; a pane whose windows reach into the next span is copied there.

    The copies stand before the span's first window. They give the first windows their
    past and are dropped again by the caller.
    """
    last = span_of(F.col("pane") + sliding.panes - 1, sliding.span)
    first = span_of(F.col("pane"), sliding.span)
    return panes.withColumn("span", F.explode(F.sequence(first, last)))


def window_totals(panes: DataFrame, sliding: Sliding, sums: list[str],
                  keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums per window from pane totals whose keys are few (none, or the event names).

    The rows copied to ``n`` windows are pane totals; their number follows the length of
    time covered, not the number of events.
    """
    folded = panes.groupBy(*keys, "pane").agg(*[F.sum(c).alias(c) for c in sums])
    spread = folded.select(
        *keys, *sums,
        F.explode(F.sequence(F.col("pane"), F.col("pane") + sliding.panes - 1)).alias("w"),
    )
    return spread.groupBy(*keys, "w").agg(*[F.sum(c).alias(c) for c in sums])


# A sum is kept as whole numbers and a count of these parts of one, both exact, so that what
# enters a window can be taken out again without a trace.
_PARTS = 10**12
# A figure of this size or more, or not a number, is no figure.
_TOO_LARGE = 1e18


def _exact(value: Column) -> tuple[Column, Column]:
    """A double as a whole number and parts of one."""
    whole = F.floor(value)
    return whole.cast("bigint"), F.round((value - whole) * _PARTS).cast("bigint")


def key_steps(panes: DataFrame, sliding: Sliding, keys: tuple[str, ...],
              sums: list[str], spread_by: tuple[Column, ...]) -> DataFrame:
    """Sliding sums of many keys as steps: ``keys, span, w_from, w_to, sums``.

    ``panes`` has one row per key and pane. A sum changes only where a pane enters or
    leaves the window, so a key contributes about two steps per pane. Both are signed
    changes, and one running sum per key and span adds them up: a key with a pane in every
    slide costs one addition per change, whatever the length of the window. The rows are
    shuffled once, by span and ``spread_by``; callers that group by at least those
    columns need no further shuffle.
    """
    n, span = sliding.panes, sliding.span
    pane, first = F.col("pane"), span_of(F.col("pane"), span)
    next_start = (first + 1) * span
    measures = [f"{kind}_{c}" for c in sums for kind in ("held", "whole", "parts")]

    def change(at_span: Column, at: Column, sign: int) -> Column:
        # A pane without a figure counts as held nowhere, so windows of such panes stay NULL.
        values = []
        for c in sums:
            value = F.when(F.abs(F.col(c).cast("double")) < _TOO_LARGE, F.col(c).cast("double"))
            whole, parts = _exact(value)
            held = F.when(value.isNotNull(), sign).otherwise(0)
            values += [held.cast("bigint"), F.coalesce(whole * sign, F.lit(0)), F.coalesce(parts * sign, F.lit(0))]
        return F.struct(at_span.alias("span"), at.alias("w"), F.lit(sign).cast("bigint").alias("live"),
                        *[v.alias(m) for v, m in zip(values, measures, strict=True)])

    enters, leaves = change(first, pane, 1), change(first, pane + n, -1)
    # Windows that reach into the next span start there anew; at its first window nothing
    # has to leave, as a span's sums begin with what enters there.
    again = (change(first + 1, next_start, 1), change(first + 1, pane + n, -1))
    changes = (
        F.when(pane + n > next_start, F.array(enters, *again))
        .when(pane + n == next_start, F.array(enters)).otherwise(F.array(enters, leaves))
    )
    salts = [c.alias(f"spread_{i}") for i, c in enumerate(spread_by)]
    salt_names = [f"spread_{i}" for i in range(len(salts))]
    rows = (
        panes.select(*keys, *salts, F.explode(changes).alias("c"))
        .select(*keys, *salt_names, "c.*")
        .repartition("span", *salt_names)
    )
    ordered = Window.partitionBy("span", *salt_names, *keys).orderBy("w")
    so_far = ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(
        *keys, *salt_names, "span", F.col("w").alias("w_from"),
        F.coalesce(F.lead("w").over(ordered), (F.col("span") + 1) * span).alias("w_to"),
        *[F.sum(c).over(so_far).alias(c) for c in ("live", *measures)],
    )

    def total(c: str) -> Column:
        value = F.col(f"whole_{c}") + F.col(f"parts_{c}") / F.lit(float(_PARTS))
        return F.when(F.col(f"held_{c}") > 0, value).alias(c)

    # Rows of the same window are peers with equal sums; the last of them has w_to beyond
    # w_from. Steps in which the key has no pane are gaps.
    return running.where((F.col("w_from") < F.col("w_to")) & (F.col("live") > 0)).select(
        *keys, *salt_names, "span", "w_from", "w_to", *[total(c) for c in sums])
