"""Trending products: sliding sums per product, totals per event type, top products."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.events import line_amount, named
from clickloom.functions.numbers import settled
from clickloom.operators.sliding import LIVE, Sliding, key_steps, span_of, window_totals
from clickloom.schemas import SALES_EVENTS

# The length of the top lists and their headings.
TOP = 10
HEADINGS = ("Product ID", "Total Quantity", "Total Sales ($)")
# Least product groups per event type and span that are ranked apart before the final ranking.
SPREAD = 16
RANK_BY = ("amount", "revenue")

_KEYS = ("event_name", "product_id")


def product_panes(events: DataFrame, sliding: Sliding, time_col: str = "event_time") -> DataFrame:
    """Quantity and revenue per event type, product and pane. A hot product is folded on
    the map side and ends as one row per pane."""
    return (
        events.where(named(*SALES_EVENTS))
        .select(*_KEYS, "quantity", line_amount().alias("revenue"),
                sliding.pane_of(F.col(time_col)).alias("pane"))
        .groupBy(*_KEYS, "pane")
        .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
    )


def product_steps(panes: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    """Each product's sliding sums as steps of windows in which they do not change.

    ``amount`` is revenue times quantity, the figure products are ranked by in the live
    tables; ``revenue`` is the plain sum of price times quantity.
    """
    groups = max(SPREAD, int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = (F.col("event_name"), F.pmod(F.xxhash64("product_id"), F.lit(groups)))
    steps = key_steps(panes, sliding, _KEYS, ["quantity", "revenue"], spread)
    revenue = settled(F.col("revenue"))
    return steps.withColumn("revenue", revenue).withColumn(
        "amount", settled(F.col("quantity") * revenue))


def _blocks(steps: DataFrame, sliding: Sliding, about: int) -> tuple[DataFrame, int]:
    """Steps cut at blocks of ``about`` so many windows: ``block, lo, hi, whole``.

    A step that fills a block stays one row there; only ragged ends need their windows
    spelled out. The block size divides the span, so a block lies in one span.
    """
    size = next(b for b in range(max(about, 1), 0, -1) if sliding.span % b == 0)
    block = F.col("block")
    first, last = span_of(F.col("w_from"), size), span_of(F.col("w_to") - 1, size)
    cut = steps.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest("w_from", block * size)
    hi = F.least("w_to", (block + 1) * size)
    return cut.select(
        *[c for c in steps.columns if c not in ("w_from", "w_to")], "block",
        lo.alias("lo"), hi.alias("hi"), (hi - lo == size).alias("whole"),
    ), size


def _windows(lo: Column, hi: Column) -> Column:
    return F.sequence(lo, hi - 1)


def trending_totals(events: DataFrame, sliding: Sliding = LIVE,
                    time_col: str = "event_time") -> DataFrame:
    """Totals per window and event type over all products, not only the top ones."""
    return totals_of_panes(product_panes(events, sliding, time_col), sliding)


def totals_of_panes(panes: DataFrame, sliding: Sliding = LIVE) -> DataFrame:
    # A step makes about L / size + size rows, least where the size is the root of L.
    pieces, size = _blocks(product_steps(panes, sliding), sliding, isqrt(sliding.panes))
    sums = ["quantity", "revenue", "amount"]
    # A piece that fills its block is summed once for the block (w NULL) ...
    ragged = F.when(~F.col("whole"), _windows(F.col("lo"), F.col("hi")))
    by_block = (
        pieces.select("event_name", "block", *sums, F.explode_outer(ragged).alias("w"))
        .groupBy("event_name", "block", "w").agg(*[F.sum(c).alias(c) for c in sums])
    )
    # ... and only the block's total is handed to its windows.
    block_windows = _windows(F.col("block") * size, (F.col("block") + 1) * size)
    every = F.when(F.col("w").isNull(), block_windows).otherwise(F.array("w"))
    totals = (
        by_block.select("event_name", *sums, F.explode(every).alias("w"))
        .groupBy("event_name", "w").agg(*[F.sum(c).alias(c) for c in sums])
    )
    return totals.select(
        *sliding.bounds(F.col("w")), "event_name",
        F.col("quantity").alias("total_quantity"),
        settled(F.col("revenue")).alias("total_revenue"),
        settled(F.col("amount")).alias("total_amount"),
    )


def top_products(events: DataFrame, sliding: Sliding = LIVE, k: int = TOP,
                 rank_by: str = "amount", time_col: str = "event_time") -> DataFrame:
    """The ``k`` best products per window and event type, with their rank.

    Ties fall to the larger quantity, then to the smaller product id.
    """
    return top_of_panes(product_panes(events, sliding, time_col), sliding, k, rank_by)


def top_of_panes(panes: DataFrame, sliding: Sliding = LIVE, k: int = TOP,
                 rank_by: str = "amount") -> DataFrame:
    """The ranking from pane sums.

    A product whose figure over a whole block of windows stays below that of ``k`` others
    cannot be ranked in any window of the block. Groups of products drop such pieces
    where they already are; what is left meets once per event type and block, is thinned
    again, and only then spelled out per window. No shuffle carries a row per window.
    """
    near = top_candidates(panes, sliding, k, rank_by)
    ranked = near.select(
        *_KEYS, "quantity", "revenue", "amount", "block",
        F.explode(_windows(F.col("lo"), F.col("hi"))).alias("w"),
    ).withColumn("rank", F.row_number().over(
        Window.partitionBy("event_name", "block", "w").orderBy(
            F.desc(rank_by), F.desc("quantity"), F.asc("product_id"))))
    return ranked.where(F.col("rank") <= k).select(
        *sliding.bounds(F.col("w")), "event_name", "rank", "product_id", "quantity",
        "revenue", "amount")


def top_candidates(panes: DataFrame, sliding: Sliding, k: int, rank_by: str) -> DataFrame:
    """Steps, cut at blocks of windows, that may be among the ``k`` best of a window."""
    if rank_by not in RANK_BY:
        raise ValueError(f"rank_by must be one of {RANK_BY}")
    steps = product_steps(panes, sliding)
    # Larger blocks make fewer pieces but lower floors; a quarter of a window did best.
    pieces, size = _blocks(steps, sliding, sliding.panes // 4)
    pieces = pieces.withColumn("standing", _standing(rank_by))
    group = ["span", *[c for c in steps.columns if c.startswith("spread_")], "block"]
    product = Window.partitionBy(*group, *_KEYS)
    # The floor stands on one piece of each product that is there in the whole block.
    present = F.sum(F.col("hi") - F.col("lo")).over(product) == size
    floor = F.when(present & (F.col("lo") == F.col("block") * size),
                   F.min("standing").over(product))
    near = _near_winners(pieces.withColumn("floor", floor), group, k)
    return _near_winners(near, ["event_name", "block"], k)


def _standing(rank_by: str) -> Column:
    """A row's place in the ranking's full order as one comparable value, ties included."""
    product = F.col("product_id")
    return F.struct(F.col(rank_by).alias("figure"), F.col("quantity").alias("quantity"),
                    product.isNull().alias("no_product"), (-product).alias("product"))


def _near_winners(pieces: DataFrame, group: list[str], k: int) -> DataFrame:
    """Pieces that reach the group's ``k``-th best floor; all of them if it has fewer.

    Floors are compared in the full order, so of many products with equal figures only the
    first by quantity and id stay.
    """
    place = F.row_number().over(
        Window.partitionBy(*group).orderBy(F.col("floor").desc_nulls_last()))
    bar = F.max(F.when(F.col("place") == k, F.col("floor"))).over(Window.partitionBy(*group))
    kept = F.col("bar").isNull() | (F.col("standing") >= F.col("bar"))
    return pieces.withColumn("place", place).withColumn("bar", bar).where(kept)


def rank_products(sums: DataFrame, k: int = TOP, rank_by: str = "amount") -> DataFrame:
    """The same ranking for rows that already are one per window, event type, product."""
    best = Window.partitionBy("window_end", "event_name").orderBy(
        F.desc(rank_by), F.desc("quantity"), F.asc("product_id"))
    return sums.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def grand_totals(events: DataFrame, sliding: Sliding = LIVE,
                 time_col: str = "event_time") -> DataFrame:
    """Quantity and revenue per window over both event types."""
    panes = events.where(named(*SALES_EVENTS)).select(
        sliding.pane_of(F.col(time_col)).alias("pane"), "quantity",
        line_amount().alias("revenue"))
    totals = window_totals(panes, sliding, ["quantity", "revenue"])
    return totals.select(
        *sliding.bounds(F.col("w")), F.col("quantity").alias("total_quantity"),
        settled(F.col("revenue")).alias("total_amount"))


def as_messages(top: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per window: ``trending``, a map from event type to its top list and totals.

    Every group holds at most ``k`` rows per event type, so the lists are small.
    """
    item = F.struct("rank", "product_id", "quantity", "amount")
    window = ["window_start", "window_end"]
    lists = top.groupBy(*window, "event_name").agg(F.sort_array(F.collect_list(item)).alias("l"))
    top10 = F.transform("l", lambda i: F.struct(i["product_id"].alias("product_id"),
                                                i["quantity"].alias("quantity"),
                                                i["amount"].alias("amount")))
    entry = F.struct(top10.alias("top10"), "total_quantity", "total_amount")
    entries = totals.join(lists, [*window, "event_name"]).select(
        *window, F.struct("event_name", entry.alias("entry")).alias("e"))
    return entries.groupBy(*window).agg(
        F.map_from_entries(F.sort_array(F.collect_list("e"))).alias("trending"))


def trending(events: DataFrame, sliding: Sliding = LIVE, k: int = TOP,
             rank_by: str = "amount", time_col: str = "event_time") -> DataFrame:
    return as_messages(top_products(events, sliding, k, rank_by, time_col),
                       trending_totals(events, sliding, time_col))


def live_tiles(totals: DataFrame) -> DataFrame:
    """Totals per window for the live tiles, from ``trending_totals``; an absent event type
    shows zeros."""
    def total(name: str, field: str, kind: str) -> Column:
        value = F.max(F.when(F.col("event_name") == name, F.col(field)))
        return F.coalesce(value, F.lit(0)).cast(kind).alias(f"{name.lower()}_{field}")

    return totals.groupBy("window_start", "window_end").agg(*[
        total(name, field, kind) for name in SALES_EVENTS
        for field, kind in (("total_quantity", "bigint"), ("total_amount", "double"))])


def top_table(top: DataFrame, event_name: str) -> DataFrame:
    """The top list of one event type as a display table, from ``top_products``."""
    return top.where(named(event_name)).select(
        "window_start", "window_end", "rank",
        *[F.col(c).alias(heading) for c, heading in
          zip(("product_id", "quantity", "amount"), HEADINGS, strict=True)])


def tiles_of_messages(messages: DataFrame) -> DataFrame:
    """The tiles of received messages (see ``as_messages``)."""
    entries = messages.select("window_start", "window_end", F.explode("trending").alias("event_name", "entry"))
    return live_tiles(entries.select("window_start", "window_end", "event_name", "entry.*"))


def table_of_messages(messages: DataFrame, event_name: str) -> DataFrame:
    """The display table of received messages."""
    items = F.posexplode(F.col("trending")[event_name]["top10"])
    return top_table(messages.select("window_start", "window_end", items.alias("pos", "t")).select(
        "window_start", "window_end", F.lit(event_name).alias("event_name"), (F.col("pos") + 1).alias("rank"),
        "t.*"), event_name)
