"""Reports over the enriched history.

``start`` and ``end`` are inclusive dates; ``None`` means the last 30 days up to today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.events import (
    DateLike,
    count_where,
    event_date,
    is_purchase,
    line_amount,
    named,
    within_dates,
)
from clickloom.functions.numbers import dollars, percent_text, ratio, settled
from clickloom.schemas import SALES_EVENTS

# The leaderboard's length and the labels of the key figures.
LEADERBOARD = 25
TILES = ("Total eComm Purchases", "Conversion Rate", "Purchase Revenue",
         "Average Order Value", "Revenue per User")


def _purchases(history: DataFrame, start: DateLike | None, end: DateLike | None) -> DataFrame:
    return within_dates(history, start, end).where(is_purchase())


def _sales() -> Column:
    return settled(F.sum(line_amount())).alias("total_sales")


# Key figures -------------------------------------------------------------------------

def total_purchases(history: DataFrame, start: DateLike | None = None,
                    end: DateLike | None = None) -> DataFrame:
    return _purchases(history, start, end).agg(F.count("*").alias("total_purchases"))


def conversion_rate(history: DataFrame, start: DateLike | None = None,
                    end: DateLike | None = None) -> DataFrame:
    """Buying customers per session in percent: customers over sessions, as published."""
    rows = _sessions(within_dates(history, start, end))
    buyers = F.count_distinct(F.when(F.col("purchases") > 0, F.col("customer_id")))
    return rows.agg(ratio(buyers * 100.0, F.count_distinct("session_id"))
                    .alias("conversion_rate"))


def purchase_revenue(history: DataFrame, start: DateLike | None = None,
                     end: DateLike | None = None) -> DataFrame:
    return _purchases(history, start, end).agg(settled(F.sum(line_amount()))
                                               .alias("total_revenue"))


def average_order_value(history: DataFrame, start: DateLike | None = None,
                        end: DateLike | None = None) -> DataFrame:
    """Per booking row, not per booking id."""
    return _purchases(history, start, end).agg(settled(F.avg(line_amount()))
                                               .alias("average_order_value"))


def revenue_per_user(history: DataFrame, start: DateLike | None = None,
                     end: DateLike | None = None) -> DataFrame:
    per_user = _purchases(history, start, end).groupBy("customer_id").agg(
        F.sum(line_amount()).alias("revenue"))
    return per_user.agg(settled(ratio(F.sum("revenue"), F.count("customer_id")))
                        .alias("revenue_per_user"))


def _sessions(rows: DataFrame) -> DataFrame:
    """Events folded per (session, customer); a distinct count then copies folded rows
    for its expansion, not events."""
    bought = F.when(is_purchase(), line_amount())
    return rows.groupBy("session_id", "customer_id").agg(
        count_where(is_purchase()).alias("purchases"),
        F.sum(bought).alias("revenue"), F.count(bought).alias("priced"))


def key_figures(history: DataFrame, start: DateLike | None = None,
                end: DateLike | None = None) -> DataFrame:
    """All five key figures in one row from one scan."""
    buyers = F.count_distinct(F.when(F.col("purchases") > 0, F.col("customer_id")))
    totals = _sessions(within_dates(history, start, end)).agg(
        F.sum("purchases").alias("purchases"), F.sum("revenue").alias("revenue"),
        F.sum("priced").alias("priced"), buyers.alias("buyers"),
        F.count_distinct("session_id").alias("sessions"))
    revenue = F.col("revenue")
    return totals.select(
        F.coalesce("purchases", F.lit(0)).alias("total_purchases"),
        ratio(F.col("buyers") * 100.0, F.col("sessions")).alias("conversion_rate"),
        settled(revenue).alias("total_revenue"),
        settled(ratio(revenue, F.col("priced"))).alias("average_order_value"),
        settled(ratio(revenue, F.col("buyers"))).alias("revenue_per_user"))


def key_figure_tiles(figures: DataFrame) -> DataFrame:
    """The key figures as labelled, formatted tiles; every tile but the rate is money."""
    texts = [
        dollars(F.col("total_purchases").cast("double"), True),
        percent_text(F.col("conversion_rate")),
        dollars(F.col("total_revenue"), True),
        dollars(F.col("average_order_value"), True),
        dollars(F.col("revenue_per_user"), True),
    ]
    rows = F.array(*[F.struct(F.lit(label).alias("label"), text.alias("value"))
                     for label, text in zip(TILES, texts, strict=True)])
    return figures.select(F.explode(rows).alias("t")).select("t.*")


# Breakdowns --------------------------------------------------------------------------

def sales_by_device_and_source(history: DataFrame) -> DataFrame:
    """Over the whole history."""
    return history.where(is_purchase()).groupBy("device_type", "traffic_source").agg(
        F.round(F.sum(line_amount()), 2).alias("total_sales"))


def sales_by_gender(history: DataFrame) -> DataFrame:
    """Over the whole history."""
    return history.where(is_purchase()).groupBy("gender").agg(_sales())


def daily_event_counts(history: DataFrame, start: DateLike | None = None,
                       end: DateLike | None = None) -> DataFrame:
    rows = within_dates(history, start, end).where(named(*SALES_EVENTS))
    return (
        rows.groupBy(event_date(rows).alias("event_date"), "event_name")
        .agg(F.count("*").alias("total_users")).orderBy("event_date", "event_name")
    )


def sales_by_category(history: DataFrame, start: DateLike | None = None,
                      end: DateLike | None = None) -> DataFrame:
    return (
        _purchases(history, start, end).groupBy("masterCategory", "subCategory")
        .agg(_sales()).orderBy(F.desc("total_sales"), "masterCategory", "subCategory")
    )


def top_sold_products(history: DataFrame, start: DateLike | None = None,
                      end: DateLike | None = None, k: int = LEADERBOARD) -> DataFrame:
    keys = ["productDisplayName", "masterCategory", "subCategory"]
    return (
        _purchases(history, start, end).groupBy(*keys)
        .agg(F.sum("quantity").alias("total_quantity"), _sales())
        .orderBy(F.desc("total_sales"), *keys).limit(k)
    )


def sales_by_location(history: DataFrame, start: DateLike | None = None,
                      end: DateLike | None = None) -> DataFrame:
    return _purchases(history, start, end).groupBy(
        "home_location_lat", "home_location_long"
    ).agg(F.round(F.sum(line_amount()), 2).alias("total_sales"))


# What the charts derive from a breakdown -----------------------------------------------

def with_subtotals(breakdown: DataFrame, outer: str, inner: str) -> DataFrame:
    """A two-level breakdown with its subtotals and grand total (``level`` 0, 1, 2).

    It rolls up the finished breakdown, a few rows, and not the events again.
    """
    return breakdown.rollup(outer, inner).agg(
        settled(F.sum("total_sales")).alias("total_sales"),
        F.when(F.grouping(outer) == 1, 2).otherwise(F.grouping(inner)).cast("int")
        .alias("level"))


def with_share(breakdown: DataFrame) -> DataFrame:
    """Each row's share of the total, which is one number from a sum over all tasks."""
    total = breakdown.agg(F.sum("total_sales")).scalar()
    return breakdown.withColumn("share", F.round(ratio(F.col("total_sales"), total), 6))


def axis_bounds(leaderboard: DataFrame) -> DataFrame:
    """Axis limits of the leaderboard chart."""
    sales, quantity = "total_sales", "total_quantity"
    return leaderboard.agg(
        (F.min(quantity) - 5).alias("x_min"), (F.max(quantity) + 5).alias("x_max"),
        (F.min(sales) - 50).alias("y_min"), (F.max(sales) + 50).alias("y_max"))
