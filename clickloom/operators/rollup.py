"""Daily summaries of the history: additive figures, and distinct counts that merge.

Sums and counts add up over days. Distinct sessions and buyers do not, so a day keeps them as
bitmaps over dense numbers; the union of the days' bitmaps counts exactly, and a report over
any range of dates reads days, not events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.events import DateLike, event_date, is_purchase, line_amount, named, within_dates
from clickloom.functions.numbers import ratio, settled
from clickloom.operators.historic import LEADERBOARD
from clickloom.schemas import SALES_EVENTS

# What sales are broken down by; coarser breakdowns add these up.
BREAKDOWNS = {
    "device": ("device_type", "traffic_source"),
    "gender": ("gender",),
    "product": ("productDisplayName", "masterCategory", "subCategory"),
    "location": ("home_location_lat", "home_location_long"),
}
# Distinct counts: what is counted, and of which events.
DISTINCTS = {"session_id": None, "customer_id": is_purchase}
# Parts in which new keys are numbered side by side.
_NUMBERING = 256


# Building ---------------------------------------------------------------------------------

def daily_totals(history: DataFrame) -> DataFrame:
    """Per day and event type: events, and of purchases' amounts sum and count."""
    return history.groupBy(event_date(history).alias("event_date"), "event_name").agg(
        F.count("*").alias("events"), F.sum(line_amount()).alias("revenue"),
        F.count(line_amount()).alias("priced"))


def daily_sales(history: DataFrame) -> DataFrame:
    """Purchases per day and breakdown, all of them from one scan and one shuffle.

    ``breakdown`` names it; the columns of the others are NULL in its rows.
    """
    keys = list(dict.fromkeys(k for columns in BREAKDOWNS.values() for k in columns))
    day = event_date(history).alias("event_date")
    rows = history.where(is_purchase()).select(day, *keys, line_amount().alias("line"), "quantity")
    sets = [["event_date", *columns] for columns in BREAKDOWNS.values()]
    # A column that a grouping set leaves out is marked 1, so a breakdown is known by its own.
    own = {name: F.grouping(columns[0]) + sum((F.lit(1) - F.grouping(k) for k in keys if k not in columns), F.lit(0))
           for name, columns in BREAKDOWNS.items()}
    name = F.coalesce(*[F.when(off == 0, n) for n, off in own.items()])
    return rows.groupingSets(sets, "event_date", *keys).agg(
        name.alias("breakdown"), F.sum("line").alias("sales"), F.sum("quantity").alias("quantity"))


def new_keys(history: DataFrame, key: str, known: DataFrame, start: int) -> DataFrame:
    """``key, id``: the keys that ``known`` (key, id) does not have, numbered from ``start``
    without gaps. The numbers depend on the set of keys alone, not on order or partitioning."""
    fresh = history.where(F.col(key).isNotNull()).select(key).distinct().join(known, key, "left_anti")
    part = F.pmod(F.xxhash64(key), F.lit(_NUMBERING))
    sizes = fresh.groupBy(part.alias("part")).agg(F.count("*").alias("size")).orderBy("part").collect()
    first, at = [], start
    for row in sizes:  # at most 256 parts
        first.append((row["part"], at))
        at += row["size"]
    begins = history.sparkSession.createDataFrame(first, "part BIGINT, begin BIGINT")
    numbered = fresh.withColumn("part", part).selectExpr(
        f"`{key}`", "part", f"row_number() OVER (PARTITION BY part ORDER BY `{key}`) - 1 AS nth")
    return numbered.join(F.broadcast(begins), "part").select(key, (F.col("begin") + F.col("nth")).alias("id"))


def daily_bitmaps(history: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``event_date, bucket, bitmap`` of the ids of ``key`` among each day's events."""
    wanted = DISTINCTS[key]
    rows = history.where(wanted()) if wanted else history
    days = rows.select(event_date(rows).alias("event_date"), key).distinct().join(ids, key)
    return days.groupBy("event_date", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


# Reports over the summaries ------------------------------------------------------------------

def distinct_count(bitmaps: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """One number: the distinct ids of the range."""
    merged = within_dates(bitmaps, start, end).groupBy("bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("distinct_ids"))


def key_figures(totals: DataFrame, sessions: DataFrame, buyers: DataFrame,
                start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """The five key figures, as ``historic.key_figures`` has them."""
    bought = within_dates(totals, start, end).agg(
        F.coalesce(F.sum(F.when(is_purchase(), F.col("events"))), F.lit(0)).alias("purchases"),
        F.sum(F.when(is_purchase(), F.col("revenue"))).alias("revenue"),
        F.sum(F.when(is_purchase(), F.col("priced"))).alias("priced"))
    buyer_count = distinct_count(buyers, start, end).scalar()
    session_count = distinct_count(sessions, start, end).scalar()
    revenue = F.col("revenue")
    return bought.select(
        F.col("purchases").alias("total_purchases"),
        ratio(buyer_count * 100.0, session_count).alias("conversion_rate"),
        settled(revenue).alias("total_revenue"),
        settled(ratio(revenue, F.col("priced"))).alias("average_order_value"),
        settled(ratio(revenue, buyer_count)).alias("revenue_per_user"))


def daily_event_counts(totals: DataFrame, start: DateLike | None = None,
                       end: DateLike | None = None) -> DataFrame:
    return within_dates(totals, start, end).where(named(*SALES_EVENTS)).groupBy(
        "event_date", "event_name").agg(F.sum("events").alias("total_users")).orderBy("event_date", "event_name")


def sales_by(sales: DataFrame, breakdown: str, columns: tuple[str, ...] | None = None,
             start: DateLike | None = None, end: DateLike | None = None, whole: bool = False,
             digits: int = 6) -> DataFrame:
    """Sales and quantity per ``columns`` of a breakdown, by default all of it; ``whole`` takes
    every date there is."""
    rows = sales.where(F.col("breakdown") == breakdown)
    rows = rows if whole else within_dates(rows, start, end)
    return rows.groupBy(*(columns or BREAKDOWNS[breakdown])).agg(
        F.sum("quantity").alias("total_quantity"), F.round(F.sum("sales"), digits).alias("total_sales"))


def top_sold_products(sales: DataFrame, start: DateLike | None = None, end: DateLike | None = None,
                      k: int = LEADERBOARD) -> DataFrame:
    keys = BREAKDOWNS["product"]
    return sales_by(sales, "product", None, start, end).select(*keys, "total_quantity", "total_sales").orderBy(
        F.desc("total_sales"), *keys).limit(k)

