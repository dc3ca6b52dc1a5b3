"""Small hand-written click streams."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = """session_id STRING, event_name STRING, event_time STRING, product_id DOUBLE,
    quantity DOUBLE, price_usd DOUBLE, customer_id BIGINT, event_id STRING"""


def make_events(spark: SparkSession, rows) -> DataFrame:
    """Rows of (session, event, time, product, quantity, price[, customer[, event id]]);
    a bare time of day falls on 2024-01-01."""
    full = []
    for i, row in enumerate(rows):
        session, name, time, product, quantity, price, *rest = row
        time = time if len(time) > 15 else f"2024-01-01 {time}"
        customer = rest[0] if rest else None
        event_id = rest[1] if len(rest) > 1 else f"{i:06d}"
        full.append((session, name, time, product, quantity, price, customer, event_id))
    return spark.createDataFrame(full, SCHEMA).withColumn(
        "event_time", F.col("event_time").cast("timestamp"))


def random_rows(seed: int, count: int, sessions: int, products: int, hours: int,
                hot: float = 0.0):
    """``hot`` is the share of rows that go to one session and one product."""
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        second = rng.randrange(hours * 3600)
        is_hot = rng.random() < hot
        rows.append((
            "s-hot" if is_hot else f"s{rng.randrange(sessions)}",
            rng.choice(["ITEM_DETAIL", "ADD_TO_CART", "BOOKING", "NOOP"]),
            f"2024-01-{1 + second // 86400:02d} {second // 3600 % 24:02d}:"
            f"{second // 60 % 60:02d}:{second % 60:02d}.{rng.randrange(1000000):06d}",
            -1.0 if is_hot else float(rng.randrange(products)),
            float(rng.randrange(1, 4)), rng.randrange(1, 5000) / 100,
        ))
    return rows


def same(left: DataFrame, right: DataFrame) -> bool:
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
