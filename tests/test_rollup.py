"""Daily summaries against the reports over events."""

import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickloom.operators import historic, rollup
from clickloom.plans import queries
from clickloom.session import work_path
from clickloom.sources import sinks
from clickloom.streaming import rollups
from events import random_rows, same
from test_enrich import plan_of
from test_streaming import Feed, in_order

RANGE = ("2024-01-01", "2024-01-02")


def attributed(events):
    """Events with the attributes that reports group by, some of them NULL."""
    n = F.col("product_id").cast("bigint")
    return events.drop("traffic_source").select(
        "*", F.lit(1.0).alias("home_location_lat"), (n % 3).cast("double").alias("home_location_long"),
        *[F.when(n % 5 != i, F.concat(F.lit(c[:3]), (n % (i + 2)).cast("string"))).alias(c) for i, c in enumerate(
            ["device_type", "traffic_source", "gender", "productDisplayName", "masterCategory", "subCategory"])])


def rows_with_customers(seed, count, hours):
    rows = random_rows(seed, count, sessions=30, products=9, hours=hours, hot=0.3)
    return [(*r, None if i % 11 == 0 else i % 17) for i, r in enumerate(rows)]


def test_numbers_are_dense_and_depend_on_the_keys_alone(spark, events):
    df = events(*rows_with_customers(1, 300, 40))
    none = spark.createDataFrame([], "session_id STRING, id BIGINT")
    first = rollup.new_keys(df.where("event_time < '2024-01-01 12:00'"), "session_id", none, 0)
    start = first.count()
    assert sorted(r.id for r in first.collect()) == list(range(start))
    more = rollup.new_keys(df, "session_id", first, start)
    again = rollup.new_keys(df.orderBy(F.rand(1)).repartition(5), "session_id", first, start)
    assert same(more, again)
    both = first.unionByName(more).collect()
    assert sorted(r.id for r in both) == list(range(len(both))) and len({r.session_id for r in both}) == len(both)
    assert len(both) == df.select("session_id").distinct().count()


@pytest.mark.parametrize("lose", [0, 1])
def test_rollups_equal_reports_after_a_repeated_batch(spark, monkeypatch, lose):
    feed, path = Feed(spark), work_path(spark, "rollup")
    for part in in_order(rows_with_customers(2, 240, 60), 2):
        feed.publish(*part)
    history = attributed(feed.batch())
    writer = lambda: rollups.rollup_writer(attributed(feed.events()), path, f"{path}/cp")
    if lose:  # the second micro-batch breaks off after its dictionaries and is repeated
        real, calls = rollup.daily_bitmaps, []

        def broken(*args):
            calls.append(1)
            if len(calls) == 6:
                raise RuntimeError("lost")
            return real(*args)

        with monkeypatch.context() as patch:
            patch.setattr(rollup, "daily_bitmaps", broken)
            with pytest.raises(StreamingQueryException):
                sinks.drain(writer())
    sinks.drain(writer())
    totals, sales, sessions, buyers = (rollups.summary(spark, path, t) for t in rollups.TABLES)
    for start, end in (RANGE, ("2024-01-02", "2024-01-03"), ("2025-01-01", "2025-01-02")):
        got = rollup.key_figures(totals, sessions, buyers, start, end).first()
        # a mean may lie half-way between two roundings
        assert tuple(got) == pytest.approx(tuple(historic.key_figures(history, start, end).first()), abs=2e-6)
        assert same(rollup.daily_event_counts(totals, start, end), historic.daily_event_counts(history, start, end))
        assert same(rollup.top_sold_products(sales, start, end), historic.top_sold_products(history, start, end))
        assert same(rollup.sales_by(sales, "product", ("masterCategory", "subCategory"), start, end)
                    .drop("total_quantity"), historic.sales_by_category(history, start, end))
        assert same(rollup.sales_by(sales, "location", None, start, end, digits=2).drop("total_quantity"),
                    historic.sales_by_location(history, start, end))
    assert same(rollup.sales_by(sales, "gender", whole=True).drop("total_quantity"), historic.sales_by_gender(history))
    assert same(rollup.sales_by(sales, "device", whole=True, digits=2).drop("total_quantity"),
                historic.sales_by_device_and_source(history))


def test_reports_read_days_and_not_events(spark):
    path = work_path(spark, "rollup")
    feed = Feed(spark)
    feed.publish(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0, 7))
    sinks.drain(rollups.rollup_writer(attributed(feed.events()), path, f"{path}/cp"))
    totals, _, sessions, buyers = (rollups.summary(spark, path, t) for t in rollups.TABLES)
    plan = plan_of(rollup.key_figures(totals, sessions, buyers, *RANGE), "formatted")
    assert not re.search(r"ReadSchema: [^\n]*(session_id|customer_id|price_usd)", plan)
    assert "bitmap_or_agg" in plan and "PushedFilters: [IsNotNull(event_date)" in plan


def scans(df):
    """Table to columns read."""
    plan = plan_of(df, "formatted")
    found = re.findall(r"Location: \w+ \[[^\]]*?/(\w+)\.parquet\].*?ReadSchema: struct<([^>]*)>", plan, re.S)
    return {table: {c.split(":")[0] for c in columns.split(",") if c} for table, columns in found}


def test_breakdowns_read_only_the_columns_they_use(spark):
    sf_dir, found = "/root/testdata/sf0.001", queries.registered()
    gender = scans(found["sales_by_gender"](spark, sf_dir))
    assert gender["customer"] == {"c_custkey"} and set(gender) == {"events", "customer"}
    category = scans(found["sales_by_category"](spark, sf_dir))
    assert category["part"] == {"p_partkey", "p_type", "p_brand"} and set(category) == {"events", "part"}
    assert set(scans(found["key_figures"](spark, sf_dir))) == {"events"}


def test_a_micro_batch_is_parsed_and_enriched_once(spark):
    path, feed = work_path(spark, "rollup"), Feed(spark)
    feed.publish(*rows_with_customers(3, 60, 10))
    seen = spark.sparkContext.accumulator(0)

    def counted(quantity):
        seen.add(1)
        return quantity

    once = F.udf(counted, "double")
    events = attributed(feed.events()).withColumn("quantity", once(F.col("quantity").cast("double")))
    sinks.drain(rollups.rollup_writer(events, path, f"{path}/cp"))
    assert seen.value == 60
