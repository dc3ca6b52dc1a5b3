"""Streams against the batch operators, over files that arrive one after the other."""

import pytest
from pyspark.sql import functions as F

from clickloom.operators.abandonment import abandoned_carts, abandonment_totals
from clickloom.operators.funnel import funnel
from clickloom.operators.sliding import Sliding
from clickloom.operators.trending import top_products, trending_totals
from clickloom.session import work_path
from clickloom.sources import messages, readers, sinks
from clickloom.streaming import jobs, panes
from events import SCHEMA, make_events, random_rows, same
from test_enrich import plan_of

SHAPE = Sliding(600, 60)
FAR = "2024-01-03 12:00:00"


class Feed:
    """A folder of message files and the typed stream over it."""

    def __init__(self, spark):
        self.spark, self.path = spark, work_path(spark, "feed")

    def publish(self, *rows):
        sinks.publish_folder(make_events(self.spark, rows).coalesce(1), self.path)

    def raw(self):
        return readers.message_folder(self.spark, self.path, files_per_batch=1)

    def events(self):
        return messages.good_events(messages.parse_messages(self.raw()))

    def batch(self):
        received = readers.message_folder(self.spark, self.path, streaming=False)
        return messages.good_events(messages.parse_messages(received))


@pytest.fixture
def feed(spark):
    return Feed(spark)


def drained(spark, rows, path=None):
    path = path or work_path(spark, "out")
    sinks.drain(sinks.append_table_stream(rows, path, f"{path}-checkpoint"))
    return spark.read.schema(rows.schema).parquet(path)


def in_order(rows, parts):
    rows = sorted(rows, key=lambda r: r[2])
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def closed(df, end):
    return df.where(F.col("window_end") <= F.lit(end).cast("timestamp"))


def test_funnel_stream_equals_batch(spark, feed):
    for part in in_order(random_rows(1, 240, sessions=8, products=4, hours=2, hot=0.3), 3):
        feed.publish(*part)
    expected = funnel(feed.batch(), SHAPE)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    out = drained(spark, jobs.funnel_stream(feed.events(), SHAPE))
    assert same(out, closed(expected, FAR))


def test_each_window_comes_once_and_open_windows_wait(spark, feed):
    feed.publish(("a", "BOOKING", "00:00:30", 1.0, 1.0, 1.0))
    feed.publish(("b", "BOOKING", "00:05:30", 1.0, 1.0, 1.0))
    out = drained(spark, jobs.funnel_stream(feed.events(), SHAPE))
    ends = sorted(str(r.window_end)[11:16] for r in out.collect())
    assert ends == ["00:01", "00:02", "00:03", "00:04", "00:05"]


def test_restart_goes_on_where_it_stopped(spark, feed):
    path = work_path(spark, "restart")
    feed.publish(("a", "BOOKING", "00:00:30", 1.0, 1.0, 1.0))
    drained(spark, jobs.funnel_stream(feed.events(), SHAPE), path)
    feed.publish(("a", "BOOKING", "00:04:30", 1.0, 1.0, 1.0))
    expected = funnel(feed.batch(), SHAPE)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    assert same(drained(spark, jobs.funnel_stream(feed.events(), SHAPE), path), expected)


def test_late_events_are_dropped_unless_awaited(spark, feed):
    feed.publish(("a", "BOOKING", "01:00:30", 1.0, 1.0, 1.0))
    # Spark compares late events with the watermark that held one micro-batch earlier.
    feed.publish(("a", "BOOKING", "01:00:31", 1.0, 1.0, 1.0))
    feed.publish(("late", "BOOKING", "00:30:30", 1.0, 1.0, 1.0))
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    strict = drained(spark, jobs.funnel_stream(feed.events(), SHAPE))
    patient = drained(spark, jobs.funnel_stream(feed.events(), SHAPE, delay=3600))
    assert (strict.count(), patient.count()) == (10, 20)


def test_publish_time_can_replace_event_time(spark, feed):
    feed.publish(("a", "BOOKING", "00:00:30", 1.0, 1.0, 1.0),
                 ("b", "NOOP", FAR, 1.0, 1.0, 1.0))
    shifted = feed.events().withColumn("arrived", F.col("event_time") + F.expr("INTERVAL 1 DAY"))
    out = drained(spark, jobs.funnel_stream(shifted, SHAPE, time_col="arrived"))
    assert {str(r.window_end)[:10] for r in out.collect()} == {"2024-01-02"}


def test_top_products_stream_equals_batch(spark, feed):
    for part in in_order(random_rows(2, 300, sessions=5, products=30, hours=2, hot=0.3), 3):
        feed.publish(*part)
    expected = top_products(feed.batch(), SHAPE, k=3)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    path = work_path(spark, "top")
    writer = jobs.top_products_writer(feed.events(), path, f"{path}-checkpoint", SHAPE, k=3)
    sinks.drain(writer)
    assert same(spark.read.parquet(path).drop("batch"), expected)


def test_abandonment_stream_equals_batch(spark, feed):
    for part in in_order(random_rows(3, 300, sessions=6, products=3, hours=6), 3):
        feed.publish(*part)
    expected = abandonment_totals(abandoned_carts(feed.batch()), SHAPE)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    assert same(drained(spark, jobs.abandonment_stream(feed.events(), SHAPE)), expected)


def test_abandonment_stream_with_live_windows(spark, feed):
    feed.publish(("s", "ADD_TO_CART", "00:00:30", 1.0, 2.0, 5.0))
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    rows = drained(spark, jobs.abandonment_stream(feed.events())).collect()
    assert len(rows) == 360 and {r.total_lost_sales for r in rows} == {10.0}


@pytest.mark.parametrize("job", [
    lambda e: jobs.abandoned_stream(e).drop("session"),
    lambda e: jobs.product_stream(e, SHAPE),
])
def test_filtered_events_advance_the_watermark(spark, feed, job):
    feed.publish(("s", "ADD_TO_CART", "00:00:30", 1.0, 2.0, 5.0))
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    assert not drained(spark, job(feed.events())).isEmpty()
    plan = plan_of(job(feed.events()), "extended").split("== Optimized Logical Plan ==")[1]
    above, below = plan.split("EventTimeWatermark", 1)
    assert "ADD_TO_CART" in above and "Filter" in above


def test_zoneless_time_becomes_a_watermark(spark):
    """Parquet times without a zone cannot carry a watermark; the adapter casts them."""
    from clickloom.sources.adapters import as_clickstream
    path = work_path(spark, "ntz")
    spark.sql("""SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:30' AS ts,
        1L AS user_id, 'view' AS event_type, 1.0D AS value, '{"k": 1}' AS props
        UNION ALL SELECT 2L, TIMESTAMP_NTZ '2024-01-02 00:00:00', 1L, 'x', 1.0D, '{"k": 1}'
        """).coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    stream = as_clickstream(readers.table_folder(spark, path, schema))
    assert drained(spark, jobs.funnel_stream(stream, SHAPE)).count() == 10


def test_enriched_history_stream(spark, feed):
    feed.publish(("s", "BOOKING", "2024-01-01 23:59:59", 1.0, 1.0, 1.0, 7))
    feed.publish(("s", "BOOKING", "2024-01-02 00:00:00", 2.0, 1.0, 1.0, 8))
    customers = spark.createDataFrame([(7, "F")], "customer_id BIGINT, gender STRING")
    products = spark.createDataFrame([(1, "Fall")], "product_id BIGINT, season STRING")
    for salts in (1, 4):
        path = work_path(spark, "history")
        stream = jobs.enriched_stream(feed.events(), customers, products, salts)
        sinks.drain(sinks.append_history_stream(stream, path, f"{path}-checkpoint"))
        rows = {r.customer_id: r for r in readers.history(spark, path).collect()}
        assert (rows[7].gender, rows[7].season, str(rows[7].event_date)) == (
            "F", "Fall", "2024-01-01")
        assert rows[8].gender is None and rows[8].event_time == "2024-01-02 00:00:00"


def test_dead_letters_stream_to_their_own_table(spark, feed):
    feed.publish(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0))
    spark.createDataFrame([("not json",)], "value STRING").write.mode("append").text(feed.path)
    letters = messages.dead_letters(messages.parse_messages(feed.raw()))
    assert [tuple(r) for r in drained(spark, letters).collect()] == [("not json", "bad_json")]
    assert feed.batch().count() == 1


def test_metrics_are_published_as_messages(spark, feed):
    feed.publish(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0), ("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    path = work_path(spark, "topic")
    metrics = jobs.funnel_stream(feed.events(), Sliding(60, 60))
    sinks.drain(sinks.publish_stream(metrics, f"{path}-checkpoint", path=path))
    value = readers.message_folder(spark, path, streaming=False).first().value
    assert value.startswith('{"window_start":"2024-01-01 00:00:00"') and '"session_count":1' in value


def test_repeated_micro_batch_adds_nothing(spark, events):
    captured = {}

    class Writer:
        outputMode = option = lambda self, *a: self

        def foreachBatch(self, function):
            captured["write"] = function
            return self

    class Rows:
        writeStream = Writer()

    path = work_path(spark, "batches")
    sinks.append_batches(Rows(), path, "unused", lambda df: df.select("session_id"))
    batch = events(("a", "BOOKING", "00:00:01", 1.0, 1.0, 1.0))
    captured["write"](batch, 0)
    captured["write"](batch, 0)
    captured["write"](batch, 1)
    assert spark.read.parquet(path).count() == 2


def test_extract_pages_advance_without_gap_or_repeat(spark, events):
    from clickloom.sources.extract import next_checkpoint, next_page
    rows = [("s", "BOOKING" if i % 5 else "NOOP", f"00:00:{i // 4:02d}", 1.0, 1.0, 1.0)
            for i in range(40)]
    source = events(*rows)
    seen, checkpoint = [], ("2023-12-31 00:00:00", "")
    while True:
        page = next_page(source, checkpoint, rows=7)
        ids = [r.event_id for r in page.collect()]
        if not ids:
            break
        seen += ids
        checkpoint = tuple(next_checkpoint(page).first())
    assert seen == [f"{i:06d}" for i in range(40) if i % 5]
    assert tuple(next_checkpoint(source.limit(0)).first()) == (None, None)
    assert "TakeOrderedAndProject" in plan_of(next_page(source, ("2024-01-01", "")))
    assert SCHEMA  # the source has the event schema the sinks expect


@pytest.mark.parametrize("hours,files", [(2, 4), (30, 3)])
def test_windows_from_stored_panes_equal_batch(spark, feed, hours, files):
    rows = random_rows(7, 240, sessions=8, products=15, hours=hours, hot=0.3)
    for part in in_order(rows, files):
        feed.publish(*part)
    sales = feed.batch().where("event_name IN ('ADD_TO_CART', 'BOOKING')")
    expected_funnel = closed(funnel(feed.batch(), SHAPE), FAR)
    expected_top = closed(top_products(sales, SHAPE, k=3), FAR)
    expected_totals = closed(trending_totals(sales, SHAPE), FAR)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    path = work_path(spark, "panes")
    sinks.drain(panes.funnel_writer(feed.events(), f"{path}/f", f"{path}/f-cp", SHAPE))
    assert same(spark.read.parquet(f"{path}/f/funnel").drop("batch"), expected_funnel)
    sinks.drain(panes.trending_writer(feed.events(), f"{path}/t", f"{path}/t-cp", SHAPE, k=3))
    assert same(spark.read.parquet(f"{path}/t/top").drop("batch"), expected_top)
    assert same(spark.read.parquet(f"{path}/t/totals").drop("batch"), expected_totals)


def test_panes_count_late_events_in_open_windows(spark, feed):
    """Two minutes late: windows that the watermark has passed keep their values."""
    def at(minute_second, name="ITEM_DETAIL", session="s1"):
        return (session, name, f"2024-01-01 01:{minute_second}", 1.0, 1.0, 1.0)

    on_time = [at("00:30"), at("03:30"), at("03:31", "BOOKING")]
    feed.publish(*on_time)
    watermark = F.lit("2024-01-01 01:03:31").cast("timestamp")
    expected = funnel(feed.batch(), SHAPE).where(F.col("window_end") <= watermark).collect()
    feed.publish(at("01:30", "BOOKING", "s2"))
    expected += funnel(feed.batch(), SHAPE).where(F.col("window_end") > watermark).collect()
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    path = work_path(spark, "late")
    sinks.drain(panes.funnel_writer(feed.events(), path, f"{path}-cp", SHAPE))
    result = spark.read.parquet(f"{path}/funnel").drop("batch")
    assert {r["window_end"]: r for r in result.collect()} == {r["window_end"]: r for r in expected}


def test_silent_time_closes_windows_and_no_closed_window_reads_empty(spark, feed):
    feed.publish(("s1", "BOOKING", "2024-01-01 01:00:30", 1.0, 2.0, 3.0))
    path = work_path(spark, "silent")
    sinks.drain(panes.trending_writer(feed.events(), path, f"{path}-cp", SHAPE))
    assert spark.read.parquet(f"{path}/top").count() == 0
    feed.publish(("s2", "NOOP", "2024-01-01 01:05:00", 1.0, 1.0, 1.0))
    feed.publish(("s2", "NOOP", "2024-01-01 01:11:00", 1.0, 1.0, 1.0))
    sinks.drain(panes.trending_writer(feed.events(), path, f"{path}-cp", SHAPE))
    assert spark.read.parquet(f"{path}/top").count() == SHAPE.panes
