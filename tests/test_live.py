"""Carried state: several micro-batches, late events, restarts and repeated batches."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickloom.operators import enrich
from clickloom.operators.abandonment import abandoned_carts, abandonment_totals
from clickloom.operators.latest import newest_fields
from clickloom.operators.sliding import Sliding
from clickloom.operators.trending import top_products
from clickloom.session import work_path
from clickloom.sources import dimensions, messages, readers, replay, sinks
from clickloom.streaming import accounts, carts, jobs, latest, panes
from events import random_rows, same
from test_enrich import plan_of
from test_streaming import FAR, Feed, closed, in_order

SHAPE = Sliding(600, 60)


@pytest.fixture
def feed(spark):
    return Feed(spark)


def result(spark, path):
    return spark.read.parquet(path).drop("batch")


def fails_once(monkeypatch, module, name, at):
    """The ``at``-th call of ``module.name`` fails after its work is done."""
    real, calls = getattr(module, name), []

    def broken(*args, **kw):
        value = real(*args, **kw)
        calls.append(1)
        if len(calls) == at:
            raise RuntimeError("lost")
        return value

    monkeypatch.setattr(module, name, broken)


def drain_with_a_loss(writer):
    """The first run breaks off, the second repeats its last micro-batch and goes on."""
    with pytest.raises(StreamingQueryException):
        sinks.drain(writer())
    sinks.drain(writer())


# The last known numbers -----------------------------------------------------------------------

def test_missing_numbers_keep_their_last_value(spark):
    rows = spark.createDataFrame(
        [(1, 5, 3, None), (2, 6, None, 3), (3, None, None, None), (2, 9, None, None)],
        "at INT, a INT, b INT, c INT")
    assert tuple(newest_fields(rows, ["a", "b", "c"], "at").first()) == (9, 3, 3)
    assert tuple(newest_fields(rows.limit(0), ["a"], "at").first()) == (None,)
    keyed = rows.withColumn("k", F.col("at") % 2)
    found = newest_fields(keyed, ["a", "b", "c"], "at", ("k",)).collect()
    assert {tuple(r) for r in found} == {(1, 5, 3, None), (0, 9, None, 3)}


def test_latest_state_merges_partial_messages(spark):
    path = work_path(spark, "latest")
    spark.createDataFrame([], "value STRING").write.text(f"{path}/feed")

    def publish(*values):
        spark.createDataFrame([(v,) for v in values], "value STRING").write.mode("append").text(f"{path}/feed")
        received = readers.message_folder(spark, f"{path}/feed")
        sinks.drain(latest.latest_writer(latest.decode(received), f"{path}/state", f"{path}/cp"))
        return tuple(latest.latest_state(spark, f"{path}/state").first())

    at = '"window_end":"2024-01-01 0%d:00:00"'
    assert publish("not json") == (0, 0, 0)
    assert publish('{%s,"session_count":5,"add_to_cart_count":3,"purchase_count":2}' % (at % 1)) == (5, 3, 2)
    assert publish('{%s,"session_count":6}' % (at % 3), '{%s,"purchase_count":null}' % (at % 3)) == (6, 3, 2)
    # behind a newer value, but the newest of another number
    assert publish('{%s,"session_count":99,"add_to_cart_count":4}' % (at % 2)) == (6, 4, 2)
    assert len(spark.read.parquet(f"{path}/state").collect()) == 2


# Carried carts -----------------------------------------------------------------------------------

def cart_writer(feed, path, **kw):
    return carts.abandonment_writer(feed.events(), path, f"{path}/cp", SHAPE, **kw)


@pytest.mark.parametrize("seed,hours,parts", [(3, 6, 3), (9, 1, 4)])
def test_carried_carts_equal_batch(spark, feed, seed, hours, parts):
    path = work_path(spark, "carts")
    for part in in_order(random_rows(seed, 400, sessions=6, products=3, hours=hours, hot=0.34), parts):
        feed.publish(*part)
        sinks.drain(cart_writer(feed, path))
    expected = abandoned_carts(feed.batch())
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    sinks.drain(cart_writer(feed, path))
    assert same(result(spark, f"{path}/carts"), expected)
    assert same(result(spark, f"{path}/totals"), closed(abandonment_totals(expected, SHAPE), FAR))
    books = accounts.accounts(spark, path).orderBy("batch_id").collect()
    assert [b.batch_id for b in books] == list(range(parts + 1))
    assert sum(b.events for b in books) == sum(b.on_time for b in books) == 401


def test_a_session_goes_on_over_micro_batches(spark, feed):
    path = work_path(spark, "carts")
    for minute in (0, 8, 16):  # each add four minutes after the one before, two to a file
        feed.publish(*[("s", "ADD_TO_CART", f"00:{m:02d}:00", 1.0, 1.0, float(10 + m)) for m in (minute, minute + 4)],
                     *[("t", "ADD_TO_CART", "00:21:00", 1.0, 2.0, 3.0)][:minute // 16])
    sinks.drain(cart_writer(feed, path))
    open_now = spark.read.parquet(f"{path}/open/slot=0")  # the third micro-batch is number 2
    assert {(r.session_id, str(r.started)[11:16], str(r.last_seen)[11:16]) for r in open_now.collect()} == {
        ("s", "00:00", "00:20"), ("t", "00:21", "00:21")}
    assert result(spark, f"{path}/carts").isEmpty()
    feed.publish(("t", "BOOKING", "00:22:00", 1.0, 2.0, 3.0))
    feed.publish(("x", "NOOP", "00:25:00", 1.0, 1.0, 1.0))
    sinks.drain(cart_writer(feed, path))
    assert [(r.session_id, r.lost_sale) for r in result(spark, f"{path}/carts").collect()] == [("s", 10.0)]


def test_late_events_are_booked_and_kept_apart(spark, feed):
    path = work_path(spark, "carts")
    feed.publish(("a", "ADD_TO_CART", "01:00:00", 1.0, 1.0, 7.0))
    feed.publish(("a", "BOOKING", "00:58:00", 1.0, 1.0, 7.0), ("b", "ADD_TO_CART", "00:59:30", 1.0, 1.0, 5.0),
                 ("c", "NOOP", "00:40:00", 1.0, 1.0, 5.0))
    feed.publish(("x", "NOOP", "03:00:00", 1.0, 1.0, 1.0))
    sinks.drain(cart_writer(feed, path, delay=60))
    # a minute's delay lets the second cart in; the booking is too late to clear the first
    assert {r.session_id for r in result(spark, f"{path}/carts").collect()} == {"a", "b"}
    assert {r.session_id for r in result(spark, f"{path}/late").collect()} == {"a", "c"}
    books = [tuple(r) for r in accounts.accounts(spark, path).orderBy("batch_id").collect()]
    assert books == [(0, 1, 1, 0, 0), (1, 3, 1, 2, 0), (2, 1, 1, 0, 0)]


@pytest.mark.parametrize("at", [2, 6])
def test_carts_survive_a_repeated_micro_batch(spark, feed, monkeypatch, at):
    path = work_path(spark, "carts")
    for part in in_order(random_rows(5, 200, sessions=4, products=2, hours=3), 3):
        feed.publish(*part)
    expected = abandoned_carts(feed.batch())
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    fails_once(monkeypatch, carts, "carry", at)
    drain_with_a_loss(lambda: cart_writer(feed, path))
    assert same(result(spark, f"{path}/carts"), expected)
    assert same(result(spark, f"{path}/totals"), closed(abandonment_totals(expected, SHAPE), FAR))
    assert accounts.accounts(spark, path).agg(F.sum("events")).first()[0] == 201


def test_nothing_to_read_is_an_empty_table(spark, feed):
    path = work_path(spark, "carts")
    spark.createDataFrame([], "value STRING").write.text(feed.path)
    sinks.drain(cart_writer(feed, path))
    assert result(spark, f"{path}/carts").isEmpty() and result(spark, f"{path}/totals").isEmpty()
    sinks.drain(panes.trending_writer(feed.events(), f"{path}/t", f"{path}/t/cp", SHAPE))
    assert result(spark, f"{path}/t/top").isEmpty() and result(spark, f"{path}/t/totals").isEmpty()
    feed.publish(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0))
    sinks.drain(panes.trending_writer(feed.events(), f"{path}/t", f"{path}/t/cp", SHAPE))
    assert result(spark, f"{path}/t/top").isEmpty()


# Stored panes ----------------------------------------------------------------------------------

def test_old_panes_are_dropped_and_windows_stay_whole(spark, feed):
    path, shape = work_path(spark, "panes"), Sliding(60, 10)  # a stretch is 24 minutes
    rows = random_rows(4, 200, sessions=5, products=8, hours=5)
    for part in in_order(rows, 4):
        feed.publish(*part)
    sales = feed.batch().where("event_name IN ('ADD_TO_CART', 'BOOKING')")
    expected = closed(top_products(sales, shape, k=3), FAR)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    sinks.drain(panes.trending_writer(feed.events(), path, f"{path}/cp", shape, k=3))
    assert same(result(spark, f"{path}/top"), expected)
    stretches = spark.read.parquet(f"{path}/panes").select("stretch").distinct().count()
    assert stretches <= 3


def test_panes_survive_a_repeated_micro_batch(spark, feed, monkeypatch):
    path = work_path(spark, "panes")
    for part in in_order(random_rows(6, 200, sessions=5, products=8, hours=2), 2):
        feed.publish(*part)
    sales = feed.batch().where("event_name IN ('ADD_TO_CART', 'BOOKING')")
    expected = closed(top_products(sales, SHAPE, k=3), FAR)
    feed.publish(("s", "NOOP", FAR, 1.0, 1.0, 1.0))
    fails_once(monkeypatch, panes, "carry", 2)
    drain_with_a_loss(lambda: panes.trending_writer(feed.events(), path, f"{path}/cp", SHAPE, k=3))
    assert same(result(spark, f"{path}/top"), expected)


def test_engine_reports_rows_behind_the_watermark(spark, feed):
    feed.publish(("a", "BOOKING", "01:00:30", 1.0, 1.0, 1.0))
    feed.publish(("a", "BOOKING", "01:00:31", 1.0, 1.0, 1.0))
    feed.publish(("late", "BOOKING", "00:30:30", 1.0, 1.0, 1.0))
    path = work_path(spark, "plain")
    query = sinks.drain(sinks.append_table_stream(
        jobs.abandoned_stream(feed.events()).drop("session"), path, f"{path}-cp"))
    reports = accounts.engine_accounts(query)
    assert sum(rows for _, rows, _ in reports) == 3 and sum(dropped for *_, dropped in reports) == 1


# The replay loop -------------------------------------------------------------------------------

def test_replay_stops_and_resumes_without_gap_or_repeat(spark, events, monkeypatch):
    rows = [("s", "BOOKING" if i % 5 else "NOOP", f"00:00:{i // 4:02d}", 1.0, 1.0, 1.0) for i in range(40)]
    source = events(*rows)
    source = source.unionByName(source.limit(1).withColumn("event_time", F.lit(None).cast("timestamp")))
    path = work_path(spark, "replay")
    assert replay.replay(source, path, rows=7, pages=2) == 2
    with monkeypatch.context() as patch:  # a page is published, its checkpoint is lost
        patch.setattr(spark, "createDataFrame", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            replay.replay(source, path, rows=7, pages=1)
    assert replay.replay(source, path, rows=7) == 3
    assert replay.replay(source, path, rows=7) == 0
    received = readers.message_folder(spark, replay.feed(path), streaming=False)
    parsed = messages.good_events(messages.parse_messages(received))
    seen = [r.event_id for r in parsed.orderBy("event_id").collect()]
    assert seen == [f"{i:06d}" for i in range(40) if i % 5]
    stream = messages.good_events(messages.parse_messages(
        readers.message_folder(spark, replay.feed(path)))).select("event_id")
    out = work_path(spark, "replayed")
    sinks.drain(sinks.append_table_stream(stream, out, f"{out}-cp"))
    assert spark.read.parquet(out).count() == len(seen)


def test_replay_keeps_keys_whole_in_jobs_that_do_not_grow_with_the_pages(spark, events):
    rows = [("s", "BOOKING", f"00:{i // 60:02d}:{i % 60:02d}", 1.0, 1.0, 1.0) for i in range(120)]
    source = events(*rows)
    source = source.unionByName(source.where("event_id IN ('000002', '000003')"))  # keys of two events
    path, context = work_path(spark, "replay-jobs"), spark.sparkContext
    context.setJobGroup("replay-jobs", "replay")
    try:
        assert replay.replay(source, path, rows=3) == 41
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("replay-jobs")) < 41
    sizes = {r["page"]: r["count"] for r in spark.read.text(replay.feed(path)).groupBy("page").count().collect()}
    assert sizes == {0: 4, 1: 3, 40: 1} | {page: 3 for page in range(2, 40)}


# Frozen dimensions --------------------------------------------------------------------------------

def test_frozen_dimension_is_joined_where_it_lies(spark, feed):
    customers = spark.createDataFrame(
        [(7, "F", 1), (7, "M", 2), (8, "M", 1), (None, "x", 1)], "customer_id INT, gender STRING, version INT")
    frozen = dimensions.freeze(customers, "customer_id", "bigint", 2, newest_by="version").drop("version")
    feed.publish(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0, 7), ("t", "BOOKING", "00:00:02", 1.0, 1.0, 1.0),
                 ("u", "BOOKING", "00:00:03", 1.0, 1.0, 1.0, 9))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(enrich.lookup(feed.batch(), frozen, "customer_id", frozen=True))
        path = work_path(spark, "frozen")
        stream = enrich.lookup(feed.events(), frozen, "customer_id", frozen=True)
        sinks.drain(sinks.append_table_stream(stream, path, f"{path}-cp"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Aggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert {(r.session_id, r.gender) for r in spark.read.parquet(path).collect()} == {
        ("s", "M"), ("t", None), ("u", None)}
    again = dimensions.frozen_at(spark, work_path(spark, "none"), frozen.schema, "customer_id", 2)
    assert again.columns == frozen.columns
    with pytest.raises(ValueError):
        enrich.lookup(feed.batch(), frozen.withColumn("customer_id", F.lit("7")), "customer_id", frozen=True)


def test_events_without_a_key_are_dealt_out(spark):
    """Half of the keys are NULL; no task of the join holds all of them."""
    events = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("customer_id"), F.col("id").alias("event_id"))
    customers = dimensions.freeze(
        spark.range(50).select(F.col("id").alias("customer_id"), F.lit("x").alias("gender")), "customer_id", "bigint", 8)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.enabled")}
    for key, value in zip(keep, ("-1", "8", "false"), strict=True):
        spark.conf.set(key, value)
    try:
        joined = enrich.lookup(events, customers, "customer_id", frozen=True).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in joined.where("customer_id IS NULL AND gender IS NULL").groupBy("task").count().collect()]
        assert joined.where("gender IS NULL").count() == 2000
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)
    assert len(sizes) == 8 and max(sizes) < 2 * 2000 / 8


@pytest.mark.parametrize("writer", ["carts", "panes"])
def test_a_micro_batch_is_parsed_once(spark, feed, writer):
    path = work_path(spark, "once")
    # late events too, which the books keep apart
    feed.publish(("a", "ADD_TO_CART", "01:00:00", 1.0, 1.0, 7.0), ("b", "NOOP", "01:01:00", 1.0, 1.0, 5.0))
    feed.publish(("a", "BOOKING", "00:20:00", 1.0, 1.0, 7.0), ("c", "ADD_TO_CART", "01:30:00", 1.0, 1.0, 5.0))
    seen = spark.sparkContext.accumulator(0)

    def counted(quantity):
        seen.add(1)
        return quantity

    once = F.udf(counted, "double")
    events = feed.events().withColumn("quantity", once(F.col("quantity").cast("double")))
    if writer == "carts":
        sinks.drain(carts.abandonment_writer(events, path, f"{path}/cp", SHAPE))
    else:
        sinks.drain(panes.trending_writer(events, path, f"{path}/cp", SHAPE))
    assert seen.value == 4
