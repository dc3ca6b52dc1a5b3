"""The registered queries: every operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators import abandonment, enrich, funnel, historic, rollup, trending
from clickloom.operators.sliding import LIVE, Sliding
from clickloom.schemas import ADD_TO_CART, PURCHASE, schema_of
from clickloom.session import work_path
from clickloom.sources import adapters, dimensions, extract, messages, readers, replay, sinks
from clickloom.streaming import accounts, carts, jobs, latest, panes, rollups

Query = Callable[[SparkSession, str], DataFrame]

START, END = "2024-01-05", "2024-01-25"
CHECKPOINT = ("2024-01-10 00:00:00", "")
COARSE = Sliding(size=3600, slide=600)
# The driver's events are sparse; a cart's session there is a matter of hours.
LONG_GAP = 6 * 3600
# Where the message feed is cut into what arrives together; a tenth of the events arrives one
# part late. Carts wait a day for late events.
FEED_EDGES = ("2024-01-08", "2024-01-15", "2024-01-22")
CART_DELAY = 86400

_QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    def zoneless(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Times leave as timestamps without a zone, so they compare as written."""
        result = query(spark, sf_dir)
        return result.select(*[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType)) else f"`{f.name}`"
            for f in result.schema.fields
        ])

    _QUERIES[query.__name__] = zoneless
    return query


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# Inputs --------------------------------------------------------------------------------

def _events(spark, sf_dir):
    return adapters.clickstream(spark, sf_dir)


def _customers(spark, sf_dir):
    return adapters.customer_source(spark, sf_dir)


def _products(spark, sf_dir):
    return readers.product_dimension(adapters.product_source(spark, sf_dir))


def _enriched(spark, sf_dir):
    """The dimensions' keys are primary keys of the driver's tables."""
    return enrich.enrich(_events(spark, sf_dir), _customers(spark, sf_dir),
                         _products(spark, sf_dir), unique=True)


def _event_stream(spark, sf_dir):
    schema = adapters.table(spark, sf_dir, "events").schema
    files = readers.table_folder(spark, sf_dir, schema, pattern="events.parquet")
    return adapters.as_clickstream(files)


def _some_unreadable(spark, sf_dir):
    """The click stream as messages, of which some event types arrive broken."""
    rows = _events(spark, sf_dir)
    fields = F.struct(*[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "event_time" else F.col(c)
        for c in rows.columns
    ])
    text = F.to_json(fields)
    cut = F.substring(text, 1, 40)
    no_time = F.regexp_replace(text, '"event_time":"[^"]*"', '"event_time":"soon"')
    value = (
        F.when(F.col("event_name") == "ERROR", cut)
        .when(F.col("event_name") == "SIGNUP", no_time).otherwise(text)
    )
    return rows.select(value.cast("binary").alias("value"))


# Sources, sinks, projections -------------------------------------------------------------

@_register
def customer_dimension(spark, sf_dir):
    return enrich.temporals_as_text(_customers(spark, sf_dir))


@_register
def product_dimension(spark, sf_dir):
    return _products(spark, sf_dir)


@_register
def incremental_extract(spark, sf_dir):
    page = extract.next_page(_events(spark, sf_dir), CHECKPOINT)
    return page.select("event_time", "event_id", "session_id", "event_name", "price_usd")


@_register
def incremental_checkpoint(spark, sf_dir):
    return extract.next_checkpoint(extract.next_page(_events(spark, sf_dir), CHECKPOINT))


@_register
def extract_remaining(spark, sf_dir):
    left = extract.after(_events(spark, sf_dir), CHECKPOINT)
    return left.groupBy("event_name").agg(F.count("*").alias("events"))


@_register
def json_messages(spark, sf_dir):
    return messages.encode(_events(spark, sf_dir))


@_register
def parsed_events(spark, sf_dir):
    parsed = messages.parse_messages(_some_unreadable(spark, sf_dir))
    return messages.good_events(parsed)


@_register
def dead_letters(spark, sf_dir):
    return messages.dead_letters(messages.parse_messages(_some_unreadable(spark, sf_dir)))


def _loosely_written(spark, sf_dir):
    """The click stream as messages of several writers: numbers with a fraction or as text,
    fractions of seconds, a bare NaN, and some that are no objects."""
    rows = _events(spark, sf_dir)
    exact = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    plain = rows.select(*[
        exact.alias(c) if c == "event_time" else F.col(c) for c in rows.columns])
    text, name = F.to_json(F.struct(*plain.columns)), F.col("event_name")
    value = (
        F.when(name == "ITEM_DETAIL", F.regexp_replace(text, r'"customer_id":(\d+)', '"customer_id":$1.0'))
        .when(name == "ADD_TO_CART", F.regexp_replace(text, r'"quantity":([\d.]+)', '"quantity":"$1"'))
        .when(name == "ERROR", F.regexp_replace(text, r'"item_price":[\d.E-]+', '"item_price": NaN'))
        .when(name == "SIGNUP", F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    )
    return plain.select(value.alias("value"))


@_register
def lenient_events(spark, sf_dir):
    return messages.good_events(messages.parse_messages(_loosely_written(spark, sf_dir)))


@_register
def lenient_dead_letters(spark, sf_dir):
    letters = messages.dead_letters(messages.parse_messages(_loosely_written(spark, sf_dir)))
    return letters.groupBy("error").agg(F.count("*").alias("messages"))


@_register
def replayed_feed(spark, sf_dir):
    """The replay loop, stopped after its first page and resumed, read back as a consumer."""
    path, events = work_path(spark, "replay"), _events(spark, sf_dir)
    replay.replay(events, path, rows=5000, pages=1)
    replay.replay(events, path, rows=5000)
    received = readers.message_folder(spark, replay.feed(path), streaming=False)
    return messages.good_events(messages.parse_messages(received))


# Enrichment ------------------------------------------------------------------------------

@_register
def enriched_events(spark, sf_dir):
    return enrich.enriched_history(_events(spark, sf_dir), _customers(spark, sf_dir),
                                   _products(spark, sf_dir), unique=True)


@_register
def enriched_unmatched(spark, sf_dir):
    """Dimensions with missing and doubled rows: events neither vanish nor multiply."""
    customers = _customers(spark, sf_dir).where("customer_id % 7 <> 3")
    products = _products(spark, sf_dir).where("product_id % 5 <> 1")
    return enrich.enriched_history(
        _events(spark, sf_dir), customers.unionAll(customers), products.unionAll(products))


@_register
def enriched_duplicates(spark, sf_dir):
    """Keys with differing rows: the same one stays whatever the order of the rows."""
    customers = _customers(spark, sf_dir)
    others = customers.where("customer_id % 3 = 0").withColumn(
        "gender", F.concat(F.lit("z"), F.coalesce("gender", F.lit(""))))
    products = _products(spark, sf_dir)
    older = products.withColumn("season", F.lit("zz")).withColumn("version", F.lit(1))
    return enrich.enriched_history(
        _events(spark, sf_dir), others.unionByName(customers),
        older.unionByName(products.withColumn("version", F.lit(2))), products_newest_by="version")


@_register
def lookup_overwrites(spark, sf_dir):
    """A matched dimension replaces same-named event columns, with its NULLs too."""
    key = F.col("customer_id")
    dimension = _customers(spark, sf_dir).where("customer_id % 7 <> 3").select(
        key, F.when(key % 2 == 0, "dim").alias("traffic_source"), "gender")
    events = _events(spark, sf_dir).select("event_id", "customer_id", "traffic_source")
    return enrich.lookup(events, dimension, "customer_id")


@_register
def lookup_frozen(spark, sf_dir):
    """The lookup in a frozen dimension, half the events without a key."""
    events = _events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_id").cast("bigint") % 2 == 0, F.col("customer_id"))
        .alias("customer_id"), "price_usd")
    customers = _customers(spark, sf_dir).select("customer_id", "home_country", "birthdate")
    return enrich.lookup(
        events, dimensions.freeze(customers, "customer_id", "bigint", 16), "customer_id", frozen=True)


@_register
def lookup_salted(spark, sf_dir):
    """The lookup with every customer spread over several partitions."""
    events = _events(spark, sf_dir).select("event_id", "customer_id", "price_usd")
    return enrich.lookup(
        events, _customers(spark, sf_dir).select("customer_id", "home_country"),
        "customer_id", salts=8)


# Historic reports ----------------------------------------------------------------------

def _report(name: str, build) -> None:
    def query(spark, sf_dir):
        return build(_enriched(spark, sf_dir))

    query.__name__ = name
    _register(query)


_report("total_purchases", lambda h: historic.total_purchases(h, START, END))
_report("conversion_rate", lambda h: historic.conversion_rate(h, START, END))
_report("purchase_revenue", lambda h: historic.purchase_revenue(h, START, END))
_report("average_order_value", lambda h: historic.average_order_value(h, START, END))
_report("revenue_per_user", lambda h: historic.revenue_per_user(h, START, END))
_report("key_figures", lambda h: historic.key_figures(h, START, END))
_report("key_figure_tiles",
        lambda h: historic.key_figure_tiles(historic.key_figures(h, START, END)))
# Moved by whole days, so that the last 30 days hold some of the events and miss others.
_report("key_figures_default_range", lambda h: historic.key_figures(h.withColumn(
    "event_time", F.col("event_time") + F.make_dt_interval(
        F.datediff(F.current_date(), F.lit(END).cast("date"))))))
_report("sales_by_device_and_source", historic.sales_by_device_and_source)
_report("sales_by_gender", historic.sales_by_gender)
_report("daily_event_counts", lambda h: historic.daily_event_counts(h, START, END))
_report("sales_by_category", lambda h: historic.sales_by_category(h, START, END))
_report("top_sold_products", lambda h: historic.top_sold_products(h, START, END))
_report("sales_by_location", lambda h: historic.sales_by_location(h, START, END))
_report("device_source_subtotals", lambda h: historic.with_subtotals(
    historic.sales_by_device_and_source(h), "device_type", "traffic_source"))
_report("category_subtotals", lambda h: historic.with_subtotals(
    historic.sales_by_category(h, START, END), "masterCategory", "subCategory"))
_report("gender_shares", lambda h: historic.with_share(historic.sales_by_gender(h)))
_report("leaderboard_axes",
        lambda h: historic.axis_bounds(historic.top_sold_products(h, START, END)))


# Live metrics as batch -------------------------------------------------------------------

def _live(name: str, build) -> None:
    def query(spark, sf_dir):
        return build(_events(spark, sf_dir))

    query.__name__ = name
    _register(query)


def _with_gaps(metrics):
    """Metrics of which no message holds all numbers."""
    minute = F.minute("window_end")
    held = {"session_count": minute.isin(0, 30), "add_to_cart_count": minute == 20,
            "purchase_count": minute == 40}
    return metrics.select("window_end", *[F.when(on, F.col(c)).alias(c) for c, on in held.items()])


_live("funnel_10min", lambda e: funnel.funnel(e, COARSE))
_live("funnel_10s", lambda e: funnel.funnel(e, LIVE))
_live("latest_funnel", lambda e: funnel.latest_funnel(funnel.funnel(e, COARSE)))
_live("latest_funnel_with_gaps", lambda e: funnel.latest_funnel(
    _with_gaps(funnel.funnel(e, COARSE))))
_live("funnel_stages", lambda e: funnel.funnel_stages(
    funnel.latest_funnel(funnel.funnel(e, COARSE))))
_live("top_products_10min", lambda e: trending.top_products(e, COARSE))
_live("top_products_by_revenue",
      lambda e: trending.top_products(e, COARSE, rank_by="revenue"))
_live("top_products_10s", lambda e: trending.top_products(e, LIVE))
_live("top_products_with_gaps", lambda e: trending.top_products(e.withColumn(
    "quantity", F.when(F.col("event_id").cast("bigint") % 5 != 0, F.col("quantity"))), COARSE))
_live("trending_totals_10min", lambda e: trending.trending_totals(e, COARSE))
_live("trending_totals_10s", lambda e: trending.trending_totals(e, LIVE))
_live("grand_totals_10min", lambda e: trending.grand_totals(e, COARSE))
_live("live_tiles", lambda e: trending.live_tiles(trending.trending_totals(e, COARSE)))
_live("live_tiles_from_messages",
      lambda e: trending.tiles_of_messages(trending.trending(e, COARSE)))
_live("top_table_add_to_cart",
      lambda e: trending.top_table(trending.top_products(e, COARSE), ADD_TO_CART))
_live("top_table_purchase",
      lambda e: trending.table_of_messages(trending.trending(e, COARSE), PURCHASE))
_live("abandoned_carts_5min", abandonment.abandoned_carts)
_live("abandoned_carts_6h", lambda e: abandonment.abandoned_carts(e, LONG_GAP))
_live("abandonment_totals_10min", lambda e: abandonment.abandonment_totals(
    abandonment.abandoned_carts(e), COARSE))
_live("abandonment_totals_10s", lambda e: abandonment.abandonment_totals(
    abandonment.abandoned_carts(e), LIVE))
_live("abandonment_trend", lambda e: abandonment.abandonment_trend(
    abandonment.abandonment_totals(abandonment.abandoned_carts(e, LONG_GAP), COARSE)))


# Streams, drained into a table -------------------------------------------------------------

def _drained(spark, name, rows):
    path = work_path(spark, name)
    sinks.drain(sinks.append_table_stream(rows, path, f"{path}-checkpoint"))
    return spark.read.parquet(path)


@_register
def stream_funnel(spark, sf_dir):
    return _drained(spark, "funnel", jobs.funnel_stream(_event_stream(spark, sf_dir), COARSE))


@_register
def stream_top_products(spark, sf_dir):
    path = work_path(spark, "top-products")
    sinks.drain(jobs.top_products_writer(
        _event_stream(spark, sf_dir), path, f"{path}-checkpoint", COARSE))
    return spark.read.parquet(path).drop("batch")


@_register
def stream_funnel_10s(spark, sf_dir):
    """Live windows at their real slide, derived from stored panes."""
    path = work_path(spark, "funnel-panes")
    sinks.drain(panes.funnel_writer(
        _event_stream(spark, sf_dir), path, f"{path}-checkpoint", LIVE))
    return spark.read.parquet(f"{path}/funnel").drop("batch")


def _fed(spark, sf_dir, name, writer, late=True):
    """Runs a writer over the click stream as messages, which arrive in four parts.

    Each part is published by parallel tasks and drained before the next one comes, so it is a
    micro-batch of its own, and every part but the first meets a restarted query. A tenth of
    the events arrives one part late. ``writer`` takes events, path and checkpoint.
    """
    path = work_path(spark, name)
    events, feed = _events(spark, sf_dir), f"{path}/feed"
    time = F.col("event_time")
    part = sum(((time >= F.lit(edge).cast("timestamp")).cast("int") for edge in FEED_EDGES), F.lit(0))
    if late:
        held_back = F.col("event_id").cast("bigint") % 10 == 3
        part = F.least(part + held_back.cast("int"), F.lit(len(FEED_EDGES)))
    for i in range(len(FEED_EDGES) + 1):
        sinks.publish_folder(events.where(part == i), feed)
        received = readers.message_folder(spark, feed, files_per_batch=None)
        sinks.drain(writer(messages.good_events(messages.parse_messages(received)),
                           f"{path}/out", f"{path}/checkpoint"))
    return f"{path}/out"


def _table(spark, path):
    return spark.read.parquet(path).drop("batch")


@_register
def stream_funnel_from_messages(spark, sf_dir):
    """JSON messages, decoded and kept in panes."""
    path = _fed(spark, sf_dir, "message-panes",
                lambda e, out, cp: panes.funnel_writer(e, out, cp, COARSE), late=False)
    return _table(spark, f"{path}/funnel")


@_register
def stream_live_top_products(spark, sf_dir):
    """Trending at the live windows from messages; late events count in windows yet open."""
    path = _fed(spark, sf_dir, "live-trending",
                lambda e, out, cp: panes.trending_writer(e, out, cp, LIVE))
    return _table(spark, f"{path}/top")


@_register
def stream_live_trending_accounts(spark, sf_dir):
    path = _fed(spark, sf_dir, "live-trending",
                lambda e, out, cp: panes.trending_writer(e, out, cp, COARSE))
    return accounts.accounts(spark, path)


def _live_carts(spark, sf_dir):
    return _fed(spark, sf_dir, "live-carts", lambda e, out, cp: carts.abandonment_writer(
        e, out, cp, LIVE, delay=CART_DELAY))


@_register
def stream_live_abandoned_carts(spark, sf_dir):
    """Carried sessions with the live gap, from messages, a day of lateness allowed."""
    return _table(spark, f"{_live_carts(spark, sf_dir)}/carts")


@_register
def stream_live_abandonment_totals(spark, sf_dir):
    return _table(spark, f"{_live_carts(spark, sf_dir)}/totals")


@_register
def stream_live_abandonment_accounts(spark, sf_dir):
    """Events on time and late add up to the events read, micro-batch by micro-batch."""
    return accounts.accounts(spark, _live_carts(spark, sf_dir))


@_register
def stream_latest_funnel(spark, sf_dir):
    """The last known numbers from messages that hold one or none of them each."""
    path = work_path(spark, "latest")
    metrics = _with_gaps(funnel.funnel(_events(spark, sf_dir), COARSE))
    for i in (1, 0, 2):  # the newest messages do not come last
        sinks.publish_folder(metrics.where(F.dayofmonth("window_end") % 3 == i), f"{path}/feed")
        received = readers.message_folder(spark, f"{path}/feed", files_per_batch=None)
        sinks.drain(latest.latest_writer(latest.decode(received), f"{path}/state", f"{path}/checkpoint"))
    return latest.latest_state(spark, f"{path}/state")


def _trending_from_panes(spark, sf_dir, table):
    path = work_path(spark, "trending-panes")
    sinks.drain(panes.trending_writer(
        _event_stream(spark, sf_dir), path, f"{path}-checkpoint", COARSE))
    return spark.read.parquet(f"{path}/{table}").drop("batch")


@_register
def stream_top_products_from_panes(spark, sf_dir):
    return _trending_from_panes(spark, sf_dir, "top")


@_register
def stream_totals_from_panes(spark, sf_dir):
    return _trending_from_panes(spark, sf_dir, "totals")


@_register
def stream_abandoned_carts(spark, sf_dir):
    carts = jobs.abandoned_stream(_event_stream(spark, sf_dir), LONG_GAP).drop("session")
    return _drained(spark, "carts", carts)


@_register
def stream_abandoned_carts_5min(spark, sf_dir):
    """The gap of the live pipeline."""
    return _drained(spark, "carts", jobs.abandoned_stream(
        _event_stream(spark, sf_dir)).drop("session"))


@_register
def stream_abandonment_totals(spark, sf_dir):
    return _drained(spark, "abandonment", jobs.abandonment_stream(
        _event_stream(spark, sf_dir), COARSE, LONG_GAP))


@_register
def stream_history(spark, sf_dir):
    """Enrich the stream into the partitioned history table and read that back."""
    path = work_path(spark, "history")
    enriched = jobs.enriched_stream(
        _event_stream(spark, sf_dir),
        dimensions.freeze(_customers(spark, sf_dir), "customer_id", "bigint", 16),
        dimensions.freeze(_products(spark, sf_dir), "product_id", "double", 16), frozen=True)
    sinks.drain(sinks.append_history_stream(enriched, path, f"{path}-checkpoint"))
    return readers.history(spark, path)


def _rolled_up(name: str, build) -> None:
    """A report from daily summaries that a stream of messages has fed."""
    def query(spark, sf_dir):
        customers = dimensions.freeze(_customers(spark, sf_dir), "customer_id", "bigint", 16)
        products = dimensions.freeze(_products(spark, sf_dir), "product_id", "double", 16)
        path = _fed(spark, sf_dir, "rollup", lambda e, out, cp: rollups.rollup_writer(
            jobs.enriched_stream(e, customers, products, frozen=True), out, cp))
        return build(*[rollups.summary(spark, path, t) for t in rollups.TABLES])

    query.__name__ = name
    _register(query)


_rolled_up("rollup_key_figures", lambda totals, sales, sessions, buyers: rollup.key_figures(
    totals, sessions, buyers, START, END))
_rolled_up("rollup_daily_event_counts", lambda totals, *_: rollup.daily_event_counts(totals, START, END))
_rolled_up("rollup_top_sold_products", lambda totals, sales, *_: rollup.top_sold_products(sales, START, END))
_rolled_up("rollup_sales_by_category", lambda totals, sales, *_: rollup.sales_by(
    sales, "product", ("masterCategory", "subCategory"), START, END).drop("total_quantity"))
_rolled_up("rollup_sales_by_device_and_source", lambda totals, sales, *_: rollup.sales_by(
    sales, "device", whole=True, digits=2).drop("total_quantity"))


@_register
def history_key_figures(spark, sf_dir):
    """Key figures from the history table, pruned to the partitions of the date range."""
    path = work_path(spark, "history")
    sinks.append_history(enriched_events(spark, sf_dir), path)
    return historic.key_figures(readers.history(spark, path), START, END)


@_register
def stream_messages(spark, sf_dir):
    """Publish the funnel metrics as JSON messages and read them as a consumer would."""
    path = work_path(spark, "messages")
    metrics = jobs.funnel_stream(_event_stream(spark, sf_dir), COARSE)
    sinks.drain(sinks.publish_stream(metrics, f"{path}-checkpoint", path=path))
    schema = schema_of("""
        window_end TIMESTAMP, session_count BIGINT, add_to_cart_count BIGINT,
        purchase_count BIGINT, purchase_percentage DOUBLE""")
    options = {"timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    received = readers.message_folder(spark, path, streaming=False)
    return received.select(F.from_json("value", schema, options).alias("m")).select("m.*")
