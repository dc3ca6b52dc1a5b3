import pytest
from pyspark.sql import functions as F

from clickloom.operators import historic as H
from clickloom.operators.enrich import enriched_history
from clickloom.session import work_path
from clickloom.sources.readers import history
from clickloom.sources.sinks import append_history
from test_enrich import plan_of

RANGE = ("2024-01-01", "2024-01-02")


@pytest.fixture
def sales(events):
    return events(
        ("s1", "BOOKING", "2023-12-31 23:59:59", 1.0, 1.0, 100.0, 1),
        ("s1", "BOOKING", "2024-01-01 00:00:00", 1.0, 2.0, 10.0, 1),
        ("s1", "BOOKING", "2024-01-01 12:00:00", 1.0, 1.0, 5.0, 1),
        ("s2", "ADD_TO_CART", "2024-01-02 10:00:00", 1.0, 1.0, 7.0, 2),
        ("s3", "BOOKING", "2024-01-02 23:59:59", 1.0, 1.0, 15.0, 3),
        ("s4", "ITEM_DETAIL", "2024-01-02 01:00:00", 1.0, 1.0, 9.0, 4),
        ("s5", "BOOKING", "2024-01-03 00:00:00", 1.0, 1.0, 100.0, 5),
    )


def test_key_figures(sales):
    row = H.key_figures(sales, *RANGE).first()
    assert row.total_purchases == 3 and row.total_revenue == 40.0
    assert row.conversion_rate == 50.0  # 2 buying customers over 4 sessions
    assert row.average_order_value == pytest.approx(40 / 3, abs=1e-6)
    assert row.revenue_per_user == 20.0


def test_single_figures_agree_with_the_one_pass_form(sales):
    together = H.key_figures(sales, *RANGE).first().asDict()
    for figure in (H.total_purchases, H.conversion_rate, H.purchase_revenue,
                   H.average_order_value, H.revenue_per_user):
        for name, value in figure(sales, *RANGE).first().asDict().items():
            assert value == together[name]


def test_no_event_in_range(sales):
    row = H.key_figures(sales, "2030-01-01", "2030-01-02").first()
    assert row.total_purchases == 0 and row.conversion_rate is None
    assert row.total_revenue is None and row.revenue_per_user is None


def test_default_range_ends_today(spark, sales):
    today = sales.withColumn("event_time", F.current_timestamp())
    assert H.total_purchases(today).first()[0] == 5
    assert H.total_purchases(sales).first()[0] == 0


def test_tiles_are_formatted(sales):
    tiles = {r.label: r.value for r in
             H.key_figure_tiles(H.key_figures(sales, *RANGE)).collect()}
    assert tiles["Conversion Rate"] == "50.00%"
    assert tiles["Purchase Revenue"] == "$40.00" and tiles["Total eComm Purchases"] == "$3.00"


def test_daily_counts_leave_page_views_out(sales):
    rows = [tuple(map(str, r)) for r in H.daily_event_counts(sales, *RANGE).collect()]
    assert rows == [("2024-01-01", "BOOKING", "2"), ("2024-01-02", "ADD_TO_CART", "1"),
                    ("2024-01-02", "BOOKING", "1")]


def named_products(sales, count=30):
    copies = F.explode(F.sequence(F.lit(1), F.lit(count)))
    return sales.withColumn("n", copies).select(
        "*", F.format_string("p%02d", "n").alias("productDisplayName"),
        F.lit("m").alias("masterCategory"), F.lit("s").alias("subCategory"))


def test_leaderboard_keeps_25_and_breaks_ties_by_name(sales):
    board = H.top_sold_products(named_products(sales), *RANGE)
    assert [r.productDisplayName for r in board.collect()] == [
        f"p{i:02d}" for i in range(1, 26)]
    assert "TakeOrderedAndProject" in plan_of(board)
    assert tuple(H.axis_bounds(board).first()) == (-1.0, 9.0, -10.0, 90.0)


def test_subtotals_and_shares(spark):
    sales = spark.createDataFrame(
        [("phone", "ad", 1.0), ("phone", "mail", 2.0), ("web", "ad", 5.0)],
        "device_type STRING, traffic_source STRING, total_sales DOUBLE")
    rows = {(r.device_type, r.traffic_source, r.level): r.total_sales for r in
            H.with_subtotals(sales, "device_type", "traffic_source").collect()}
    assert rows[("phone", None, 1)] == 3.0 and rows[(None, None, 2)] == 8.0
    assert len(rows) == 6
    assert [r.share for r in H.with_share(sales).orderBy("total_sales").collect()] == [
        0.125, 0.25, 0.625]


def test_history_table_is_pruned_to_the_dates(spark, sales):
    customers = spark.createDataFrame([(1, "F")], "customer_id BIGINT, gender STRING")
    products = spark.createDataFrame([(1, "n")], "product_id BIGINT, season STRING")
    path = work_path(spark, "history")
    append_history(enriched_history(sales, customers, products), path)
    table = history(spark, path)
    plan = plan_of(H.purchase_revenue(table, *RANGE))
    pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in pruned
    assert H.key_figures(table, *RANGE).first() == H.key_figures(sales, *RANGE).first()


def test_event_time_range_is_pushed_to_the_scan(spark, sales):
    path = work_path(spark, "events")
    sales.write.parquet(path)
    plan = plan_of(H.total_purchases(spark.read.parquet(path), *RANGE), "formatted")
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan
