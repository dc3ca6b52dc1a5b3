import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.functions.events import line_amount
from clickloom.functions.numbers import settled
from clickloom.operators.sliding import LIVE, Sliding
from clickloom.operators.trending import (
    live_tiles, product_panes, product_steps, table_of_messages, tiles_of_messages, top_candidates, top_products, top_table,
    trending, trending_totals)
from events import random_rows, same
from test_enrich import plan_of
from test_sliding import by_definition

ONE = Sliding(3600, 3600)


def sums_by_definition(events, sliding):
    sales = by_definition(events.where("event_name IN ('ADD_TO_CART', 'BOOKING')"), sliding)
    sums = sales.groupBy("window_start", "window_end", "event_name", "product_id").agg(
        F.sum("quantity").alias("quantity"), settled(F.sum(line_amount())).alias("revenue"))
    return sums.withColumn("amount", settled(F.col("quantity") * F.col("revenue")))


def top_by_definition(events, sliding, k, rank_by):
    order = Window.partitionBy("window_end", "event_name").orderBy(
        F.desc(rank_by), F.desc("quantity"), "product_id")
    ranked = sums_by_definition(events, sliding).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def test_golden_amounts(events):
    df = events(("s", "ADD_TO_CART", "00:00:01", 1.0, 2.0, 10.0),
                ("s", "ADD_TO_CART", "00:00:02", 1.0, 1.0, 10.0),
                ("s", "BOOKING", "00:00:03", 2.0, 1.0, 5.0),
                ("s", "BOOKING", "00:00:04", 1.0, 1.0, 10.0),
                ("s", "ITEM_DETAIL", "00:00:05", 9.0, 9.0, 9.0))
    add = top_products(df, ONE).where("event_name = 'ADD_TO_CART'").first()
    assert (add.product_id, add.quantity, add.revenue, add.amount) == (1.0, 3.0, 30.0, 90.0)
    totals = {r.event_name: r for r in trending_totals(df, ONE).collect()}
    assert totals["BOOKING"].total_amount == 15.0
    assert totals["ADD_TO_CART"].total_quantity == 3.0


def test_eleven_products_give_ten_rows_and_whole_totals(events):
    df = events(*[("s", "BOOKING", "00:00:01", float(p), 1.0, float(p)) for p in range(1, 12)])
    rows = top_products(df, ONE).orderBy("rank").collect()
    assert [r.product_id for r in rows] == [float(p) for p in range(11, 1, -1)]
    assert trending_totals(df, ONE).first().total_quantity == 11.0


def test_ties_fall_to_quantity_then_product_id(events):
    df = events(("s", "BOOKING", "00:00:01", 3.0, 1.0, 4.0),
                ("s", "BOOKING", "00:00:01", 2.0, 1.0, 4.0),
                ("s", "BOOKING", "00:00:01", 9.0, 2.0, 1.0))
    rows = top_products(df, ONE).orderBy("rank").collect()
    assert [r.product_id for r in rows] == [9.0, 2.0, 3.0]


@pytest.mark.parametrize("rank_by", ["amount", "revenue"])
@pytest.mark.parametrize("sliding", [Sliding(60, 10), Sliding(3600, 600), Sliding(600, 10)])
@pytest.mark.parametrize("k,products,hours", [(3, 40, 1), (10, 6, 50)])
def test_top_products_equal_their_definition(events, sliding, rank_by, k, products, hours):
    df = events(*random_rows(k, 500, sessions=5, products=products, hours=hours, hot=0.3))
    assert same(top_products(df, sliding, k, rank_by), top_by_definition(df, sliding, k, rank_by))


@pytest.mark.parametrize("sliding", [Sliding(60, 10), Sliding(3600, 600), Sliding(600, 10)])
def test_totals_equal_their_definition(events, sliding):
    df = events(*random_rows(8, 500, sessions=5, products=12, hours=30, hot=0.3))
    expected = sums_by_definition(df, sliding).groupBy(
        "window_start", "window_end", "event_name").agg(
        F.sum("quantity").alias("total_quantity"),
        settled(F.sum("revenue")).alias("total_revenue"),
        settled(F.sum("amount")).alias("total_amount"))
    assert same(trending_totals(df, sliding), expected)


def test_null_product_and_null_quantity(events):
    df = events(("s", "BOOKING", "00:00:01", None, 1.0, 4.0),
                ("s", "BOOKING", "00:00:01", 1.0, None, 4.0),
                ("s", "BOOKING", "00:00:02", 1.0, 1.0, 2.0))
    rows = {r.product_id: r.amount for r in top_products(df, ONE).collect()}
    assert rows == {None: 4.0, 1.0: 2.0}


def test_hot_product_is_one_row_per_pane(events):
    df = events(*random_rows(4, 600, sessions=5, products=50, hours=1, hot=0.34))
    hot = product_panes(df, Sliding(3600, 600)).where("product_id = -1")
    assert hot.count() <= 6 * 2


def test_messages_tiles_and_tables(events):
    df = events(("s", "ADD_TO_CART", "00:00:01", 1.0, 2.0, 10.0),
                ("s", "ADD_TO_CART", "00:00:02", 2.0, 1.0, 50.0))
    messages = trending(df, ONE).cache()
    message = messages.first().trending
    assert set(message) == {"ADD_TO_CART"}
    assert [i.product_id for i in message["ADD_TO_CART"].top10] == [2.0, 1.0]
    tiles = live_tiles(trending_totals(df, ONE)).first()
    assert tiles_of_messages(messages).first() == tiles
    assert tiles.add_to_cart_total_quantity == 3 and tiles.add_to_cart_total_amount == 90.0
    assert tiles.booking_total_quantity == 0 and tiles.booking_total_amount == 0.0
    table = top_table(top_products(df, ONE), "ADD_TO_CART").collect()
    assert sorted(map(tuple, table_of_messages(messages, "ADD_TO_CART").collect())) == sorted(map(tuple, table))
    assert [(r["rank"], r["Product ID"], r["Total Sales ($)"]) for r in table] == [
        (1, 2.0, 50.0), (2, 1.0, 40.0)]
    assert top_table(top_products(df, ONE), "BOOKING").isEmpty()
    assert table_of_messages(messages, "BOOKING").isEmpty()


def test_sums_leave_no_trace_of_what_left_the_window(events):
    """Running sums: large figures enter and leave again, small ones stay exact."""
    rows = [("s", "BOOKING", f"{h:02d}:{m:02d}:00", 1.0, 1.0, 1e11 if m == 0 else 0.1 + m / 1000)
            for h in range(6) for m in range(0, 60, 3)]
    shape = Sliding(600, 60)
    assert same(top_products(events(*rows), shape), top_by_definition(events(*rows), shape, 10, "amount"))


def test_running_sums_need_one_addition_per_change(events):
    plan = plan_of(product_steps(product_panes(events(*random_rows(1, 9, 3, 3, 1)), LIVE), LIVE))
    assert "RangeFrame, unboundedpreceding$(), currentrow$()" in plan
    assert "RangeFrame, -" not in plan


def test_products_of_equal_figures_are_pruned(events):
    """Of 400 products that tie in everything but the id, few are spelled out per window."""
    df = events(*[("s", "BOOKING", "00:00:01", float(p), 1.0, 5.0) for p in range(400)])
    shape = Sliding(600, 10)
    top = top_products(df, shape, k=3)
    assert {r.product_id for r in top.select("product_id").distinct().collect()} == {0.0, 1.0, 2.0}
    spelled = top_candidates(product_panes(df, shape), shape, 3, "amount").where("hi - lo = 15")
    assert spelled.count() <= 4 * 3


def test_unknown_ranking_is_refused(events):
    with pytest.raises(ValueError):
        top_products(events(("s", "BOOKING", "00:00:01", 1.0, 1.0, 1.0)), ONE, rank_by="price")
