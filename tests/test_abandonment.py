import pytest
from pyspark.sql import functions as F

from clickloom.operators.abandonment import (
    abandoned_carts, abandonment_totals, abandonment_trend, cart_fields, cart_sessions, stamped)
from clickloom.operators.sliding import LIVE, Sliding
from events import random_rows, same
from test_enrich import plan_of


def lost(df, **kw):
    return {(r.session_id, r.product_id): r.lost_sale for r in abandoned_carts(df, **kw).collect()}


def test_only_the_cart_without_booking_is_abandoned(events):
    df = events(("s1", "ADD_TO_CART", "00:00:01", 1.0, 2.0, 10.0),
                ("s2", "ADD_TO_CART", "00:01:00", 1.0, 1.0, 10.0),
                ("s2", "BOOKING", "00:02:00", 1.0, 1.0, 10.0))
    assert lost(df) == {("s1", 1.0): 20.0}
    assert abandoned_carts(df).first().abandoned_time == "2024-01-01 00:00:01"


def test_booking_before_the_add_clears_the_cart(events):
    df = events(("s", "BOOKING", "00:00:00", 1.0, 1.0, 10.0),
                ("s", "ADD_TO_CART", "00:01:00", 1.0, 1.0, 10.0))
    assert lost(df) == {}


def test_first_add_counts_alone(events):
    df = events(("s", "ADD_TO_CART", "00:01:00", 1.0, 5.0, 10.0, 1, "b"),
                ("s", "ADD_TO_CART", "00:00:00", 1.0, 1.0, 10.0, 1, "z"),
                ("s", "ADD_TO_CART", "00:00:00", 1.0, 3.0, 10.0, 1, "a"))
    assert lost(df) == {("s", 1.0): 30.0}


@pytest.mark.parametrize("booked,abandoned", [("00:04:59.999999", 0), ("00:05:00", 1),
                                              ("00:05:01", 1)])
def test_session_edge(events, booked, abandoned):
    df = events(("s", "ADD_TO_CART", "00:00:00", 1.0, 1.0, 10.0),
                ("s", "BOOKING", booked, 1.0, 1.0, 10.0))
    assert len(lost(df)) == abandoned


def test_short_steps_join_a_long_session(events):
    adds = [("s", "ADD_TO_CART", f"00:{m:02d}:30", 1.0, 1.0, 10.0) for m in range(0, 40, 4)]
    df = events(*adds, ("s", "BOOKING", "00:41:00", 1.0, 1.0, 10.0))
    assert lost(df) == {}
    assert cart_sessions(df).count() == 1


@pytest.mark.parametrize("gap,hours", [(300, 2), (60, 1), (3600, 40)])
def test_sessions_equal_sparks_session_windows(events, gap, hours):
    df = events(*random_rows(gap, 500, sessions=3, products=3, hours=hours, hot=0.34))
    sales = df.where("event_name IN ('ADD_TO_CART', 'BOOKING')")
    session = F.session_window("event_time", f"{gap - 1}.999999 seconds")
    first = F.min(F.struct("event_time", "event_id", "price_usd", "quantity"))
    expected = sales.groupBy("session_id", "product_id", session).agg(
        F.bool_and(F.col("event_name") == "ADD_TO_CART").alias("only_adds"),
        first.alias("first")).where("only_adds").select(*cart_fields("first"))
    assert same(abandoned_carts(df, gap).drop("closed_at"), expected)


def test_totals_per_window(events):
    df = events(("s1", "ADD_TO_CART", "00:00:01", 1.0, 2.0, 10.0),
                ("s2", "ADD_TO_CART", "00:10:00", 1.0, 1.0, 5.005))
    totals = abandonment_totals(abandoned_carts(df), LIVE)
    # The carts close at 00:05:00.999999 and 00:14:59.999999.
    assert totals.count() == 360 + 59
    both = totals.where("abandoned_count = 2")
    assert both.count() == 360 - 59
    assert {r.total_lost_sales for r in both.collect()} == {25.01}
    ends = totals.agg(F.min("window_end"), F.max("window_end")).first()
    assert [str(e) for e in ends] == ["2024-01-01 00:05:10", "2024-01-01 01:14:50"]


def test_trend_and_stamp(events):
    df = events(("s1", "ADD_TO_CART", "00:00:01", 1.0, 2.0, 10.0))
    totals = abandonment_totals(abandoned_carts(df), Sliding(3600, 600))
    ends = [r.window_end for r in abandonment_trend(totals).collect()]
    assert ends == sorted(ends) and len(ends) == 6
    assert len(stamped(totals).first().timestamp) == len("2024-01-01 00:00:00")


def test_hot_pair_is_folded_before_it_is_ordered(events):
    rows = [("hot", "ADD_TO_CART", f"00:{i % 60:02d}:{i // 60 % 60:02d}", 1.0, 1.0, 1.0)
            for i in range(2000)]
    plan = plan_of(cart_sessions(events(*rows)))
    # Two shuffles: the folding one, combined on the map side, and the ordering one.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("partial_min") >= 1
    assert cart_sessions(events(*rows)).count() == 1
