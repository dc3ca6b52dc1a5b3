"""Pane and step forms against the definition: every event in each of its windows."""

import pytest
from pyspark.sql import functions as F

from clickloom.functions.events import line_amount
from clickloom.operators.funnel import (
    COUNTS, event_counts, funnel, funnel_stages, latest_funnel, percentages)
from clickloom.operators.sliding import LIVE, Sliding
from clickloom.operators.trending import grand_totals
from events import random_rows, same
from test_enrich import plan_of

SHAPES = [Sliding(60, 10), Sliding(3600, 600), Sliding(3600, 3600), Sliding(30, 10)]


def by_definition(events, sliding):
    window = F.window("event_time", f"{sliding.size} seconds", f"{sliding.slide} seconds")
    return events.withColumn("w", window).select(
        "*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def funnel_by_definition(events, sliding):
    sessions = by_definition(events, sliding).groupBy(
        "window_start", "window_end", "session_id").agg(*event_counts())
    return sessions.groupBy("window_start", "window_end").agg(
        F.count("*").alias("session_count"), *[F.sum(c).alias(c) for c in COUNTS],
    ).select("*", *percentages())


def test_golden_funnel(events):
    df = events(
        ("a", "ITEM_DETAIL", "00:00:01", 1.0, 1.0, 1.0),
        ("a", "ITEM_DETAIL", "00:00:02", 1.0, 1.0, 1.0),
        ("b", "ITEM_DETAIL", "00:00:03", 1.0, 1.0, 1.0),
        ("b", "ADD_TO_CART", "00:00:04", 1.0, 1.0, 1.0),
        ("c", "NOOP", "00:00:05", 1.0, 1.0, 1.0))
    rows = funnel(df, LIVE).collect()
    assert len(rows) == 360
    assert {tuple(r)[2:] for r in rows} == {(3, 3, 1, 0, 100.0, 33.33, 0.0)}
    assert min(str(r.window_start) for r in rows) == "2023-12-31 23:00:10"
    assert max(str(r.window_end) for r in rows) == "2024-01-01 01:00:00"


@pytest.mark.parametrize("sliding", SHAPES)
@pytest.mark.parametrize("seed,hours", [(1, 1), (2, 60)])
def test_funnel_equals_its_definition(events, sliding, seed, hours):
    df = events(*random_rows(seed, 400, sessions=15, products=5, hours=hours, hot=0.3))
    assert same(funnel(df, sliding), funnel_by_definition(df, sliding))


def test_partitioning_does_not_matter(events):
    df = events(*random_rows(5, 300, sessions=9, products=5, hours=3))
    mixed = df.orderBy(F.rand(3)).repartition(7)
    assert same(funnel(df, Sliding(600, 30)), funnel(mixed, Sliding(600, 30)))


def test_a_null_session_is_a_session(events):
    df = events((None, "BOOKING", "00:00:01", 1.0, 1.0, 1.0),
                ("a", "BOOKING", "00:00:01", 1.0, 1.0, 1.0))
    assert funnel(df, Sliding(10, 10)).first().session_count == 2


def test_funnel_never_copies_events_per_window(events):
    plan = plan_of(funnel(events(*random_rows(1, 9, 3, 3, 1)), LIVE))
    # Windows are spelled out last, from one row per change, above the final window.
    assert "Expand" not in plan
    assert plan.index("Generate explode(sequence(w") < plan.index("Window [")


def test_grand_totals(events):
    df = events(*random_rows(3, 300, sessions=5, products=5, hours=2))
    sales = by_definition(df.where("event_name IN ('ADD_TO_CART', 'BOOKING')"), Sliding(60, 10))
    expected = sales.groupBy("window_start", "window_end").agg(
        F.sum("quantity").alias("total_quantity"),
        F.round(F.sum(line_amount()), 6).alias("total_amount"))
    assert same(grand_totals(df, Sliding(60, 10)), expected)


def test_latest_funnel_and_stages(events):
    df = events(("a", "ITEM_DETAIL", "00:00:01", 1.0, 1.0, 1.0),
                ("a", "ADD_TO_CART", "02:00:01", 1.0, 1.0, 1.0),
                ("b", "BOOKING", "02:00:02", 1.0, 1.0, 1.0))
    latest = latest_funnel(funnel(df, Sliding(3600, 600)))
    assert tuple(latest.first()) == (2, 1, 1)
    stages = funnel_stages(latest).orderBy("stage_no").collect()
    assert [(s.stage, s.value, s.percent_of_initial) for s in stages] == [
        ("Sessions", 2, 100.0), ("Added to Cart", 1, 50.0), ("Purchased", 1, 50.0)]


def test_latest_funnel_starts_with_zeros(events):
    nothing = funnel(events(("a", "BOOKING", "00:00:01", 1.0, 1.0, 1.0)).limit(0))
    latest = latest_funnel(nothing)
    assert tuple(latest.first()) == (0, 0, 0)
    assert {r.percent_of_initial for r in funnel_stages(latest).collect()} == {0.0}


def test_window_shape_is_checked():
    for size, slide in [(60, 7), (0, 10), (10, 0)]:
        with pytest.raises(ValueError):
            Sliding(size, slide)
