"""A session without an id that views, adds and pays, and a session whose row is there twice."""

from __future__ import annotations

import datetime as dt

import pytest

from journey import operators as op
from journey.spec import FunnelSpec
from tests.conftest import rows

SPEC = FunnelSpec((("view", "V"), ("add", "A"), ("pay", "P")))


@pytest.fixture(scope="module")
def tables(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 10, m)
    p = '{"product_id": 1, "category": "%s", "price": 10.0, "method": "%s"}'
    events = [(1, None, at(0), "view", p % ("x", "m1")), (2, None, at(1), "add", p % ("x", "m1")), (3, None, at(2), "pay", p % ("x", "m1")),
              (4, "s1", at(0), "view", p % ("y", "m2")), (5, "s1", at(1), "add", p % ("y", "m2")), (6, "s1", at(9), "pay", p % ("y", "m2")),
              (7, "s2", at(3), "view", p % ("y", "m2"))]
    return {
        "events": spark.createDataFrame(events, "event_id BIGINT, session_id STRING, event_timestamp TIMESTAMP_NTZ, "
                                                "event_name STRING, event_properties STRING"),
        "sessions": spark.createDataFrame([("s1", "mobile"), ("s1", "mobile"), ("s2", "desktop")], "session_id STRING, device_type STRING"),
        "orders": spark.createDataFrame([("o1", "s1", 5.0, "upi"), ("o2", None, 7.0, "upi")],
                                        "order_id STRING, session_id STRING, gmv DOUBLE, payment_method STRING"),
    }


def test_product_and_payment_rates_leave_the_null_session_out(tables):
    e = tables["events"]
    assert rows(op.price_cart_histogram(e, "view", "add", 5.0)) == [(10.0, False, 1), (10.0, True, 1)]
    assert rows(op.category_cart_rate(e, "view", "add")) == [("y", 0.5)]
    assert rows(op.method_failure_rate(e, "add", "pay", "fail")) == [("m2", 0.0)]


def test_wide_funnel_keeps_the_null_group_in_the_sums_only(tables):
    w = op.wide_funnel(tables["events"], SPEC).first()
    assert (w.total_sessions, w.sessions_with_view, w.sessions_with_add, w.sessions_with_pay) == (2, 3, 2, 2)
    assert [r.session_count for r in op.overall_funnel(tables["events"], SPEC).orderBy("stage_idx").collect()] == [2, 1, 1]


def test_repeated_session_rows(tables):
    e, s, o = tables["events"], tables["sessions"], tables["orders"]
    # stages count sessions once, the denominator counts session rows
    assert rows(op.segment_funnel(s, e, SPEC, "device_type").filter("stage_idx = 2"), "segment", "session_count", "total_sessions") == [
        ("desktop", 0, 1), ("mobile", 1, 2)]
    r = op.ab_significance(s, e, SPEC, "device_type", "mobile", "desktop").first()
    assert (r.n_a, r.x_a, r.n_b, r.x_b) == (2, 1, 1, 0)
    assert rows(op.payment_mix_by_segment(s, o, "device_type", "upi")) == [("mobile", 1, 1, 1.0)]
    drop = op.device_dropoff(s, e, "device_type", "view", "add", "cart", "pay")
    assert rows(drop, "device_type", "total_sessions", "purchases") == [("desktop", 1, 0), ("mobile", 1, 1)]
    roi = op.channel_roi(s, e, o, "device_type", "pay")
    assert rows(roi, "device_type", "total_sessions", "converting_sessions", "total_revenue") == [
        ("desktop", 1, 0, 0.0), ("mobile", 1, 1, 10.0)]  # the join repeats the order with the session's row
    assert rows(op.channel_roi(s, e, o, "device_type", "pay", dedup=True), "device_type", "total_revenue") == [
        ("desktop", 0.0), ("mobile", 5.0)]


def test_money_does_not_depend_on_the_order_of_rows(spark):
    o = spark.range(20_000).selectExpr("CAST(id AS STRING) AS order_id", "1e9 + id * 0.01 + id / 7 AS gmv",
                                       "CAST('2024-01-01' AS TIMESTAMP_NTZ) AS order_date", "'s' AS session_id")
    first = op.daily_revenue(o).first().gmv
    for n in (1, 3, 17):
        assert op.daily_revenue(o.repartition(n, "order_id")).first().gmv == first
