"""Cross-operator invariants on the sf0.01 benchmark tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from journey import operators as op
from journey.sources.driver_tables import driver_tables
from journey.spec import DRIVER_ROLES as R, PRESETS
from tests.conftest import SF001

SPEC = PRESETS["driver"]


@pytest.fixture(scope="module")
def t(spark):
    return driver_tables(spark, SF001)


@pytest.fixture(scope="module")
def q1(t):
    return {r.stage_idx: r for r in op.overall_funnel(t.events, SPEC).collect()}


def test_wide_funnel_equals_overall_counts(t, q1):
    w = op.wide_funnel(t.events, SPEC).first()
    assert [w[f"sessions_with_{n}"] for n in SPEC.names] == [q1[i].session_count for i in range(SPEC.n)]


def test_dropoff_is_previous_minus_count(q1):
    for i in range(1, SPEC.n):
        assert q1[i].dropoff_count == q1[i - 1].session_count - q1[i].session_count


def test_flows_out_of_a_stage_add_to_its_count(t, q1):
    out = op.funnel_flow(t.events, SPEC).groupBy("source_idx").agg(F.sum("value").alias("v")).collect()
    assert {r.source_idx: r.v for r in out} == {i: q1[i].session_count for i in range(SPEC.n - 1)}


def test_dedup_revenue_is_revenue_of_orders_with_a_session(t):
    roi = op.channel_roi(t.sessions, t.events, t.orders, "traffic_source", R.purchase, dedup=True)
    total = roi.agg(F.sum("total_revenue")).first()[0]
    known = t.orders.join(t.sessions.select("session_id"), "session_id", "left_semi").agg(F.sum("gmv")).first()[0]
    assert total == pytest.approx(known, rel=1e-12)


def test_literal_revenue_not_below_dedup(t):
    lit = {r[0]: r.total_revenue for r in op.channel_roi(t.sessions, t.events, t.orders, "traffic_source", R.purchase).collect()}
    ded = {r[0]: r.total_revenue for r in
           op.channel_roi(t.sessions, t.events, t.orders, "traffic_source", R.purchase, dedup=True).collect()}
    assert lit.keys() == ded.keys() and all(lit[k] >= ded[k] - 1e-6 for k in lit)


def test_segment_totals_add_to_sessions(t):
    seg = op.segment_funnel(t.sessions, t.events, SPEC, "traffic_source").filter("stage_idx = 0")
    assert seg.agg(F.sum("total_sessions")).first()[0] == t.sessions.count()


def test_user_rollup_totals(t):
    r = op.user_rollup(t.users, t.sessions, t.user_orders).agg(F.sum("total_sessions"), F.sum("total_orders")).first()
    assert r[0] == t.sessions.count() and r[1] == t.user_orders.count()


def test_hot_session_does_not_change_presence_results(spark, fx):
    """A session holding most rows (here: copies of one session's events) leaves presence-based results unchanged."""
    from tests.conftest import STAGES, rows

    hot = fx.events.filter("session_id = 's1'").select("*", F.explode(F.sequence(F.lit(1), F.lit(20000))).alias("_r"))
    skewed = fx.events.unionByName(hot.drop("_r"))
    for f in (lambda ev: op.overall_funnel(ev, STAGES),
              lambda ev: op.segment_funnel(fx.sessions, ev, STAGES, "device_type"),
              lambda ev: op.method_failure_rate(ev, "payment_initiated", "payment_success", "payment_failed"),
              lambda ev: op.category_cart_rate(ev, "product_detail_view", "add_to_cart")):
        assert rows(f(skewed)) == rows(f(fx.events))
