"""Plan shape checks: one pass, partial aggregation, pushdown, no Python."""

from __future__ import annotations

import pytest

from journey import operators as op
from journey.plans import QUERIES
from journey.plans.inspect import exchanges, physical_plan, pushed_filters, python_udfs, read_schemas, scans
from journey.sources.driver_tables import driver_tables
from journey.spec import PRESETS
from tests.conftest import SF001

SPEC = PRESETS["driver"]


@pytest.fixture(scope="module")
def t(spark):
    return driver_tables(spark, SF001)


def test_overall_funnel_single_pass(t):
    df = op.overall_funnel(t.events, SPEC)
    assert len(scans(df, "events")) == 1
    ex = exchanges(df)
    assert len(ex) == 2, ex
    assert any("hashpartitioning(session_id" in e for e in ex)
    assert any("SinglePartition" in e for e in ex)
    # the stage IN-list reaches the Parquet reader and only one column is read
    assert any("In(event_type" in p for p in pushed_filters(df))
    assert read_schemas(df) == ["struct<ts:timestamp_ntz,user_id:bigint,event_type:string>"]


def test_wide_funnel_single_pass(t):
    df = op.wide_funnel(t.events, SPEC)
    assert len(scans(df, "events")) == 1 and len(exchanges(df)) == 2


def test_unused_dimension_join_is_pruned(spark):
    # lazy sessions: hourly conversion needs no customer/nation/region column, so those scans must not appear
    lazy = driver_tables(spark, SF001)
    df = op.hourly_conversion(lazy.sessions, lazy.orders)
    assert scans(df, "customer") == [] and scans(df, "nation") == []


def test_segment_join_uses_dimension(spark):
    lazy = driver_tables(spark, SF001)
    df = op.segment_funnel(lazy.sessions, lazy.events, SPEC, "device_type")
    assert len(scans(df, "customer")) == 1


def test_sessions_read_the_event_log_once(t):
    assert len(scans(t.sessions, "events")) == 1
    assert len(scans(op.segment_funnel(t.sessions, t.events, SPEC, "device_type"), "events")) == 2  # sessions and flags


@pytest.mark.parametrize("name", ["q08_failure_reasons", "q23_price_cart_histogram", "q24_category_cart_rate",
                                  "q25_method_failure_rate", "q32_abandoned_products"])
def test_properties_are_parsed_once_from_the_given_text(spark, name):
    pp = physical_plan(QUERIES[name](spark, SF001))
    assert "from_json" in pp and "concat_ws" not in pp and "get_json_object" not in pp


def raw_aggregates(df):
    """The aggregates that read a scan without an exchange in between."""
    lines = physical_plan(df).split("== Initial Plan ==")[-1].splitlines()
    out, seen = [], []
    for line in lines:
        name = line.strip(" :+-*()0123456789")
        if "Exchange" in name:
            seen = []
        elif "Aggregate" in name:
            seen.append(name.split("(")[0])
        elif name.startswith("FileScan") or "Scan parquet" in name:
            out += seen
            seen = []
    return out


@pytest.mark.parametrize("name", ["q24_category_cart_rate", "q25_method_failure_rate", "q25_method_failure_rate_selected"])
def test_raw_events_are_hash_aggregated(spark, name):
    got = raw_aggregates(QUERIES[name](spark, SF001))
    assert got and all(x.startswith("HashAggregate") for x in got), got


def test_first_session_is_limited_before_the_shuffle(spark, fx):
    pp = physical_plan(op.new_session_flag(fx.sessions))
    assert "WindowGroupLimit" in pp and "SortAggregate" not in pp


def test_channel_roi_has_no_fanout_join_of_raw_rows(t):
    df = op.channel_roi(t.sessions, t.events, t.orders, "traffic_source", "purchase")
    text = "\n".join(exchanges(df))
    assert "Expand" not in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_in_plans(spark, name):
    assert python_udfs(QUERIES[name](spark, SF001)) == []


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_or_global_window(spark, name):
    pp = physical_plan(QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in pp and "BroadcastNestedLoopJoin" not in pp
    # the one window is a user's first session date
    assert all("windowspecdefinition(user_id" in line for line in pp.splitlines() if "windowspecdefinition" in line)
