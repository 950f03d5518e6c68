"""The report command runs every analysis over reference-style CSV tables and writes the results."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from journey import operators as op
from journey import report
from journey.functions.exprs import parse_props
from journey.plans.inspect import physical_plan
from journey.session import save_table
from journey.spec import PRESETS, SCRIPT_ROLES
from tests.conftest import rows, write_journey_csv


def test_report_writes_every_analysis(spark):
    d = tempfile.mkdtemp(prefix="journey-report-", dir=os.environ.get("TMPDIR", "/tmp"))
    src, out = os.path.join(d, "in"), os.path.join(d, "out")
    os.makedirs(src)
    write_journey_csv(src)
    written = report.run(spark, src, out, fmt="csv", preset="script", out_format="parquet")
    assert {"new_session_flag", "campaign_tag", "method_failure_rate_selected", "channel_roi_dedup_device_type"} <= set(written)
    assert len(written) >= 45 and "funnel_overall" in written and "user_rollup" in written
    funnel = spark.read.parquet(os.path.join(out, "funnel_overall"))
    assert funnel.count() == 10  # the ten script stages, present or not
    roll = spark.read.parquet(os.path.join(out, "user_rollup"))
    assert sorted((r.user_id, r.total_orders) for r in roll.collect()) == [("u1", 1), ("u2", 0), ("u3", 2), ("u4", 0)]


def test_flags_stand_in_for_the_events(spark, fx):
    d = tempfile.mkdtemp(prefix="journey-report-", dir=os.environ.get("TMPDIR", "/tmp"))
    spec, roles = PRESETS["script"], SCRIPT_ROLES
    flags = save_table(op.flag_table(fx.events, spec, report.flag_events(spec, roles)), os.path.join(d, "flags"))
    plain = report.analyses(fx, spec, roles, {"add_to_cart": 8})
    stored = report.analyses(fx, spec, roles, {"add_to_cart": 8}, flags)
    assert set(plain) == set(stored) and "priority_matrix" in plain
    from_flags = [n for n in plain if f"{d}/flags" in physical_plan(stored[n])]
    assert len(from_flags) >= 20
    for name in from_flags:
        assert rows(stored[name]) == rows(plain[name]), name


def test_warehouse_tables_run_as_the_sql_expects_them(spark, fx):
    d = tempfile.mkdtemp(prefix="journey-report-", dir=os.environ.get("TMPDIR", "/tmp"))
    names = {"product_detail_view": "product_view", "payment_initiated": "begin_checkout", "payment_success": "purchase"}
    props = parse_props("event_properties")
    fx.events.replace(names, subset=["event_name"]).select(
        "event_id", "session_id", "event_name", F.col("event_timestamp").cast("string").alias("timestamp"),
        props.getField("product_id").alias("product_id"), props.getField("category").alias("category"),
    ).write.parquet(os.path.join(d, "events.parquet"))
    fx.sessions.write.parquet(os.path.join(d, "sessions.parquet"))
    fx.orders.select("session_id", F.col("gmv").alias("order_value")).write.parquet(os.path.join(d, "orders.parquet"))
    written = report.run(spark, d, os.path.join(d, "out"), "parquet", "warehouse", "parquet", work_dir=os.path.join(d, "work"))
    assert len(written) == 9
    read = lambda n: spark.read.parquet(os.path.join(d, "out", n))
    assert read("time_to_purchase").first()[0] == 5.42
    assert rows(read("channel_roi_traffic_source"), "traffic_source", "total_revenue") == [
        ("direct", 0.0), ("email_campaign", 400.0), ("social_media", 1500.0)]
    assert rows(read("device_dropoff_device_type"), "device_type", "total_sessions", "checkouts", "purchases") == [
        (None, 1, 0, 0), ("desktop", 2, 2, 1), ("mobile", 2, 1, 1)]
    assert read("wide_funnel").first().sessions_with_page_view == 6  # the events without a session id are one group
    assert read("abandoned_products").count() == 0  # more than 50 sessions are asked for


WAREHOUSE_CSV = {
    "sessions": 'traffic_source,session_id,device_type\ndirect,s1,mobile\n"email, own",s2,desktop\n',
    "events": 'event_id,timestamp,session_id,event_name,category,product_id,note\n'
              '1,2025-03-01 10:00:00,s1,page_view,,,"{""a"": ""x, y""}"\n'
              '2,2025-03-01 10:05:00,s1,add_to_cart,"Home, Garden",p1,\n'
              '3,2025-03-01 10:30:00,s1,purchase,"Home, Garden",p1,\n'
              '4,2025-03-01 11:00:00,s2,page_view,,,\n',
    "orders": 'order_value,session_id\n{amount},s1\n',
}


def write_warehouse(amount):
    d = tempfile.mkdtemp(prefix="journey-report-", dir=os.environ.get("TMPDIR", "/tmp"))
    for name, text in WAREHOUSE_CSV.items():
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write(text.replace("{amount}", amount))
    return d


def test_warehouse_csv_is_read_by_declared_types_and_header_names(spark):
    d = write_warehouse("250.5")
    wanted = ["time_to_purchase", "channel_roi_traffic_source", "wide_funnel"]
    assert sorted(report.run(spark, d, os.path.join(d, "out"), "csv", "warehouse", "parquet", wanted)) == sorted(wanted)
    read = lambda n: spark.read.parquet(os.path.join(d, "out", n))
    assert read("time_to_purchase").first()[0] == 30.0
    roi = read("channel_roi_traffic_source")
    assert dict(roi.dtypes)["total_revenue"] == "double"
    assert rows(roi, "traffic_source", "total_revenue") == [("direct", 250.5), ("email, own", 0.0)]
    assert read("wide_funnel").first().sessions_with_page_view == 2


def test_warehouse_csv_with_a_value_of_another_type_fails(spark):
    d = write_warehouse("many")
    with pytest.raises(Exception, match="(?i)malformed|many"):
        report.run(spark, d, os.path.join(d, "out"), "csv", "warehouse", "parquet", ["channel_roi_device_type"])
