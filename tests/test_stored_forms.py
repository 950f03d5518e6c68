"""Fused session facts, bucketed tables, incremental state, checked loads, VARIANT properties and the time cube."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from journey import operators as op
from journey.functions.exprs import parse_variant
from journey.operators.flags import FLAG
from journey.plans import QUERIES
from journey.plans.inspect import exchanges, physical_plan, scans
from journey.sources import schemas
from journey.sources.bucketed import store_bucketed
from journey.sources.checked import checked_csv, checked_parquet, load_with_report
from journey.sources.driver_tables import driver_tables
from journey.sources.io import write_parquet
from journey.spec import PRESETS
from tests.conftest import EVENTS, EVENTS_DDL, SF001, SF0001, STAGES, rows, write_journey_csv

SPEC = PRESETS["driver"]
D = dt.date


@pytest.fixture(scope="module")
def t(spark):
    return driver_tables(spark, SF0001)


# --- session row and flags from one aggregate ------------------------------------

@pytest.mark.parametrize("name", ["q09_segment_funnel", "q10_segment_gap", "q12_city_tier_funnel", "q26_ab_significance_device",
                                  "q28_experiment_sample_size", "q30_device_dropoff", "q38_dashboard_segment_funnel",
                                  "c24_count_arrays"])
def test_segment_queries_scan_the_event_log_once(spark, name):
    df = QUERIES[name](spark, SF001)
    assert len(scans(df, "events")) == 1
    assert sum("hashpartitioning(session_id" in e for e in exchanges(df)) == 1


def test_facts_count_like_sessions_joined_with_events(t):
    for col in ("device_type", "traffic_source", "is_new_user"):
        for keep in (False, True):
            assert rows(op.segment_counts(t.facts, t.facts, SPEC, col, keep)) == rows(
                op.segment_counts(t.sessions, t.events, SPEC, col, keep))


def test_facts_leave_out_events_without_a_session(fx):
    facts = op.session_facts(fx.events, STAGES, STAGES.names, F.min("event_timestamp").alias("started"))
    assert rows(facts, "session_id", FLAG + "add_to_cart") == [("s1", 1), ("s2", 1), ("s3", 0), ("s4", 1), ("s5", 0)]
    assert op.has_flags(facts, STAGES) and not op.has_flags(fx.sessions, STAGES)


# --- bucketed tables ----------------------------------------------------------------

@pytest.fixture(scope="module")
def stored(spark, t, tmp_path_factory):
    b = store_bucketed(t, SPEC, str(tmp_path_factory.mktemp("bucketed")), buckets=4)
    yield b
    b.drop()


def bucketed_forms(b):
    return {
        "segment_funnel": op.segment_funnel(b.sessions, b.flags, SPEC, "device_type"),
        "segment_conversion": op.segment_conversion(b.sessions, b.events, SPEC, "traffic_source"),
        "city_tier": op.city_tier_funnel(b.sessions, b.flags, SPEC, "state", ("ASIA",), ("EUROPE",)),
        "mix": op.payment_mix_by_segment(b.sessions, b.orders, "device_type", "m0"),
        "dropoff": op.device_dropoff(b.sessions, b.events, "device_type", "view", "click", "signup", "purchase"),
        "roi": op.channel_roi(b.sessions, b.events, b.orders, "traffic_source", "purchase"),
        "dashboard": op.dashboard_segment_funnel(b.sessions, b.flags, SPEC, "traffic_source"),
        "share": op.segment_share(b.sessions, b.orders, "device_type"),
        "hourly": op.hourly_conversion(b.sessions, b.orders),
    }


def test_bucketed_tables_join_without_a_session_shuffle(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables too large to broadcast
    try:
        for name, df in bucketed_forms(stored).items():
            assert not [e for e in exchanges(df) if "hashpartitioning(session_id" in e], name
            assert "SortMergeJoin" in physical_plan(df), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_give_the_same_rows(t, stored):
    from journey.plans.catalog import rounded

    plain = type(stored)(t.sessions, t.events, t.orders, flags=t.events)
    want = bucketed_forms(plain)
    for name, df in bucketed_forms(stored).items():
        assert rows(rounded(df)) == rows(rounded(want[name])), name


def test_one_sorted_file_a_bucket(spark, t, stored, tmp_path):
    assert len(stored.sessions.inputFiles()) <= 4
    extra = t.sessions.limit(3).withColumn("session_id", F.lit(None).cast("string")).unionByName(t.sessions)
    b = store_bucketed(type(stored)(extra, t.events, t.orders), SPEC, str(tmp_path / "x"), buckets=2, event_cols=["session_id", "event_name"])
    assert b.sessions.count() == extra.count() and b.events.columns == ["session_id", "event_name"]
    assert b.flags.filter("session_id IS NULL").count() == 0
    b.drop()
    assert not spark.catalog.tableExists(b.names["sessions"])


# --- incremental state ------------------------------------------------------------------

def day_log(spark, path, events):
    df = spark.createDataFrame(events, EVENTS_DDL).withColumn("day", F.to_date("event_timestamp"))
    write_parquet(df.drop("event_properties"), path, ["day"])
    return spark.read.schema("event_id long, session_id string, event_timestamp timestamp_ntz, event_name string, day date").parquet(path)


def test_a_second_update_opens_new_days_only(spark, tmp_path):
    path, cut = str(tmp_path / "log"), dt.datetime(2023, 11, 1)
    state = op.FunnelState(spark, str(tmp_path / "state"), STAGES)
    assert state.flags().collect() == [] and state.ledger().collect() == []
    log = day_log(spark, path, [e for e in EVENTS if e[2] < cut])
    assert state.update(log, "day") == [D(2023, 10, 2), D(2023, 10, 3)]
    assert state.update(log, "day") == []
    late = spark.createDataFrame([e for e in EVENTS if e[2] >= cut], EVENTS_DDL).withColumn("day", F.to_date("event_timestamp"))
    late.drop("event_properties").write.mode("append").partitionBy("day").parquet(path)
    for old in Path(path).glob("day=2023-10-*/*.parquet"):  # a file that is opened again would fail the update
        old.write_bytes(b"not parquet")
        old.with_name(f".{old.name}.crc").unlink(missing_ok=True)
    again = spark.read.schema(log.schema).parquet(path)
    assert state.update(again, "day") == [D(2023, 11, 4), D(2023, 11, 5)]
    whole = spark.createDataFrame(EVENTS, EVENTS_DDL)
    assert rows(op.overall_funnel(state.flags(), STAGES)) == rows(op.overall_funnel(whole, STAGES))
    assert rows(state.ledger(), "seq", "day", "sessions") == [
        (1, D(2023, 10, 2), 1), (1, D(2023, 10, 3), 2), (2, D(2023, 11, 4), 1), (2, D(2023, 11, 5), 1)]


def test_a_day_processed_again_replaces_its_flags_and_dead_updates_are_not_seen(spark, tmp_path):
    state = op.FunnelState(spark, str(tmp_path / "state"), STAGES)
    first = [(1, "a", dt.datetime(2024, 1, 1, 5), "page_view", None), (2, "b", dt.datetime(2024, 1, 2, 5), "page_view", None),
             (3, "b", dt.datetime(2024, 1, 1, 23), "add_to_cart", None)]
    log = day_log(spark, str(tmp_path / "log1"), first)
    state.update(log, "day")
    fixed = day_log(spark, str(tmp_path / "log2"), [*first[:2], (3, "c", dt.datetime(2024, 1, 1, 23), "payment_success", None)])
    assert state.update(fixed, "day") == []
    assert state.update(fixed, "day", again=[D(2024, 1, 1), D(2025, 1, 1)]) == [D(2024, 1, 1)]
    dead = f"{state.path}/flags/batch=dead/day=2024-01-01"
    spark.createDataFrame([("z", 1, 1, 1, 1, 1)], ", ".join(["session_id string", *[f"`{FLAG}{n}` int" for n in STAGES.names]])
                          ).write.parquet(dead)
    got = rows(state.flags(), "session_id", FLAG + "page_view", FLAG + "add_to_cart", FLAG + "payment_success")
    assert got == [("a", 1, 0, 0), ("b", 1, 0, 0), ("c", 0, 0, 1)]


# --- loads with a report --------------------------------------------------------------------

def test_report_names_what_does_not_fit(spark, tmp_path):
    write_journey_csv(str(tmp_path), users=False)
    orders = tmp_path / "orders.csv"
    header, *lines = orders.read_text().splitlines()
    orders.unlink()
    orders.mkdir()
    (orders / "a.csv").write_text("\n".join([header, lines[0], lines[1].replace("1000.0", "a lot"), "o9,s1"]) + "\n")
    names = header.split(",")
    at = names.index("gmv")
    turned = lambda x: ",".join([x.split(",")[at], *[v for i, v in enumerate(x.split(",")) if i != at], "new"])
    (orders / "b.csv").write_text("\n".join([turned(header).replace("coupon_code", "code"), turned(lines[2])]) + "\n")
    tables, report = load_with_report(spark, str(tmp_path))
    assert rows(tables.orders, "order_id", "gmv", "coupon_code") == [("o1", 200.0, "SAVE20"), ("o3", 500.0, None)]
    assert tables.orders.count() == 2  # a narrow query sees the same rows
    assert tables.sessions.count() == 6 and tables.events.count() == 20 and tables.users.count() == 0
    got = {(r["table"], Path(r["file"]).name, r["problem"], r["detail"]) for r in report.collect()}
    assert got == {
        ("users", "users.csv", "missing table", None), ("orders", "b.csv", "missing column", "coupon_code"),
        ("orders", "b.csv", "unknown column", "code"), ("orders", "b.csv", "unknown column", "new"),
        ("orders", "a.csv", "bad row", lines[1].replace("1000.0", "a lot")), ("orders", "a.csv", "bad row", "o9,s1")}


def test_report_of_empty_files_and_parquet(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text(",".join(schemas.USERS.names) + "\n")
    got, report = checked_csv(spark, str(tmp_path / "header.csv"), schemas.USERS, "users")
    assert got.collect() == [] and report.collect() == []
    got, report = checked_csv(spark, str(tmp_path / "empty.csv"), schemas.USERS, "users")
    assert got.collect() == []
    spark.createDataFrame([("u1", "x", "2.5")], "user_id string, gender string, total_orders string").write.parquet(str(tmp_path / "p"))
    got, report = checked_parquet(spark, str(tmp_path / "p"), schemas.USERS, "users")
    assert rows(got, "user_id", "total_orders", "loyalty_tier") == [("u1", 2.5, None)]
    assert {"other type", "missing column"} == {r["problem"] for r in report.collect()}


# --- VARIANT properties -------------------------------------------------------------------------

MIXED = [
    '{"product_id": 7, "category": "beauty", "price": 199, "extra": {"a": [1, 2]}}', '{"price": "199", "product_id": 7.5}',
    '{"price": true, "category": 12, "method": false}', '{"category": null, "reason": "bank", "price": 1.25}', "not json", "", "[1, 2]",
    '"text"', "null", '{"product_id": "12", "category": "", "price": 1e3}', None, "{}", '{"Price": 5}',
]


def test_variant_properties_equal_parsed_text(spark):
    text = spark.createDataFrame(list(enumerate(MIXED)), "id int, event_properties string")
    from journey.functions.exprs import props_of

    variant = text.withColumn("event_properties", parse_variant("event_properties"))
    keys = ("product_id", "category", "price", "method", "reason")
    pick = lambda df: rows(df.select("id", *[props_of(df, "event_properties").getField(k).alias(k) for k in keys]))
    assert pick(variant) == pick(text)


def test_queries_give_the_same_rows_on_text_struct_and_variant(spark, t, tmp_path):
    text = t.events.withColumn("event_properties", F.to_json("event_properties"))
    text.withColumn("event_properties", parse_variant("event_properties")).write.parquet(str(tmp_path / "variant"))
    forms = [t.events, text, spark.read.parquet(str(tmp_path / "variant"))]
    for ask in (lambda e: op.failure_reasons(e, "error"), lambda e: op.price_cart_histogram(e, "view", "click", 50.0),
                lambda e: op.category_cart_rate(e, "view", "click"),
                lambda e: op.method_failure_rate(e, "signup", "purchase", "error")):
        one, two, three = (rows(ask(e)) for e in forms)
        assert one == two == three and one


# --- first sessions and the time cube ----------------------------------------------------------

def test_first_sessions_send_one_row_a_user_and_task(spark, fx):
    df = op.first_sessions(fx.sessions)
    assert "WindowGroupLimit" in physical_plan(df)
    assert rows(df, "user_id", "session_id") == [("u1", "s1"), ("u2", "s3"), ("u3", "s4"), ("u4", "s6")]
    odd = spark.createDataFrame([("b", "u", None, 3), ("a", "u", D(2024, 1, 1), 1), ("c", None, None, None), ("b", "u", None, 3)],
                                "session_id string, user_id string, session_date date, session_hour int")
    assert rows(op.new_session_flag(odd)) == [("a", "u", False), ("b", "u", True), ("b", "u", True), ("c", None, False)]


def test_new_session_flag_joins_on_the_session(t):
    pp = physical_plan(op.new_session_flag(t.sessions))
    assert "SortAggregate" not in pp and "WindowGroupLimit" in pp


@pytest.mark.parametrize("source", ["driver", "fixture"])
def test_cube_equals_the_single_queries(t, fx, source):
    from journey.plans.catalog import rounded

    s, o = (t.sessions, t.orders) if source == "driver" else (fx.sessions, fx.orders)
    cube = op.time_cube(s, o)
    tables = op.cube_tables(cube)
    for name, df in tables.items():
        want = getattr(op, name)(s, o)
        assert sorted(df.columns) == sorted(want.columns), name
        assert rows(rounded(df), *sorted(df.columns)) == rows(rounded(want), *sorted(df.columns)), name


def test_cube_reads_sessions_and_orders_once(spark, tmp_path):
    t = driver_tables(spark, SF001)
    t.sessions.write.parquet(str(tmp_path / "se"))
    t.orders.write.parquet(str(tmp_path / "od"))
    cube = op.time_cube(spark.read.parquet(str(tmp_path / "se")), spark.read.parquet(str(tmp_path / "od")))
    assert len(scans(cube)) == 2 and "Expand" in physical_plan(cube)
