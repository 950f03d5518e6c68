"""Bins from sketches, bitmaps of session numbers, SQL table functions."""

from __future__ import annotations

import math
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from journey import operators as op
from journey.plans import QUERIES
from journey.plans.inspect import exchanges, physical_plan, pushed_filters, read_schemas, scans
from tests.conftest import D, EVENTS, EVENTS_DDL, SF001, STAGES, rows

# --- bins ----------------------------------------------------------------------------


def plain_width(values):
    v = sorted(x for x in values if x is not None and math.isfinite(x))
    if not v:
        return None
    if len(v) < 2 or v[0] == v[-1]:
        raw = 1.0
    else:
        at = lambda q: v[math.ceil(q * len(v)) - 1]
        iqr = at(0.75) - at(0.25)
        raw = 2 * iqr / len(v) ** (1 / 3) if iqr else (v[-1] - v[0]) / (math.ceil(math.log2(len(v))) + 1)
    base = 10.0 ** math.floor(math.log10(raw))
    return base * next(n for n, top in ((1, 2 ** .5), (2, 10 ** .5), (5, 50 ** .5), (10, 11)) if raw / base < top)


@pytest.mark.parametrize("values", [
    [], [None], [3.0], [3.0] * 9, [0.0] * 90 + [7.0], [1.0, 2.0], [float("nan"), float("inf"), 1.0, 4.0, 9.0],
    [-5.5, -4.0, 0.25, 17.0, 3.5], [random.Random(1).gauss(500, 120) for _ in range(3000)],
    [random.Random(2).random() / 1000 for _ in range(2000)]])
def test_bin_width_of_exact_quartiles(spark, values):
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = op.bin_widths(op.quantile_sketches(df, "x")).first()["bin_width"]
    want = plain_width(values)
    assert got == pytest.approx(want) if want else got is None
    h = op.auto_histogram(df, "x")
    finite = [x for x in values if x is not None and math.isfinite(x)]
    assert sum(r["rows"] for r in h.collect()) == len(finite)
    assert {round(r["bin_low"] / got) for r in h.collect()} == {math.floor(x / got) for x in finite}


def test_merged_sketches_give_the_width_of_all(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i % 7 if i % 3 else None, rng.expovariate(0.01)) for i in range(3500)], "day int, x double")
    per = op.quantile_sketches(df, "x", "day")
    whole = op.bin_widths(op.quantile_sketches(df, "x")).collect()
    assert per.count() == 8 and op.bin_widths(op.merge_sketches(per)).collect() == whole
    assert rows(op.auto_histogram(df, "x", sketches=per)) == rows(op.auto_histogram(df, "x"))


def test_sketches_of_many_values_stay_close(spark):
    # far more values than a sketch holds; 2 x IQR / n^(1/3) is about 17,900, far from a rounding limit
    df = spark.range(300_000).select(F.pmod(F.xxhash64("id"), F.lit(1_200_000)).cast("double").alias("x"))
    assert op.bin_widths(op.quantile_sketches(df, "x")).first()["bin_width"] == 20_000.0


# --- bitmaps --------------------------------------------------------------------------


def _path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def _log(spark, tmp_path, data):
    ev = spark.createDataFrame(data, "session_id string, event_name string, product_id long, category string, day int")
    return op.numbered(ev, op.number_sessions(ev, _path(tmp_path)), _path(tmp_path))


def _events(n=4000):
    """One product holds a third of all rows; sessions add on several days; NULL sessions, products and categories."""
    rng = random.Random(5)
    return [(None if rng.random() < 0.02 else f"s{rng.randrange(600)}", rng.choice(["add", "add", "buy", "view"]),
             None if rng.random() < 0.02 else 1 if rng.random() < 0.33 else rng.randrange(2, 40),
             rng.choice(["a", "b", None]), rng.randrange(4)) for _ in range(n)]


def test_bitmaps_count_what_sets_count(spark, tmp_path):
    data = _events()
    log = _log(spark, tmp_path, data)
    want = {}
    for s, e, p, c, _ in data:
        if s is not None and p is not None and e != "view":
            want.setdefault((p, c), (set(), set()))[e == "buy"].add(s)
    want = {(p, c, len(a), len(b)) for (p, c), (a, b) in want.items() if len(a) > 3}
    direct = op.product_bitmaps(log, "add", "buy")
    by_day = op.product_bitmaps(log, "add", "buy", keys=("day",))
    for bitmaps in (direct, op.merge_bitmaps(by_day)):
        got = op.abandoned_from_bitmaps(bitmaps, min_sessions=3, k=10_000).collect()
        assert {(r.product_id, r.category, r.added_to_cart_sessions, r.purchased_sessions) for r in got} == want
    assert by_day.groupBy("product_id", "category", "bucket").count().filter("count > 1").count() > 0


def test_bitmaps_equal_the_row_form_and_empty_logs(spark, fx, tmp_path):
    log = op.numbered(fx.events, op.number_sessions(fx.events, _path(tmp_path), STAGES), _path(tmp_path), STAGES)
    bitmaps = op.product_bitmaps(log, "add_to_cart", "payment_success", spec=STAGES)
    assert rows(op.abandoned_from_bitmaps(bitmaps, 0)) == rows(
        op.abandoned_products(fx.events, "add_to_cart", "payment_success", 0, spec=STAGES))
    assert op.abandoned_from_bitmaps(op.merge_bitmaps(bitmaps.limit(0)), 0).collect() == []


def test_bitmaps_shuffle_no_row_per_session(spark, tmp_path):
    log = _log(spark, tmp_path, _events(300))
    df = op.abandoned_from_bitmaps(op.product_bitmaps(log, "add", "buy"), 0)
    keys = [e for e in exchanges(df) if "hashpartitioning" in e]
    assert len(keys) == 2 and not any("session" in e for e in keys)
    # one product whose sessions share a bucket is one row, however many sessions
    one = spark.range(1, 20_001, numPartitions=2).select(
        F.col("id").alias("session_no"), F.lit("add").alias("event_name"), F.lit(1).alias("product_id"), F.lit("a").alias("category"))
    assert op.product_bitmaps(one, "add", "buy").count() == 1
    assert op.abandoned_from_bitmaps(op.product_bitmaps(one, "add", "buy")).first()["added_to_cart_sessions"] == 20_000


# --- table functions ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def functions(spark, fx):
    for name in ("sessions", "events", "orders"):
        getattr(fx, name).createOrReplaceTempView("tf_" + name)
    return op.register_functions(spark, STAGES, {"device": "device_type", "new": "is_new_user", "the city": "city"},
                                 "tf_sessions", "tf_events", "tf_orders", prefix="tf_")


def test_functions_equal_the_operators(spark, fx, functions):
    assert functions == ["tf_overall_funnel", "tf_segment_funnel", "tf_revenue_leakage"]
    assert rows(spark.sql("SELECT * FROM tf_overall_funnel()")) == rows(op.overall_funnel(fx.events, STAGES))
    assert rows(spark.sql("SELECT * FROM tf_revenue_leakage()")) == rows(op.revenue_leakage(fx.events, fx.orders, STAGES))
    for name, col in (("device", "device_type"), ("the city", "city")):
        for keep in (False, True):
            assert rows(spark.sql(f"SELECT * FROM tf_segment_funnel('{name}', {str(keep).lower()})")) == rows(
                op.segment_funnel(fx.sessions, fx.events, STAGES, col, keep))
    assert {r.segment for r in spark.sql("SELECT * FROM tf_segment_funnel('new')").collect()} == {"true", "false"}


def test_function_day_limits_and_use_in_a_query(spark, fx, functions):
    some = fx.events.filter((F.to_date("event_timestamp") >= F.lit(D(2023, 10, 3))) & (F.to_date("event_timestamp") <= F.lit(D(2023, 11, 4))))
    got = spark.sql("SELECT * FROM tf_overall_funnel(DATE'2023-10-03', DATE'2023-11-04')")
    assert rows(got) == rows(op.overall_funnel(some, STAGES))
    assert rows(spark.sql("SELECT * FROM tf_overall_funnel(last_day => DATE'2023-10-02')"))[0][3] == 1
    top = spark.sql("SELECT segment FROM tf_segment_funnel('device') WHERE stage_idx = 4 ORDER BY conv_rate DESC, segment LIMIT 1")
    assert rows(top) == [("desktop",)]


def test_events_without_a_time_count_where_no_day_is_asked_for(spark, fx, functions):
    late = spark.createDataFrame([*EVENTS, (99, "s6", None, "page_view", "{}")], EVENTS_DDL)
    late.createOrReplaceTempView("tg_events")
    op.register_functions(spark, STAGES, {"device": "device_type"}, "tf_sessions", "tg_events", "tf_orders", prefix="tg_")
    assert rows(spark.sql("SELECT * FROM tg_overall_funnel()")) == rows(op.overall_funnel(late, STAGES))


def test_unknown_segment_is_an_error(spark, functions):
    with pytest.raises(PySparkException, match="unknown segment; known: device, new, the city"):
        spark.sql("SELECT * FROM tf_segment_funnel('nope')").collect()


def test_function_plans_are_the_operators_plans(spark):
    df = QUERIES["x05_sql_overall_funnel"](spark, SF001)
    assert len(scans(df, "events")) == 1 and len(exchanges(df)) == 2
    assert any("In(event_type" in p for p in pushed_filters(df))
    df = QUERIES["x05_sql_segment_funnel"](spark, SF001)
    assert "raise_error" not in physical_plan(df) and "NestedLoop" not in physical_plan(df)
    assert all("r_name" not in s for s in read_schemas(df) if "event_type" in s)
