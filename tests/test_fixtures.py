"""Hand-made tables (FIXTURES.md §3) with expected outputs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from journey import operators as op
from journey.functions.exprs import pooled_z_sql, sample_size_per_variant, two_sided_p_sql, power_delta
from tests.conftest import STAGES, approx, rows


def by_stage(df, col):
    return [r[col] for r in df.orderBy("stage_idx").collect()]


def test_overall_funnel(fx):
    f = op.overall_funnel(fx.events, STAGES)
    assert by_stage(f, "session_count") == [5, 3, 3, 3, 2]
    assert [approx(x) for x in by_stage(f, "overall_conv_rate")] == [1.0, 0.6, 0.6, 0.6, 0.4]
    assert [approx(x) for x in by_stage(f, "stage_conv_rate")] == [1.0, 0.6, 1.0, 1.0, 0.6667]
    assert by_stage(f, "dropoff_count") == [None, 2, 0, 0, 1]


def test_revenue_leakage_and_total(fx):
    f = op.revenue_leakage(fx.events, fx.orders, STAGES)
    assert [approx(x) for x in by_stage(f, "revenue_lost")] == [None, 453.3333, 0.0, 0.0, 226.6667]
    assert approx(op.leak_total(fx.events, fx.orders, STAGES).first()[0]) == 680.0


def test_leak_ranking(fx):
    r = op.leak_ranking(fx.events, fx.orders, STAGES, k=2).orderBy("leak_rank").collect()
    assert [x.stage_name for x in r[:2]] == ["product_detail_view", "payment_success"]
    assert [x.is_top_leak for x in r] == [True, True, False, False]


def test_flow_and_waterfall(fx):
    fl = op.funnel_flow(fx.events, STAGES)
    assert fl.count() == 2 * (STAGES.n - 1)
    out = fl.filter(F.col("source_idx") == 0).collect()
    # flows out of a stage add up to its count
    assert sum(r.value for r in out) == 5
    w = op.conversion_waterfall(fx.events, STAGES).orderBy("stage_idx").collect()
    assert [r.measure for r in w] == ["relative"] * 4 + ["total"]
    assert approx(w[0].value) == -0.4 and approx(w[-1].value) == 0.4


def test_payment_failure_and_reasons(fx):
    r = op.payment_failure_rate(fx.events, "payment_initiated", "payment_failed").first()
    assert (r.initiated, r.failed, approx(r.failure_rate)) == (3, 2, 0.6667)
    assert rows(op.failure_reasons(fx.events, "payment_failed")) == [("unknown", 1), ("upi_error", 1)]


def test_segment_funnel(fx):
    f = op.segment_funnel(fx.sessions, fx.events, STAGES, "device_type")
    got = {}
    for r in f.orderBy("segment", "stage_idx").collect():
        got.setdefault(r.segment, [r.total_sessions]).append(r.session_count)
    assert got == {"mobile": [2, 2, 1, 2, 1, 1], "desktop": [2, 2, 2, 1, 2, 1], "tablet": [1, 0, 0, 0, 0, 0]}
    kept = op.segment_funnel(fx.sessions, fx.events, STAGES, "device_type", keep_null=True)
    assert rows(kept.filter(F.col("segment").isNull()), "stage_idx", "session_count") == [
        (0, 1), (1, 0), (2, 0), (3, 0), (4, 0)]


def test_segment_funnel_sums_to_overall(fx):
    # invariant: with every segment kept, per-segment counts add up to the overall counts
    seg = op.segment_funnel(fx.sessions, fx.events, STAGES, "traffic_source")
    tot = seg.groupBy("stage_idx").agg(F.sum("session_count").alias("n")).orderBy("stage_idx")
    assert [r.n for r in tot.collect()] == by_stage(op.overall_funnel(fx.events, STAGES), "session_count")


def test_device_dropoff_inner(fx):
    d = op.device_dropoff(fx.sessions, fx.events, "device_type", "product_detail_view", "add_to_cart",
                          "payment_initiated", "payment_success")
    assert rows(d, "device_type", "total_sessions", "checkouts", "purchases") == [
        (None, 1, 0, 0), ("desktop", 2, 2, 1), ("mobile", 2, 1, 1)]


def test_city_tiers(fx):
    f = op.city_tier_funnel(fx.sessions, fx.events, STAGES).filter("stage_idx = 0")
    assert rows(f, "segment", "total_sessions") == [("Tier 1", 2), ("Tier 2", 3), ("Tier 3", 1)]


def test_conversion_matrix(fx):
    m = op.conversion_matrix(fx.sessions, fx.orders, "traffic_source", "device_type", ["mobile", "desktop", "tablet"])
    got = {r.traffic_source: (r.mobile, r.desktop, r.tablet) for r in m.collect()}
    assert got == {"email_campaign": (1.0, 0.0, None), "social_media": (0.0, 1.0, None), "direct": (None, None, 0.0)}
    ext = {r.kind: (r.traffic_source, r.device_type) for r in op.matrix_extremes(fx.sessions, fx.orders,
                                                                                 "traffic_source", "device_type").collect()}
    # ties: smallest column value first, then row value
    assert ext == {"best": ("social_media", "desktop"), "worst": ("email_campaign", "desktop")}


def test_hourly_and_monthly(fx):
    h = op.hourly_conversion(fx.sessions, fx.orders)
    assert [(r[0], r[1], r[2], approx(r[3])) for r in rows(h)] == [(9, 2, 0, 0.0), (13, 2, 2, 1.0), (20, 3, 1, 0.3333)]
    assert tuple(op.peak_hour(fx.sessions, fx.orders).first()) == (13, 1.0)
    m = op.monthly_trend(fx.sessions, fx.orders)
    assert rows(m, "month", "sessions", "conversions", "gmv") == [("2023-10", 3, 1, 200.0), ("2023-11", 4, 2, 1500.0)]


def test_duration_and_bounce(fx):
    d = op.duration_conversion(fx.sessions, fx.orders).orderBy("bucket_idx").collect()
    assert [r.duration_bucket for r in d] == ["< 30s", "30s-2m", "2m-5m", "5m-15m", "15m+"]
    assert [approx(r.conv_rate) for r in d] == [0.0, 0.0, 1.0, 0.0, 0.6667]
    assert approx(op.bounce_rate(fx.sessions, fx.orders).first()[0], 6) == 0.142857


def test_products(fx):
    h = op.price_cart_histogram(fx.events, "product_detail_view", "add_to_cart", 200)
    assert rows(h) == [(0.0, True, 1), (400.0, False, 1), (400.0, True, 1)]
    c = op.category_cart_rate(fx.events, "product_detail_view", "add_to_cart")
    assert rows(c) == [("beauty", 1.0), ("sports", 0.5)]


def test_method_failure_literal(fx):
    m = op.method_failure_rate(fx.events, "payment_initiated", "payment_success", "payment_failed")
    assert rows(m) == [("cod", 1.0), ("unknown", 0.0), ("upi", 0.0)]


def test_time_to_purchase(fx):
    assert op.time_to_purchase(fx.events, "payment_success").first()[0] == 5.42


def test_channel_roi_literal_vs_dedup(fx):
    lit = op.channel_roi(fx.sessions, fx.events, fx.orders, "traffic_source", "payment_success")
    assert rows(lit, "traffic_source", "total_sessions", "converting_sessions", "total_revenue") == [
        ("direct", 2, 0, 0.0), ("email_campaign", 2, 1, 400.0), ("social_media", 2, 1, 1500.0)]
    ded = op.channel_roi(fx.sessions, fx.events, fx.orders, "traffic_source", "payment_success", dedup=True)
    assert rows(ded, "traffic_source", "total_revenue") == [
        ("direct", 0.0), ("email_campaign", 200.0), ("social_media", 1500.0)]


def test_user_rollup_and_tiers(fx, spark):
    r = op.loyalty_tiers(fx.users, fx.sessions, fx.orders)
    assert rows(r) == [("u1", 2, 1, 200.0, "bronze"), ("u2", 1, 0, 0.0, "new"),
                       ("u3", 2, 2, 1500.0, "silver"), ("u4", 1, 0, 0.0, "new")]
    four = spark.createDataFrame([(f"o{i}", "x", "u9", 1.0) for i in range(4)], "order_id STRING, session_id STRING, "
                                                                              "user_id STRING, gmv DOUBLE")
    g = op.loyalty_tiers(spark.createDataFrame([("u9",)], "user_id STRING"), fx.sessions, four).first()
    assert g.loyalty_tier == "gold"


def test_first_seen_and_new_flag(fx, spark):
    users = spark.createDataFrame([("u1",), ("u5",)], "user_id STRING")
    fs = op.first_seen(users, fx.sessions, default_date="2023-07-01")
    assert [(r.user_id, str(r.first_seen_date)) for r in fs.orderBy("user_id").collect()] == [
        ("u1", "2023-10-02"), ("u5", "2023-07-01")]
    nf = op.new_session_flag(fx.sessions)
    assert rows(nf.filter("is_new_user"), "session_id") == [("s1",), ("s3",), ("s4",), ("s6",)]


def test_campaign_tag(fx):
    t = op.campaign_tag(fx.sessions, ["social_media"])
    assert rows(t.filter(F.col("utm_campaign").isNotNull())) == [
        ("s2", "campaign_social_media_Oct"), ("s4", "campaign_social_media_Nov")]


def test_dashboard_and_abandonment(fx):
    d = op.dashboard_funnel(fx.events, STAGES).orderBy("step_idx").collect()
    assert approx(d[1].pct_previous) == 0.6 and d[0].pct_previous == 1.0
    a = op.abandonment_rates(fx.events, STAGES, "add_to_cart", "payment_initiated", "payment_success").first()
    assert approx(a.cart_abandonment) == 0.0 and approx(a.checkout_abandonment) == 33.3333


def test_z_test_formula(spark):
    df = spark.createDataFrame([(50, 1000, 30, 1000), (0, 10, 0, 10)], "xa INT, na INT, xb INT, nb INT")
    r = df.select(F.expr(pooled_z_sql("xa", "na", "xb", "nb")).alias("z")).withColumn("p", F.expr(two_sided_p_sql("z"))).collect()
    assert approx(r[0].z, 6) == 2.282177
    assert abs(r[0].p - 0.02247887) < 2e-7
    assert r[1].z is None and r[1].p is None  # p = 0: no standard error
    tiny = spark.range(1).select(F.lit(12.0).alias("z")).select(F.expr(two_sided_p_sql("z")).alias("p")).first().p
    assert abs(tiny / math.erfc(12 / math.sqrt(2)) - 1) < 2e-7  # relative accuracy far out


def test_sample_size_formula(spark):
    assert abs(power_delta(0.05, 0.8) - 2.8015817870135784) < 1e-9
    n = spark.range(1).select(sample_size_per_variant(F.lit(0.014), F.lit(0.0007)).alias("n")).first().n
    assert n == 442227


def test_ab_significance_fixture(fx):
    r = op.ab_significance(fx.sessions, fx.events, STAGES, "device_type", "desktop", "mobile").first()
    assert (r.n_a, r.x_a, r.n_b, r.x_b) == (2, 1, 2, 1)
    assert r.z == 0.0 and r.significant is False


def test_empty_events(spark, fx):
    empty = fx.events.limit(0)
    f = op.overall_funnel(empty, STAGES).orderBy("stage_idx").collect()
    assert [r.session_count for r in f] == [0] * 5
    assert all(r.overall_conv_rate is None for r in f)
    assert all(r.stage_conv_rate is None for r in f[1:])  # no ANSI divide-by-zero error


def test_ties_smallest_key_wins(spark):
    from journey.operators.flags import mark_best
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.1)], "k STRING, v DOUBLE")
    assert rows(mark_best(df, "k", "v").filter("is_best"), "k") == [("a",)]


def test_permuted_input_same_result(fx):
    base = rows(op.overall_funnel(fx.events, STAGES))
    shuffled = fx.events.orderBy(F.rand(7)).repartition(3)
    assert rows(op.overall_funnel(shuffled, STAGES)) == base


def test_payment_mix(fx):
    s = op.with_city_tier(fx.sessions)
    r = op.payment_mix_by_segment(s, fx.orders, "city_tier", "cod")
    assert rows(r) == [("Tier 1", 3, 2, pytest.approx(2 / 3))]


def test_typed_properties_give_same_results(fx):
    """Properties stored as a struct column (no JSON parsing) give the JSON-text results."""
    from journey.functions.exprs import parse_props

    typed = fx.events.withColumn("event_properties", parse_props("event_properties"))
    pairs = [
        (lambda ev: op.failure_reasons(ev, "payment_failed")),
        (lambda ev: op.method_failure_rate(ev, "payment_initiated", "payment_success", "payment_failed")),
        (lambda ev: op.price_cart_histogram(ev, "product_detail_view", "add_to_cart", 200)),
        (lambda ev: op.category_cart_rate(ev, "product_detail_view", "add_to_cart")),
        (lambda ev: op.abandoned_products(ev, "add_to_cart", "payment_success", 0, 20)),
    ]
    for f in pairs:
        assert rows(f(typed)) == rows(f(fx.events))


def test_segment_count_arrays(fx):
    a = {r.segment: (r.total_sessions, list(r.counts), [approx(x) for x in r.conv_rates])
         for r in op.segment_count_arrays(fx.sessions, fx.events, STAGES, "device_type").collect()}
    assert a["mobile"] == (2, [2, 1, 2, 1, 1], [1.0, 0.5, 1.0, 0.5, 0.5])
    assert a["tablet"] == (1, [0, 0, 0, 0, 0], [0.0] * 5)


def test_missing_column_fails_early(fx):
    import pytest as _pytest

    with _pytest.raises(ValueError):
        op.overall_funnel(fx.events.drop("event_name"), STAGES)


def test_all_zero_later_stages(fx):
    """Only first-stage events: later step rates divide 0 by 0 → NULL, without an ANSI error."""
    only_first = fx.events.filter("event_name = 'page_view'")
    f = op.overall_funnel(only_first, STAGES).orderBy("stage_idx").collect()
    assert [r.session_count for r in f] == [5, 0, 0, 0, 0]
    assert f[1].stage_conv_rate == 0.0 and all(r.stage_conv_rate is None for r in f[2:])
    assert all(r.dropoff_rate is None for r in f[2:])
    w = op.wide_funnel(only_first, STAGES).first()
    assert w["product_detail_view_to_add_to_cart_rate"] is None and w["overall_conversion_rate"] == 0.0
