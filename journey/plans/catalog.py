"""Registered queries: each library operator run over the benchmark tables.

Every callable takes ``(spark, sf_dir)``, derives the journey tables from the
whole benchmark tables (``driver_tables``) and returns one lazy DataFrame.
Doubles are rounded to 6 decimals (and -0.0 normalised) at the very end so a
different float summation order cannot change the compared values; the
library operators themselves return unrounded values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journey import operators as op
from journey.functions import exprs as X
from journey.session import ensure_checkpoint_dir, save_table
from journey.sources import schemas
from journey.sources.bucketed import store_bucketed
from journey.sources.checked import load_with_report
from journey.sources.driver_tables import driver_tables
from journey.sources.io import dataset_summary, read_csv, write_csv, write_parquet
from journey.spec import DRIVER_ROLES, PRESETS

# --- fixed values: parameters of the registered queries ---------------------
SPEC = PRESETS["driver"]
R = DRIVER_ROLES
DEVICE, SOURCE = "device_type", "traffic_source"
SEG_A, SEG_B = "BUILDING", "AUTOMOBILE"
DEVICE_VALUES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
TIER_COL, TIER1, TIER2 = "state", ("AMERICA", "EUROPE"), ("ASIA",)
MIX_METHOD = "m0"
PAID_SOURCES = ("AMERICA", "ASIA")
EFFORT = {"click": 8, "signup": 5, "purchase": 3}
PRICE_BIN = 50.0
ABANDON_MIN_SESSIONS, ABANDON_TOP_K = 15, 20
LIFT = 0.05
ROUND_DP = 6
STORE_BUCKETS = 8
# ---------------------------------------------------------------------------

FLAGSHIP = "q01_overall_funnel"


def rounded(df: DataFrame, dp: int = ROUND_DP) -> DataFrame:
    """Round DOUBLE columns (one SQL projection: a single JVM call for all columns)."""
    cols = [f"round(`{n}`, {dp}) + 0.0D AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes]
    return df.selectExpr(*cols)


def _q(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(driver_tables(spark, sf_dir)))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _page_urls(t):
    """Events per page URL and stage title."""
    name = F.col("event_name")
    return t.events.groupBy(X.page_url(name).alias("page_url"), X.title_case(name).alias("title")).agg(
        F.count(F.lit(1)).alias("events"))


def _display(t):
    """C20: the overview figures in their display forms."""
    k = op.kpi_overview(t.sessions, t.events, t.orders, R.purchase)
    return k.select(
        X.thousands("total_revenue", "₹").alias("revenue_text"), X.thousands("total_orders").alias("orders_text"),
        X.inr_lakh("total_revenue").alias("revenue_lakh"), X.percent_text("conversion_rate").alias("conversion_text"))


def _properties_json(t):
    """Events per serialised property set (without the free number)."""
    p = F.col("event_properties")
    j = X.props_json(category=p.getField("category"), method=p.getField("method"), reason=p.getField("reason"))
    return t.events.groupBy(j.alias("properties")).agg(F.count(F.lit(1)).alias("events"))


def _count_arrays(t):
    """The per-segment count and rate arrays, one row per element."""
    w = op.segment_count_arrays(t.facts, t.facts, SPEC, DEVICE)
    return w.select("segment", "total_sessions", F.posexplode(F.arrays_zip("counts", "conv_rates")).alias("stage_idx", "z")).select(
        "segment", "total_sessions", "stage_idx", F.col("z.counts").alias("session_count"), F.col("z.conv_rates").alias("conv_rate"))


def _text_times(t):
    """Time to purchase from timestamps given as text."""
    return op.time_to_purchase(t.events.withColumn("event_timestamp", F.col("event_timestamp").cast("string")), R.purchase)


def _peak(t):
    """Sessions inside and outside the peak hours."""
    return t.sessions.groupBy(X.is_peak_hour("session_hour").alias("is_peak_hour")).agg(F.count(F.lit(1)).alias("sessions"))


def _csv_round_trip(t):
    """Orders through the CSV sink and the Parquet sink and back by declared schema."""
    base = f"{ensure_checkpoint_dir(t.orders.sparkSession).rstrip('/')}/journey-sinks-{uuid.uuid4().hex}"
    orders = t.orders.select(*[F.col(f.name).cast(f.dataType) if f.name in t.orders.columns else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in schemas.ORDERS.fields])
    write_csv(orders, f"{base}/orders.csv")
    back = read_csv(orders.sparkSession, f"{base}/orders.csv", schemas.ORDERS)
    write_parquet(back.withColumn("day", F.to_date("order_date")), f"{base}/orders.parquet", ["day"])
    stored = orders.sparkSession.read.parquet(f"{base}/orders.parquet")
    return stored.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("orders"), X.money_total("gmv").alias("gmv"),
        F.min(F.to_date("order_date")).alias("first_date"), F.max(F.to_date("order_date")).alias("last_date"))


def _named_tables(t):
    """The tables as views, read by SQL text."""
    spark, prefix = t.raw.spark, "j_"
    t.events.createOrReplaceTempView(prefix + "events")
    t.sessions.createOrReplaceTempView(prefix + "sessions")
    return spark.sql(f"SELECT s.{DEVICE} AS segment, count(*) AS events FROM {prefix}events e "
                     f"JOIN {prefix}sessions s ON e.session_id = s.session_id GROUP BY s.{DEVICE}")


def _scratch(t, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.raw.spark).rstrip('/')}/journey-{name}-{uuid.uuid4().hex}"


def _bucketed(fn):
    """The query over sessions, events and orders that are stored bucketed by session first."""
    def run(t):
        log = ["session_id", "event_name"]
        return fn(store_bucketed(t, SPEC, _scratch(t, "bucketed"), buckets=STORE_BUCKETS, event_cols=log))

    return run


def _tiers_of(b):
    return op.with_city_tier(b.sessions, TIER_COL, TIER1, TIER2)


def _updates(t):
    """The event log stored by day, taken in by two updates: the days before the middle one, then all."""
    days = _scratch(t, "days")
    write_parquet(t.events.select("session_id", "event_name", F.to_date("event_timestamp").alias("day")), days, ["day"])
    log = t.raw.spark.read.schema("session_id string, event_name string, day date").parquet(days)
    middle = log.agg(F.expr("date_add(min(day), CAST(floor(datediff(max(day), min(day)) / 2) AS INT))")).scalar()
    state = op.FunnelState(t.raw.spark, _scratch(t, "state"), SPEC)
    state.update(log.filter(F.col("day") < middle), "day")
    state.update(log, "day")
    return state


def _incremental_ledger(t):
    """The days and the sessions a day that each update read."""
    return _updates(t).ledger().groupBy(F.col("seq").alias("update")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("sessions").alias("sessions"))


def _load_report(t):
    """S3: CSV tables with planted faults, loaded with a report; one row per fault kind, bad rows and good rows counted."""
    base = _scratch(t, "faulty")

    def put(df, name, schema, mode="overwrite", drop=(), **planted):
        columns = [planted.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)).cast("string").alias(f.name)
                   for f in schema.fields if f.name not in drop]
        columns += [c.alias(n) for n, c in planted.items() if n not in schema.names]
        df.select(*columns).write.mode(mode).options(header="true", escape='"', quote='"').csv(f"{base}/{name}.csv")

    nth = F.pmod(F.col("order_id"), F.lit(50))
    faults = {"gmv": F.when(nth == 0, "n/a").otherwise(F.col("gmv").cast("string")),
              "order_date": F.when(nth == 1, "yesterday").otherwise(F.col("order_date").cast("string"))}
    even = F.pmod(F.col("order_id"), F.lit(2)) == 0
    put(t.orders.filter(even), "orders", schemas.ORDERS, **faults)
    put(t.orders.filter(~even), "orders", schemas.ORDERS, "append", drop=("coupon_code",), **faults)
    put(t.sessions, "sessions", schemas.SESSIONS, drop=("utm_campaign",), campaign=F.lit("none"))
    put(t.events.withColumn("event_properties", F.to_json("event_properties")), "events", schemas.EVENTS)
    loaded, report = load_with_report(t.raw.spark, base)
    faults = report.filter("problem <> 'bad row'").select("table", "problem", F.when(
        F.col("problem") != "missing table", F.col("detail")).alias("detail")).distinct().withColumn("n", F.lit(1).cast("long"))
    bad = report.filter("problem = 'bad row'").groupBy("table", "problem").agg(F.count(F.lit(1)).alias("n"))
    out = faults.unionByName(bad.withColumn("detail", F.lit(None).cast("string")))
    for name in ("sessions", "events", "orders"):
        out = out.unionByName(getattr(loaded, name).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table"), F.lit("loaded").alias("problem"), F.lit(None).cast("string").alias("detail"), "n"))
    return out.withColumnRenamed("table", "table_name")


def _variant_events(t):
    """The events with their properties as VARIANT, parsed from JSON text."""
    return t.events.withColumn("event_properties", X.parse_variant(F.to_json("event_properties")))


def _category_bins(t):
    """The bin width of each category's prices and of all prices, the latter from the categories' merged sketches."""
    ps = op.product_sessions(t.events, R.product_view, R.add_to_cart, SPEC).filter("viewed")
    per = save_table(op.quantile_sketches(ps, "price", "category"), _scratch(t, "sketches"))
    total = op.merge_sketches(per).withColumn("category", F.lit(None).cast("string"))
    widths = op.bin_widths(per).unionByName(op.bin_widths(total))
    return widths.select("category", "n", "low", "high", "bin_width")


def _table_function(call: str):
    """``SELECT * FROM`` a table function over views of the tables."""
    def run(t):
        spark, prefix = t.raw.spark, f"f_{uuid.uuid4().hex}_"
        for name in ("sessions", "events", "orders"):
            getattr(t, name).createOrReplaceTempView(prefix + name)
        op.register_functions(spark, SPEC, {c: c for c in (DEVICE, SOURCE, TIER_COL)}, prefix + "sessions", prefix + "events",
                              prefix + "orders", prefix=prefix)
        return spark.sql(f"SELECT * FROM {prefix}{call}")

    return run


def _numbered(t):
    """The event log with session numbers, stored."""
    log = t.events.withColumn("day", F.to_date("event_timestamp"))
    numbers = op.number_sessions(t.events, _scratch(t, "numbers"), SPEC)
    return op.numbered(log, numbers, _scratch(t, "numbered"), SPEC, "event_name", "event_properties", "day")


def _bitmap_abandoned(t):
    """O3, Q32: distinct sessions per product from bitmaps of their numbers."""
    bitmaps = op.product_bitmaps(_numbered(t), R.add_to_cart, R.purchase, spec=SPEC)
    return op.abandoned_from_bitmaps(bitmaps, ABANDON_MIN_SESSIONS, ABANDON_TOP_K)


def _daily_bitmaps(t):
    """O3, Q32: bitmaps stored by day, merged and counted."""
    by_day = op.product_bitmaps(_numbered(t), R.add_to_cart, R.purchase, spec=SPEC, keys=("day",))
    days = save_table(by_day, _scratch(t, "bitmaps"))
    return op.abandoned_from_bitmaps(op.merge_bitmaps(days), ABANDON_MIN_SESSIONS, ABANDON_TOP_K)


def _tiered(t):
    return op.with_city_tier(t.sessions, TIER_COL, TIER1, TIER2)


QUERIES = {
    "q01_overall_funnel": _q(lambda t: op.overall_funnel(t.events, SPEC)),
    "q02_revenue_leakage": _q(lambda t: op.revenue_leakage(t.events, t.orders, SPEC)),
    "q03_leak_ranking": _q(lambda t: op.leak_ranking(t.events, t.orders, SPEC, k=2)),
    "q04_leak_total": _q(lambda t: op.leak_total(t.events, t.orders, SPEC)),
    "q05_funnel_flow": _q(lambda t: op.funnel_flow(t.events, SPEC)),
    "q06_conversion_waterfall": _q(lambda t: op.conversion_waterfall(t.events, SPEC)),
    "q07_payment_failure_rate": _q(lambda t: op.payment_failure_rate(t.events, R.initiated, R.failed)),
    "q08_failure_reasons": _q(lambda t: op.failure_reasons(t.events, R.failed)),
    "q09_segment_funnel": _q(lambda t: op.segment_funnel(t.facts, t.facts, SPEC, DEVICE)),
    "q10_segment_gap": _q(lambda t: op.segment_gap(t.facts, t.facts, SPEC, DEVICE, SEG_A, SEG_B)),
    "q11_segment_conversion": _q(lambda t: op.segment_conversion(t.facts, t.facts, SPEC, SOURCE)),
    "q12_city_tier_funnel": _q(lambda t: op.city_tier_funnel(t.facts, t.facts, SPEC, TIER_COL, TIER1, TIER2)),
    "q13_payment_mix_by_tier": _q(lambda t: op.payment_mix_by_segment(_tiered(t), t.orders, "city_tier", MIX_METHOD)),
    "q14_conversion_matrix": _q(lambda t: op.conversion_matrix(t.sessions, t.orders, SOURCE, DEVICE, DEVICE_VALUES)),
    "q15_matrix_extremes": _q(lambda t: op.matrix_extremes(t.sessions, t.orders, SOURCE, DEVICE)),
    "q16_hourly_conversion": _q(lambda t: op.hourly_conversion(t.sessions, t.orders)),
    "q17_peak_hour": _q(lambda t: op.peak_hour(t.sessions, t.orders)),
    "q18_hour_day_matrix": _q(lambda t: op.hour_day_matrix(t.sessions, t.orders)),
    "q19_weekday_conversion": _q(lambda t: op.weekday_conversion(t.sessions, t.orders)),
    "q20_monthly_trend": _q(lambda t: op.monthly_trend(t.sessions, t.orders)),
    "q21_duration_conversion": _q(lambda t: op.duration_conversion(t.sessions, t.orders)),
    "q22_bounce_rate": _q(lambda t: op.bounce_rate(t.sessions, t.orders, threshold=30)),
    "q23_price_cart_histogram": _q(lambda t: op.price_cart_histogram(t.events, R.product_view, R.add_to_cart, PRICE_BIN)),
    "q24_category_cart_rate": _q(lambda t: op.category_cart_rate(t.events, R.product_view, R.add_to_cart)),
    "q25_method_failure_rate": _q(lambda t: op.method_failure_rate(t.events, R.initiated, R.success, R.failed)),
    "q25_method_failure_rate_selected": _q(
        lambda t: op.method_failure_rate(t.events, R.initiated, R.success, R.failed, method_stage=R.method_selected)
    ),
    "q26_ab_significance_device": _q(lambda t: op.ab_significance(t.facts, t.facts, SPEC, DEVICE, SEG_A, SEG_B)),
    "q26_ab_significance_new_user": _q(lambda t: op.ab_significance(t.facts, t.facts, SPEC, "is_new_user", True, False)),
    "q27_priority_matrix": _q(lambda t: op.priority_matrix(t.facts, t.facts, t.orders, SPEC, DEVICE, EFFORT)),
    "q28_experiment_sample_size": _q(lambda t: op.experiment_sample_size(t.facts, t.facts, SPEC, SOURCE, LIFT)),
    "q29_wide_funnel": _q(lambda t: op.wide_funnel(t.events, SPEC)),
    "q30_device_dropoff": _q(
        lambda t: op.device_dropoff(t.facts, t.facts, DEVICE, R.product_view, R.add_to_cart, R.checkout, R.purchase)
    ),
    "q31_time_to_purchase": _q(lambda t: op.time_to_purchase(t.events, R.purchase)),
    "q32_abandoned_products": _q(
        lambda t: op.abandoned_products(t.events, R.add_to_cart, R.purchase, ABANDON_MIN_SESSIONS, ABANDON_TOP_K)
    ),
    "q32_abandoned_products_via_session": _q(
        lambda t: op.abandoned_products(t.events, R.add_to_cart, R.purchase, ABANDON_MIN_SESSIONS, ABANDON_TOP_K,
                                        via_session=True)
    ),
    "q33_channel_roi": _q(lambda t: op.channel_roi(t.sessions, t.events, t.orders, SOURCE, R.purchase)),
    "q33_channel_roi_dedup": _q(lambda t: op.channel_roi(t.sessions, t.events, t.orders, SOURCE, R.purchase, dedup=True)),
    "q34_kpi_overview": _q(lambda t: op.kpi_overview(t.sessions, t.events, t.orders, R.purchase)),
    "q35_daily_revenue": _q(lambda t: op.daily_revenue(t.orders)),
    "q36_dashboard_funnel": _q(lambda t: op.dashboard_funnel(t.events, SPEC)),
    "q37_abandonment_rates": _q(lambda t: op.abandonment_rates(t.events, SPEC, R.add_to_cart, R.checkout, R.purchase)),
    "q38_dashboard_segment_funnel": _q(lambda t: op.dashboard_segment_funnel(t.facts, t.facts, SPEC, SOURCE)),
    "q39_user_rollup": _q(lambda t: op.user_rollup(t.users, t.sessions, t.user_orders)),
    "q40_loyalty_tiers": _q(lambda t: op.loyalty_tiers(t.users, t.sessions, t.user_orders)),
    "q41_first_seen": _q(lambda t: op.first_seen(t.users, t.sessions)),
    "q42_new_session_flag": _q(lambda t: op.new_session_flag(t.sessions)),
    "q43_campaign_tag": _q(lambda t: op.campaign_tag(t.sessions, PAID_SOURCES)),
    "q44_dataset_summary": _q(lambda t: dataset_summary(t)),
    "q45_segment_share": _q(lambda t: op.segment_share(t.sessions, t.orders, DEVICE)),
    "c13_peak_hours": _q(_peak),
    "c15_text_timestamps": _q(_text_times),
    "c18_page_urls": _q(_page_urls),
    "c20_display_formats": _q(_display),
    "c23_properties_json": _q(_properties_json),
    "c24_count_arrays": _q(_count_arrays),
    "s04_named_tables": _q(_named_tables),
    "s07_csv_round_trip": _q(_csv_round_trip),
    "s03_load_report": _q(_load_report),
    "b09_bucketed_segment_funnel": _q(_bucketed(lambda b: op.segment_funnel(b.sessions, b.flags, SPEC, DEVICE))),
    "b13_bucketed_payment_mix": _q(_bucketed(lambda b: op.payment_mix_by_segment(_tiers_of(b), b.orders, "city_tier", MIX_METHOD))),
    "b30_bucketed_device_dropoff": _q(_bucketed(lambda b: op.device_dropoff(
        b.sessions, b.events, DEVICE, R.product_view, R.add_to_cart, R.checkout, R.purchase))),
    "b33_bucketed_channel_roi": _q(_bucketed(lambda b: op.channel_roi(b.sessions, b.events, b.orders, SOURCE, R.purchase))),
    "b45_bucketed_segment_share": _q(_bucketed(lambda b: op.segment_share(b.sessions, b.orders, DEVICE))),
    "a03_incremental_funnel": _q(lambda t: op.overall_funnel(_updates(t).flags(), SPEC)),
    "a03_incremental_ledger": _q(_incremental_ledger),
    "a16_time_cube": _q(lambda t: op.time_cube(t.sessions, t.orders)),
    "a19_auto_price_bins": _q(lambda t: op.price_cart_auto_histogram(t.events, R.product_view, R.add_to_cart, SPEC)),
    "a19_category_bin_widths": _q(_category_bins),
    "x05_sql_overall_funnel": _q(_table_function("overall_funnel()")),
    "x05_sql_segment_funnel": _q(_table_function(f"segment_funnel('{DEVICE}')")),
    "x05_sql_revenue_leakage": _q(_table_function("revenue_leakage()")),
    "o03_bitmap_abandoned": _q(_bitmap_abandoned),
    "o03_daily_bitmaps": _q(_daily_bitmaps),
    "w05_first_sessions": _q(lambda t: op.first_sessions(t.sessions.select("session_id", "user_id", "session_date", "session_hour"))),
    "v08_variant_failure_reasons": _q(lambda t: op.failure_reasons(_variant_events(t), R.failed)),
    "v23_variant_price_histogram": _q(lambda t: op.price_cart_histogram(_variant_events(t), R.product_view, R.add_to_cart, PRICE_BIN)),
    "v24_variant_category_cart_rate": _q(lambda t: op.category_cart_rate(_variant_events(t), R.product_view, R.add_to_cart)),
    "v25_variant_method_failure_rate": _q(lambda t: op.method_failure_rate(_variant_events(t), R.initiated, R.success, R.failed)),
}

for _name, _fn in QUERIES.items():
    _fn.__name__ = _fn.__qualname__ = _name
