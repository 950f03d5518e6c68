"""Run the analyses over journey tables and write every result as a table.

    python -m journey.report --tables DIR [--format csv|parquet] --out DIR
                             [--preset script|generator|warehouse]
                             [--effort FILE.json] [--work DIR]

The counterpart of running the original analysis scripts: it reads
``sessions``, ``events``, ``orders`` (and ``users`` if present) from DIR,
runs the operators with the original's stage vocabulary and roles, and
writes one output per analysis under ``--out`` (CSV with header, or
Parquet).  Each output is computed by Spark and written by the executors;
nothing is collected to the driver.

With ``--work`` (a new folder that all executors share) one table of session
flags is written first, and every analysis that only asks which events a
session has reads it instead of the event log.  ``--effort`` names a JSON object
stage name -> ease, which the priority matrix needs.  The ``warehouse`` preset
expects the SQL's input shape: plain product columns, ``timestamp`` and
``order_value``; it runs the five SQL analyses.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame

from journey import operators as op
from journey.session import save_table
from journey.sources import schemas
from journey.sources.io import Tables, dataset_summary, load_tables, read_csv, write_csv, write_parquet
from journey.spec import PRESETS, SCRIPT_ROLES, WAREHOUSE_COLUMNS, WAREHOUSE_ROLES, Columns, FunnelSpec, Roles

# --- fixed values: segments, devices and A/B pairs of the original analyses --
SEGMENTS = ("device_type", "traffic_source")
DEVICES = ("mobile", "desktop", "tablet")
AB_PAIRS = (("device_type", "desktop", "mobile"), ("traffic_source", "email_campaign", "social_media"),
            ("is_new_user", True, False))
PAID_SOURCES = ("paid_search", "social_media", "affiliate")
# ---------------------------------------------------------------------------


def flag_events(spec: FunnelSpec, roles: Roles) -> list[str]:
    """The events whose presence per session the analyses ask for."""
    return [*spec.names, roles.product_view, roles.add_to_cart, roles.checkout, roles.purchase]


def warehouse_analyses(t: Tables, spec: FunnelSpec, roles: Roles, cols: Columns = WAREHOUSE_COLUMNS,
                       flags: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five SQL analyses, over the SQL's input shape."""
    seen = t.events if flags is None else flags
    out = {
        "wide_funnel": op.wide_funnel(seen, spec),
        "time_to_purchase": op.time_to_purchase(t.events, roles.purchase, spec.session_col, spec.event_col, spec.ts_col),
        "abandoned_products": op.abandoned_products(t.events, roles.add_to_cart, roles.purchase, spec=spec),
    }
    for col in SEGMENTS:
        out[f"device_dropoff_{col}"] = op.device_dropoff(t.sessions, seen, col, roles.product_view, roles.add_to_cart,
                                                         roles.checkout, roles.purchase, spec)
        for name, dedup in (("channel_roi", False), ("channel_roi_dedup", True)):
            out[f"{name}_{col}"] = op.channel_roi(t.sessions, t.events, t.orders, col, roles.purchase, dedup, cols.gmv, spec)
    return out


def analyses(t: Tables, spec: FunnelSpec, roles: Roles, effort: dict[str, int] | None = None,
             flags: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every analysis as a named lazy DataFrame; ``flags`` is a stored ``flag_table``."""
    seen = t.events if flags is None else flags
    out = warehouse_analyses(t, spec, roles, Columns(), flags)
    out |= {
        "funnel_overall": op.revenue_leakage(seen, t.orders, spec),
        "leak_ranking": op.leak_ranking(seen, t.orders, spec),
        "leak_total": op.leak_total(seen, t.orders, spec),
        "funnel_flow": op.funnel_flow(seen, spec),
        "conversion_waterfall": op.conversion_waterfall(seen, spec),
        "payment_failure_rate": op.payment_failure_rate(t.events, roles.initiated, roles.failed),
        "failure_reasons": op.failure_reasons(t.events, roles.failed),
        "city_tier_funnel": op.city_tier_funnel(t.sessions, seen, spec),
        "payment_mix_by_tier": op.payment_mix_by_segment(op.with_city_tier(t.sessions), t.orders, "city_tier", "cod"),
        "conversion_matrix": op.conversion_matrix(t.sessions, t.orders, "traffic_source", "device_type", DEVICES),
        "matrix_extremes": op.matrix_extremes(t.sessions, t.orders, "traffic_source", "device_type"),
        "hourly_conversion": op.hourly_conversion(t.sessions, t.orders),
        "peak_hour": op.peak_hour(t.sessions, t.orders),
        "hour_day_matrix": op.hour_day_matrix(t.sessions, t.orders),
        "weekday_conversion": op.weekday_conversion(t.sessions, t.orders),
        "monthly_trend": op.monthly_trend(t.sessions, t.orders),
        "duration_conversion": op.duration_conversion(t.sessions, t.orders),
        "bounce_rate": op.bounce_rate(t.sessions, t.orders),
        "price_cart_histogram": op.price_cart_histogram(t.events, roles.product_view, roles.add_to_cart),
        "category_cart_rate": op.category_cart_rate(t.events, roles.product_view, roles.add_to_cart),
        "method_failure_rate": op.method_failure_rate(t.events, roles.initiated, roles.success, roles.failed),
        "kpi_overview": op.kpi_overview(t.sessions, t.events, t.orders, roles.purchase),
        "daily_revenue": op.daily_revenue(t.orders),
        "dashboard_funnel": op.dashboard_funnel(seen, spec),
        "dataset_summary": dataset_summary(t),
        "new_session_flag": op.new_session_flag(t.sessions),
        "campaign_tag": op.campaign_tag(t.sessions, PAID_SOURCES),
    }
    if roles.method_selected:
        out["method_failure_rate_selected"] = op.method_failure_rate(
            t.events, roles.initiated, roles.success, roles.failed, method_stage=roles.method_selected)
    if spec.n >= 3:
        s = spec.stages
        out["abandonment_rates"] = op.abandonment_rates(seen, spec, s[-3][0], s[-2][0], s[-1][0])
    for col in SEGMENTS:
        out[f"segment_funnel_{col}"] = op.segment_funnel(t.sessions, seen, spec, col)
        out[f"segment_conversion_{col}"] = op.segment_conversion(t.sessions, seen, spec, col)
        out[f"dashboard_segment_funnel_{col}"] = op.dashboard_segment_funnel(t.sessions, seen, spec, col)
        out[f"segment_share_{col}"] = op.segment_share(t.sessions, t.orders, col)
        out[f"experiment_sample_size_{col}"] = op.experiment_sample_size(t.sessions, seen, spec, col)
    out["segment_gap_device"] = op.segment_gap(t.sessions, seen, spec, "device_type", "desktop", "mobile")
    for col, a, b in AB_PAIRS:
        out[f"ab_significance_{col}"] = op.ab_significance(t.sessions, seen, spec, col, a, b)
    if effort:
        out["priority_matrix"] = op.priority_matrix(t.sessions, seen, t.orders, spec, "device_type", effort)
    if t.users is not None:
        out["user_rollup"] = op.loyalty_tiers(t.users, t.sessions, t.orders)
        out["first_seen"] = op.first_seen(t.users, t.sessions)
    return out


def run(spark, tables_dir: str, out_dir: str, fmt: str = "csv", preset: str = "script",
        out_format: str = "csv", only: list[str] | None = None, effort: dict[str, int] | None = None,
        work_dir: str | None = None) -> list[str]:
    if preset == "warehouse":
        read = lambda n: spark.read.parquet(f"{tables_dir}/{n}.parquet") if fmt == "parquet" else read_csv(
            spark, f"{tables_dir}/{n}.csv", schemas.WAREHOUSE[n])
        t = Tables(read("sessions"), read("events"), read("orders"))
        spec, roles = PRESETS[preset], WAREHOUSE_ROLES
    else:
        t, spec, roles = load_tables(spark, tables_dir, fmt), PRESETS[preset], SCRIPT_ROLES
    flags = save_table(op.flag_table(t.events, spec, flag_events(spec, roles)), f"{work_dir.rstrip('/')}/flags") if work_dir else None
    every = warehouse_analyses(t, spec, roles, flags=flags) if preset == "warehouse" else analyses(t, spec, roles, effort, flags)
    written = []
    for name, df in every.items():
        if only and name not in only:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        (write_csv if out_format == "csv" else write_parquet)(df, path)
        written.append(name)
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--tables", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--out", required=True)
    ap.add_argument("--out-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--preset", default="script", choices=["script", "generator", "warehouse"])
    ap.add_argument("--only", nargs="*")
    ap.add_argument("--effort", help="JSON file: stage name -> ease")
    ap.add_argument("--work", help="new folder, shared by all executors, for one table of session flags")
    a = ap.parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("journey-report").config("spark.ui.enabled", "false").getOrCreate()
    effort = None
    if a.effort:
        with open(a.effort, encoding="utf-8") as f:
            effort = {str(k): int(v) for k, v in json.load(f).items()}
    for name in run(spark, a.tables, a.out, a.format, a.preset, a.out_format, a.only, effort, a.work):
        print(name)


if __name__ == "__main__":
    main()
