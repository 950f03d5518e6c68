"""User-level operators, one function per analysis (DataFrame in, DataFrame out)."""

from journey.operators.flags import flag_table, has_flags, session_facts, session_flags, stage_counts, mark_best
from journey.operators.funnel import (
    overall_funnel, revenue_leakage, leak_ranking, leak_total, funnel_flow, conversion_waterfall,
    wide_funnel, dashboard_funnel, abandonment_rates, average_order_value,
)
from journey.operators.segments import (
    segment_counts, segment_count_arrays, segment_funnel, segment_gap, segment_conversion, city_tier_funnel, with_city_tier,
    payment_mix_by_segment, conversion_cells, conversion_matrix, matrix_extremes, device_dropoff,
    dashboard_segment_funnel, segment_share,
)
from journey.operators.timing import (
    merged_sessions, hourly_conversion, peak_hour, hour_day_matrix, weekday_conversion, monthly_trend,
    duration_conversion, bounce_rate, time_cube, cube_tables, time_to_purchase, daily_revenue,
)
from journey.operators.payments import payment_failure_rate, failure_reasons, method_failure_rate
from journey.operators.products import product_sessions, price_cart_histogram, category_cart_rate, abandoned_products
from journey.operators.revenue import channel_roi, kpi_overview
from journey.operators.users import user_rollup, loyalty_tiers, first_seen, first_sessions, new_session_flag, campaign_tag
from journey.operators.stats import ab_significance, experiment_sample_size, priority_matrix
from journey.operators.incremental import FunnelState
from journey.operators.bins import auto_histogram, bin_widths, merge_sketches, price_cart_auto_histogram, quantile_sketches
from journey.operators.bitmaps import abandoned_from_bitmaps, merge_bitmaps, number_sessions, numbered, product_bitmaps
from journey.operators.sql_functions import register_functions
