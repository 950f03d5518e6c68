"""Explicit schemas of the four journey tables (no inference pass on read)."""

from pyspark.sql import types as T

SESSIONS = T.StructType(
    [
        T.StructField("session_id", T.StringType(), False),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("session_hour", T.IntegerType()),
        T.StructField("session_day_of_week", T.IntegerType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("landing_page", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("is_new_user", T.BooleanType()),
        T.StructField("is_logged_in", T.BooleanType()),
        T.StructField("session_duration_seconds", T.IntegerType()),
        T.StructField("utm_campaign", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_timestamp", T.TimestampNTZType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_properties", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("time_on_page_seconds", T.IntegerType()),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("gmv", T.DoubleType()),
        T.StructField("discount_applied", T.BooleanType()),
        T.StructField("coupon_code", T.StringType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("delivery_pincode", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("is_first_order", T.BooleanType()),
        T.StructField("device_type", T.StringType()),
    ]
)

# Totals are written as floats by pandas after a left merge; read as DOUBLE.
USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("first_seen_date", T.DateType()),
        T.StructField("age_bucket", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("preferred_device", T.StringType()),
        T.StructField("preferred_category", T.StringType()),
        T.StructField("email_opt_in", T.BooleanType()),
        T.StructField("push_opt_in", T.BooleanType()),
        T.StructField("total_sessions", T.DoubleType()),
        T.StructField("total_orders", T.DoubleType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("loyalty_tier", T.StringType()),
    ]
)

BY_NAME = {"sessions": SESSIONS, "events": EVENTS, "orders": ORDERS, "users": USERS}

# The warehouse tables: the columns that its five analyses read; a file may have more.
WAREHOUSE = {
    "sessions": T.StructType(
        [
            T.StructField("session_id", T.StringType()),
            T.StructField("device_type", T.StringType()),
            T.StructField("traffic_source", T.StringType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("session_id", T.StringType()),
            T.StructField("event_name", T.StringType()),
            T.StructField("timestamp", T.TimestampNTZType()),
            T.StructField("product_id", T.StringType()),
            T.StructField("category", T.StringType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("session_id", T.StringType()),
            T.StructField("order_value", T.DoubleType()),
        ]
    ),
}
