from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from journey.session import get_spark  # noqa: E402
from journey.sources.io import Tables  # noqa: E402
from journey.spec import FunnelSpec  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

STAGES = FunnelSpec((
    ("page_view", "Session Started"),
    ("product_detail_view", "Viewed Product Detail"),
    ("add_to_cart", "Added to Cart"),
    ("payment_initiated", "Initiated Payment"),
    ("payment_success", "Completed Purchase"),
))


@pytest.fixture(scope="session")
def spark():
    s = get_spark("*", shuffle_partitions=8, app="journey-tests")
    yield s


D = dt.date
TS = dt.datetime

SESSIONS = [
    ("s1", "u1", D(2023, 10, 2), 20, 0, "mobile", "email_campaign", "Mumbai", True, 200),
    ("s2", "u1", D(2023, 10, 3), 20, 1, "mobile", "social_media", "Pune", False, 10),
    ("s3", "u2", D(2023, 10, 3), 9, 1, "desktop", "email_campaign", "Pune", True, 400),
    ("s4", "u3", D(2023, 11, 4), 13, 5, "desktop", "social_media", "Delhi", True, 1000),
    ("s5", "u3", D(2023, 11, 5), 20, 6, None, "direct", "Jaipur", False, 100),
    ("s6", "u4", D(2023, 11, 5), 9, 6, "tablet", "direct", "Goa", True, None),
]
SESSIONS_DDL = ("session_id STRING, user_id STRING, session_date DATE, session_hour INT, session_day_of_week INT, "
                "device_type STRING, traffic_source STRING, city STRING, is_new_user BOOLEAN, "
                "session_duration_seconds INT")

_P1 = '{"product_id": 1, "category": "beauty", "price": 199}'
_P2 = '{"product_id": 2, "category": "sports", "price": 499}'
EVENTS = [
    (1, "s1", TS(2023, 10, 2, 20, 0, 0), "page_view", "{}"),
    (2, "s1", TS(2023, 10, 2, 20, 0, 10), "product_detail_view", _P1),
    (3, "s1", TS(2023, 10, 2, 20, 0, 20), "add_to_cart", _P1),
    (4, "s1", TS(2023, 10, 2, 20, 0, 30), "payment_initiated", "{}"),
    (5, "s1", TS(2023, 10, 2, 20, 0, 45), "payment_failed", '{"method": "upi", "amount": 199, "reason": "upi_error"}'),
    (6, "s1", TS(2023, 10, 2, 20, 0, 40), "payment_success", "{}"),
    (7, "s1", TS(2023, 10, 2, 20, 0, 50), "payment_success", "{}"),
    (8, "s2", TS(2023, 10, 3, 20, 10, 0), "page_view", "{}"),
    (9, "s2", TS(2023, 10, 3, 20, 11, 0), "add_to_cart", "not json"),
    (10, "s3", TS(2023, 10, 3, 9, 0, 0), "page_view", "{}"),
    (11, "s3", TS(2023, 10, 3, 9, 0, 30), "product_detail_view", _P2),
    (12, "s3", TS(2023, 10, 3, 9, 1, 0), "payment_initiated", "{}"),
    (13, "s3", TS(2023, 10, 3, 9, 1, 10), "payment_failed", '{"method": "cod", "amount": 499}'),
    (14, "s4", TS(2023, 11, 4, 13, 0, 0), "page_view", "{}"),
    (15, "s4", TS(2023, 11, 4, 13, 1, 0), "product_detail_view", _P2),
    (16, "s4", TS(2023, 11, 4, 13, 2, 0), "add_to_cart", _P2),
    (17, "s4", TS(2023, 11, 4, 13, 5, 0), "payment_initiated", "{}"),
    (18, "s4", TS(2023, 11, 4, 13, 10, 0), "payment_success", "{}"),
    (19, "s5", TS(2023, 11, 5, 20, 0, 0), "page_view", "{}"),
    (20, None, TS(2023, 11, 5, 21, 0, 0), "page_view", "{}"),
]
EVENTS_DDL = "event_id BIGINT, session_id STRING, event_timestamp TIMESTAMP_NTZ, event_name STRING, event_properties STRING"

ORDERS = [
    ("o1", "s1", "u1", TS(2023, 10, 2, 20, 1, 0), 200.0, "upi"),
    ("o2", "s4", "u3", TS(2023, 11, 4, 13, 11, 0), 1000.0, "cod"),
    ("o3", "s4", "u3", TS(2023, 11, 4, 13, 12, 0), 500.0, "cod"),
]
ORDERS_DDL = "order_id STRING, session_id STRING, user_id STRING, order_date TIMESTAMP_NTZ, gmv DOUBLE, payment_method STRING"


@pytest.fixture(scope="session")
def fx(spark) -> Tables:
    return Tables(
        sessions=spark.createDataFrame(SESSIONS, SESSIONS_DDL),
        events=spark.createDataFrame(EVENTS, EVENTS_DDL),
        orders=spark.createDataFrame(ORDERS, ORDERS_DDL),
        users=spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",)], "user_id STRING"),
    )


def rows(df, *cols):
    """Rows as tuples (selected columns), sorted with NULLs first."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def approx(x, nd=4):
    return None if x is None else round(x, nd)


def write_journey_csv(d: str, users: bool = True) -> None:
    """The fixture tables as CSV files with the full journey schemas (pandas-style quoting)."""
    import csv
    import os

    from journey.sources import schemas

    def write(name, rows):
        with open(os.path.join(d, f"{name}.csv"), "w", newline="") as f:
            w = csv.writer(f, quoting=csv.QUOTE_MINIMAL, doublequote=True)
            w.writerow([fld.name for fld in schemas.BY_NAME[name].fields])
            for r in rows:
                w.writerow(["" if v is None else v for v in r])

    write("sessions", [(s[0], s[1], s[2].isoformat(), s[3], s[4], s[5], s[6], "homepage", s[7], None, s[8], False,
                        s[9], None) for s in SESSIONS])
    write("events", [(e[0], e[1], None, e[2].strftime("%Y-%m-%d %H:%M:%S"), e[3], e[4], "/" + e[3].replace("_", "-"), 10)
                     for e in EVENTS])
    write("orders", [(o[0], o[1], o[2], o[3].strftime("%Y-%m-%d %H:%M:%S"), o[4], True, "SAVE20", 0.0, o[5], "010101",
                      "beauty", True, "mobile") for o in ORDERS])
    if not users:
        return
    write("users", [(u, "2023-10-02", "25-34", "F", "mobile", "beauty", True, False, 0.0, 0.0, 0.0, "new")
                    for u in ("u1", "u2", "u3", "u4")])
