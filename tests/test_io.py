"""Sources and sinks: CSV round trip (S1/S7), Parquet sink, adapter profile."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from journey.sources.driver_tables import driver_tables
from journey.sources.io import read_csv, write_csv, write_parquet
from journey.spec import PRESETS
from journey import operators as op
from tests.conftest import SF001, rows

CSV = '''event_id,event_properties,is_new,coupon,total
1,"{""product_id"": 12, ""category"": ""fashion"", ""price"": 499}",True,,1.0
2,{},False,SAVE20,0.0
'''


def _scratch():
    return tempfile.mkdtemp(prefix="journey-test-", dir=os.environ.get("TMPDIR", "/tmp"))


def test_csv_read_keeps_json_and_nulls(spark):
    d = _scratch()
    p = os.path.join(d, "e.csv")
    with open(p, "w") as f:
        f.write(CSV)
    df = read_csv(spark, p, StructType.fromDDL("event_id BIGINT, event_properties STRING, is_new BOOLEAN, coupon STRING, total DOUBLE"))
    r = df.orderBy("event_id").collect()
    assert r[0].event_properties == '{"product_id": 12, "category": "fashion", "price": 499}'
    assert (r[0].is_new, r[0].coupon, r[0].total) == (True, None, 1.0)
    assert (r[1].event_properties, r[1].is_new, r[1].coupon) == ("{}", False, "SAVE20")


def test_csv_round_trip(spark):
    d = _scratch()
    src = spark.createDataFrame([(1, '{"a": "x, \\"y\\""}', None)], "id BIGINT, props STRING, c STRING")
    write_csv(src, os.path.join(d, "out"))
    back = read_csv(spark, os.path.join(d, "out"), StructType.fromDDL("id BIGINT, props STRING, c STRING")).collect()
    assert [tuple(r) for r in back] == [(1, '{"a": "x, \\"y\\""}', None)]


def test_parquet_sink_partitioned(spark, fx):
    d = _scratch()
    ev = fx.events.withColumn("event_date", F.to_date("event_timestamp"))
    write_parquet(ev, os.path.join(d, "events"), partition_by=["event_date"])
    back = spark.read.parquet(os.path.join(d, "events"))
    assert back.count() == ev.count()


def test_adapter_profile_sf001(spark):
    # FIXTURES.md §2: user-day sessions and stage presence at sf0.01
    t = driver_tables(spark, SF001)
    assert t.sessions.count() == 4006
    counts = [r.session_count for r in op.overall_funnel(t.events, PRESETS["driver"]).orderBy("stage_idx").collect()]
    assert counts[0] == 1617 and counts[1] == 1601 and counts[3] == 1604


def test_adapter_props_are_a_struct(spark):
    t = driver_tables(spark, SF001)
    errors = t.events.filter(F.col("event_name") == "error").select("event_properties.*")
    assert errors.columns == ["product_id", "category", "price", "method", "reason"]
    assert errors.filter("reason IS NULL OR method IS NULL OR price IS NOT NULL").count() == 0


def test_reader_binds_by_header_and_refuses_bad_values(spark):
    import pytest

    d = _scratch()
    with open(os.path.join(d, "o.csv"), "w") as f:
        f.write("gmv,extra,order_id,session_id\n5.0,x,o1,s1\n")
    schema = "order_id STRING, session_id STRING, gmv DOUBLE"
    declared = StructType.fromDDL(schema)
    assert tuple(read_csv(spark, os.path.join(d, "o.csv"), declared).first()) == ("o1", "s1", 5.0)
    with open(os.path.join(d, "bad.csv"), "w") as f:
        f.write("order_id,session_id,gmv\no1,s1,five\n")
    with pytest.raises(Exception, match="MALFORMED|five"):
        read_csv(spark, os.path.join(d, "bad.csv"), declared).collect()
    assert read_csv(spark, os.path.join(d, "bad.csv"), declared, mode="PERMISSIVE").first().gmv is None
    with open(os.path.join(d, "short.csv"), "w") as f:
        f.write("order_id,gmv\no1,5\n")
    with pytest.raises(ValueError, match="session_id"):
        read_csv(spark, os.path.join(d, "short.csv"), declared)


def test_only_a_missing_users_path_makes_users_optional(spark, fx):
    import pytest
    from pyspark.errors import AnalysisException

    from journey.sources.io import load_tables

    d = _scratch()
    for name in ("sessions", "events", "orders"):
        getattr(fx, name).write.parquet(os.path.join(d, f"{name}.parquet"))
    assert load_tables(spark, d).users is None
    os.makedirs(os.path.join(d, "users.parquet"))  # there, but without any file to read a schema from
    with pytest.raises(AnalysisException):
        load_tables(spark, d)


def test_load_tables_csv_end_to_end(spark, fx):
    """Journey tables as CSV files (pandas quoting) → declared schemas → funnel."""
    from journey.sources.io import load_tables
    from tests.conftest import STAGES, write_journey_csv

    d = _scratch()
    write_journey_csv(d, users=False)
    t = load_tables(spark, d, fmt="csv")
    assert t.users is None
    assert t.orders.filter("delivery_pincode = '010101'").count() == 3  # leading zero kept
    got = rows(op.overall_funnel(t.events, STAGES), "stage_idx", "session_count")
    assert got == rows(op.overall_funnel(fx.events, STAGES), "stage_idx", "session_count")
    assert rows(op.failure_reasons(t.events, "payment_failed")) == [("unknown", 1), ("upi_error", 1)]
    assert rows(op.hourly_conversion(t.sessions, t.orders), "session_hour", "sessions") == [(9, 2), (13, 2), (20, 3)]


def test_missing_table_raises(spark):
    import pytest
    from pyspark.errors import AnalysisException

    from journey.sources.io import load_tables

    with pytest.raises(AnalysisException):
        load_tables(spark, "/nonexistent/journey")
