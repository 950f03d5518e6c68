"""Scalar expressions of functions/exprs.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from journey.functions import exprs as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_quadrants(spark):
    df = spark.createDataFrame([(8, 500000.0), (3, 850000.0), (9, 280000.0), (4, 100.0), (None, 1e6), (9, None)], "e INT, i DOUBLE")
    got = [r.q for r in df.select(X.priority_quadrant(F.col("e"), F.col("i")).alias("q")).collect()]
    assert got == ["Quick Wins", "Major Projects", "Fill-ins", "Don't Bother", None, None]


def test_labels_and_names(spark):
    assert one(spark, X.weekday_name(F.lit(0))) == "Mon" and one(spark, X.weekday_name(F.lit(6))) == "Sun"
    assert one(spark, X.page_url(F.lit("add_to_cart"))) == "/add-to-cart"
    assert one(spark, X.title_case(F.lit("device_type"))) == "Device Type"
    assert one(spark, X.inr_lakh(F.lit(453333.0))) == "₹4.5L"
    assert one(spark, X.percent_text(F.lit(4.471))) == "4.47%"
    assert one(spark, X.thousands(F.lit(1234567), "₹")) == "₹1,234,567"
    assert one(spark, X.is_peak_hour(F.lit(21))) is True and one(spark, X.is_peak_hour(F.lit(19))) is False
    assert str(one(spark, X.text_timestamp(F.lit("2023-10-02 20:00:10")))) == "2023-10-02 20:00:10"
    assert one(spark, X.text_timestamp(F.lit("no time"))) is None
    assert one(spark, X.loyalty_tier(F.lit(3))) == "silver"
    assert one(spark, X.city_tier(F.lit("Goa"))) == "Tier 3"


def test_props_json_round_trip(spark):
    j = X.props_json(product_id=F.lit(7).cast("long"), category=F.lit("beauty"), reason=F.lit(None).cast("string"))
    assert one(spark, j) == '{"product_id":7,"category":"beauty"}'
    df = spark.range(1).select(j.alias("p"), F.lit("not json").alias("bad"), F.lit('{"reason": null}').alias("none"))
    got = df.select(X.prop_of(df, "p", "category"), X.prop_of(df, "bad", "reason", "unknown"),
                    X.prop_of(df, "none", "reason", "unknown")).first()
    assert tuple(got) == ("beauty", "unknown", "unknown")
    plain = spark.range(1).select(F.lit("c1").alias("category"))
    assert plain.select(X.prop_of(plain, "event_properties", "category"),
                        X.prop_of(plain, "event_properties", "reason", "unknown")).first()[:] == ("c1", "unknown")


def test_safe_division(spark):
    assert one(spark, X.safe_div(F.lit(1), F.lit(0))) is None
    assert one(spark, X.safe_div_or_zero(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, X.pct(F.lit(1), F.lit(3))) == 33.33
