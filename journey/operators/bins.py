"""Histogram bins chosen from the data, from quantile sketches that merge.

The width is Freedman and Diaconis' 2 x IQR / n^(1/3), rounded to 1, 2 or 5
times a power of ten.  Quartiles come from KLL sketches: one binary value of
bounded size for a group however many rows it has, built on the map side and
merged, so no sort and no shuffle of values.  Sketches can be stored (one a
day, say) and merged later; a width over all days then reads sketches only.

A sketch of ``k`` is exact up to ``k`` values; beyond that its rank error is
about 1.2 / k^0.9 and random, which the rounding hides unless the width lies
next to a rounding limit.

Defined cases: NULL, NaN and infinite values are in no sketch and no bin.
Without spread between the quartiles the range is cut into ceil(log2 n) + 1
parts; fewer than two values, or equal ones, give a width of 1.  A group
without values has no width and no bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journey.functions.sqltext import ident
from journey.operators.products import product_sessions
from journey.spec import FunnelSpec

#: values that a sketch holds exactly
SKETCH_K = 4096

_DEFAULT = FunnelSpec((("_", "_"),))


def _finite(value: str) -> Column:
    v = F.col(ident(value)).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))


def quantile_sketches(df: DataFrame, value: str, *keys: str, k: int = SKETCH_K) -> DataFrame:
    """``keys.., n, low, high, sketch`` of the finite values, one row per group (one row in all without keys)."""
    v = F.col(ident(value)).cast("double")
    return df.filter(_finite(value)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, k).alias("sketch"))


def merge_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches of finer groups, or of several days, merged to one per ``keys``."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def nice_width(raw: str) -> str:
    """``raw`` rounded to 1, 2 or 5 times a power of ten, the nearest by ratio (SQL text)."""
    base = f"power(10.0D, floor(log10({raw})))"
    part = f"({raw} / {base})"
    return (f"CASE WHEN {part} < sqrt(2.0D) THEN 1.0D WHEN {part} < sqrt(10.0D) THEN 2.0D "
            f"WHEN {part} < sqrt(50.0D) THEN 5.0D ELSE 10.0D END * {base}")


def bin_widths(sketches: DataFrame) -> DataFrame:
    """The columns of ``sketches`` but the sketch, and ``bin_width`` (NULL for a group without values)."""
    rest = [ident(c) for c in sketches.columns if c != "sketch"]
    # the sketch of no values has no quantiles: it is not asked for them
    spread = sketches.selectExpr(*rest, "CASE WHEN n > 1 AND high > low THEN kll_sketch_get_quantile_double(sketch, 0.75D) "
                                        "- kll_sketch_get_quantile_double(sketch, 0.25D) END AS _iqr")
    raw = spread.selectExpr(*rest, "CASE WHEN n = 0 THEN NULL WHEN _iqr IS NULL THEN 1.0D "
                                   "WHEN _iqr > 0 THEN 2.0D * _iqr / power(CAST(n AS DOUBLE), 1.0D / 3.0D) "
                                   "ELSE (high - low) / (ceil(log2(CAST(n AS DOUBLE))) + 1.0D) END AS _raw")
    return raw.selectExpr(*rest, f"{nice_width('_raw')} AS bin_width")


def auto_histogram(df: DataFrame, value: str, *by: str, sketches: DataFrame | None = None) -> DataFrame:
    """``bin_low, bin_width, by.., rows``: counts in bins of one width chosen from ``value``.

    The width comes from ``df`` itself, or from stored ``sketches`` of the
    same values.  It is a scalar subquery; counting is one aggregate on
    (bin, by) with partial aggregation.
    """
    one = merge_sketches(sketches) if sketches is not None else quantile_sketches(df, value)
    width = bin_widths(one).select("bin_width").scalar()
    v = F.col(ident(value)).cast("double")
    rows = df.filter(_finite(value)).select(v.alias("_v"), *[F.col(ident(c)) for c in by]).withColumn("bin_width", width)
    low = (F.floor(F.col("_v") / F.col("bin_width")) * F.col("bin_width")).cast("double")
    return rows.groupBy(low.alias("bin_low"), "bin_width", *by).agg(F.count(F.lit(1)).alias("rows"))


def price_cart_auto_histogram(events, view: str, add: str, spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q23 with bins chosen from the prices: viewing sessions per bin, split by whether they added to cart."""
    ps = product_sessions(events, view, add, spec).filter("viewed")
    h = auto_histogram(ps, "price", "added")
    return h.select(F.col("bin_low").alias("price_bin"), "bin_width", "added", F.col("rows").alias("sessions"))
