"""Time patterns: Q16–Q22, Q31, Q35.

The original merges sessions with orders (LEFT JOIN, so a session with k
orders becomes k rows) and then averages per group.  Here orders are first
reduced to one row per session (rows, orders, gmv), and the fan-out is
carried as a row weight — same numbers, no multiplied rows in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import (
    DURATION_BUCKETS, DURATION_EDGES, money_sum, money_total, month_key, seconds_between, text_timestamp, weekday_name,
)
from journey.functions.sqltext import array, div, ident, lit, named_struct
from journey.operators.flags import mark_best

W_ROWS, W_CONV, W_GMV = "_w_rows", "_w_conv", "_w_gmv"


def merged_sessions(sessions: DataFrame, orders: DataFrame, session_col: str = "session_id",
                    order_col: str = "order_id", gmv_col: str = "gmv") -> DataFrame:
    """Sessions with the weights of ``sessions LEFT JOIN orders``.

    _w_rows = rows the session contributes to the merge (≥ 1), _w_conv = rows
    with an order id, _w_gmv = their gmv (NULL when none).
    """
    per = orders.filter(F.col(session_col).isNotNull()).groupBy(session_col).agg(
        F.count(F.lit(1)).alias("_m"), F.count(order_col).alias("_k"), money_sum(gmv_col).alias(W_GMV)
    )
    return sessions.join(per, session_col, "left").selectExpr(
        "* EXCEPT (_m, _k)",
        f"CAST(greatest(coalesce(_m, 0), 1) AS BIGINT) AS {W_ROWS}",
        f"CAST(coalesce(_k, 0) AS BIGINT) AS {W_CONV}",
    )


def _rate():
    return F.expr(div(f"sum({W_CONV})", f"sum({W_ROWS})"))


def _sessions_sum(session_col: str):
    """Merged rows that carry a session id (``count(session_id)`` over the merge)."""
    return F.expr(f"CAST(sum(CASE WHEN {ident(session_col)} IS NOT NULL THEN {W_ROWS} ELSE 0 END) AS BIGINT) AS sessions")


def hourly_conversion(sessions, orders, hour_col: str = "session_hour", session_col: str = "session_id") -> DataFrame:
    """Q16: per hour — merged rows with a session id, converted rows, rate."""
    m = merged_sessions(sessions.select(session_col, hour_col), orders, session_col)
    return (
        m.filter(F.col(hour_col).isNotNull())
        .groupBy(hour_col)
        .agg(_sessions_sum(session_col), F.expr(f"CAST(sum({W_CONV}) AS BIGINT) AS conversions"))
        .selectExpr("*", f"{div('conversions', 'sessions')} AS conv_rate")
    )


def peak_hour(sessions, orders, hour_col: str = "session_hour", session_col: str = "session_id") -> DataFrame:
    """Q17: the hour with the highest conversion rate (ties: earliest hour)."""
    h = hourly_conversion(sessions, orders, hour_col, session_col).filter(F.col("conv_rate").isNotNull())
    return h.orderBy(F.col("conv_rate").desc(), F.col(hour_col)).limit(1).select(hour_col, "conv_rate")


def hour_day_matrix(sessions, orders, hour_col: str = "session_hour", day_col: str = "session_day_of_week",
                    session_col: str = "session_id") -> DataFrame:
    """Q18: hour × weekday conversion rate; columns d0 (Monday) .. d6."""
    m = merged_sessions(sessions.select(session_col, hour_col, day_col), orders, session_col)
    cells = m.filter(F.col(hour_col).isNotNull() & F.col(day_col).isNotNull()).groupBy(hour_col, day_col).agg(
        _rate().alias("rate")
    )
    p = cells.groupBy(hour_col).pivot(day_col, list(range(7))).agg(F.first("rate"))
    return p.select(hour_col, *[F.col(str(d)).alias(f"d{d}") for d in range(7)])


def weekday_conversion(sessions, orders, day_col: str = "session_day_of_week", session_col: str = "session_id") -> DataFrame:
    """Q19: conversion per weekday (Monday = 0) with the best day flagged."""
    m = merged_sessions(sessions.select(session_col, day_col), orders, session_col)
    r = m.filter(F.col(day_col).isNotNull()).groupBy(day_col).agg(_rate().alias("conv_rate"))
    r = r.select(day_col, weekday_name(F.col(day_col)).alias("day_name"), "conv_rate")
    return mark_best(r, day_col, "conv_rate")


def monthly_trend(sessions, orders, date_col: str = "session_date", session_col: str = "session_id") -> DataFrame:
    """Q20: per month (yyyy-MM) — sessions, conversions, gmv, rate."""
    m = merged_sessions(sessions.select(session_col, date_col), orders, session_col)
    return (
        m.groupBy(month_key(F.col(date_col)).alias("month"))
        .agg(_sessions_sum(session_col), F.expr(f"CAST(sum({W_CONV}) AS BIGINT) AS conversions"),
             F.expr(f"coalesce(CAST(sum({W_GMV}) AS DOUBLE), 0.0D) AS gmv"))
        .selectExpr("*", f"{div('conversions', 'sessions')} AS conv_rate")
    )


def duration_conversion(sessions, orders, duration_col: str = "session_duration_seconds",
                        edges=DURATION_EDGES, labels=DURATION_BUCKETS, session_col: str = "session_id") -> DataFrame:
    """Q21: conversion per duration bucket in fixed bucket order; empty buckets give NULL.

    One global aggregate with a conditional ratio per bucket, then ``inline``:
    no join with a bucket dimension, no sort.
    """
    m = merged_sessions(sessions.select(session_col, duration_col), orders, session_col)
    d = ident(duration_col)
    bucket = " ".join(f"WHEN {d} < {e} THEN {i}" for i, e in enumerate(edges))
    m = m.selectExpr(f"CASE {bucket} ELSE {len(edges)} END AS _b", W_ROWS, W_CONV)
    one = m.agg(*[F.expr(f"{div(f'sum(CASE WHEN _b = {i} THEN {W_CONV} END)', f'sum(CASE WHEN _b = {i} THEN {W_ROWS} END)')} AS r{i}")
                  for i in range(len(labels))])
    rows = array([named_struct({"bucket_idx": str(i), "duration_bucket": lit(lbl), "conv_rate": f"r{i}"})
                  for i, lbl in enumerate(labels)])
    return one.selectExpr(f"inline({rows})")


def bounce_rate(sessions, orders, threshold: int = 30, duration_col: str = "session_duration_seconds",
                session_col: str = "session_id") -> DataFrame:
    """Q22: share of merged rows shorter than ``threshold`` seconds (NULL duration is not a bounce)."""
    m = merged_sessions(sessions.select(session_col, duration_col), orders, session_col)
    hit = f"coalesce({ident(duration_col)} < {int(threshold)}, false)"
    return m.agg(F.expr(f"{div(f'sum(CASE WHEN {hit} THEN {W_ROWS} ELSE 0 END)', f'sum({W_ROWS})')} AS bounce_rate"))


#: the groupings of ``time_cube``: name -> columns
CUBE = {"hour": ("hour",), "weekday": ("weekday",), "hour_weekday": ("hour", "weekday"), "month": ("month",),
        "duration": ("bucket",), "all": ()}


def time_cube(sessions, orders, hour_col: str = "session_hour", day_col: str = "session_day_of_week",
              date_col: str = "session_date", duration_col: str = "session_duration_seconds", threshold: int = 30,
              edges=DURATION_EDGES, session_col: str = "session_id") -> DataFrame:
    """A16 / Q16–Q22 in one pass: the merge's sums by hour, weekday, hour × weekday, month, duration bucket and overall.

    Columns ``grouping`` (a name of ``CUBE``), ``hour``, ``weekday``, ``month``, ``bucket`` (NULL where not
    grouped by), ``merged`` and ``sessions`` (merged rows, and those with a session id), ``conversions``, ``gmv``,
    ``bounces``.  Sessions are summed to the finest cells first (hours × weekdays × months × buckets), so
    the grouping sets multiply those cells and never the sessions.
    """
    m = merged_sessions(sessions.select(session_col, hour_col, day_col, date_col, duration_col), orders, session_col)
    d = ident(duration_col)
    bucket = " ".join(f"WHEN {d} < {e} THEN {i}" for i, e in enumerate(edges))
    has_id = f"CASE WHEN {ident(session_col)} IS NOT NULL THEN {W_ROWS} ELSE 0 END"
    bounce = f"CASE WHEN coalesce({d} < {int(threshold)}, false) THEN {W_ROWS} ELSE 0 END"
    cells = m.withColumns({"_month": month_key(F.col(date_col)), "_bucket": F.expr(f"CASE {bucket} ELSE {len(edges)} END")}).groupBy(
        F.col(hour_col).alias("hour"), F.col(day_col).alias("weekday"), F.col("_month").alias("month"), F.col("_bucket").alias("bucket")
    ).agg(F.sum(W_ROWS).alias("merged"), F.expr(f"sum({has_id}) AS sessions"), F.sum(W_CONV).alias("conversions"),
          F.sum(W_GMV).alias("gmv"), F.expr(f"sum({bounce}) AS bounces"))
    dims = ("hour", "weekday", "month", "bucket")
    masks = {sum(1 << (len(dims) - 1 - i) for i, c in enumerate(dims) if c not in cols): n for n, cols in CUBE.items()}
    sums = [F.sum(c).cast("double" if c == "gmv" else "long").alias(c) for c in ("merged", "sessions", "conversions", "gmv", "bounces")]
    cube = cells.groupingSets([[F.col(c) for c in cols] for cols in CUBE.values()], *dims).agg(
        F.grouping_id().cast("int").alias("_g"), *sums)
    name = F.expr("CASE _g " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in masks.items()) + " END")
    return cube.select(name.alias("grouping"), *dims, "merged", "sessions", "conversions",
                       F.coalesce("gmv", F.lit(0.0)).alias("gmv"), "bounces")


def cube_tables(cube: DataFrame, labels=DURATION_BUCKETS) -> dict[str, DataFrame]:
    """Q16, Q18–Q22 out of a (stored) ``time_cube``, with the columns of the single queries."""
    of = {n: cube.filter(F.col("grouping") == n) for n in CUBE}
    merged, known = F.expr(div("conversions", "merged")), F.expr(div("conversions", "sessions"))
    hours = of["hour"].filter("hour IS NOT NULL")
    days = of["weekday"].filter("weekday IS NOT NULL")
    cells = of["hour_weekday"].filter("hour IS NOT NULL AND weekday IS NOT NULL").groupBy("hour").agg(
        *[F.max(F.when(F.col("weekday") == d, merged)).alias(f"d{d}") for d in range(7)])
    buckets = cube.sparkSession.createDataFrame(list(enumerate(labels)), "bucket_idx int, duration_bucket string")
    rates = of["duration"].select(F.col("bucket").alias("bucket_idx"), merged.alias("conv_rate"))
    return {
        "hourly_conversion": hours.select(F.col("hour").alias("session_hour"), "sessions", "conversions", known.alias("conv_rate")),
        "hour_day_matrix": cells.withColumnRenamed("hour", "session_hour"),
        "weekday_conversion": mark_best(days.select(
            F.col("weekday").alias("session_day_of_week"), weekday_name(F.col("weekday")).alias("day_name"),
            merged.alias("conv_rate")), "session_day_of_week", "conv_rate"),
        "monthly_trend": of["month"].select("month", "sessions", "conversions", "gmv", known.alias("conv_rate")),
        "duration_conversion": buckets.join(rates, "bucket_idx", "left"),
        "bounce_rate": of["all"].select(F.expr(div("bounces", "merged")).alias("bounce_rate")),
    }


def time_to_purchase(events, purchase: str, session_col: str = "session_id", event_col: str = "event_name",
                     ts_col: str = "event_timestamp") -> DataFrame:
    """Q31: mean minutes from a session's first event to its last purchase, 2 dp.

    Text timestamps are parsed; text that is no timestamp counts as NULL.
    """
    if dict(events.dtypes)[ts_col] == "string":
        events = events.withColumn(ts_col, text_timestamp(ts_col))
    e = F.col(event_col) == F.lit(purchase)
    per = events.groupBy(session_col).agg(
        F.min(ts_col).alias("_start"), F.max(F.when(e, F.col(ts_col))).alias("_purchase")
    )
    return per.filter(F.col("_purchase").isNotNull()).agg(
        F.round(F.avg(seconds_between("_start", "_purchase") / F.lit(60.0)), 2).alias("avg_minutes_to_purchase")
    )


def daily_revenue(orders, date_col: str = "order_date", gmv_col: str = "gmv") -> DataFrame:
    """Q35: gmv per calendar day; text dates are parsed."""
    if dict(orders.dtypes)[date_col] == "string":
        orders = orders.withColumn(date_col, text_timestamp(date_col))
    return (
        orders.groupBy(F.to_date(F.col(date_col)).alias("date"))
        .agg(money_total(gmv_col).alias("gmv"))
        .orderBy("date")
    )
