"""Segmented funnels and segment comparisons: Q9–Q15, Q30, Q38, Q45."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import city_tier, money_sum, pct, safe_div, TIER1_CITIES, TIER2_CITIES
from journey.functions.sqltext import array, div, ident, lit, named_struct
from journey.operators.flags import flag_sums, has_flags, mark_best, own_flags, session_flags
from journey.spec import FunnelSpec, require_columns


def segment_counts(
    sessions: DataFrame, events: DataFrame, spec: FunnelSpec, segment_col: str, keep_null: bool = False
) -> DataFrame:
    """Wide per-segment counts: ``segment, total_sessions, c0..c{n-1}``.

    The events are first reduced to one flag row per session (the
    aggregate-before-join rewrite), then LEFT JOINed to the session rows so
    that sessions without events still count in ``total_sessions``.
    ``total_sessions`` counts session rows, the stages count distinct
    sessions: repeated rows of a session are merged after the join, where
    they lie in one partition already, before one ``groupBy(segment)``.

    Sessions that carry their stage flags (``session_facts``) are counted as
    they are: no join, and ``events`` is not read.
    """
    require_columns(sessions, spec.session_col, segment_col)
    if has_flags(sessions, spec):
        own = sessions.selectExpr(f"{ident(segment_col)} AS segment", *own_flags(spec))
        own = own if keep_null else own.filter("segment IS NOT NULL")
        return own.groupBy("segment").agg(F.expr("count(1) AS total_sessions"), *flag_sums(spec))
    s = sessions.selectExpr(ident(spec.session_col), f"{ident(segment_col)} AS segment")
    if not keep_null:
        s = s.filter("segment IS NOT NULL")
    j = s.join(session_flags(events, spec), spec.session_col, "left")
    once = j.groupBy(spec.session_col, "segment").agg(
        F.expr("count(1) AS _rows"), *[F.max(c).alias(c) for c in spec.flag_cols()])
    return once.groupBy("segment").agg(F.expr("sum(_rows) AS total_sessions"), *flag_sums(spec))


def _segment_rows(spec: FunnelSpec, denominator: str) -> str:
    return array([
        named_struct({"stage_idx": str(i), "stage_name": lit(n), "stage_label": lit(lbl),
                      "session_count": f"c{i}", "conv_rate": div(f"c{i}", denominator)})
        for i, (n, lbl) in enumerate(spec.stages)
    ])


def segment_funnel(sessions, events, spec: FunnelSpec, segment_col: str, keep_null: bool = False) -> DataFrame:
    """Q9: per segment and stage — session_count, total_sessions and count / total_sessions.

    NULL segments are dropped unless ``keep_null``.
    """
    w = segment_counts(sessions, events, spec, segment_col, keep_null)
    return w.selectExpr("segment", "total_sessions", f"inline({_segment_rows(spec, 'total_sessions')})").select(
        "segment", "stage_idx", "stage_name", "stage_label", "session_count", "total_sessions", "conv_rate"
    )


def segment_count_arrays(sessions, events, spec: FunnelSpec, segment_col: str, keep_null: bool = False) -> DataFrame:
    """Q9 in the original's per-segment shape: ``segment, total_sessions, counts, conv_rates``.

    ``counts`` is the array of stage counts in funnel order and
    ``conv_rates`` the element-wise count / total_sessions (C24); the arrays
    are built from the one aggregated row per segment, nothing is collected.
    """
    w = segment_counts(sessions, events, spec, segment_col, keep_null)
    counts = array([f"c{i}" for i in range(spec.n)])
    return w.selectExpr(
        "segment", "total_sessions", f"{counts} AS counts",
        f"transform({counts}, c -> {div('c', 'total_sessions')}) AS conv_rates",
    )


def _last_stage(spec: FunnelSpec) -> FunnelSpec:
    return spec.with_stages([spec.stages[-1]])


def segment_conversion(sessions, events, spec: FunnelSpec, segment_col: str) -> DataFrame:
    """Q11: final-stage conversion per segment with the best segment flagged."""
    w = segment_counts(sessions, events, _last_stage(spec), segment_col)
    r = w.select(
        "segment", "total_sessions", F.col("c0").alias("conversions"),
        safe_div(F.col("c0"), F.col("total_sessions")).alias("conv_rate"),
    )
    return mark_best(r, "segment", "conv_rate")


def segment_gap(sessions, events, spec: FunnelSpec, segment_col: str, a: str, b: str) -> DataFrame:
    """Q10: final-stage conversion of segments ``a`` and ``b`` and their gap in points."""
    s = sessions.filter(F.col(segment_col).isin(a, b))
    w = segment_counts(s, events, _last_stage(spec), segment_col)
    rate = safe_div(F.col("c0"), F.col("total_sessions"))
    one = w.agg(
        F.max(F.when(F.col("segment") == a, rate)).alias("cr_a"),
        F.max(F.when(F.col("segment") == b, rate)).alias("cr_b"),
    )
    return one.select(
        F.lit(a).alias("segment_a"), F.lit(b).alias("segment_b"), "cr_a", "cr_b",
        ((F.col("cr_a") - F.col("cr_b")) * F.lit(100.0)).alias("gap_pp"),
    )


def with_city_tier(sessions: DataFrame, city_col: str = "city", tier1=TIER1_CITIES, tier2=TIER2_CITIES) -> DataFrame:
    return sessions.withColumn("city_tier", city_tier(city_col, tier1, tier2))


def city_tier_funnel(sessions, events, spec: FunnelSpec, city_col: str = "city",
                     tier1=TIER1_CITIES, tier2=TIER2_CITIES) -> DataFrame:
    """Q12: the segment funnel by city tier."""
    return segment_funnel(with_city_tier(sessions, city_col, tier1, tier2), events, spec, "city_tier")


def payment_mix_by_segment(sessions, orders, segment_col: str, method: str,
                           method_col: str = "payment_method", session_col: str = "session_id") -> DataFrame:
    """Q13: orders per segment and the share paid with ``method`` (0 when a segment has no orders).

    A segment's orders are those with a session among the segment's sessions
    (a left semi join per segment): each order counts once however often its
    session's row is repeated.  Orders are counted per session before the
    join; repeated session rows are merged after it, where they lie in one
    partition already.
    """
    s = sessions.selectExpr(ident(session_col), f"{ident(segment_col)} AS segment").filter("segment IS NOT NULL")
    per = orders.filter(F.col(session_col).isNotNull()).groupBy(session_col).agg(
        F.expr("count(1) AS _n"), F.expr(f"count_if({ident(method_col)} = {lit(method)}) AS _m"))
    once = s.join(per, session_col, "inner").groupBy(session_col, "segment").agg(F.max("_n").alias("_n"), F.max("_m").alias("_m"))
    agg = once.groupBy("segment").agg(F.expr("sum(_n) AS orders"), F.expr("sum(_m) AS method_orders"))
    return agg.selectExpr("segment", "orders", "method_orders",
                          f"coalesce({div('method_orders', 'orders')}, 0.0D) AS method_rate")


def conversion_cells(sessions, orders, row_col: str, col_col: str, session_col: str = "session_id",
                     order_col: str = "order_id") -> DataFrame:
    """Long form of the conversion matrix: one row per (row, col) cell present in the data.

    ``count(order) / count(*)`` over sessions LEFT JOIN orders (a session with
    two orders counts twice, as in the original). Orders are reduced to per
    session counts before the join, so the fan-out is arithmetic, not rows.
    """
    per_session = orders.filter(f"{ident(session_col)} IS NOT NULL").groupBy(session_col).agg(
        F.expr(f"count({ident(order_col)}) AS _n_orders"), F.expr("count(1) AS _n_rows")
    )
    s = sessions.select(session_col, row_col, col_col).filter(f"{ident(row_col)} IS NOT NULL AND {ident(col_col)} IS NOT NULL")
    j = s.join(per_session, session_col, "left")
    # a session matches max(1, rows) merged rows, of which n_orders have an order id
    return j.groupBy(row_col, col_col).agg(
        F.expr(f"{div('sum(coalesce(_n_orders, 0))', 'sum(greatest(coalesce(_n_rows, 0), 1))')} AS rate")
    )


def conversion_matrix(sessions, orders, row_col: str, col_col: str, col_values: list) -> DataFrame:
    """Q14: ``row_col`` × ``col_col`` conversion matrix; empty cells are NULL.

    The pivot values are given so Spark needs no extra job to find them.
    """
    cells = conversion_cells(sessions, orders, row_col, col_col)
    return cells.groupBy(row_col).pivot(col_col, list(col_values)).agg(F.first("rate"))


def matrix_extremes(sessions, orders, row_col: str, col_col: str) -> DataFrame:
    """Q15: best and worst cell; ties go to the smallest column value, then row value."""
    cells = conversion_cells(sessions, orders, row_col, col_col).filter(F.col("rate").isNotNull())
    # both extremes from one distributed aggregate over the cells: min_by with the
    # tie-break order (rate, then column value, then row value) as the ordering key
    cell = F.struct(F.col(row_col).alias("r"), F.col(col_col).alias("c"), F.col("rate").alias("v"))
    key = lambda rate: F.struct(rate.alias("k1"), F.col(col_col).alias("k2"), F.col(row_col).alias("k3"))
    one = cells.agg(F.min_by(cell, key(-F.col("rate"))).alias("best"), F.min_by(cell, key(F.col("rate"))).alias("worst"))
    pick = lambda kind: named_struct({"kind": lit(kind), row_col: f"{kind}.r", col_col: f"{kind}.c", "rate": f"{kind}.v"})
    return one.filter("best IS NOT NULL").selectExpr(f"inline({array([pick('best'), pick('worst')])})")


def device_dropoff(sessions, events, segment_col: str, product_view: str, add_to_cart: str, checkout: str,
                   purchase: str, spec: FunnelSpec | None = None) -> DataFrame:
    """Q30: per segment — sessions with events, stage counts, CR % and checkout abandonment %.

    Inner join: only sessions that have events and a session row count, once
    per segment.  NULL segments form their own group (SQL GROUP BY).
    """
    base = spec or FunnelSpec((("_", "_"),))
    sub = base.with_stages([(product_view, "product_views"), (add_to_cart, "cart_adds"),
                            (checkout, "checkouts"), (purchase, "purchases")])
    if has_flags(sessions, sub):
        j = sessions.selectExpr(ident(segment_col), *own_flags(sub))
    else:
        flags = session_flags(events, sub, all_sessions=True)
        s = sessions.select(sub.session_col, segment_col)
        j = flags.join(s, sub.session_col, "inner").groupBy(sub.session_col, segment_col).agg(
            *[F.max(c).alias(c) for c in sub.flag_cols()])
    agg = j.groupBy(segment_col).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        *[F.coalesce(F.sum(sub.flag(i)), F.lit(0)).cast("long").alias(lbl) for i, lbl in enumerate(sub.labels)],
    )
    return agg.select(
        segment_col, "total_sessions", *sub.labels,
        pct(F.col("purchases"), F.col("total_sessions")).alias("cr_percentage"),
        pct(F.col("checkouts") - F.col("purchases"), F.col("checkouts")).alias("checkout_abandonment_rate"),
    ).orderBy(F.col("total_sessions").desc())


def dashboard_segment_funnel(sessions, events, spec: FunnelSpec, segment_col: str) -> DataFrame:
    """Q38: per segment and step — sessions and share of the segment's first step."""
    w = segment_counts(sessions, events, spec, segment_col)
    rows = array([
        named_struct({"step_idx": str(i), "step": lit(n), "sessions": f"c{i}", "pct_initial": div(f"c{i}", "c0")})
        for i, n in enumerate(spec.names)
    ])
    return w.selectExpr("segment", f"inline({rows})")


def segment_share(sessions, orders, segment_col: str, session_col: str = "session_id",
                  gmv_col: str = "gmv") -> DataFrame:
    """Q45: each segment's share of sessions, orders and revenue.

    Totals are scalar subqueries over the per-segment aggregate (its exchange
    is reused), so no global window is needed.
    """
    per_session = orders.filter(F.col(session_col).isNotNull()).groupBy(session_col).agg(
        F.count(F.lit(1)).alias("_orders"), money_sum(gmv_col).alias("_revenue")
    )
    s = sessions.select(session_col, F.col(segment_col).alias("segment")).filter(F.col("segment").isNotNull())
    agg = s.join(per_session, session_col, "left").groupBy("segment").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.coalesce(F.sum("_orders"), F.lit(0)).cast("long").alias("orders"),
        F.coalesce(F.sum("_revenue").cast("double"), F.lit(0.0)).alias("revenue"),
    )
    tot = agg.agg(F.struct(*[F.sum(c).alias(c) for c in ("sessions", "orders", "revenue")])).scalar()
    # the subquery is evaluated once into a column; the shares then read its fields
    return agg.withColumn("_tot", tot).select(
        "segment", "sessions", "orders", "revenue",
        *[safe_div(F.col(c), F.col("_tot").getField(c)).alias(share)
          for c, share in (("sessions", "session_share"), ("orders", "order_share"), ("revenue", "revenue_share"))],
    )
