"""Revenue operators: Q33, Q34."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import money_sum, money_total, pct, safe_div
from journey.spec import FunnelSpec

_DEFAULT = FunnelSpec((("_", "_"),))


def channel_roi(sessions, events, orders, segment_col: str, purchase: str, dedup: bool = False,
                gmv_col: str = "gmv", spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q33: per segment — sessions, converting sessions, CR %, revenue, revenue per session.

    Literal form (``dedup=False``) keeps the original's double LEFT JOIN
    sessions ⟕ purchase events ⟕ orders, where a session's revenue is
    counted once per purchase event.  That fan-out is reproduced exactly by
    arithmetic — revenue × max(1, purchase events) per session — so no
    (event × order) pairs are ever materialised.  ``dedup=True`` counts each
    order once per segment.  Sessions are counted distinct; a repeated
    session row repeats its revenue in the literal form, as in the original.
    """
    sc = spec.session_col
    pe = events.filter((F.col(spec.event_col) == F.lit(purchase)) & F.col(sc).isNotNull()) \
        .groupBy(sc).agg(F.count(F.lit(1)).alias("_npe"))
    po = orders.filter(F.col(sc).isNotNull()).groupBy(sc).agg(money_sum(gmv_col).alias("_rev"))
    s = sessions.select(sc, segment_col)
    j = s.join(pe, sc, "left").join(po, sc, "left")
    # repeated session rows lie in one partition after the joins
    j = j.groupBy(sc, segment_col).agg(F.count(F.lit(1)).alias("_rows"), F.max("_npe").alias("_npe"), F.max("_rev").alias("_rev"))
    mult = F.lit(1) if dedup else F.greatest(F.coalesce(F.col("_npe"), F.lit(0)), F.lit(1)) * F.col("_rows")
    agg = j.groupBy(segment_col).agg(
        F.count(F.col(sc)).alias("total_sessions"),
        F.count(F.when(F.col("_npe") > 0, F.col(sc))).alias("converting_sessions"),
        F.sum(F.col("_rev") * mult).cast("double").alias("_rev"),
    )
    return agg.select(
        segment_col, "total_sessions", "converting_sessions",
        pct(F.col("converting_sessions"), F.col("total_sessions")).alias("conversion_rate"),
        F.coalesce(F.col("_rev"), F.lit(0.0)).alias("total_revenue"),
        F.round(safe_div(F.coalesce(F.col("_rev"), F.lit(0.0)), F.col("total_sessions")), 2).alias("revenue_per_session"),
    ).orderBy(F.col("total_revenue").desc())


def kpi_overview(sessions, events, orders, purchase: str, gmv_col: str = "gmv",
                 spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q34: total revenue, orders, mean order value, and purchase sessions per distinct session (%)."""
    sc = spec.session_col
    buyers = events.filter(F.col(spec.event_col) == F.lit(purchase)).agg(F.count_distinct(sc)).scalar()
    all_sessions = sessions.agg(F.count_distinct(sc)).scalar()
    return orders.agg(
        money_total(gmv_col).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        safe_div(money_sum(gmv_col), F.count(gmv_col)).alias("avg_order_value"),
    ).withColumn("conversion_rate", safe_div(buyers, all_sessions) * F.lit(100.0))
