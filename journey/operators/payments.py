"""Payment operators: Q7, Q8, Q25."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import prop_of, safe_div_or_zero
from journey.spec import FunnelSpec

_DEFAULT = FunnelSpec((("_", "_"),))


def payment_failure_rate(events, initiated: str, failed: str, spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q7: failed rows / initiated rows (event rows, not sessions); 0 with no initiations."""
    e = F.col(spec.event_col)
    return (
        events.filter(e.isin(initiated, failed))
        .agg(F.count_if(e == F.lit(initiated)).alias("initiated"), F.count_if(e == F.lit(failed)).alias("failed"))
        .withColumn("failure_rate", safe_div_or_zero("failed", "initiated"))
    )


def failure_reasons(events, failed: str, spec: FunnelSpec = _DEFAULT, default: str = "unknown") -> DataFrame:
    """Q8: failure events per reason; missing key, JSON null or bad JSON → ``default``."""
    return (
        events.filter(F.col(spec.event_col) == F.lit(failed))
        .select(prop_of(events, spec.props_col, "reason", default).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col("reason"))
    )


def method_failure_rate(events, initiated: str, success: str, failed: str, method_stage: str | None = None,
                        spec: FunnelSpec = _DEFAULT, default: str = "unknown") -> DataFrame:
    """Q25: per payment method, 1 − share of initiating sessions that succeeded.

    A session's method is its first (by event id) method that is not the
    default.  In the literal form only the payment events are read, so the
    method comes from failure events; ``method_stage`` adds the event that
    records the chosen method.  Events without a session id are left out.
    The raw events go through one hash aggregate per (session, method).
    """
    names = [initiated, success, failed] + ([method_stage] if method_stage else [])
    s, e, oid = F.col(spec.session_col), F.col(spec.event_col), F.col(spec.order_col)
    m = prop_of(events, spec.props_col, "method", default)
    pay = events.filter(e.isin(*names) & s.isNotNull()).select(spec.session_col, e.alias("_e"), oid.alias("_o"), m.alias("_m"))
    per = pay.groupBy(spec.session_col, "_m").agg(
        F.bool_or(F.col("_e") == F.lit(initiated)).alias("_init"),
        F.bool_or(F.col("_e") == F.lit(success)).alias("_ok"), F.min("_o").alias("_o"),
    )
    per = per.groupBy(spec.session_col).agg(
        F.bool_or("_init").alias("_init"), F.bool_or("_ok").alias("_ok"),
        F.coalesce(
            F.min_by(F.col("_m"), F.when(F.col("_m") != F.lit(default), F.col("_o"))), F.lit(default)
        ).alias("method"),
    )
    return per.filter("_init").groupBy("method").agg(
        (F.lit(1.0) - F.avg(F.col("_ok").cast("double"))).alias("failure_rate")
    )
