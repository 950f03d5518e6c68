"""Significance tests, sample sizes and the priority matrix: Q26–Q28."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from journey.functions.exprs import pooled_z_sql, priority_quadrant, safe_div, sample_size_per_variant, two_sided_p_sql
from journey.functions.sqltext import array, div, lit, named_struct
from journey.operators.flags import final_conv
from journey.operators.funnel import average_order_value
from journey.operators.segments import segment_counts
from journey.spec import FunnelSpec


def ab_significance(sessions, events, spec: FunnelSpec, segment_col: str, a, b, alpha: float = 0.05) -> DataFrame:
    """Q26: pooled two-proportion z-test of final-stage conversion, segment ``a`` vs ``b``.

    n = session rows of the segment, x = its sessions reaching the last
    stage.  One flags ⋈ sessions aggregate, then a one-row pivot.  A zero
    standard error gives NULL z and p and ``significant = false``.
    """
    last = spec.with_stages([spec.stages[-1]])
    s = sessions.filter(F.col(segment_col).isin(a, b))
    w = segment_counts(s, events, last, segment_col)
    pick = lambda v, c, name: F.expr(f"CAST(coalesce(max(CASE WHEN segment = {lit(v)} THEN {c} END), 0) AS BIGINT) AS {name}")
    one = w.agg(pick(a, "total_sessions", "n_a"), pick(a, "c0", "x_a"), pick(b, "total_sessions", "n_b"), pick(b, "c0", "x_b"))
    tested = one.selectExpr(
        f"{lit(str(a))} AS label_a", f"{lit(str(b))} AS label_b", "n_a", "x_a", "n_b", "x_b",
        f"{div('x_a', 'n_a')} AS conv_a", f"{div('x_b', 'n_b')} AS conv_b",
        f"{pooled_z_sql('x_a', 'n_a', 'x_b', 'n_b')} AS z",
    ).selectExpr("*", f"{two_sided_p_sql('z')} AS p_value")
    return tested.selectExpr(
        "*", f"coalesce(p_value < {alpha!r}D, false) AS significant",
        f"CASE WHEN p_value < {alpha!r}D THEN 'significant' ELSE 'not significant' END AS verdict",
    )


def experiment_sample_size(sessions, events, spec: FunnelSpec, segment_col: str, relative_lift: float = 0.05,
                           alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Q28: per segment — baseline conversion, MDE = baseline × lift, sessions needed per variant."""
    w = segment_counts(sessions, events, spec.with_stages([spec.stages[-1]]), segment_col)
    base = w.select("segment", safe_div(F.col("c0"), F.col("total_sessions")).alias("baseline"))
    base = base.withColumn("mde", F.col("baseline") * F.lit(float(relative_lift)))
    return base.withColumn("n_per_variant", sample_size_per_variant(F.col("baseline"), F.col("mde"), alpha, power))


def effort_frame(spark, effort: dict[str, int]) -> DataFrame:
    """Small (stage_name, ease) dimension from a dict given by the analyst."""
    schema = T.StructType([T.StructField("stage_name", T.StringType(), False), T.StructField("ease", T.IntegerType())])
    return spark.createDataFrame(sorted(effort.items()), schema)


def priority_matrix(sessions, events, orders, spec: FunnelSpec, segment_col: str, effort: dict[str, int],
                    ease_min: int = 6, impact_min: float = 400000, gmv_col: str = "gmv") -> DataFrame:
    """Q27: CRO priority quadrant per segment × stage.

    revenue_impact is the revenue-leakage formula of Q2 within the segment
    (drop-off × segment final conversion × AOV); sessions = sessions lost at
    the stage; ease comes from the analyst's effort table (one row per
    stage, broadcast — its size is the number of stages).
    """
    w = segment_counts(sessions, events, spec, segment_col)
    aov = average_order_value(orders, gmv_col)
    rows = array([named_struct({"stage_idx": str(i), "stage_name": lit(spec.names[i]), "sessions": f"(c{i - 1} - c{i})"})
                  for i in range(1, spec.n)])
    long = w.select("segment", final_conv(spec).alias("_final"), F.inline(F.expr(rows))).withColumn(
        "revenue_impact", F.col("sessions").cast("double") * F.col("_final") * aov)
    eff = F.broadcast(effort_frame(sessions.sparkSession, effort))
    j = long.join(eff, "stage_name", "left")
    return j.select(
        "segment", "stage_idx", "stage_name", "ease", "revenue_impact", "sessions",
        priority_quadrant(F.col("ease"), F.col("revenue_impact"), ease_min, impact_min).alias("category"),
    )
