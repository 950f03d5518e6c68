"""Overall funnel operators: Q1–Q6, Q29, Q36, Q37."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import money_total
from journey.functions.sqltext import array, div, ident, lit, named_struct, pct_sql
from journey.operators.flags import final_conv, funnel_rows, session_flags, stage_counts, flag_sums
from journey.spec import FunnelSpec


def overall_funnel(events: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Q1: sessions reaching each stage (presence, any order) with rates.

    overall_conv_rate = count / first-stage count; stage_conv_rate = count /
    previous count (1.0 for the first stage); dropoff = previous − count.
    """
    return stage_counts(events, spec).select(F.inline(funnel_rows(spec)))


def average_order_value(orders: DataFrame, gmv_col: str = "gmv"):
    """Scalar subquery: ``sum(gmv) / count(*)``, 0 when there are no orders."""
    return orders.agg(
        F.coalesce(F.try_divide(money_total(gmv_col), F.count(F.lit(1)).cast("double")), F.lit(0.0))
    ).scalar()


def revenue_leakage(events: DataFrame, orders: DataFrame, spec: FunnelSpec, gmv_col: str = "gmv") -> DataFrame:
    """Q2: Q1 plus revenue_lost = dropoff × final conversion × AOV."""
    aov = average_order_value(orders, gmv_col)
    return (
        stage_counts(events, spec)
        .select(final_conv(spec).alias("_final"), F.inline(funnel_rows(spec)))
        .withColumn("revenue_lost", F.col("dropoff_count").cast("double") * F.col("_final") * aov)
        .drop("_final")
    )


def leak_ranking(events: DataFrame, orders: DataFrame, spec: FunnelSpec, k: int = 2, gmv_col: str = "gmv") -> DataFrame:
    """Q3: stages ranked by drop-off volume (ties: earlier stage first); the top ``k`` are the leaks.

    The rank of a stage is 1 + the number of stages ahead of it, counted by
    pairwise comparisons on the one-row stage counts — no window, no sort.
    """
    aov = average_order_value(orders, gmv_col)
    d = {i: f"(c{i - 1} - c{i})" for i in range(1, spec.n)}
    rows = []
    for i in d:
        ahead = [f"CASE WHEN {d[j]} > {d[i]} OR ({d[j]} = {d[i]} AND {lit(j < i)}) THEN 1 ELSE 0 END" for j in d if j != i]
        rank = "CAST(" + " + ".join(["1"] + ahead) + " AS INT)"
        rows.append(named_struct({"stage_idx": str(i), "stage_name": lit(spec.names[i]),
                                  "stage_label": lit(spec.labels[i]), "dropoff_count": d[i], "leak_rank": rank}))
    ranked = stage_counts(events, spec).select(final_conv(spec).alias("_final"), F.inline(F.expr(array(rows))))
    return ranked.select(
        "stage_idx", "stage_name", "stage_label", "dropoff_count",
        (F.col("dropoff_count").cast("double") * F.col("_final") * aov).alias("revenue_lost"),
        "leak_rank", (F.col("leak_rank") <= F.lit(k)).alias("is_top_leak"),
    )


def leak_total(events: DataFrame, orders: DataFrame, spec: FunnelSpec, gmv_col: str = "gmv") -> DataFrame:
    """Q4: total revenue lost over all stages."""
    return revenue_leakage(events, orders, spec, gmv_col).agg(
        F.coalesce(F.sum("revenue_lost"), F.lit(0.0)).alias("total_revenue_lost")
    )


def funnel_flow(events: DataFrame, spec: FunnelSpec, drop_label: str = "Dropped Off") -> DataFrame:
    """Q5: Sankey edges — stage i → i+1 with the next count, and i → drop with the next drop-off."""
    if spec.n < 2:
        raise ValueError("a flow needs at least two stages")
    edges = []
    for i in range(spec.n - 1):
        src = {"source_idx": str(i), "source_stage": lit(spec.labels[i])}
        edges.append(named_struct({**src, "target_stage": lit(spec.labels[i + 1]), "value": f"c{i + 1}"}))
        edges.append(named_struct({**src, "target_stage": lit(drop_label), "value": f"(c{i} - c{i + 1})"}))
    return stage_counts(events, spec).selectExpr(f"inline({array(edges)})")


def conversion_waterfall(events: DataFrame, spec: FunnelSpec, total_label: str = "Total") -> DataFrame:
    """Q6: signed drop-off rate per stage (relative) plus the final conversion (total).

    Each relative value carries the label of the stage it belongs to; the
    total gets its own row.
    """
    rows = [
        named_struct({"stage_idx": str(i), "stage_label": lit(spec.labels[i]), "measure": lit("relative"),
                      "value": f"0.0D - coalesce({div(f'(c{i - 1} - c{i})', f'c{i - 1}')}, 0.0D)"})
        for i in range(1, spec.n)
    ]
    rows.append(named_struct({"stage_idx": str(spec.n), "stage_label": lit(total_label), "measure": lit("total"),
                              "value": div(f"c{spec.n - 1}", "c0")}))
    return stage_counts(events, spec).selectExpr(f"inline({array(rows)})")


def wide_funnel(events: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Q29: one row — sessions with any event, sessions per stage, step and overall rates (percent, 2 dp).

    As in the original SQL, events without a session id form one group: it
    counts in the stage sums, and not in ``COUNT(session_id)``.
    """
    flags = session_flags(events, spec, all_sessions=True, keep_null=True)
    wide = flags.agg(F.count(spec.session_col).alias("total_sessions"), *flag_sums(spec))
    n = spec.names
    cols = ["total_sessions"] + [f"c{i} AS {ident('sessions_with_' + n[i])}" for i in range(spec.n)]
    cols += [f"{pct_sql(f'c{i}', f'c{i - 1}')} AS {ident(n[i - 1] + '_to_' + n[i] + '_rate')}" for i in range(1, spec.n)]
    cols.append(f"{pct_sql(f'c{spec.n - 1}', 'total_sessions')} AS overall_conversion_rate")
    return wide.selectExpr(*cols)


def dashboard_funnel(events: DataFrame, spec: FunnelSpec) -> DataFrame:
    """Q36: step counts with percent of initial and of previous (as fractions)."""
    return overall_funnel(events, spec).select(
        F.col("stage_idx").alias("step_idx"),
        F.col("stage_name").alias("step"),
        F.col("stage_label").alias("label"),
        F.col("session_count").alias("sessions"),
        F.col("overall_conv_rate").alias("pct_initial"),
        F.col("stage_conv_rate").alias("pct_previous"),
    )


def abandonment_rates(events: DataFrame, spec: FunnelSpec, cart: str, checkout: str, purchase: str) -> DataFrame:
    """Q37: cart and checkout abandonment in percent; 0 when the base stage has no sessions."""
    sub = spec.with_stages([(cart, cart), (checkout, checkout), (purchase, purchase)])
    cnt = stage_counts(events, sub)
    cart_n, chk_n, pur_n = (F.col(f"c{i}").cast("double") for i in range(3))
    return cnt.select(
        F.when(cart_n > 0, F.lit(100.0) - (chk_n / cart_n) * F.lit(100.0)).otherwise(F.lit(0.0)).alias("cart_abandonment"),
        F.when(chk_n > 0, F.lit(100.0) - (pur_n / chk_n) * F.lit(100.0)).otherwise(F.lit(0.0)).alias("checkout_abandonment"),
    )

