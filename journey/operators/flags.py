"""The shared core: one row per session with a 0/1 flag per funnel stage.

``MAX(CASE WHEN event = stage THEN 1 ELSE 0 END)`` for every stage in a single
aggregate: one scan of the events, partial (map-side) aggregation, one hash
exchange on the session key — instead of one filtered distinct count per
stage.  Partial aggregation also makes a hot session harmless: each task
sends at most one row per session to the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journey.functions.sqltext import array, div, ident, in_list, lit, named_struct
from journey.spec import FunnelSpec, require_columns


FLAG = "flag:"


def flag_table(events: DataFrame, spec: FunnelSpec, names) -> DataFrame:
    """One row per session with any event and a 0/1 column ``flag:<event>`` for each of ``names``.

    Written once, it stands in for the events wherever only presence of
    events per session matters: ``session_flags`` reads it instead of
    aggregating the event log again.
    """
    names = list(dict.fromkeys(names))
    flags = session_flags(events, spec.with_stages([(n, n) for n in names]), all_sessions=True, keep_null=True)
    return flags.select(spec.session_col, *[F.col(spec.flag(i)).alias(FLAG + n) for i, n in enumerate(names)])


def session_flags(events: DataFrame, spec: FunnelSpec, all_sessions: bool = False, keep_null: bool = False) -> DataFrame:
    """``session_id, s0..s{n-1}`` (INT 0/1).

    With ``all_sessions=False`` events outside the funnel are filtered before
    the shuffle (the IN-list reaches the Parquet scan); sessions without any
    stage event then have no row, which does not change any stage count.
    ``all_sessions=True`` keeps one row for every session with any event.
    NULL session ids are dropped (distinct counts skip NULL) unless
    ``keep_null``, which keeps them as one row (SQL ``GROUP BY``).
    ``events`` may also be a ``flag_table`` that holds all stages.
    """
    s = ident(spec.session_col)
    if any(c.startswith(FLAG) for c in events.columns):
        require_columns(events, spec.session_col, *[FLAG + n for n in spec.names])
        flags = events.select(spec.session_col, *[F.col(ident(FLAG + n)).alias(spec.flag(i)) for i, n in enumerate(spec.names)])
        if not keep_null:
            flags = flags.filter(f"{s} IS NOT NULL")
        return flags if all_sessions else flags.filter(" + ".join(spec.flag_cols()) + " > 0")
    require_columns(events, spec.session_col, spec.event_col)
    e = ident(spec.event_col)
    conds = ([] if keep_null else [f"{s} IS NOT NULL"]) + ([] if all_sessions else [f"{e} IN ({in_list(spec.names)})"])
    cond = " AND ".join(conds) or "true"
    return events.filter(cond).groupBy(spec.session_col).agg(
        *[F.expr(f"max(CASE WHEN {e} = {lit(n)} THEN 1 ELSE 0 END) AS {spec.flag(i)}") for i, n in enumerate(spec.names)]
    )


def session_facts(events: DataFrame, spec: FunnelSpec, names, *attributes: Column) -> DataFrame:
    """One row per session id with ``attributes`` (aggregate columns) and ``flag:<event>`` for each of ``names``.

    Session row and stage flags come from the same aggregate: one scan of the
    event log and one exchange on the session key, where deriving them apart
    costs two of each and a join.  Operators that take a session table and
    the events read both from this one table (see ``has_flags``).  Events
    without a session id are left out.
    """
    require_columns(events, spec.session_col, spec.event_col)
    e = ident(spec.event_col)
    flags = [F.expr(f"max(CASE WHEN {e} = {lit(n)} THEN 1 ELSE 0 END) AS {ident(FLAG + n)}") for n in dict.fromkeys(names)]
    return events.filter(F.col(spec.session_col).isNotNull()).groupBy(spec.session_col).agg(*attributes, *flags)


def has_flags(sessions: DataFrame, spec: FunnelSpec) -> bool:
    """Whether ``sessions`` carries the flags of all stages itself.

    Such a table has one row per session, as ``session_facts`` and
    ``flag_table`` make it; no events need to be joined to it.
    """
    return {FLAG + n for n in spec.names} <= set(sessions.columns)


def own_flags(spec: FunnelSpec) -> list[str]:
    """The flags that a table carries itself, as ``s0..s{n-1}`` (SQL text)."""
    return [f"{ident(FLAG + n)} AS {spec.flag(i)}" for i, n in enumerate(spec.names)]


def count_cols(spec: FunnelSpec) -> list[str]:
    return [f"c{i}" for i in range(spec.n)]


def flag_sums(spec: FunnelSpec) -> list[Column]:
    """Stage counts as aggregate expressions over a flag table (0 on empty input)."""
    return [F.expr(f"CAST(coalesce(sum({spec.flag(i)}), 0) AS BIGINT) AS c{i}") for i in range(spec.n)]


def stage_counts(events: DataFrame, spec: FunnelSpec) -> DataFrame:
    """One row ``c0..c{n-1}``: sessions reaching each stage."""
    return session_flags(events, spec).agg(*flag_sums(spec))


def funnel_rows_sql(spec: FunnelSpec, with_rates: bool = True) -> str:
    """Array of per-stage structs computed from the wide counts ``c0..`` (SQL text).

    Lag, first-stage and overrides of the first row are plain column
    arithmetic on the wide row, so no window (and no single-partition sort)
    is needed; ``inline`` then turns the array into rows.
    """
    rows = []
    for i, (name, label) in enumerate(spec.stages):
        f = {"stage_idx": str(i), "stage_name": lit(name), "stage_label": lit(label), "session_count": f"c{i}"}
        if with_rates:
            prev = f"c{i - 1}"
            f["overall_conv_rate"] = div(f"c{i}", "c0")
            f["stage_conv_rate"] = "1.0D" if i == 0 else div(f"c{i}", prev)
            f["dropoff_count"] = "CAST(NULL AS BIGINT)" if i == 0 else f"({prev} - c{i})"
            f["dropoff_rate"] = "CAST(NULL AS DOUBLE)" if i == 0 else div(f"({prev} - c{i})", prev)
        rows.append(named_struct(f))
    return array(rows)


def funnel_rows(spec: FunnelSpec, with_rates: bool = True) -> Column:
    return F.expr(funnel_rows_sql(spec, with_rates))


def final_conv(spec: FunnelSpec) -> Column:
    return F.expr(div(f"c{spec.n - 1}", "c0"))


def mark_best(df: DataFrame, key: str, value: str, name: str = "is_best") -> DataFrame:
    """Flag the row with the largest ``value``; ties go to the smallest ``key``.

    The winner is found by a distributed ``min_by`` aggregate run as a scalar
    subquery, so no global window gathers the rows into one task.
    """
    ordering = F.struct((-F.col(value)).alias("v"), F.col(key).alias("k"))
    best = df.filter(F.col(value).isNotNull()).agg(F.min_by(F.col(key), ordering)).scalar()
    return df.withColumn(name, F.coalesce(F.col(key) == best, F.lit(False)))
