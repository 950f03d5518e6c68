"""The funnel analyses as table functions that SQL users call.

``register_functions`` creates temporary SQL table functions over three views:

    SELECT * FROM overall_funnel()
    SELECT * FROM overall_funnel(DATE'2024-01-01', DATE'2024-01-31')
    SELECT * FROM segment_funnel('device_type')
    SELECT * FROM revenue_leakage()

A function's body is one query made from the funnel's stages; Spark inlines it
into the caller's plan, so filters, column pruning and broadcasts work as in
a query written by hand, and nothing runs when a function is created.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from journey.functions.sqltext import array, div, ident, in_list, lit, named_struct
from journey.operators.flags import funnel_rows_sql
from journey.spec import FunnelSpec

#: (name, type) of the rows of a funnel, without those of a segment
STAGE = (("stage_idx", "INT"), ("stage_name", "STRING"), ("stage_label", "STRING"), ("session_count", "BIGINT"))
RATES = (("overall_conv_rate", "DOUBLE"), ("stage_conv_rate", "DOUBLE"), ("dropoff_count", "BIGINT"), ("dropoff_rate", "DOUBLE"))


def _columns(fields) -> str:
    return ", ".join(f"{n} {t}" for n, t in fields)


def _names(fields, of: str = "") -> str:
    return ", ".join(of + n for n, _ in fields)


def _flags(spec: FunnelSpec, events: str, where: str = "true") -> str:
    """One row per session with a stage event and a 0/1 column per stage."""
    s, e = ident(spec.session_col), ident(spec.event_col)
    cols = ", ".join(f"max(CASE WHEN {e} = {lit(n)} THEN 1 ELSE 0 END) AS {spec.flag(i)}" for i, n in enumerate(spec.names))
    return (f"SELECT {s} AS sid, {cols} FROM {events} WHERE {s} IS NOT NULL AND {e} IN ({in_list(spec.names)}) "
            f"AND {where} GROUP BY {s}")


def _sums(spec: FunnelSpec, of: str) -> str:
    return ", ".join(f"CAST(coalesce(sum({of}.{spec.flag(i)}), 0) AS BIGINT) AS c{i}" for i in range(spec.n))


def function_texts(spec: FunnelSpec, segments: dict[str, str], sessions: str, events: str, orders: str,
                   gmv_col: str = "gmv", prefix: str = "") -> dict[str, str]:
    """Function name → its CREATE statement.  ``segments`` maps a segment's name to its column of ``sessions``."""
    ts, sid = ident(spec.ts_col), ident(spec.session_col)
    name = lambda n: ident(prefix + n)
    # a missing day is no limit and folds away; a constant one reaches the scan
    days = f"(first_day IS NULL OR {ts} >= first_day) AND (last_day IS NULL OR {ts} < date_add(last_day, 1))"
    overall = (f"CREATE OR REPLACE TEMPORARY FUNCTION {name('overall_funnel')}(first_day DATE DEFAULT NULL, last_day DATE DEFAULT NULL) "
               f"RETURNS TABLE ({_columns(STAGE + RATES)}) RETURN SELECT {_names(STAGE + RATES, 'r.')} FROM "
               f"(SELECT {_sums(spec, 'f')} FROM ({_flags(spec, events, days)}) f) w "
               f"LATERAL VIEW inline({funnel_rows_sql(spec)}) r AS {_names(STAGE + RATES)}")
    # a text that names no segment is an error; a constant one leaves a single column of the sessions
    pick = " ".join(f"WHEN {lit(k)} THEN CAST({ident(c)} AS STRING)" for k, c in segments.items())
    known = ", ".join(segments)
    pick = f"CASE by_segment {pick} ELSE raise_error({lit('unknown segment; known: ' + known)}) END"
    rows = array([named_struct({"stage_idx": str(i), "stage_name": lit(n), "stage_label": lit(lbl), "session_count": f"c{i}"})
                  for i, (n, lbl) in enumerate(spec.stages)])
    out = (("segment", "STRING"), *STAGE, ("total_sessions", "BIGINT"), ("conv_rate", "DOUBLE"))
    merged = ", ".join(f"max(f.{spec.flag(i)}) AS {spec.flag(i)}" for i in range(spec.n))
    once = (f"SELECT s.segment, count(1) AS n_rows, {merged} FROM (SELECT {sid} AS sid, {pick} AS segment FROM {sessions}) s "
            f"LEFT JOIN ({_flags(spec, events)}) f ON s.sid = f.sid WHERE s.segment IS NOT NULL OR keep_null GROUP BY s.sid, s.segment")
    segment = (f"CREATE OR REPLACE TEMPORARY FUNCTION {name('segment_funnel')}(by_segment STRING, keep_null BOOLEAN DEFAULT false) "
               f"RETURNS TABLE ({_columns(out)}) RETURN SELECT w.segment, {_names(STAGE, 'r.')}, w.total_sessions, "
               f"{div('r.session_count', 'w.total_sessions')} FROM "
               f"(SELECT o.segment, sum(o.n_rows) AS total_sessions, {_sums(spec, 'o')} FROM ({once}) o GROUP BY o.segment) w "
               f"LATERAL VIEW inline({rows}) r AS {_names(STAGE)}")
    money = f"CAST(sum(CAST({ident(gmv_col)} AS DECIMAL(18, 6))) AS DOUBLE)"
    aov = f"(SELECT coalesce({div(money, 'count(1)')}, 0.0D) FROM {orders})"
    leak = (f"CREATE OR REPLACE TEMPORARY FUNCTION {name('revenue_leakage')}() "
            f"RETURNS TABLE ({_columns(STAGE + RATES)}, revenue_lost DOUBLE) RETURN SELECT {_names(STAGE + RATES, 'r.')}, "
            f"CAST(r.dropoff_count AS DOUBLE) * {div(f'w.c{spec.n - 1}', 'w.c0')} * {aov} FROM "
            f"(SELECT {_sums(spec, 'f')} FROM ({_flags(spec, events)}) f) w "
            f"LATERAL VIEW inline({funnel_rows_sql(spec)}) r AS {_names(STAGE + RATES)}")
    return {prefix + "overall_funnel": overall, prefix + "segment_funnel": segment, prefix + "revenue_leakage": leak}


def register_functions(spark: SparkSession, spec: FunnelSpec, segments: dict[str, str], sessions: str = "sessions",
                       events: str = "events", orders: str = "orders", gmv_col: str = "gmv", prefix: str = "") -> list[str]:
    """Create the table functions over the views (or tables) of the given names; returns the functions' names."""
    made = function_texts(spec, segments, sessions, events, orders, gmv_col, prefix)
    for text in made.values():
        spark.sql(text)
    return list(made)
