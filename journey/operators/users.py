"""User-level rollups and derived session columns: Q39–Q43."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from journey.functions.exprs import campaign_tag as _campaign_tag
from journey.functions.exprs import loyalty_tier, money_sum


def user_rollup(users, sessions, orders, user_col: str = "user_id", order_col: str = "order_id",
                gmv_col: str = "gmv") -> DataFrame:
    """Q39: every user with session count, order count and revenue (0 when none).

    Both sides are aggregated per user first (partial aggregation, so a user
    with a third of all rows costs one row per task), then LEFT JOINed.
    """
    sc = sessions.groupBy(user_col).agg(F.count(F.lit(1)).alias("_s"))
    oc = orders.groupBy(user_col).agg(F.count(order_col).alias("_o"), money_sum(gmv_col).alias("_r"))
    return (
        users.select(user_col)
        .join(sc, user_col, "left")
        .join(oc, user_col, "left")
        .select(
            user_col,
            F.coalesce(F.col("_s"), F.lit(0)).cast("long").alias("total_sessions"),
            F.coalesce(F.col("_o"), F.lit(0)).cast("long").alias("total_orders"),
            F.coalesce(F.col("_r").cast("double"), F.lit(0.0)).alias("total_revenue"),
        )
    )


def loyalty_tiers(users, sessions, orders, **kw) -> DataFrame:
    """Q40: Q39 plus the loyalty tier from the order count."""
    r = user_rollup(users, sessions, orders, **kw)
    return r.withColumn("loyalty_tier", loyalty_tier(F.col("total_orders")))


def first_seen(users, sessions, default_date: str | _dt.date | None = None, user_col: str = "user_id",
               date_col: str = "session_date") -> DataFrame:
    """Q41: each user's first session date; users without sessions get ``default_date``.

    Without a default, the start of the data (earliest session date) is used.
    """
    f = sessions.groupBy(user_col).agg(F.min(date_col).alias("_first"))
    if default_date is None:
        dflt = sessions.agg(F.min(date_col)).scalar()
    else:
        dflt = F.lit(default_date).cast("date")
    return users.select(user_col).join(f, user_col, "left").select(
        user_col, F.coalesce(F.col("_first"), dflt).alias("first_seen_date")
    )


def first_sessions(sessions, user_col: str = "user_id", session_col: str = "session_id",
                   order_cols=("session_date", "session_hour")) -> DataFrame:
    """Each user's first session (by date, hour, then session id); an unknown date or hour comes first.

    A row number of which only the first is kept: Spark limits every task to
    one row per user before the shuffle, so a user with a third of all sessions costs
    one row per task.
    """
    order = Window.partitionBy(user_col).orderBy(*[F.col(c).asc_nulls_first() for c in (*order_cols, session_col)])
    known = sessions.filter(F.col(user_col).isNotNull())
    return known.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def new_session_flag(sessions, user_col: str = "user_id", session_col: str = "session_id",
                     order_cols=("session_date", "session_hour")) -> DataFrame:
    """Q42: ``is_new_user`` — the session is its user's first (``first_sessions``); sessions without a user are not.

    The first sessions meet the sessions on the session id, not on the user, so
    no task gets all sessions of one user.
    """
    known = sessions.select(session_col, user_col, *order_cols)
    first = first_sessions(known, user_col, session_col, order_cols).select(
        F.col(session_col).alias("_first"), F.col(user_col).alias("_user"))
    flagged = known.join(first, F.col(session_col) == F.col("_first"), "left")
    return flagged.select(session_col, user_col, F.coalesce(F.col(user_col) == F.col("_user"), F.lit(False)).alias("is_new_user"))


def campaign_tag(sessions, paid_sources, source_col: str = "traffic_source", date_col: str = "session_date",
                 session_col: str = "session_id") -> DataFrame:
    """Q43: ``campaign_<source>_<Mon>`` for sessions from paid sources, else NULL."""
    return sessions.select(session_col, _campaign_tag(F.col(source_col), F.col(date_col), paid_sources).alias("utm_campaign"))
