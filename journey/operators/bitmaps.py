"""Distinct sessions per product from bitmaps, where sessions carry numbers.

Each number is a bit of one bucket; a bucket holds 32,768 numbers.  Per (product,
category, bucket) the sessions that added and those that bought are two
bitmaps of 4 KB, built on the map side and merged: what is shuffled grows
with products x buckets that occur in a task, never with rows per (session,
product), and a product with a third of all sessions is spread over its
buckets.  Counts are exact.

Bitmaps pay where a bucket holds many sessions of a product.  For a long tail
of rarely seen products each row is a nearly empty bitmap: small in the
shuffle, which compresses it, but 4 KB before.  Spark builds bitmaps with a
sort-based aggregate: a task sorts its events by group and holds one bitmap at
a time.  ``abandoned_products`` is the better choice for long tails.

Bitmaps of parts of the log, days for instance, can be stored and merged:
a session that adds a product on two days counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import pct, props_of
from journey.functions.sqltext import ident
from journey.session import save_table
from journey.spec import FunnelSpec

_DEFAULT = FunnelSpec((("_", "_"),))


def number_sessions(events: DataFrame, path: str, spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """``session, session_no`` of the session ids in ``events``, written once to ``path`` (new) and read back.

    Numbers are the row's place in its task, tasks apart by 2^33: buckets fill
    up and no task sees all sessions.  They are only valid as stored, a
    second call numbers anew.
    """
    key = spec.session_col
    ids = events.filter(F.col(key).isNotNull()).select(key).distinct()
    return save_table(ids.withColumn("session_no", F.monotonically_increasing_id()), path)


def numbered(events: DataFrame, numbers: DataFrame, path: str, spec: FunnelSpec = _DEFAULT, *columns: str) -> DataFrame:
    """``columns`` of ``events`` (all by default) with ``session_no``, written once to ``path`` (new).

    The join on the session id is paid when the log is stored, not by the
    queries that read it.  Events without a session id have no number.
    """
    wanted = list(columns) or list(events.columns)
    joined = events.join(numbers.select(spec.session_col, "session_no"), spec.session_col, "left")
    return save_table(joined.select(*[F.col(ident(c)) for c in wanted], "session_no"), path)


def _bits(when: Column, number: str) -> Column:
    return F.bitmap_construct_agg(F.when(when, F.bitmap_bit_position(F.col(ident(number)))))


def product_bitmaps(events: DataFrame, add: str, purchase: str, number: str = "session_no",
                    spec: FunnelSpec = _DEFAULT, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys.., product_id, category, bucket, added, bought``: bitmaps of the sessions that added and that bought.

    ``keys`` are columns of ``events`` that name a part of the log, its day for
    instance.  Events without a session number or without a product are left
    out; a NULL category is a group of its own.
    """
    p, e = props_of(events, spec.props_col), F.col(spec.event_col)
    src = events.filter(e.isin(add, purchase) & F.col(ident(number)).isNotNull())
    fields = F.struct(p.getField("product_id").alias("product_id"), p.getField("category").alias("category"))
    # the one-element ``inline`` keeps the filter above the parse, as in ``abandoned_products``
    pe = src.select(*keys, F.col(ident(number)), e.alias("_e"), F.inline(F.array(fields))).filter(F.col("product_id").isNotNull())
    return pe.groupBy(*keys, "product_id", "category", F.bitmap_bucket_number(F.col(ident(number))).alias("bucket")).agg(
        _bits(F.col("_e") == F.lit(add), number).alias("added"),
        _bits(F.col("_e") == F.lit(purchase), number).alias("bought"))


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several parts of the log (all numbered by one ``number_sessions``) as one set of bitmaps."""
    return bitmaps.groupBy("product_id", "category", "bucket").agg(
        F.bitmap_or_agg("added").alias("added"), F.bitmap_or_agg("bought").alias("bought"))


def abandoned_from_bitmaps(bitmaps: DataFrame, min_sessions: int = 50, k: int = 20) -> DataFrame:
    """Q32 from ``product_bitmaps``: buckets are disjoint, so their counts add up."""
    added, bought = (F.sum(F.bitmap_count(F.col(c))).cast("long") for c in ("added", "bought"))
    prod = bitmaps.groupBy("product_id", "category").agg(
        added.alias("added_to_cart_sessions"), bought.alias("purchased_sessions"))
    lost = F.col("added_to_cart_sessions") - F.col("purchased_sessions")
    return prod.filter(F.col("added_to_cart_sessions") > F.lit(min_sessions)).select(
        "product_id", "category", "added_to_cart_sessions", "purchased_sessions", lost.alias("abandonments"),
        pct(lost, F.col("added_to_cart_sessions")).alias("abandonment_rate"),
    ).orderBy(F.col("abandonments").desc(), F.col("product_id"), F.col("category")).limit(k)
