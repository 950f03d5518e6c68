"""Product operators from JSON event properties: Q23, Q24, Q32."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from journey.functions.exprs import pct, props_of
from journey.spec import FunnelSpec

_DEFAULT = FunnelSpec((("_", "_"),))


def product_sessions(events, view: str, add: str, spec: FunnelSpec = _DEFAULT, default: str = "unknown") -> DataFrame:
    """Per session with a product-view or add-to-cart event: viewed, added, max price, first category.

    "First" follows the event id (file order), not the timestamp.  Events
    without a session id are left out.  The raw events go through one hash
    aggregate per (session, category) with fixed-width buffers; the string
    is compared only among a session's few categories.
    """
    s, e = F.col(spec.session_col), F.col(spec.event_col)
    p = props_of(events, spec.props_col)
    pe = events.filter(e.isin(view, add) & s.isNotNull()).select(
        spec.session_col, e.alias("_e"), F.col(spec.order_col).alias("_o"),
        p.getField("price").alias("_price"), F.coalesce(p.getField("category"), F.lit(default)).alias("_cat"),
    )
    per = pe.groupBy(spec.session_col, "_cat").agg(
        F.bool_or(F.col("_e") == F.lit(view)).alias("_v"), F.bool_or(F.col("_e") == F.lit(add)).alias("_a"),
        F.max("_price").alias("_price"), F.min("_o").alias("_o"),
    )
    return per.groupBy(spec.session_col).agg(
        F.bool_or("_v").alias("viewed"), F.bool_or("_a").alias("added"), F.max("_price").alias("price"),
        F.min_by("_cat", "_o").alias("category"),
    )


def price_cart_histogram(events, view: str, add: str, bin_width: float = 500.0,
                         spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q23: viewing sessions per price bin, split by whether they added to cart."""
    ps = product_sessions(events, view, add, spec).filter("viewed").filter(F.col("price").isNotNull())
    w = F.lit(float(bin_width))
    return ps.groupBy((F.floor(F.col("price") / w) * w).cast("double").alias("price_bin"), F.col("added")).agg(
        F.count(F.lit(1)).alias("sessions")
    )


def category_cart_rate(events, view: str, add: str, spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q24: add-to-cart rate of viewing sessions per first-seen category."""
    ps = product_sessions(events, view, add, spec).filter("viewed")
    return ps.groupBy("category").agg(F.avg(F.col("added").cast("double")).alias("add_rate"))


def abandoned_products(events, add: str, purchase: str, min_sessions: int = 50, k: int = 20,
                       via_session: bool = False, spec: FunnelSpec = _DEFAULT) -> DataFrame:
    """Q32: products added to cart in more than ``min_sessions`` sessions, ranked by abandonments.

    Two conditional distinct counts are computed as flags per (session,
    product, category) and then summed — two hash aggregations with partial
    aggregation, instead of the Expand plan of two COUNT(DISTINCT …).
    With ``via_session`` a product counts as purchased when its session has a
    purchase event at all (for data whose purchase events carry no product).
    The top-``k`` is the report itself; ties are broken by product, category.
    """
    s, e = F.col(spec.session_col), F.col(spec.event_col)
    p = props_of(events, spec.props_col)
    src = events
    if min_sessions >= 0:
        # only add / purchase rows can raise either count, and a product with no
        # add cannot pass ``added > min_sessions``: filter before parsing JSON
        # (the IN-list reaches the scan).
        src = events.filter(e.isin(add) if via_session else e.isin(add, purchase))
    # The parsed fields come out of a one-element ``inline``: a filter on them
    # stays above the generator, so the JSON is parsed once per row (a plain
    # projection would let the filter be pushed below it with a second parse).
    parsed = F.struct(p.getField("product_id").alias("product_id"), p.getField("category").alias("category"))
    pe = src.select(s, e.alias("_e"), F.inline(F.array(parsed))).filter(F.col("product_id").isNotNull())
    keys = [spec.session_col, "product_id", "category"]
    if not via_session:
        per = pe.filter(s.isNotNull()).groupBy(*keys).agg(
            F.max((F.col("_e") == F.lit(add)).cast("int")).alias("_a"),
            F.max((F.col("_e") == F.lit(purchase)).cast("int")).alias("_p"),
        )
    else:
        bought = events.filter((e == F.lit(purchase)) & s.isNotNull()).select(spec.session_col).distinct() \
            .withColumn("_p", F.lit(1))
        per = pe.filter(s.isNotNull()).groupBy(*keys).agg(F.max((F.col("_e") == F.lit(add)).cast("int")).alias("_a")) \
            .join(bought, spec.session_col, "left").withColumn("_p", F.coalesce(F.col("_p"), F.lit(0)) * F.col("_a"))
    prod = per.groupBy("product_id", "category").agg(
        F.sum("_a").cast("long").alias("added_to_cart_sessions"),
        F.sum("_p").cast("long").alias("purchased_sessions"),
    )
    out = prod.filter(F.col("added_to_cart_sessions") > F.lit(min_sessions)).select(
        "product_id", "category", "added_to_cart_sessions", "purchased_sessions",
        (F.col("added_to_cart_sessions") - F.col("purchased_sessions")).alias("abandonments"),
        pct(F.col("added_to_cart_sessions") - F.col("purchased_sessions"), F.col("added_to_cart_sessions"))
        .alias("abandonment_rate"),
    )
    return out.orderBy(F.col("abandonments").desc(), F.col("product_id"), F.col("category")).limit(k)
