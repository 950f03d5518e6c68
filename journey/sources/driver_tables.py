"""Adapter: the benchmark's star-schema tables → journey-shaped tables.

The benchmark tables carry an event log (``events``: event_id, ts, user_id,
event_type, value, props) and customer / nation / region / orders
dimensions, but no sessions. The adapter derives journey tables from them
with the journey column names, entirely as lazy Spark plans:

* ``events``   – session = (user, calendar day); ``props`` is parsed once into a
                 struct with the journey keys (product_id, category, price,
                 method, reason), of which only the used fields survive.
* ``sessions`` – one row per session, from one pass over the events, LEFT
                 JOINed to the customer → nation → region dimension.  The
                 dimension is unique on its key, so Catalyst removes the join
                 where a query does not use its columns.  It is a lazy plan:
                 every query that reads sessions pays for deriving them.
* ``orders``   – one order per purchase event.
* ``users`` / ``user_orders`` – customers and their order history.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from journey.functions.exprs import whole_seconds_between
from journey.operators.flags import FLAG, session_facts
from journey.sources.io import Tables
from journey.spec import PRESETS

RAW_TABLES = ("events", "customer", "orders", "nation", "region")

# --- fixed values: how benchmark event types carry journey properties ------
PRODUCT_EVENTS = ("view", "click", "purchase")
METHOD_EVENTS = ("click", "error")
REASON_EVENTS = ("error",)
PURCHASE_EVENT = "purchase"
# ---------------------------------------------------------------------------


# Declared schemas of the benchmark tables: the scan needs no footer pass
# to infer them, and only the columns a query uses are read.
RAW_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


class RawTables(dict):
    """Benchmark tables, each read on first use with its declared schema."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df


def read_raw(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(spark, sf_dir)


def _parsed(raw_events: DataFrame) -> DataFrame:
    """The events with ``_k``, the number in ``props``; malformed text or values give NULL, not a failed job."""
    return raw_events.withColumn("_k", F.from_json("props", "k BIGINT").getField("k"))


def session_key(user_id, ts):
    return F.concat(F.col(user_id).cast("string"), F.lit("-"), F.date_format(F.to_date(F.col(ts)), "yyyyMMdd"))


def adapt_events(raw_events: DataFrame) -> DataFrame:
    """Journey events; ``event_properties`` is a typed struct."""
    # k is parsed once in its own projection (Catalyst keeps a non-cheap
    # expression that is used several times out of the collapsed projection)
    raw_events = _parsed(raw_events).select("event_id", "ts", "user_id", "event_type", "value", "_k")
    k = F.col("_k")
    name = F.col("event_type")
    product, method, reason = name.isin(*PRODUCT_EVENTS), name.isin(*METHOD_EVENTS), name.isin(*REASON_EVENTS)
    return raw_events.select(
        F.col("event_id"),
        session_key("user_id", "ts").alias("session_id"),
        F.col("user_id"),
        F.col("ts").alias("event_timestamp"),
        name.alias("event_name"),
        F.struct(
            F.when(product, k).alias("product_id"),
            F.when(product, F.concat(F.lit("c"), (k % 5).cast("string"))).alias("category"),
            F.when(product, F.col("value")).alias("price"),
            F.when(method, F.concat(F.lit("m"), (k % 4).cast("string"))).alias("method"),
            F.when(reason, F.concat(F.lit("r"), (k % 3).cast("string"))).alias("reason"),
        ).alias("event_properties"),
        F.col("value"),
    )


def customer_dim(raw: dict[str, DataFrame]) -> DataFrame:
    """customer ⋈ nation ⋈ region, unique on c_custkey.

    nation and region are fixed-size dimensions (25 and 5 rows); Spark's
    size-checked auto-broadcast handles them. A customer with several rows
    is represented by the row with the smallest (nation, segment); the
    aggregate also makes the key unique for the optimizer, so an unused LEFT
    JOIN to it is dropped.
    """
    c = raw["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    n = raw["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = raw["region"].select("r_regionkey", "r_name")
    d = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    row = F.struct("c_nationkey", "c_mktsegment", "n_name", "r_name")
    return d.groupBy(F.col("c_custkey").alias("d_user_id")).agg(F.min(row).alias("_d")).select(
        "d_user_id",
        F.col("_d.c_mktsegment").alias("device_type"),
        F.col("_d.r_name").alias("traffic_source"),
        F.col("_d.n_name").alias("city"),
        F.col("_d.r_name").alias("state"),
    )


def adapt_sessions(events: DataFrame, raw: dict[str, DataFrame], names=()) -> DataFrame:
    """One aggregate of the event log per session; the user's first date is a window over those sessions.

    The same aggregate gives a flag column for each event of ``names``.
    Events without a user or time have no session id and no session.
    """
    core = session_facts(
        events, PRESETS["driver"], names,
        F.min("user_id").alias("user_id"),
        F.min("event_timestamp").alias("_start"),
        F.max("event_timestamp").alias("_end"),
    )
    flags = [F.col(f"`{FLAG}{n}`") for n in names]
    s = core.select(
        "session_id",
        "user_id",
        F.to_date("_start").alias("session_date"),
        F.hour("_start").alias("session_hour"),
        F.weekday("_start").alias("session_day_of_week"),
        whole_seconds_between("_start", "_end").alias("session_duration_seconds"),
        F.to_date(F.min("_start").over(Window.partitionBy("user_id"))).alias("_first_date"),
        *flags,
    )
    s = s.join(customer_dim(raw), s.user_id == F.col("d_user_id"), "left")
    return s.select(
        "session_id",
        "user_id",
        "session_date",
        "session_hour",
        "session_day_of_week",
        "device_type",
        "traffic_source",
        "city",
        "state",
        (F.col("session_date") == F.col("_first_date")).alias("is_new_user"),
        "session_duration_seconds",
        *flags,
    )


def adapt_orders(raw_events: DataFrame) -> DataFrame:
    return _parsed(raw_events.filter(F.col("event_type") == PURCHASE_EVENT)).select(
        F.col("event_id").alias("order_id"),
        session_key("user_id", "ts").alias("session_id"),
        F.col("user_id"),
        F.col("ts").alias("order_date"),
        F.col("value").alias("gmv"),
        F.concat(F.lit("m"), (F.col("_k") % 4).cast("string")).alias("payment_method"),
    )


def adapt_users(raw: dict[str, DataFrame]) -> DataFrame:
    return raw["customer"].select(F.col("c_custkey").alias("user_id"))


def adapt_user_orders(raw: dict[str, DataFrame]) -> DataFrame:
    return raw["orders"].select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("gmv"),
    )


class DriverTables(Tables):
    """Journey tables over the benchmark tables, each a lazy plan built on first access.

    A query that only needs ``events`` never constructs the session joins.
    To derive sessions once for several queries, write them with
    ``journey.session.save_table`` and assign the result to ``sessions``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):  # noqa: D107
        self.raw = read_raw(spark, sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return adapt_events(self.raw["events"])

    @cached_property
    def sessions(self) -> DataFrame:
        return adapt_sessions(self.events, self.raw)

    @cached_property
    def facts(self) -> DataFrame:
        """The sessions with the stage flags of the benchmark's events, from one aggregate of the log."""
        return adapt_sessions(self.events, self.raw, PRESETS["driver"].names)

    @cached_property
    def orders(self) -> DataFrame:
        return adapt_orders(self.raw["events"])

    @cached_property
    def users(self) -> DataFrame:
        return adapt_users(self.raw)

    @cached_property
    def user_orders(self) -> DataFrame:
        return adapt_user_orders(self.raw)


def driver_tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    """The journey tables of ``sf_dir``; nothing is kept between calls, so changed files are seen."""
    return DriverTables(spark, sf_dir)
