"""Sources and sinks: CSV / Parquet scans with explicit schemas, views, writers."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from journey.sources import schemas

# CSV written by pandas quotes fields and doubles inner quotes; the default
# backslash escape would split JSON fields, so escape is the quote itself.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}


@dataclass
class Tables:
    """The journey tables. ``user_orders`` is the order history used for user rollups."""

    sessions: DataFrame
    events: DataFrame
    orders: DataFrame
    users: DataFrame | None = None
    user_orders: DataFrame | None = None

    def register_views(self, prefix: str = "") -> None:
        """Expose every table as a temp view for ``spark.sql``."""
        for f in fields(self):
            df = getattr(self, f.name)
            if df is not None:
                df.createOrReplaceTempView(prefix + f.name)


def read_csv(spark: SparkSession, path: str, schema, mode: str = "FAILFAST") -> DataFrame:
    """Header CSV with a declared schema (no inference pass), columns bound by header name.

    The header gives the order; a declared column that it lacks is an error,
    further columns are left out, and a file whose header differs from the
    first one's fails (``enforceSchema=false``).  A value that does not fit its
    type fails the job, unless ``mode="PERMISSIVE"`` asks for NULLs.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    missing = [n for n in declared if n not in header]
    if missing:
        raise ValueError(f"columns {missing} not in the header of {path}: {header}")
    read = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in header])
    df = spark.read.schema(read).options(**CSV_OPTIONS, enforceSchema="false", mode=mode).csv(path)
    return df.select(*declared)


def load_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> Tables:
    """S3: load sessions/events/orders/users from ``base/<name>.<fmt>``.

    A missing path raises ``AnalysisException`` at load time; only a missing
    users table is fine (the rollups alone need it), an unreadable one is not.
    """

    def one(name):
        path = f"{base}/{name}.{fmt}"
        if fmt == "csv":
            return read_csv(spark, path, schemas.BY_NAME[name])
        return spark.read.parquet(path)

    try:
        users = one("users")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        users = None
    return Tables(sessions=one("sessions"), events=one("events"), orders=one("orders"), users=users)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Table sink; partition events by date so date filters prune files."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink with the same quoting as the reader."""
    df.write.mode("overwrite").options(header="true", escape='"', quote='"').csv(path)


def dataset_summary(t: Tables) -> DataFrame:
    """Table sizes and orders per session in one row.

    Each count is a scalar subquery (partial count per task, one final row).
    """
    n_sessions = t.sessions.agg(F.count(F.lit(1))).scalar()
    n_events = t.events.agg(F.count(F.lit(1))).scalar()
    n_users = t.users.agg(F.count(F.lit(1))).scalar() if t.users is not None else F.lit(None).cast("long")
    n_orders = t.orders.agg(F.count(F.lit(1)).alias("n_orders"))
    return n_orders.select(
        n_sessions.alias("n_sessions"),
        n_events.alias("n_events"),
        n_users.alias("n_users"),
        F.col("n_orders"),
    ).withColumn(
        "conversion_rate", F.try_divide(F.col("n_orders").cast("double"), F.col("n_sessions").cast("double"))
    )
