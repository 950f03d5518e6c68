"""SparkSession construction shared by tests, bench and the driver entry."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "journey") -> SparkSession:
    """Local session with the settings the operators assume.

    On a cluster the session is created by the platform; only the settings
    below that the operators rely on (UTC session time zone, AQE) matter.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "journey-warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share (``spark.checkpoint.dir``).

    It comes from the session configuration and is never overridden.  Only a
    local session, where driver and executors are one machine, may do
    without: it gets a scratch folder.  A cluster without the setting is
    refused, since other executors could not read what one of them writes.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="journey-ckpt-"))
    return sc.getCheckpointDir()


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path``, which must not exist yet, and return its scan.

    For derived tables that several queries read: the lineage is cut and the
    files survive lost executors.  The caller chooses, keeps and deletes the
    folder; the number of files follows from the data's partitions.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
