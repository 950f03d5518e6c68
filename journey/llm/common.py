"""Helpers shared by the training-data operators: shared scratch tables, safe column names, Arrow plumbing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the folder that all executors share.

    The session's ``spark.checkpoint.dir`` names it.  Only a local session
    may do without (tests); a cluster without the setting is refused,
    because other executors could not read what one executor writes.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="journey-llm-")
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


#: Spark's setting by which an execution's shuffle files are removed when it ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new Parquet table in the shared folder and return its scan.

    Cuts the lineage: after a lost executor later stages reread the files.
    So the shuffle files of the write go when it ends; without the setting they
    would stay until the driver happens to collect garbage.
    """
    path = shared_dir(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], stem: str) -> str:
    """A column name that does not clash with ``columns`` (compared without case, as Spark does)."""
    taken, name = {c.lower() for c in columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def q(name: str) -> Column:
    """Column by exact name, also with dots or back-ticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def give_back() -> None:
    """Return freed memory to the system, so that an idle Python worker does not hold what its last task needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_rows(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` where ``fn(columns: dict[str, list]) -> dict[str, list]`` sees one bounded slice of a batch.

    Slices hold at most about ``SLICE_BYTES`` of Arrow data (one row at
    least), so a batch of very long texts never doubles in Python at once.
    """
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                got = fn({n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)
        give_back()

    return df.mapInArrow(run, schema)


SLICE_BYTES = 8 << 20
#: what a checked side of a join may hold to be broadcast
BROADCAST_BYTES = 8 << 20


def join_checked(df: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """Semi or anti join of ``df`` with the stored one-column table ``keys`` of strings.

    The keys are broadcast only if their measured size is at most
    ``BROADCAST_BYTES``; otherwise both sides are shuffled.  Rows are the same
    either way.
    """
    n, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(on)), F.lit(0))).first()
    return df.join(F.broadcast(keys) if size + 32 * n <= BROADCAST_BYTES else keys, on, how)


def broadcast_checked(df: DataFrame) -> DataFrame:
    """The stored table ``df``, to be broadcast only if its measured size is at most ``BROADCAST_BYTES``.

    Beyond that a join with it is Spark's own choice.  Rows are the same either way.
    """
    size = sum((F.coalesce(F.octet_length(q(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    held = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(df) if held <= BROADCAST_BYTES else df


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES):
    """Consecutive row ranges of ``batch`` of about ``limit`` bytes each."""
    if batch.num_rows == 0:
        return
    rows = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def type_of(ddl: str):
    return _parse_datatype_string(ddl)
