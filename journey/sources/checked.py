"""S3: load journey tables next to a report of everything that does not fit.

Nothing stops the load: a missing table is empty, a missing column is NULL, a
row that does not parse is left out, and each is one row of the report
(table, file, problem, detail).  Headers are read per file, so files written by
different versions of an export (other column order, fewer or more columns)
bind by name each.
"""

from __future__ import annotations

import csv
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from journey.sources import schemas
from journey.sources.io import CSV_OPTIONS, Tables

REPORT = "table string, file string, problem string, detail string"
CORRUPT = "_corrupt_record"


def file_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The header fields of every CSV file below ``path``: one small row per file reaches the driver, which lists the files anyway."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("start")).filter("start = 0")
    first = lines.groupBy("file").agg(F.min("at").alias("at"))
    rows = lines.join(first, ["file", "at"]).select("file", "value").collect()
    return {r["file"]: next(csv.reader([r["value"].lstrip("﻿")]), []) for r in rows}


def checked_csv(spark: SparkSession, path: str, schema: T.StructType, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``schema``, report) of the CSV files at ``path``.

    All columns are parsed before a row counts as fitting, whatever a later
    query selects.  Files of one header are read together.
    """
    declared = {f.name: f for f in schema.fields}
    found: list[tuple] = []
    by_header: dict[tuple, list[str]] = defaultdict(list)
    try:
        headers = file_headers(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        headers = {}
        found.append((table, path, "missing table", None))
    for file, header in sorted(headers.items()):
        by_header[tuple(header)].append(file)
        found += [(table, file, "missing column", n) for n in declared if n not in header]
        found += [(table, file, "unknown column", n) for n in header if n not in declared]
    good, bad = [], []
    for header, files in by_header.items():
        names = [n if n in declared and header.index(n) == i else f"_unread{i}" for i, n in enumerate(header)]
        read = T.StructType([T.StructField(n, declared[n].dataType if n in declared else T.StringType()) for n in names])
        df = (spark.read.schema(T.StructType([*read.fields, T.StructField(CORRUPT, T.StringType())]))
              .options(**CSV_OPTIONS, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
              .csv(files))
        # only columns that are referenced get parsed, so all are, in a form that Spark does not fold
        other = F.xxhash64(*names) >= F.lit(-(1 << 63))
        fit = F.col(CORRUPT).isNull() & other
        good.append(df.filter(fit).select(*[
            F.col(n) if n in names else F.lit(None).cast(f.dataType).alias(n) for n, f in declared.items()]))
        bad.append(df.filter(F.col(CORRUPT).isNotNull() & other).select(F.lit(table).alias("table"), F.col("_metadata.file_path").alias("file"),
                                          F.lit("bad row").alias("problem"), F.col(CORRUPT).alias("detail")))
    rows, report = spark.createDataFrame([], schema_of(schema)), spark.createDataFrame(found, REPORT)
    for g in good:
        rows = rows.unionByName(g)
    for b in bad:
        report = report.unionByName(b)
    return rows, report


def schema_of(schema: T.StructType) -> T.StructType:
    """``schema`` with every column nullable: a file may lack any of them."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def checked_parquet(spark: SparkSession, path: str, schema: T.StructType, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows, report) of a Parquet table: columns that are missing are NULL; a column that cannot be cast is reported."""
    found: list[tuple] = []
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return (spark.createDataFrame([], schema_of(schema)),
                spark.createDataFrame([(table, path, "missing table", None)], REPORT))
    columns = []
    for f in schema.fields:
        if f.name not in df.columns:
            found.append((table, path, "missing column", f.name))
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[f.name].dataType == f.dataType:
            columns.append(F.col(f.name))
        else:
            found.append((table, path, "other type", f"{f.name}: {df.schema[f.name].dataType.simpleString()}"))
            columns.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    found += [(table, path, "unknown column", n) for n in df.columns if n not in schema.names]
    return df.select(*columns), spark.createDataFrame(found, REPORT)


def load_with_report(spark: SparkSession, base: str, fmt: str = "csv") -> tuple[Tables, DataFrame]:
    """The journey tables at ``base/<name>.<fmt>`` and the report over all of them."""
    read = checked_csv if fmt == "csv" else checked_parquet
    loaded = {n: read(spark, f"{base}/{n}.{fmt}", s, n) for n, s in schemas.BY_NAME.items()}
    report = spark.createDataFrame([], REPORT)
    for _, problems in loaded.values():
        report = report.unionByName(problems)
    return Tables(**{n: rows for n, (rows, _) in loaded.items()}), report
