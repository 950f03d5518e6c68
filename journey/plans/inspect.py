"""Plan checks through the public ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """The physical plan section of ``explain('extended')``."""
    text = plan_text(df, "extended")
    return text.split("== Physical Plan ==", 1)[-1]


def exchanges(df: DataFrame) -> list[str]:
    """One line per Exchange in the (initial, pre-AQE) physical plan."""
    return [ln.strip() for ln in physical_plan(df).splitlines() if re.search(r"\bExchange\b", ln)]


def scans(df: DataFrame, table: str | None = None) -> list[str]:
    lines = [ln.strip() for ln in physical_plan(df).splitlines() if "FileScan" in ln or "Scan parquet" in ln]
    return [ln for ln in lines if table is None or f"/{table}." in ln or f"/{table}/" in ln]


def python_udfs(df: DataFrame) -> list[str]:
    """Operators that run Python code per row or batch (should be empty)."""
    pat = re.compile(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas")
    return [ln.strip() for ln in physical_plan(df).splitlines() if pat.search(ln)]


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))
