"""SQL-text building blocks for wide projections.

A projection with dozens of fields built from ``F.*`` calls costs one
driver→JVM round trip per call; the same projection written as SQL text is
parsed in the JVM in one call.  These helpers quote names and literals for
such text (used with ``F.expr`` / ``selectExpr``).
"""

from __future__ import annotations


def lit(v) -> str:
    """SQL literal: strings escaped, floats as DOUBLE (a bare ``1.0`` would be DECIMAL)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"{v!r}D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def div(a: str, b: str) -> str:
    """``a / b`` in DOUBLE, NULL when ``b`` is 0 or NULL."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def pct_sql(a: str, b: str, scale: int = 2) -> str:
    """``ROUND(a * 100 / NULLIF(b, 0), scale)`` in DOUBLE."""
    return f"round(try_divide(CAST({a} AS DOUBLE) * 100.0D, CAST({b} AS DOUBLE)), {scale})"


def named_struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{lit(k)}, {v}" for k, v in fields.items()) + ")"


def array(items: list[str]) -> str:
    return "array(" + ", ".join(items) + ")"


def in_list(values) -> str:
    return ", ".join(lit(v) for v in values)
