"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: row count, column names and types, then values (columns sorted by name,
rows sorted, floats compared exactly after the 6-dp rounding both sides do).

    python tools/oracle_check.py [--sf DIR] [--tz ZONE] [--ansi on|off] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(round(v, 6) + 0.0))
    if hasattr(v, "item"):
        v = v.item()
    return (3, str(v))


def table(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} duck={dcols}")
    else:
        dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        for f in sdf.schema.fields:
            want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
            if dtypes.get(f.name) != want:
                problems.append(f"type {f.name}: spark={f.dataType.simpleString()} duck={dtypes.get(f.name)}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = table(srows, scols), table(drows, dcols)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    status = "OK " if not problems else "BAD"
    print(f"{status} {name:40s} rows={len(srows):6d} spark={t1 - t0:6.2f}s duck={t2 - t1:5.2f}s {'; '.join(problems)}",
          flush=True)
    return not problems


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--tz", default=None, help="session time zone to run Spark with")
    ap.add_argument("--ansi", choices=["on", "off"], default=None, help="spark.sql.ansi.enabled for the Spark side")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from journey.plans import ORACLE_SQL, QUERIES
    from journey.session import get_spark

    spark = get_spark(8)
    if a.tz:
        spark.conf.set("spark.sql.session.timeZone", a.tz)
    if a.ansi:
        spark.conf.set("spark.sql.ansi.enabled", "true" if a.ansi == "on" else "false")
    con = duck(a.sf)
    names = a.names or list(QUERIES)
    ok = 0
    for n in names:
        if n not in ORACLE_SQL:
            print(f"--- {n:40s} no oracle")
            continue
        try:
            ok += compare(spark, con, n, QUERIES[n], ORACLE_SQL[n], a.sf)
        except Exception as e:  # report and continue with the next query
            print(f"ERR {n:40s} {type(e).__name__}: {str(e)[:400]}", flush=True)
    print(f"{ok}/{len(names)} match")


if __name__ == "__main__":
    main()
