"""Every registered query against its DuckDB oracle SQL at sf0.01 (rows, names, types, values)."""

from __future__ import annotations

import uuid

import pytest

from journey.plans import ORACLE_SQL, QUERIES
from tests.conftest import SF001
from tools.oracle_check import SPARK_TO_DUCK, duck, table


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def _check(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in con.execute(f"DESCRIBE {ORACLE_SQL[name]}").fetchall()}
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == dtypes[f.name], f.name
    assert len(srows) == len(drows)
    assert table(srows, sdf.columns) == table(drows, dcols)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    _check(spark, con, name)


def test_a_stored_sessions_table_gives_the_same(spark, con):
    from journey import operators as op
    from journey.plans import catalog
    from journey.session import ensure_checkpoint_dir, save_table
    from journey.sources.driver_tables import driver_tables

    t = driver_tables(spark, SF001)
    t.sessions = save_table(t.sessions, f"{ensure_checkpoint_dir(spark)}/sessions-{uuid.uuid4().hex}")
    got = catalog.rounded(op.segment_funnel(t.sessions, t.events, catalog.SPEC, catalog.DEVICE))
    want = QUERIES["q09_segment_funnel"](spark, SF001)
    assert table([tuple(r) for r in got.collect()], got.columns) == table([tuple(r) for r in want.collect()], want.columns)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 4
    assert df.columns[:3] == ["stage_idx", "stage_name", "stage_label"]
