"""Every query against its oracle, and the shape of every plan."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    columns = sorted(df.columns)
    ours = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert ours
    if name in entry.oracle_sql():
        theirs = db.execute(f'SELECT "{'", "'.join(columns)}" FROM ({entry.oracle_sql()[name]})').fetchall()
        assert ours == sorted(map(repr, theirs))


def test_entry(spark):
    assert entry.entry(spark).count() == 5
