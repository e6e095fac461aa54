"""Every registered query with an SQL oracle matches DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import rows_of

from .conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows, 9) == rows_of(dcols, drows, 9)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["l_returnflag", "l_linestatus", "size", "share"]
