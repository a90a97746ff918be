"""Every registered query against its DuckDB oracle (rows, columns, values) on sf0.001.

The driver runs the same comparison at sf0.01; ``tools/oracle_check.py`` runs it
at any scale from the command line.
"""

import pytest

import __spark_entry__ as E
from floe.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import duck, rows_of

registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(cols) > 0
        return
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert rows_of(cols, rows) == rows_of(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "lwe_fused" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
