"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from quayside.plans.compare import duck, same
from quayside.plans.queries import QUERIES
from tests.conftest import SF_SMALL

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    ok, why = same(got, want)
    assert ok, why


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "row_op_ts" not in df.columns
