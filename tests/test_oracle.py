"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from ledgerline.plans import registry
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(KEYS) == set(registry.oracles()) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, key, SF_SMALL, con)
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
    assert res["types_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["utm_source", "utm_campaign"]
