"""Every registered query against its DuckDB oracle on sf0.001 (the driver repeats this at sf0.01)."""

import pytest

from acoustispark.plans import registry
from tools.oracle_check import compare, duck

from .conftest import SF

REG = registry()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    fn, sql = REG[name]
    r = compare(spark, con, name, fn, sql, SF)
    assert "error" not in r, r
    if sql is not None:
        assert r["cols_ok"], r
        assert r["rows"] == r["oracle_rows"], r
        assert r["hash_ok"], r
