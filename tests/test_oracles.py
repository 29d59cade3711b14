"""Every registered query against its DuckDB statement, over whole tables."""

import oracle
import pytest

from segmentry.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_oracle(spark, con, name):
    problem, rows = oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert problem is None
    assert rows > 0 or name.startswith(("correlation_drop_list", "imputed_drop"))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
