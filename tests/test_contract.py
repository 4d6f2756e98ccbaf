"""Every registered query against its SQL twin in another engine."""

import pytest

import __spark_entry__ as contract
from compare import compare, engine


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    connection = engine(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.REGISTERED))
def test_query_agrees_with_its_twin(spark, other_engine, sf_dir, name):
    assert compare(spark, other_engine, name, sf_dir) == ""


def test_every_query_has_a_twin():
    assert set(contract.REGISTERED) == set(contract.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_scores_the_smallest_inputs(spark):
    rows = contract.entry(spark)
    assert rows.count() > 0
    assert "is_outlier_any_mad" in rows.columns
