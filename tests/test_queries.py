"""Every registered query against its check SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from turnloom.plans.catalog import QUERIES
from tests.compare import difference, duck, rows_of_duck, rows_of_spark

SF = "/root/testdata/sf0.001"
# Learned vocabularies and what they encode: compared with a trainer library and the codec in test_vocab and test_wordcoding.
NO_SQL = {"bpe_vocab", "bpe_compression", "bpe_pretrain_arrays"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_query(spark, con, name):
    query, sql = QUERIES[name]
    assert difference(rows_of_spark(query(spark, SF)), rows_of_duck(con, sql)) is None


def test_all_others_have_sql():
    assert {name for name, (_query, sql) in QUERIES.items() if not sql} == NO_SQL


def test_contract_lists_them():
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
