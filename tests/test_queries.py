import pytest

from fieldloom.plans import registry

from . import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.tables(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    oracle.compare(spark, con, sf_dir, registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
