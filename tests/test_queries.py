import pytest

from tallyframe.plans import registry
from tests.oracle import same

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, sf_dir, name):
    assert same(spark, QUERIES[name], ORACLE[name], sf_dir) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1500
    assert set(QUERIES) <= set(__spark_entry__.queries())
