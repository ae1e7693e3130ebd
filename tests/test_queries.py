import pytest
from oracle import same

from corpusmill.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(QUERIES) <= set(__spark_entry__.queries())
