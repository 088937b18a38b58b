import compare
import pagewright.plans.fixed  # noqa: F401  (adds its queries)
import pytest
from pagewright.plans.oracles import ORACLES
from pagewright.plans.queries import QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    assert not compare.difference(QUERIES[name](spark, DIR), con, ORACLES[name])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 50
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
