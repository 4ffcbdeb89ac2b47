import pytest
from checks.compare import connect, difference
from checks.oracle import ORACLES

import __spark_entry__ as entry_module
from linksieve.operators.features import FEATURE_NAMES
from linksieve.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, name, sf_dir) is None


def test_contract(spark):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    assert QUERIES.keys() <= queries.keys() and set(sql) <= set(queries)
    assert set(ORACLES) == set(QUERIES)
    out = entry_module.entry(spark)
    assert out.columns == ["page_id", "canonical_url", *FEATURE_NAMES]
    assert out.count() == 50
