import pytest
from oracle import connect, differences

from kartoteka.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, con, name):
    assert not differences(spark, con, FOLDER, registry.QUERIES[name], registry.ORACLES[name])


#: Queries that SQL cannot express; their own tests hold brute force against them.
WITHOUT_SQL = {"e01_weighted_match"}


def test_every_query_has_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == WITHOUT_SQL
