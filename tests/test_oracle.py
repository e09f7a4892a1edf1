"""Every registered query against its oracle SQL, on the smallest tables."""

import pytest

from acceptance.compare import compare, connect
from acceptance.oracles import BODIES, oracle_sql
from acceptance.queries import queries


@pytest.fixture(scope="module")
def duck(folder):
    connection = connect(folder)
    yield connection
    connection.close()


def test_every_oracle_has_a_query():
    assert set(BODIES) == set(queries())


@pytest.mark.parametrize("name", queries())
def test_query_matches_oracle(spark, folder, duck, name):
    assert compare(spark, duck, folder, name, oracle_sql()[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
