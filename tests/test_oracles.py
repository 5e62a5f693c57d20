"""Every registered query that has SQL gives the same rows in Spark and DuckDB."""

import pytest

from verification.compare import connection, differences
from verification.oracles import ORACLES
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connection(FOLDER)
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], duck) == []
