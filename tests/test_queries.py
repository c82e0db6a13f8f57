"""Every registered query against its reference SQL on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from rolebook.compare import connect, differences
from rolebook.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    problems = [p for p in differences(queries()[name](spark, FOLDER), duck, oracle_sql()[name]) if p != "no rows"]
    assert not problems, "\n".join(problems)
