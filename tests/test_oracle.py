"""Every registered query against its SQL twin, schema and values exactly."""

import pytest

from depotflow import registry
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"
TWINS = registry.oracle_sql()
BUILD = registry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_matches_sql_twin(spark, duck, name):
    text = difference(spark, duck, name, BUILD[name], TWINS[name], FOLDER)
    assert text is None, text


def test_queries_without_twin_return_rows(spark):
    for name in sorted(set(BUILD) - set(TWINS)):
        assert BUILD[name](spark, FOLDER).count() > 0, name
