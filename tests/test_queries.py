"""Every registered query against its SQL twin, over whole tables."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as registry
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
    assert set(QUERIES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert compare.difference(QUERIES[name](spark, SMALL), duck, ORACLE[name]) is None
