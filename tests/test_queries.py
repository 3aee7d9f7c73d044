"""Every registered query against its SQL twin, value by value."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import compare, connect
from checks.registry import REGISTRY

RUNS = {name: run for name, run in entry_point.queries().items() if name in REGISTRY}
TEXTS = {name: sql for name, sql in entry_point.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(RUNS))
def test_query_matches_sql(spark, duck, sf_dir, name):
    ok, note = compare(spark, duck, sf_dir, RUNS[name], TEXTS.get(name))
    assert ok, note


def test_every_query_has_sql():
    assert set(RUNS) == set(TEXTS)


def test_entry(spark):
    assert entry_point.entry(spark).columns[:2] == ["symbol", "sector"]
