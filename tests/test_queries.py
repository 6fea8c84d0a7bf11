"""Registered queries against their SQL at the smallest scale. ``python -m checks.compare`` runs them all."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
# Whole runs take a minute or more together; the comparison tool covers them at every scale.
LONG = {"frontier_closure", "frontier_accounting", "frontier_budget", "ingest_run", "ingest_house", "stream_ingest_run", "written_counts"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["host", "pages", "links", "distinct_links", "dedupe_ratio"]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LONG])
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLE[name]) == ""
