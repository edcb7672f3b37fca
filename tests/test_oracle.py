"""Every query against its SQL, on whole tables."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry_points

QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row["status"] == "ok" and row["winner"] == "challenger"


def test_fixture_values(spark):
    """Values of the smallest slice that were worked out beforehand, at sf0.01."""
    rows = {r["ab_group"]: r for r in QUERIES["auc_by_group"](spark, "/root/testdata/sf0.01").collect()}
    assert (rows["challenger"]["positives"], rows["challenger"]["auc"]) == (2487, 0.922642)
    assert (rows["champion"]["positives"], rows["champion"]["auc"]) == (2446, 0.749199)
