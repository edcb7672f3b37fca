"""Samples of exact size, from a hash, without a sort of the table."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from duelist.operators import sampling


def size(n, fraction):
    return int(n * fraction + 0.5)


@pytest.mark.parametrize("fraction", [0.0, 0.001, 1 / 3, 0.8, 1.0])
@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_exactly_so_many_rows_for_any_layout(tx, fraction, method):
    n = tx.count()
    rows = tx.select("tx_id", "tx_amount")
    taken, rest = sampling.exact_sample(rows, "tx_id", fraction, method=method)
    got = {r[0] for r in taken.select("tx_id").collect()}
    assert len(got) == size(n, fraction)
    assert got | {r[0] for r in rest.select("tx_id").collect()} == {r[0] for r in rows.select("tx_id").collect()} and rest.count() == n - len(got)
    again, _ = sampling.exact_sample(rows.repartition(7), "tx_id", fraction, method=method)
    assert {r[0] for r in again.select("tx_id").collect()} == got


def test_each_class_has_its_own_share(tx):
    marked = sampling.exact_split(tx.withColumn("class", F.expr("if(tx_id % 7 = 0, NULL, tx_fraud)")), "tx_id", 0.3, by=("class",))
    for r in marked.groupBy("class").agg(F.count("*").alias("n"), F.count_if("sampled").alias("k")).collect():
        assert r["k"] == size(r["n"], 0.3)


@pytest.mark.parametrize("hot", ["named_struct('k', 7L, 'v', 1L)", "named_struct('k', 7L, 'v', id)", "named_struct('k', cast(NULL AS bigint), 'v', id)"])
def test_a_key_with_a_third_of_the_rows(spark, hot):
    """Equal rows, rows with one key, and rows without one, where the sample ends inside them and where it does not."""
    df = spark.range(9000).selectExpr(f"if(id % 3 = 0, {hot}, named_struct('k', id + 100, 'v', id)) AS s").select("s.*")
    for tenths in range(1, 10):
        taken, rest = sampling.exact_sample(df, "k", tenths / 10)
        assert (taken.count(), rest.count()) == (900 * tenths, 9000 - 900 * tenths)
    both = taken.unionAll(rest).groupBy("k", "v").count()
    assert both.exceptAll(df.groupBy("k", "v").count()).count() == 0


def test_empty_tables_and_refusals(spark, tx):
    taken, rest = sampling.exact_sample(tx.limit(0), "tx_id", 0.5)
    assert taken.count() == rest.count() == 0 and taken.columns == tx.columns
    assert sampling.exact_split(tx.limit(0), "tx_id", 0.5, by=("tx_fraud",)).count() == 0
    for bad in (lambda: sampling.exact_split(tx, "tx_id", 1.5), lambda: sampling.exact_split(tx.withColumn("sampled", F.lit(1)), "tx_id", 0.5)):
        with pytest.raises(ValueError):
            bad()


def test_only_the_step_where_the_sample_ends_is_ordered(spark):
    df = spark.range(200000).selectExpr("id AS k")
    marked = sampling.exact_split(df, "k", 0.4)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Sort \[", plan) and "Window" in plan
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and all("_bucket" in w or "_run" in w for w in windows)
    below = marked.filter("NOT sampled").count()
    assert below == 120000


def test_positions_of_weighted_rows(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (3, 4), (4, 2)], "k int, w long")
    got = {r["k"]: r["position"] for r in sampling.with_position(df, "k", "k div 2", weight="w").collect()}
    assert got == {1: 0, 2: 3, 3: 4, 4: 8}
