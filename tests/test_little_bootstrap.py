"""Little bootstraps: weights, and the spread against the row bootstrap and DeLong's formula."""

from __future__ import annotations

import math

import numpy as np
import pytest

from duelist.operators import bootstrap, metrics
from duelist.operators.little_bootstrap import little_bootstrap, poisson_steps, summarise_bags, uniforms
from duelist.plans import fixtures


@pytest.fixture(scope="module")
def scored(spark):
    return fixtures.scored_transactions(spark, "/root/testdata/sf0.01").cache()


@pytest.mark.parametrize("mean", [1.0, 8.0, 300.0, 1e6])
def test_weights_are_poisson(mean):
    rng = np.random.default_rng(1)
    low, steps = poisson_steps(mean)
    h1, h2 = (rng.integers(0, 1 << 32, 20_000, dtype=np.uint64) for _ in range(2))
    draws = np.stack([low + np.searchsorted(steps, uniforms(h1, h2, r), side="right") for r in range(1, 21)])
    assert draws.mean() == pytest.approx(mean, rel=0.01) and draws.var() == pytest.approx(mean, rel=0.03)
    between = np.corrcoef(draws)
    assert np.abs(between[np.triu_indices(20, 1)]).max() < 0.05


def test_spread_is_that_of_the_row_bootstrap(scored):
    rows = {r["series"]: r for r in bootstrap.summarise(bootstrap.bootstrap_auc(scored, "tx_id", "tx_fraud", 1000, exact=True)).collect()}
    values = little_bootstrap(scored, "tx_id", "tx_fraud", 400, bags=6).cache()
    little = {r["series"]: r for r in summarise_bags(values).collect()}
    exact = {r["ab_group"]: r for r in metrics.group_metrics(scored, ["ab_group"], "tx_fraud").collect()}
    for name in ("champion", "challenger", "gain"):
        assert little[name]["bags"] == 6 and little[name]["replicates"] == 2400
        assert little[name]["sd"] == pytest.approx(rows[name]["sd"], rel=0.05)
        assert little[name]["mean"] == pytest.approx(rows[name]["mean"], abs=0.002)
        assert little[name]["high"] - little[name]["low"] == pytest.approx(rows[name]["high"] - rows[name]["low"], rel=0.1)
    for name, row in exact.items():
        assert little[name]["sd"] == pytest.approx(row["auc_se"], rel=0.06)
    accuracy = {r["series"]: r for r in summarise_bags(values, "accuracy").collect()}
    for name, row in exact.items():
        a = row["accuracy"]
        assert accuracy[name]["sd"] == pytest.approx(math.sqrt(a * (1 - a) / row["sample_size"]), rel=0.06)


def test_repeatable_and_independent_of_layout(scored):
    first = little_bootstrap(scored, "tx_id", "tx_fraud", 3, bags=4)
    second = little_bootstrap(scored.repartition(7, "score"), "tx_id", "tx_fraud", 3, bags=4)
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect())) and first.count() == 4 * 3 * 2


def test_one_key_with_a_third_of_the_rows_fills_no_bag(scored, spark):
    hot = scored.selectExpr("if(tx_id % 3 = 0, 1, tx_id) AS k", "ab_group", "tx_fraud", "score", "prediction")
    bags = little_bootstrap(hot, "k", "tx_fraud", 1, bags=10)
    assert bags.select("bag").distinct().count() == 10
    assert all(r["auc"] is not None for r in bags.collect())


def test_edge_input(spark, scored):
    assert little_bootstrap(scored.limit(0), "tx_id", "tx_fraud", 2).count() == 0
    odd = scored.limit(100).selectExpr("tx_id", "if(tx_id % 2 = 0, NULL, 1) AS tx_fraud", "score", "prediction", "ab_group", "1 AS bag", "2 AS side", "3 AS h1")
    rows = little_bootstrap(odd, "tx_id", "tx_fraud", 2).collect()
    assert rows and all(r["auc"] is None and r["accuracy"] is not None for r in rows)
    summary = summarise_bags(little_bootstrap(odd, "tx_id", "tx_fraud", 2)).collect()
    assert all(r["sd"] is None and r["share_positive"] is None for r in summary)
