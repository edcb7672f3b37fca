"""Repeated looks: running cells, error over looks, and power."""

from __future__ import annotations

import math

import pytest

from duelist.functions.hashing import hash_sql
from duelist.operators import decision, sequential
from duelist.operators.metrics import group_metrics


def trials(spark, tests: int, rows: int, looks: int, gain: float = 0.0):
    """Both groups get the same noisy score, the challenger's with ``gain`` more of the label."""
    base = spark.range(tests * rows).selectExpr(f"id % {tests} AS test", "id", f"cast(id / {tests} as bigint) % {looks} AS period_start")
    return base.selectExpr(
        "test", "period_start", f"cast({hash_sql('id', repr('y'))} < 0.3 AS int) AS y",
        f"if({hash_sql('id', repr('g'))} < 0.5, 'challenger', 'champion') AS ab_group", f"{hash_sql('id', repr('s'))} AS noise",
    ).selectExpr("*", f"least(0.999D, (noise + (0.3D + if(ab_group = 'challenger', {gain}D, 0D)) * y) / 1.5D) AS score").selectExpr(
        "*", "cast(score > 0.5 AS double) AS prediction")


def test_looks_hold_all_periods_so_far(spark):
    scored = trials(spark, 2, 4000, 7).filter("NOT (test = 1 AND period_start IN (2, 3))")
    got = sequential.report_by_look(scored, "y", ["test"], bins=40)
    seen = {(r["test"], r["look"]): r for r in got.collect()}
    assert len(seen) == 7 + 5
    for test, periods in ((0, range(7)), (1, (0, 1, 4, 5, 6))):
        for look, last in enumerate(periods, 1):
            upto = scored.filter(f"test = {test} AND period_start <= {last}")
            want = decision.with_deltas(decision.compare_groups(group_metrics(upto, ["ab_group"], "y", bins=40))).first()
            mine = seen[test, look]
            assert (mine["champion_sample_size"], mine["challenger_sample_size"]) == (want["champion_sample_size"], want["challenger_sample_size"])
            assert mine["auc_improvement"] == pytest.approx(want["auc_improvement"], abs=1e-12)


def test_a_cell_is_repeated_once_a_look_at_most(spark):
    scored = trials(spark, 1, 5000, 20)
    cells = sequential.cumulated_cells(sequential.score_cells(scored, ["period_start", "ab_group"], "y", bins=30), [])
    assert cells.groupBy("look", "ab_group", "score").count().filter("count > 1").isEmpty()
    assert cells.count() <= 20 * 2 * 31
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_hundred_looks_at_no_difference(spark):
    """Of 200 tests without a difference, each looked at 100 times, at most one in twenty is ever called; a fixed
    5 % test at each look would call many more."""
    looks = sequential.report_by_look(trials(spark, 200, 6000, 100), "y", ["test"], bins=50).cache()
    z = "abs(auc_improvement) / sqrt(champion_auc_se * champion_auc_se + challenger_auc_se * challenger_auc_se)"
    last = looks.groupBy("test").agg({"sequentially_significant": "max"}).toDF("test", "called")
    fixed = looks.filter("log_ratio IS NOT NULL").selectExpr("test", f"{z} > 1.96 AS called").groupBy("test").agg({"called": "max"}).toDF("test", "called")
    rate, naive = (d.selectExpr("avg(cast(called AS int)) AS r").first()["r"] for d in (last, fixed))
    assert rate <= 0.05 and naive > 0.15
    assert looks.filter("sequential_p < 0 OR sequential_p > 1").isEmpty()
    # a p value never rises again
    again = looks.selectExpr("test", "look", "sequential_p - lag(sequential_p) OVER (PARTITION BY test ORDER BY look) AS step")
    assert again.filter("step > 0").isEmpty()


def test_a_difference_is_found_before_the_end(spark):
    looks = sequential.report_by_look(trials(spark, 20, 6000, 50, gain=0.3), "y", ["test"], bins=50)
    first = looks.filter("promote_now").groupBy("test").agg({"look": "min"}).toDF("test", "look")
    assert first.count() == 20 and first.agg({"look": "max"}).first()[0] < 50


def test_ratio_is_that_of_the_formula(spark):
    row = dict(look=1, auc_improvement=0.03, champion_auc_se=0.006, challenger_auc_se=0.008, should_promote=True,
               champion_positives=50, champion_negatives=50, challenger_positives=50, challenger_negatives=50)
    few = dict(row, look=2, champion_positives=29)
    out = sequential.with_sequential_p(spark.createDataFrame([row, few]), tau=0.02).orderBy("look").collect()
    v, t = 0.006**2 + 0.008**2, 0.02**2
    want = 0.5 * math.log(v / (v + t)) + 0.03**2 * t / (2 * v * (v + t))
    assert out[0]["log_ratio"] == pytest.approx(want) and out[1]["log_ratio"] is None
    assert out[0]["sequential_p"] == pytest.approx(min(1, math.exp(-want))) == out[1]["sequential_p"]


def test_empty_and_edge_input(spark):
    scored = trials(spark, 1, 100, 3)
    assert sequential.report_by_look(scored.limit(0), "y", bins=10).count() == 0
    assert sequential.report_by_look(scored.selectExpr("* EXCEPT (period_start)", "cast(NULL AS bigint) AS period_start"), "y", bins=10).count() == 0
    one = sequential.report_by_look(scored.filter("ab_group = 'champion'"), "y", exact=True).collect()
    assert [r["sequential_p"] for r in one] == [1.0] * 3 and not any(r["promote_now"] for r in one)
    with pytest.raises(ValueError):
        sequential.report_by_look(scored, "y")
