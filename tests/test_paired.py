"""The paired test equals its definition over all pairs of rows."""

from __future__ import annotations

import numpy as np
import pytest

from duelist.functions.hashing import hash_sql
from duelist.operators import paired


def by_pairs(y, a, b):
    """Means, variances and covariance of the placements, every positive against every negative."""
    p, n = y == 1, y == 0
    psi = [((s[p][:, None] > s[n][None, :]) + 0.5 * (s[p][:, None] == s[n][None, :])) for s in (a, b)]
    over_p, over_n = np.cov([m.mean(axis=1) for m in psi]), np.cov([m.mean(axis=0) for m in psi])
    return [m.mean() for m in psi], over_p / p.sum() + over_n / n.sum()


@pytest.mark.parametrize("step", [2, 20, 100000])
def test_equal_to_all_pairs(spark, step):
    rng = np.random.default_rng(step)
    rows = []
    for group, n in (("x", 300), ("y", 120), (None, 60)):
        y = rng.integers(0, 2, n)
        common = rng.normal(size=n)
        a, b = (np.floor((common + rng.normal(size=n) + k * y) * step) / step for k in (0.5, 1.0))
        rows += [(group, int(u), float(v), float(w)) for u, v, w in zip(y, a, b)]
    df = spark.createDataFrame(rows, "g string, y int, a double, b double").repartition(5)
    for r in paired.paired_auc(df, ["g"], "y", "a", "b").collect():
        mine = np.array([row[1:] for row in rows if row[0] == r["g"]])
        (auc_a, auc_b), cov = by_pairs(*mine.T)
        z = (auc_b - auc_a) / np.sqrt(cov[0, 0] + cov[1, 1] - 2 * cov[0, 1])
        got = [r[c] for c in ("first_auc", "second_auc", "first_auc_se", "second_auc_se", "auc_covariance", "paired_z")]
        assert got == pytest.approx([auc_a, auc_b, np.sqrt(cov[0, 0]), np.sqrt(cov[1, 1]), cov[0, 1], z], rel=1e-9)
        assert r["positives"] + r["negatives"] == len(mine) and r["invalid"] == 0


def test_models_without_a_difference_are_called_one_in_twenty(spark):
    """200 tests of two equally good models on the same 400 rows each."""
    u = {s: hash_sql("id", f"'{s}'", "xxhash64") for s in ("y", "common", "a", "b")}
    df = spark.range(80000).selectExpr("id % 200 AS t", f"int({u['y']} < 0.4D) AS y", *(
        f"{u['common']} + {u[s]} + 0.3D * int({u['y']} < 0.4D) AS {s}" for s in "ab"))
    called = paired.paired_auc(df, ["t"], "y", "a", "b").filter("paired_significant").count()
    assert 2 <= called <= 20


def test_sharper_than_two_groups(spark):
    u = {s: hash_sql("id", f"'{s}'", "xxhash64") for s in ("y", "common", "a")}
    df = spark.range(4000).selectExpr(f"int({u['y']} < 0.4D) AS y", f"{u['common']} + 0.3D * int({u['y']} < 0.4D) AS a").selectExpr(
        "y", "a", "a + 0.05D * y AS b")
    r = paired.paired_auc(df, [], "y", "a", "b").first()
    alone = r["auc_gain"] / (r["first_auc_se"] ** 2 + r["second_auc_se"] ** 2) ** 0.5
    assert r["paired_significant"] and r["paired_z"] > 5 * alone


def test_undefined_and_unusable_rows(spark):
    rows = [(1, 0.5, 0.5), (0, 0.5, 0.5), (1, 0.7, 0.7), (0, 0.2, 0.2), (None, 0.1, 0.1), (1, None, 0.4), (0, 0.4, float("nan")), (2, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    r = paired.paired_auc(df, [], "y", "a", "b").first()
    assert (r["positives"], r["negatives"], r["invalid"]) == (2, 2, 4)
    assert r["first_auc"] == r["second_auc"] == 0.875 and r["paired_z"] is None and not r["paired_significant"]
    one = paired.paired_auc(df.filter("y = 1"), [], "y", "a", "b").first()
    assert one["first_auc"] is None and one["paired_p_value"] is None and one["positives"] == 2
    empty = paired.paired_auc(df.limit(0), [], "y", "a", "b").collect()
    assert len(empty) == 1 and empty[0]["positives"] == 0 and empty[0]["auc_gain"] is None
    assert paired.paired_auc(df.limit(0), ["y"], "y", "a", "b").count() == 0


def test_a_third_of_the_rows_on_one_score(spark):
    """Tied rows are one cell before the shuffle, and no window holds a group."""
    df = spark.range(30000).selectExpr("int(pmod(hash(id), 2)) AS y", "if(id % 3 = 0, 0.5D, rand(1)) AS a", "if(id % 3 = 0, 0.5D, rand(2)) AS b")
    assert paired.paired_cells(df, [], "y", "a", "b").count() < 20010
    plan = paired.paired_auc(df.withColumn("g", df.y), ["g"], "y", "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
