"""Metrics from counts made before the only shuffle: equal to the plain ones, and to all pairs."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from test_metrics import brute, close

from duelist.operators import combine, metrics

SCHEMA = "g string, y int, score double, prediction double, extra string"


def made(rng, n):
    """A third on one score, ties, both zeros, infinities, and rows that cannot be used."""
    rows = []
    for k in range(n):
        score = 0.25 if k % 3 == 0 else rng.choice([rng.random(), round(rng.random(), 1), rng.gauss(0, 50), 0.0, -0.0, float("inf")])
        rows.append((rng.choice(["a", "a", "b", None]), int(rng.random() < 0.4), score, float(score > 0.5), "x" * (k % 5)))
    return rows + [("a", None, 0.3, 1.0, ""), ("a", 1, None, 1.0, ""), ("b", 0, float("nan"), 0.0, ""), ("b", 2, 0.3, 0.0, None), ("b", 1, 0.3, None, "")]


def table(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


@pytest.mark.parametrize("limit", [1, 7, 100, 10**6])
@pytest.mark.parametrize("keys", [["g"], [], ["g", "extra"]])
def test_equal_to_group_metrics(spark, limit, keys):
    df = spark.createDataFrame(made(random.Random(4), 900), SCHEMA).repartition(5)
    want, got = table(metrics.group_metrics(df, keys, "y"), *keys), table(combine.combined_metrics(df, keys, "y", combine_rows=limit), *keys)
    assert want.keys() == got.keys()
    for key, row in want.items():
        for name, value in row.items():
            same = close(value, got[key][name]) if isinstance(value, float) else value == got[key][name]
            assert same, (key, name, value, got[key][name])


def test_equal_to_all_pairs(spark):
    rows = [r for r in made(random.Random(9), 400) if r[0] == "a" and r[1] in (0, 1) and r[2] is not None]
    got = combine.combined_metrics(spark.createDataFrame(rows, SCHEMA), ["g"], "y", combine_rows=20).first()
    auc, se = brute([(r[1], r[2]) for r in rows])
    assert close(got["auc"], auc) and close(got["auc_se"], se)


def test_bins_and_own_bucket(spark):
    df = spark.createDataFrame(made(random.Random(5), 300), SCHEMA).filter("score BETWEEN 0 AND 1")
    for options in ({"bins": 10}, {"bucket": "0"}, {"bucket": "cast(floor(score * 8) AS int)"}):
        a, b = metrics.group_metrics(df, [], "y", **options).first(), combine.combined_metrics(df, [], "y", **options).first()
        assert close(a["auc"], b["auc"]) and a["invalid"] == b["invalid"] and close(a["tied_pairs"], b["tied_pairs"])


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert combine.combined_metrics(df, ["g"], "y").count() == 0
    assert combine.combined_metrics(df, [], "y").first().asDict() == metrics.group_metrics(df, [], "y").first().asDict()


def test_rows_are_shuffled_once(spark):
    """One exchange below the running sums; the others carry bucket and group totals only."""
    df = spark.range(1000).selectExpr("cast(id % 3 AS string) AS g", "cast(id % 2 AS int) AS y", "id / 1000 AS score", "1D AS prediction")

    def below_the_first_window(made_from):
        plan = made_from(df, ["g"], "y")._jdf.queryExecution().executedPlan().toString()
        return plan[plan.rindex("Window") :].count("Exchange")

    assert below_the_first_window(combine.combined_metrics) == 1
    assert below_the_first_window(metrics.group_metrics) == 2


def test_a_hot_score_is_counted_in_one_cell(spark):
    df = spark.range(0, 60_000, 1, 4).selectExpr("'a' AS g", "cast(id % 2 AS int) AS y", "if(id % 3 = 0, 0.5D, id / 60000D) AS score", "1D AS prediction")
    cells = combine.combined_cells(df, ["g"], "y")
    hot = cells.filter("score = 0.5").first()
    assert hot["positives"] + hot["negatives"] == 20_000 and cells.count() == 40_001


def test_a_hot_score_leaves_a_task_once_per_limit():
    """100 batches, half of the rows on one score: 50,000 others under a limit of 10,000 cells."""
    batches = [pa.record_batch({"_k0": ["a"] * 1000, "_score": [0.5 if i % 2 else b + 1 + i / 1000 for i in range(1000)], "_code": [1] * 1000})
               for b in range(100)]
    out = pa.Table.from_batches(combine._counting(["_k0", "_score", "_code"], 10_000)(iter(batches)))
    hot = out.filter(pa.compute.equal(out["_score"], 0.5))
    assert sum(hot["_n"].to_pylist()) == 50_000 and hot.num_rows <= 10 and sum(out["_n"].to_pylist()) == 100_000
