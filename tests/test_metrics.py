"""Metrics against MLlib, brute force and their own laws."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from duelist.functions.scores import logit_bucket, score_splits, split_bucket
from duelist.operators import metrics
from duelist.plans import fixtures

SCHEMA = "g string, y int, score double, prediction double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(pairs):
    """AUC and DeLong standard error over all pairs."""
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None, None

    def wins(a, b):
        return 1.0 if a > b else 0.5 if a == b else 0.0

    v10 = [sum(wins(p, n) for n in neg) / len(neg) for p in pos]
    v01 = [sum(wins(p, n) for p in pos) / len(pos) for n in neg]
    auc = sum(v10) / len(pos)
    if len(pos) < 2 or len(neg) < 2:
        return auc, None
    var = [sum((v - sum(vs) / len(vs)) ** 2 for v in vs) / (len(vs) - 1) / len(vs) for vs in (v10, v01)]
    return auc, math.sqrt(sum(var))


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) < 1e-9)


def test_brute_force_many_groups(spark):
    """Small groups of all shapes: ties, one class, single rows, scores outside [0, 1]."""
    rng = random.Random(7)
    rows = []
    for g in range(120):
        kind = g % 4
        for _ in range(rng.randint(1, 25)):
            score = [rng.random(), round(rng.random(), 1), rng.gauss(0, 3), rng.random() * 1e-9][kind]
            rows.append((f"g{g}", int(rng.random() < 0.4), score, float(score > 0.5)))
    got = {r["g"]: r for r in metrics.group_metrics(frame(spark, rows), ["g"], "y").collect()}
    for g, part in itertools.groupby(rows, key=lambda r: r[0]):
        auc, se = brute([(r[1], r[2]) for r in part])
        assert close(got[g]["auc"], auc) and close(got[g]["auc_se"], se), g


@pytest.mark.parametrize("bucket", ["one", "logit", "splits"])
def test_bucket_does_not_change_result(spark, bucket):
    rng = random.Random(3)
    rows = [("a", int(rng.random() < 0.3), rng.betavariate(1, 30), 0.0) for _ in range(2000)]
    df = frame(spark, rows)
    text = {"one": "0", "logit": logit_bucket("score"), "splits": split_bucket("score", score_splits(df, "score", 32))}
    base = metrics.group_metrics(df, [], "y").first()
    other = metrics.group_metrics(df, [], "y", bucket=text[bucket]).first()
    assert close(base["auc"], other["auc"]) and close(base["auc_se"], other["auc_se"])


def test_logit_bucket_is_monotone(spark):
    scores = sorted([random.Random(1).random() for _ in range(3000)] + [0.0, 1.0, -5.0, 7.0, 1e-300, 1 - 2**-53, 5e-17])
    df = spark.createDataFrame([(s,) for s in scores], "score double").selectExpr("score", f"{logit_bucket('score')} b")
    buckets = [r["b"] for r in df.orderBy("score").collect()]
    assert buckets == sorted(buckets) and None not in buckets


def test_same_as_mllib(spark, sf_dir):
    scored = fixtures.scored_transactions(spark, sf_dir)
    for group in ("champion", "challenger"):
        part = scored.filter(f"ab_group = '{group}'")
        row = metrics.group_metrics(part, [], "tx_fraud").first()
        auc = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="score", numBins=0).evaluate(part)
        assert close(row["auc"], auc)
        for ours, theirs in (("accuracy", "accuracy"), ("f1_weighted", "f1")):
            value = MulticlassClassificationEvaluator(labelCol="tx_fraud", metricName=theirs).evaluate(part)
            assert close(row[ours], value)
        f1 = MulticlassClassificationEvaluator(labelCol="tx_fraud", metricName="fMeasureByLabel", metricLabel=1.0)
        assert close(row["f1_positive"], f1.evaluate(part))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=40))
def test_auc_laws(spark, data):
    """Unchanged by a monotone map of the score; turned into 1 - AUC by a sign change."""
    maps = {"raw": lambda s: s / 20, "cube": lambda s: (s / 20) ** 3, "negative": lambda s: -s / 20}
    rows = [(name, y, f(s), 0.0) for name, f in maps.items() for y, s in data]
    got = {r["g"]: r["auc"] for r in metrics.group_metrics(frame(spark, rows), ["g"], "y").collect()}
    assert close(got["raw"], got["cube"])
    assert close(got["raw"], None if got["negative"] is None else 1 - got["negative"])


def test_hot_score_and_hot_group(spark):
    """A third of all rows share one score; the result is that of the counted pairs."""
    df = spark.range(30000).selectExpr(
        "'g' AS g", "cast(id % 5 = 0 AS int) AS y",
        "if(id % 3 = 0, 0.25D, pmod(id * 7919, 10007) / 10007D) AS score", "0D AS prediction",
    )
    row = metrics.group_metrics(df, ["g"], "y").first()
    auc = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(df)
    assert close(row["auc"], auc) and row["sample_size"] == 30000


def test_invalid_rows_are_counted(spark):
    rows = [("a", 1, 0.9, 1.0), ("a", 0, 0.1, 0.0), ("a", None, 0.5, 1.0), ("a", 1, None, 1.0),
            ("a", 1, float("nan"), 1.0), ("a", 2, 0.5, 1.0), ("a", 1, 0.5, None)]
    row = metrics.group_metrics(frame(spark, rows), ["g"], "y").first()
    assert (row["sample_size"], row["invalid"], row["auc"], row["accuracy"]) == (7, 5, 1.0, 1.0)


def test_empty_and_one_class(spark):
    empty = metrics.group_metrics(frame(spark, []), ["g"], "y")
    assert empty.count() == 0
    whole = metrics.group_metrics(frame(spark, []), [], "y").first()
    assert whole["sample_size"] == 0 and whole["auc"] is None and whole["accuracy"] is None
    row = metrics.group_metrics(frame(spark, [("a", 1, 0.4, 1.0)]), ["g"], "y").first()
    assert row["auc"] is None and row["accuracy"] == 1.0


@pytest.mark.parametrize("bins", [10, 200])
def test_bins_keep_within_their_bound(spark, bins):
    rng = random.Random(11)
    rows = [("a", int(rng.random() < 0.3), rng.random(), 0.0) for _ in range(3000)]
    df = frame(spark, rows)
    exact, binned = (metrics.group_metrics(df, [], "y", bins=b).first() for b in (None, bins))
    assert exact["tied_pairs"] == 0 and abs(binned["tied_pairs"] - 1 / bins) < 0.01
    assert abs(exact["auc"] - binned["auc"]) <= binned["tied_pairs"] / 2


def test_cells_merge(spark, sf_dir):
    """Cells of parts add up to the cells of the whole."""
    scored = fixtures.scored_transactions(spark, sf_dir)
    parts = [metrics.score_cells(scored.filter(f"tx_id % 2 = {i}"), ["ab_group"], "tx_fraud") for i in (0, 1)]
    merged = metrics.metrics_from_cells(metrics.merge_cells(parts[0].unionByName(parts[1]), ["ab_group"]), ["ab_group"])
    whole = metrics.group_metrics(scored, ["ab_group"], "tx_fraud")
    assert sorted(merged.collect()) == sorted(whole.collect())


def test_raw_margins_spread_over_buckets(spark):
    from duelist.functions.scores import logit_bucket

    df = spark.range(10_000).selectExpr("cast(id - 5000 AS double) AS score")
    buckets = df.selectExpr("score", f"{logit_bucket('score')} AS b")
    assert buckets.select("b").distinct().count() > 2_000
    out_of_order = buckets.selectExpr("b", "lag(b) OVER (ORDER BY score) AS before").filter("b < before")
    assert out_of_order.count() == 0
