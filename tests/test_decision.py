"""Branches, edges and documents of the decision."""

from __future__ import annotations

import json

import pytest

from duelist.operators import decision
from duelist.plans import fixtures

METRICS = ("ab_group string, sample_size bigint, invalid bigint, auc double, auc_se double, accuracy double, "
           "f1_weighted double, f1_positive double, positives bigint, negatives bigint, tp bigint, tn bigint")


def decide(spark, champion_auc, challenger_auc, n1=100, n2=100, invalid=0, **options):
    rows = [(g, n, invalid, auc, 0.01, 0.5, 0.5, 0.5, 10, n - 10, 5, 5)
            for g, n, auc in (("champion", n1, champion_auc), ("challenger", n2, challenger_auc)) if n]
    return decision.report_from_metrics(spark.createDataFrame(rows, METRICS), **options).first()


@pytest.mark.parametrize(
    ("champion", "challenger", "n1", "n2", "winner", "promote", "message", "hold"),
    [
        (0.5, 0.75, 100, 100, "challenger", True, "Challenger better by 0.2500 AUC (statistically significant)", None),
        (0.5, 0.51, 100, 100, "challenger", False, "Challenger better by 0.0100 AUC (not statistically significant)", "gain not above threshold"),
        (0.5, 0.75, 950, 50, "challenger", False, "Challenger better by 0.2500 AUC (not statistically significant)", "unbalanced groups"),
        (0.75, 0.5, 100, 100, "champion", False, "Champion better by 0.2500 AUC", None),
        (0.5, 0.5, 100, 100, "champion", False, "Champion better by 0.0000 AUC", None),
        # a tenth exactly is not balanced
        (0.5, 0.75, 900, 100, "challenger", False, "Challenger better by 0.2500 AUC (not statistically significant)", "unbalanced groups"),
    ],
)
def test_branches(spark, champion, challenger, n1, n2, winner, promote, message, hold):
    row = decide(spark, champion, challenger, n1, n2)
    assert (row["status"], row["winner"], row["should_promote"]) == ("ok", winner, promote)
    assert (row["improvement_message"], row["hold_reason"]) == (message, hold)


def test_gain_equal_to_threshold_is_not_promoted(spark):
    row = decide(spark, 0.5, 0.75, threshold=0.25)
    assert row["winner"] == "challenger" and not row["should_promote"]


def test_undefined_and_failed(spark):
    assert decide(spark, None, 0.9)["reason"] == "a group has one class only"
    assert decide(spark, 0.9, None)["status"] == "undefined"
    missing = decide(spark, 0.5, 0.9, n2=0)
    assert (missing["status"], missing["reason"], missing["challenger_sample_size"]) == ("undefined", "a group has no rows", 0)
    bad = decide(spark, 0.5, 0.9, invalid=1)
    assert (bad["status"], bad["should_promote"], bad["winner"]) == ("failed", False, None)


def test_empty_input_gives_a_failure_record(spark):
    empty = spark.createDataFrame([], "y int, ab_group string, score double, prediction double")
    report = decision.ab_report(empty, "y")
    row = report.first()
    assert (row["status"], row["reason"], row["is_balanced"]) == ("failed", "no rows", False)
    assert decision.failures(report).count() == 1


def test_gate(spark):
    report = decision.report_from_metrics(
        spark.createDataFrame([(g, 100, 0, a, 0.01, 0.5, 0.5, 0.5, 10, 90, 5, 5) for g, a in (("champion", 0.5), ("challenger", 0.9))], METRICS)
    )
    assert [decision.promotion_gate(report, auto).first()["promotion_status"] for auto in (True, False)] == ["success", "not_promoted"]


def test_document(spark, sf_dir):
    report = decision.ab_report(fixtures.scored_transactions(spark, sf_dir), "tx_fraud").selectExpr("*", "'2001-08-01' AS timestamp")
    doc = json.loads(decision.document_json(report).first()["document"])
    assert set(doc) >= {"timestamp", "test_name", "traffic_split", "champion_metrics", "challenger_metrics", "improvements",
                        "statistical_significance", "winner", "should_promote", "improvement_message", "confidence_threshold"}
    assert set(doc["champion_metrics"]) == {"auc", "accuracy", "f1", "sample_size"}
    assert doc["reason"] is None  # kept, not left out
    assert decision.metrics_long(report, []).count() == 11
    assert decision.params_long(report, []).count() == 8


def test_message_rounding(spark):
    for x, text in ((0.03125, "0.0313"), (0.00005, "0.0001"), (-0.25, "0.2500"), (0.0, "0.0000"), (0.99999, "1.0000")):
        assert spark.sql(f"SELECT {decision.four_places(f'{x}D')} AS t").first()["t"] == text
