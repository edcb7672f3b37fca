"""From group metrics to a decision: deltas, balance, winner, promotion, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import quote
from duelist.functions.stats import ratio
from duelist.operators.metrics import group_metrics

# Group names, promotion threshold on the AUC gain, smallest share of a group.
CHAMPION, CHALLENGER = "champion", "challenger"
CONFIDENCE_THRESHOLD = 0.02
MIN_GROUP_SHARE = 0.1

_PIVOTED = ["auc", "auc_se", "accuracy", "f1_weighted", "f1_positive", "positives", "negatives", "tp", "tn"]


def compare_groups(metrics: DataFrame, keys: list[str] | None = None, group: str = "ab_group") -> DataFrame:
    """One row per key set with ``champion_*`` and ``challenger_*`` columns.

    A missing group has size 0 and NULL metrics; metrics that were not computed are left
    out. Without keys there is always a row, also for empty input.
    """
    aggs = []
    for name in (CHAMPION, CHALLENGER):
        for c in ("sample_size", "invalid", *_PIVOTED):
            if c in metrics.columns:
                value = f"max({c}) FILTER (WHERE {group} = '{name}')"
                value = f"coalesce({value}, 0L)" if c in ("sample_size", "invalid") else value
                aggs.append(F.expr(f"{value} AS {name}_{c}"))
    return metrics.groupBy(*(keys or [])).agg(*aggs)


def with_deltas(wide: DataFrame) -> DataFrame:
    """Challenger minus champion for AUC, accuracy and label-weighted F1."""
    return wide.selectExpr(
        "*",
        "challenger_auc - champion_auc AS auc_improvement",
        "challenger_accuracy - champion_accuracy AS accuracy_improvement",
        "challenger_f1_weighted - champion_f1_weighted AS f1_improvement",
    )


def four_places(x: str) -> str:
    """SQL text of a size with four decimals, halves rounded up in every engine."""
    return f"format_string('%.4f', floor(round(abs({x}), 9) * 10000D + 0.5D) / 10000D)"


def decide(deltas: DataFrame, threshold: float = CONFIDENCE_THRESHOLD, min_share: float = MIN_GROUP_SHARE,
           max_invalid_share: float = 0.0) -> DataFrame:
    """Winner, promotion and message, with the state of the test.

    Rows without a usable label, score or prediction are left out of the metrics and counted; a test with more than
    ``max_invalid_share`` of them fails, by default any.

    ``status`` is ``ok``, ``undefined`` (an AUC does not exist) or ``failed``, with a
    ``reason``; only ``ok`` tests have a winner. ``hold_reason`` names why a better
    challenger is not promoted.
    """
    n1, n2 = "champion_sample_size", "challenger_sample_size"
    gain = "auc_improvement"
    size = four_places(gain)
    return (
        deltas.selectExpr(
            "*",
            f"coalesce({ratio(f'least({n1}, {n2})', f'{n1} + {n2}')} > {min_share!r}D, false) AS is_balanced",
            f"""CASE WHEN {n1} + {n2} = 0 THEN 'no rows'
                     WHEN champion_invalid + challenger_invalid > {float(max_invalid_share)!r}D * ({n1} + {n2}) THEN 'label, score or prediction missing'
                     WHEN least({n1}, {n2}) = 0 THEN 'a group has no rows'
                     WHEN {gain} IS NULL THEN 'a group has one class only' END AS reason""",
            f"{float(threshold)!r}D AS confidence_threshold",
        )
        .selectExpr(
            "*",
            """CASE WHEN reason IS NULL THEN 'ok'
                    WHEN reason IN ('no rows', 'label, score or prediction missing') THEN 'failed'
                    ELSE 'undefined' END AS status""",
            f"coalesce(reason IS NULL AND {gain} > confidence_threshold AND is_balanced, false) AS should_promote",
            f"coalesce(reason IS NULL AND {gain} > 0, false) AS _better",
        )
        # Message texts.
        .selectExpr(
            "*",
            f"CASE WHEN _better THEN '{CHALLENGER}' WHEN reason IS NULL THEN '{CHAMPION}' END AS winner",
            f"""CASE WHEN should_promote THEN concat('Challenger better by ', {size}, ' AUC (statistically significant)')
                     WHEN _better THEN concat('Challenger better by ', {size}, ' AUC (not statistically significant)')
                     WHEN reason IS NULL THEN concat('Champion better by ', {size}, ' AUC') END AS improvement_message""",
            f"""CASE WHEN should_promote OR NOT _better THEN NULL
                     WHEN {gain} > confidence_threshold THEN 'unbalanced groups'
                     ELSE 'gain not above threshold' END AS hold_reason""",
        )
        .drop("_better")
    )


def ab_report(
    scored: DataFrame,
    label: str,
    keys: list[str] | None = None,
    test_name: str = "ab_test",
    traffic_split: float = 0.5,
    threshold: float = CONFIDENCE_THRESHOLD,
    min_share: float = MIN_GROUP_SHARE,
    group: str = "ab_group",
    bins: int | None = None,
    max_invalid_share: float = 0.0,
) -> DataFrame:
    """The whole evaluation of scored rows as one plan: one row per test."""
    metrics = group_metrics(scored, [*(keys or []), group], label, bins=bins)
    return report_from_metrics(metrics, keys, test_name, traffic_split, threshold, min_share, group, max_invalid_share)


def report_from_metrics(
    metrics: DataFrame,
    keys: list[str] | None = None,
    test_name: str = "ab_test",
    traffic_split: float = 0.5,
    threshold: float = CONFIDENCE_THRESHOLD,
    min_share: float = MIN_GROUP_SHARE,
    group: str = "ab_group",
    max_invalid_share: float = 0.0,
) -> DataFrame:
    decided = decide(with_deltas(compare_groups(metrics, keys, group)), threshold, min_share, max_invalid_share)
    return decided.selectExpr(
        "*", f"{quote(test_name)} AS test_name", f"{float(traffic_split)!r}D AS traffic_split"
    )


def failures(report: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The failure records: tests without a decision and why."""
    return report.filter(F.col("status") != "ok").select(*(keys or []), "test_name", "status", "reason")


def promotion_gate(report: DataFrame, auto_promote: bool) -> DataFrame:
    """Adds ``promote`` (won and allowed) and the intended ``promotion_status``; what the aliases allow is in
    ``registry.promotion_outcome``."""
    return report.selectExpr("*", f"should_promote AND {str(auto_promote).lower()} AS promote").selectExpr(
        "*", "if(promote, 'success', 'not_promoted') AS promotion_status"
    )


# Names of the logged metrics and parameters of a test, and the report columns they hold.
REPORT_METRICS = {
    "champion_auc": "champion_auc",
    "champion_accuracy": "champion_accuracy",
    "champion_f1": "champion_f1_weighted",
    "champion_sample_size": "champion_sample_size",
    "challenger_auc": "challenger_auc",
    "challenger_accuracy": "challenger_accuracy",
    "challenger_f1": "challenger_f1_weighted",
    "challenger_sample_size": "challenger_sample_size",
    "auc_improvement": "auc_improvement",
    "accuracy_improvement": "accuracy_improvement",
    "f1_improvement": "f1_improvement",
}
REPORT_PARAMS = {
    "ab_traffic_split": "traffic_split",
    "ab_test_timestamp": "timestamp",
    "ab_test_name": "test_name",
    "confidence_threshold": "confidence_threshold",
    "winner": "winner",
    "should_promote": "should_promote",
    "statistical_significance": "is_balanced",
    "improvement_message": "improvement_message",
}


def _long(report: DataFrame, keep: list[str], names: dict[str, str], value_type: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', cast({c} AS {value_type})" for n, c in names.items())
    return report.selectExpr(*keep, f"stack({len(names)}, {pairs}) AS (name, value)")


def metrics_long(report: DataFrame, keep: list[str]) -> DataFrame:
    """Eleven (name, value) rows per test."""
    return _long(report, keep, REPORT_METRICS, "double")


def params_long(report: DataFrame, keep: list[str]) -> DataFrame:
    """Eight (name, value) rows per test; needs a ``timestamp`` column."""
    return _long(report, keep, REPORT_PARAMS, "string")


def document(report: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Nested result record, one row per test; needs a ``timestamp`` column."""

    def side(name: str) -> str:
        return (
            f"struct({name}_auc AS auc, {name}_accuracy AS accuracy, {name}_f1_weighted AS f1, "
            f"{name}_sample_size AS sample_size) AS {name}_metrics"
        )

    return report.selectExpr(
        *(keep or []),
        "cast(timestamp AS string) AS timestamp",
        "test_name",
        "traffic_split",
        side(CHAMPION),
        side(CHALLENGER),
        "struct(auc_improvement AS auc, accuracy_improvement AS accuracy, f1_improvement AS f1) AS improvements",
        "is_balanced AS statistical_significance",
        "winner",
        "should_promote",
        "improvement_message",
        "confidence_threshold",
        "status",
        "reason",
        *(c for c in ("promotion_status",) if c in report.columns),
    )


def document_json(report: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The result record as JSON text, NULLs included."""
    doc = document(report, keep)
    fields = ", ".join(c for c in doc.columns if c not in (keep or []))
    return doc.selectExpr(*(keep or []), f"to_json(struct({fields}), map('ignoreNullFields', 'false')) AS document")
