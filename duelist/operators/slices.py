"""Metrics per segment, to find factors with a systematic error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.stats import two_proportion_z, two_sided_p
from duelist.operators.metrics import COUNTS, metrics_from_cells, score_cells

ALL = "(all)"
FALSE_DISCOVERY_RATE = 0.05
QUOTED = "'{0}'"


def slice_metrics(scored: DataFrame, label: str, factors: list[str], group: str = "ab_group",
                  bins: int | None = None) -> DataFrame:
    """Metrics per group, factor and segment of the factor, one factor at a time, and per group
    (factor and segment ``(all)``).

    The rows are counted once at the finest level; grouping sets expand those cells, not rows.
    """
    cells = score_cells(scored, [group, *factors], label, bins=bins)

    def named(value: str) -> str:
        whens = " ".join(f"WHEN grouping({f}) = 0 THEN {value.format(f)}" for f in factors)
        return f"CASE {whens} ELSE '{ALL}' END"

    sets = [[group, f, "score"] for f in factors] + [[group, "score"]]
    rolled = cells.groupingSets(sets, group, *factors, "score").agg(
        F.expr(f"{named(QUOTED)} AS _factor"),
        F.expr(f"{named('cast({0} AS string)')} AS _segment"),
        *[F.expr(f"sum({c}) AS {c}") for c in COUNTS],
    )
    named_cells = rolled.selectExpr(group, "_factor AS factor", "_segment AS segment", "score", *COUNTS)
    return metrics_from_cells(named_cells, [group, "factor", "segment"])


def slice_bias(metrics: DataFrame, group: str = "ab_group", rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """Accuracy of each segment against the rest of its group.

    ``q_value`` is the p value corrected for the number of segments of the group (Benjamini and Hochberg): of the
    segments called ``biased`` at most ``rate`` are expected to be noise. Works on metric rows, one per segment;
    the group's own row is read by a window, so the metrics are computed once, and a NULL group stays.
    """
    whole = lambda value: f"max(if(factor = '{ALL}', {value}, NULL)) OVER (PARTITION BY {group})"
    with_totals = metrics.selectExpr(
        "*", f"{whole('positives + negatives')} AS _all_n", f"{whole('tp + tn')} AS _all_hits", f"{whole('accuracy')} AS group_accuracy"
    )
    z = two_proportion_z("tp + tn", "positives + negatives", "_all_hits - tp - tn", "_all_n - positives - negatives")
    return (
        with_totals.filter(f"factor <> '{ALL}'")
        .selectExpr("*", "accuracy - group_accuracy AS accuracy_gap", f"{z} AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value")
        .selectExpr(
            "*", f"p_value * count(p_value) OVER (PARTITION BY {group}) / "
                 f"nullif(count(p_value) OVER (PARTITION BY {group} ORDER BY p_value), 0) AS _scaled")
        .selectExpr("*", f"if(p_value IS NULL, NULL, least(1D, min(_scaled) OVER (PARTITION BY {group} ORDER BY p_value DESC))) AS q_value")
        .selectExpr("*", f"coalesce(q_value <= {rate!r}D, false) AS biased")
        .drop("_all_n", "_all_hits", "_scaled")
    )
