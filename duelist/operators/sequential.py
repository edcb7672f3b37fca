"""A test that may be looked at after every period.

A fixed 5 % test that is repeated every hour is wrong far more often than in 5 % of the tests. Here every look has a
mixture sequential probability ratio of the cumulated AUC gain: with a gain ``d`` of variance ``v`` and gains spread under
the alternative by ``tau``, it is ``sqrt(v / (v + tau^2)) * exp(d^2 tau^2 / (2 v (v + tau^2)))``. Under no difference
its chance of ever reaching ``1 / alpha`` is at most ``alpha``, however often one looks; so the smallest ``1 / ratio`` so far is
a p value that stays valid at every look.

The metrics of a look cover all periods up to it. They come from running sums of the periods' cells, one row per look, group
and score, so no row is counted twice and no period is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.operators.decision import CONFIDENCE_THRESHOLD, report_from_metrics
from duelist.operators.metrics import COUNTS, merge_cells, metrics_from_cells, score_cells

ALPHA = 0.05
#: Positives and negatives that each group must have before a look counts: the normal approximation needs some.
MIN_CLASS = 30


def cumulated_cells(cells: DataFrame, keys: list[str], period: str = "period_start", group: str = "ab_group") -> DataFrame:
    """Cells of every look: ``look`` numbers the periods of a key set from 1, and a cell holds the sum of all periods up to it.

    A sum is repeated from its own look to the one before the score's next cell, so the result has at most
    one row per look, group and score, without a join of looks and scores. Cells without a period are left out.
    """
    timed = merge_cells(cells.filter(F.col(period).isNotNull()), [*keys, period, group])
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    own = [f"_key{i}" for i in range(len(keys))]
    # one row per key set and period
    looks = timed.select(*keys, period).distinct().selectExpr(
        *[f"{k} AS {o}" for k, o in zip(keys, own)], f"{period} AS _period", f"row_number() OVER ({by}ORDER BY {period}) AS look",
        f"count(*) OVER ({by.strip()}) AS _looks")
    on = F.col(period) == F.col("_period")
    for k, o in zip(keys, own):
        on &= F.col(k).eqNullSafe(F.col(o))
    dated = timed.join(looks, on)
    over = f"OVER (PARTITION BY {', '.join([*keys, group, 'score'])} ORDER BY look)"
    summed = dated.selectExpr(
        *keys, group, "score", "look", "_looks", *[f"sum({c}) {over} AS {c}" for c in COUNTS], f"lead(look) {over} AS _next")
    return summed.selectExpr(*keys, group, "score", "explode(sequence(look, coalesce(_next - 1, _looks))) AS look", *COUNTS)


def with_sequential_p(report: DataFrame, keys: list[str] | None = None, alpha: float = ALPHA, tau: float = CONFIDENCE_THRESHOLD,
                      min_class: int = MIN_CLASS) -> DataFrame:
    """Adds ``log_ratio`` (NULL while a look does not count), ``sequential_p`` and ``sequentially_significant`` to report rows
    with a ``look``; ``promote_now`` is a promotion that the repeated looks allow."""
    variance = "(champion_auc_se * champion_auc_se + challenger_auc_se * challenger_auc_se)"
    enough = " AND ".join(f"least({g}_positives, {g}_negatives) >= {min_class}" for g in ("champion", "challenger"))
    t = f"{tau * tau!r}D"
    ratio = (f"0.5D * ln(try_divide({variance}, {variance} + {t})) + "
             f"try_divide(auc_improvement * auc_improvement * {t}, 2D * {variance} * ({variance} + {t}))")
    over = f"OVER ({f'PARTITION BY {", ".join(keys)} ' if keys else ''}ORDER BY look ROWS UNBOUNDED PRECEDING)"
    return (
        report.selectExpr("*", f"if({enough} AND {variance} > 0D, {ratio}, NULL) AS log_ratio")
        .selectExpr("*", f"coalesce(least(1D, exp(-greatest(0D, max(log_ratio) {over}))), 1D) AS sequential_p")
        .selectExpr("*", f"sequential_p <= {alpha!r}D AS sequentially_significant")
        .selectExpr("*", "should_promote AND sequentially_significant AS promote_now")
    )


def report_by_look(scored: DataFrame, label: str, keys: list[str] | None = None, period: str = "period_start", bins: int | None = None,
                   exact: bool = False, alpha: float = ALPHA, tau: float = CONFIDENCE_THRESHOLD, min_class: int = MIN_CLASS, **options) -> DataFrame:
    """The A/B report of every look over scored rows with a period: one row per key set and look.

    ``bins`` bounds the cells of a look; without it every distinct score is a cell of every look, which
    ``exact=True`` asks for. ``options`` are those of ``report_from_metrics``.
    """
    if bins is None and not exact:
        raise ValueError("set bins, or exact=True to keep every distinct score")
    own = keys or []
    return report_from_cells(score_cells(scored, [*own, period, "ab_group"], label, bins=bins), keys, period, alpha, tau, min_class, **options)


def report_from_cells(cells: DataFrame, keys: list[str] | None = None, period: str = "period_start", alpha: float = ALPHA,
                      tau: float = CONFIDENCE_THRESHOLD, min_class: int = MIN_CLASS, **options) -> DataFrame:
    """The same from stored cells, such as those of ``streaming.period_cells``."""
    own = [*(keys or []), "look"]
    metrics = metrics_from_cells(cumulated_cells(cells, keys or [], period), [*own, "ab_group"])
    return with_sequential_p(report_from_metrics(metrics, own, **options), keys, alpha, tau, min_class)
