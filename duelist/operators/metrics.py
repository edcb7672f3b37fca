"""Quality metrics of scored rows, per any set of keys.

One grouped pass turns rows into *cells*: counts per (keys, score). Everything
else is computed from cells, so rows are shuffled only after map-side counting.

AUC needs, for each score, the number of negatives below it. A window over a
whole group would put that group in one task, so the running sum has two levels:
inside a score bucket first, giving a few moments per bucket, then over the
buckets of a group (some ten thousand rows). The bucket totals come from the
same rows as the inner sums, so the plan is one chain without a self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import quote
from duelist.functions.scores import logit_bucket
from duelist.functions.stats import ratio

COUNTS = ["positives", "negatives", "tp", "fp", "invalid"]


def usable(label: str, prediction: str, score: str | None = None) -> str:
    """Whether a row counts for the metrics (SQL text, never NULL)."""
    ok = f"{label} IN (0, 1) AND {prediction} IN (0, 1)"
    if score is not None:
        ok += f" AND {score} IS NOT NULL AND NOT isnan({score})"
    return f"coalesce({ok}, false)"


def _count_columns(label: str, prediction: str, score: str | None) -> list[Column]:
    ok = usable(label, prediction, score)
    conditions = {
        "positives": f"{ok} AND {label} = 1",
        "negatives": f"{ok} AND {label} = 0",
        "tp": f"{ok} AND {label} = 1 AND {prediction} = 1",
        "fp": f"{ok} AND {label} = 0 AND {prediction} = 1",
        "invalid": f"NOT {ok}",
    }
    return [F.expr(f"count_if({conditions[c]}) AS {c}") for c in COUNTS]


def _sums() -> list[Column]:
    return [F.expr(f"sum({c}) AS {c}") for c in COUNTS]


def group_counts(df: DataFrame, group: str = "ab_group", names: list[str] | None = None) -> DataFrame:
    """Rows per group. With ``names``, one row whose absent groups count as 0."""
    if names is None:
        return df.groupBy(group).agg(F.count("*").alias("sample_size"))
    return df.agg(*[F.expr(f"count_if({group} = {quote(n)}) AS {n}_count") for n in names])


def confusion(df: DataFrame, keys: list[str], label: str, prediction: str = "prediction") -> DataFrame:
    """Confusion counts per key set in one aggregation; rows without a usable label or
    prediction are counted as ``invalid``."""
    return _with_n(df.groupBy(*keys).agg(*_count_columns(label, prediction, None)))


def _with_n(counts: DataFrame) -> DataFrame:
    return counts.selectExpr(
        "*", "positives + negatives + invalid AS sample_size", "positives - tp AS fn", "negatives - fp AS tn"
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Adds accuracy, F1 of the positive class and label-weighted F1 to confusion counts."""
    both = counts.selectExpr(
        "*",
        f"{ratio('tp + tn', 'positives + negatives')} AS accuracy",
        f"{ratio('2 * tp', 'positives + tp + fp')} AS f1_positive",
        f"{ratio('2 * tn', 'negatives + tn + fn')} AS _f1_negative",
    )
    weighted = "positives * coalesce(f1_positive, 0D) + negatives * coalesce(_f1_negative, 0D)"
    return both.selectExpr("*", f"{ratio(weighted, 'positives + negatives')} AS f1_weighted").drop("_f1_negative")


def score_value(score: str, bins: int | None = None) -> str:
    """The score as a double, or rounded down to one of ``bins`` equal steps (SQL text)."""
    value = f"cast({score} AS double)"
    return value if bins is None else f"floor({value} * {bins}) / {bins}D"


def score_cells(
    df: DataFrame,
    keys: list[str],
    label: str,
    score: str = "score",
    prediction: str = "prediction",
    bins: int | None = None,
) -> DataFrame:
    """Counts per (keys, score). Cells add up, so cells of parts can be stored and merged.

    ``bins`` rounds scores down to that many equal steps of [0, 1]: fewer cells,
    approximate AUC (``tied_pairs`` bounds the error). By default AUC is exact.
    """
    return df.groupBy(*keys, F.expr(f"{score_value(score, bins)} AS score")).agg(*_count_columns(label, prediction, score))


def merge_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds up cells, for instance of several increments or of finer keys."""
    return cells.groupBy(*keys, "score").agg(*_sums())


def metrics_from_cells(cells: DataFrame, keys: list[str], bucket: str | None = None) -> DataFrame:
    """AUC with its DeLong (1988) standard error, confusion counts and rates, per key set.

    ``tied_pairs`` is the share of (positive, negative) pairs with equal scores. If cells were
    made with ``bins``, the exact AUC lies within half of it.

    ``bucket`` is SQL text of any expression that never decreases with ``score``; it
    decides how the work is spread, not the result. Default: ``logit_bucket``.
    """
    part = ", ".join(keys)
    inner = f"OVER (PARTITION BY {', '.join(['_bucket', *keys])} ORDER BY score ROWS UNBOUNDED PRECEDING)"
    outer = (
        f"OVER ({f'PARTITION BY {part} ' if keys else ''}ORDER BY _bucket "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    # _x, _y: mid-rank counts of the other class at or below a score, inside the bucket.
    ranked = cells.withColumn("_bucket", F.expr(bucket or logit_bucket("score"))).selectExpr(
        "*",
        f"sum(negatives) {inner} - negatives / 2D AS _x",
        f"sum(positives) {inner} - positives / 2D AS _y",
    )
    per_bucket = ranked.groupBy(*keys, "_bucket").agg(
        *_sums(),
        F.expr("sum(positives * _x) AS _sx"),
        F.expr("sum(positives * _x * _x) AS _sxx"),
        F.expr("sum(negatives * _y) AS _sy"),
        F.expr("sum(negatives * _y * _y) AS _syy"),
        F.expr("sum(cast(positives AS double) * negatives) AS _tied"),
    )
    # _ln, _lp: negatives and positives in all lower buckets; they shift the inner counts.
    shifted = per_bucket.selectExpr(
        "*",
        f"cast(coalesce(sum(negatives) {outer}, 0) AS double) AS _ln",
        f"cast(coalesce(sum(positives) {outer}, 0) AS double) AS _lp",
    )
    sums = shifted.groupBy(*keys).agg(
        *[F.expr(f"coalesce(sum({c}), 0) AS {c}") for c in COUNTS],
        F.expr("sum(_sx + positives * _ln) AS _sx"),
        F.expr("sum(_sxx + 2 * _ln * _sx + positives * _ln * _ln) AS _sxx"),
        F.expr("sum(_sy + negatives * _lp) AS _sy"),
        F.expr("sum(_syy + 2 * _lp * _sy + negatives * _lp * _lp) AS _syy"),
        F.expr("sum(_tied) AS _tied"),
    )
    spread = with_rates(_with_n(sums)).selectExpr(
        "*",
        f"{_variance('_sx', '_sxx', count='positives', scale='negatives')} AS _var_positive",
        f"{_variance('_sy', '_syy', count='negatives', scale='positives')} AS _var_negative",
    )
    return spread.selectExpr(
        *keys, "sample_size", *COUNTS, "tn", "fn",
        "try_divide(_sx, cast(positives AS double) * negatives) AS auc",
        f"sqrt({ratio('_var_positive', 'positives')} + {ratio('_var_negative', 'negatives')}) AS auc_se",
        "try_divide(_tied, cast(positives AS double) * negatives) AS tied_pairs",
        "accuracy", "f1_positive", "f1_weighted",
    )


def _variance(total: str, squares: str, count: str, scale: str) -> str:
    """Sample variance of value/scale from weighted sums; NULL below two rows.

    Differences lost in rounding count as zero variance.
    """
    norm = f"(cast({scale} AS double) * {scale})"
    mean_square = f"try_divide({squares}, {norm})"
    square_of_sum = f"try_divide({total} * {total}, {norm} * {count})"
    spread = f"if({mean_square} - {square_of_sum} > 1e-12D * {mean_square}, {mean_square} - {square_of_sum}, 0D)"
    return f"if({scale} > 0 AND {count} > 1, try_divide({spread}, {count} - 1D), NULL)"


def group_metrics(
    df: DataFrame,
    keys: list[str],
    label: str,
    score: str = "score",
    prediction: str = "prediction",
    bins: int | None = None,
    bucket: str | None = None,
) -> DataFrame:
    """All metrics per key set from one pass over the scored rows."""
    return metrics_from_cells(score_cells(df, keys, label, score, prediction, bins), keys, bucket)
