"""Two scores of the same rows: the difference of their AUCs and how sure it is.

Both models can score one holdout. Their AUCs are then correlated, which makes a much sharper test than two
separate groups: the variance of the difference is that of DeLong, DeLong and Clarke-Pearson (1988), with the
covariance of the two scores' placements.

Rows become *cells* first: counts per (keys, first score, second score), made on the map side. The placement of
a score (how many rows of the other class lie below, ties half) comes from running sums on two levels, inside
score buckets and over bucket totals, so no task holds a group and no pairs of rows are formed. Each cell then
looks up its two placements by score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.scores import logit_bucket
from duelist.functions.stats import Z_95, ratio, two_sided_p
from duelist.operators.sampling import _join_null_safe


def paired_cells(df: DataFrame, keys: list[str], label: str, first: str, second: str) -> DataFrame:
    """Counts per (keys, ``_a``, ``_b``). Rows without a usable label or one of the scores are one cell of NULLs.
    Cells add up, so cells of parts can be merged."""
    scores = [f"cast({c} AS double)" for c in (first, second)]
    ok = "coalesce(" + " AND ".join([f"{label} IN (0, 1)", *(f"{s} IS NOT NULL AND NOT isnan({s})" for s in scores)]) + ", false)"
    rows = df.selectExpr(*keys, *(f"if({ok}, {s}, NULL) AS {n}" for s, n in zip(scores, ("_a", "_b"))), f"if({ok}, {label}, NULL) AS _y")
    return rows.groupBy(*keys, "_a", "_b").agg(
        F.expr("count_if(_y = 1) AS _p"), F.expr("count_if(_y = 0) AS _n"), F.expr("count_if(_y IS NULL) AS _invalid"))


def _placements(cells: DataFrame, keys: list[str], side: str, bucket: str | None) -> DataFrame:
    """Per (keys, score): ``_x``, negatives below the score, and ``_y``, positives below it, ties half."""
    by = [*keys, "_bucket"]
    inner = f"OVER (PARTITION BY {', '.join(by)} ORDER BY {side} ROWS UNBOUNDED PRECEDING)"
    outer = f"OVER ({f'PARTITION BY {chr(44).join(keys)} ' if keys else ''}ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    scores = cells.filter(f"{side} IS NOT NULL").groupBy(*keys, side).agg(F.expr("sum(_p) AS _p"), F.expr("sum(_n) AS _n")).selectExpr(
        "*", f"{bucket or logit_bucket(side)} AS _bucket")
    inside = scores.selectExpr(*by, side, f"sum(_n) {inner} - _n / 2D AS _in", f"sum(_p) {inner} - _p / 2D AS _ip")
    before = scores.groupBy(*by).agg(F.expr("sum(_p) AS _p"), F.expr("sum(_n) AS _n")).selectExpr(
        *by, f"cast(coalesce(sum(_n) {outer}, 0) AS double) AS _on", f"cast(coalesce(sum(_p) {outer}, 0) AS double) AS _op")
    return _join_null_safe(inside, before, by).selectExpr(*keys, side, f"_in + _on AS _x{side}", f"_ip + _op AS _y{side}")


def _look_up(cells: DataFrame, places: DataFrame, keys: list[str], side: str) -> DataFrame:
    other = places.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, side]})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys] + [F.col(side) == F.col(f"_right_{side}")]
    return cells.join(other, on, "left").drop(*(f"_right_{k}" for k in [*keys, side]))


def _covariance(v: str, w: str, count: str, scale: str) -> str:
    """Sample covariance of two placements as shares of ``scale`` rows; NULL below two rows."""
    name = "".join(sorted((v, w)))
    mean_product = f"try_divide(_s{name}, cast({scale} AS double) * {scale})"
    product = f"try_divide(_s{v}, cast({scale} AS double)) * try_divide(_s{w}, cast({scale} AS double))"
    return f"if({count} > 1, try_divide({mean_product} - try_divide({product}, {count}), {count} - 1D), NULL)"


def paired_auc(df: DataFrame, keys: list[str], label: str, first: str, second: str, z_limit: float = Z_95,
               bucket: tuple[str, str] | None = None) -> DataFrame:
    """One row per key set: both AUCs with standard errors, their covariance, the gain of ``second`` over ``first``
    with z and p value.

    A row without a usable label or without one of the two scores counts as ``invalid`` and for nothing else.
    Undefined values (one class only; variance: fewer than two rows of a class) are NULL and never significant;
    so is z where both scores order the rows alike. NULL keys are a key set like others. An empty table gives
    no row with keys and one row of zeros without. ``bucket``, SQL text over ``_a`` and over ``_b`` that never
    decreases, decides how the work is spread, not the result.
    """
    cells = paired_cells(df, keys, label, first, second)
    placed = cells
    for k, side in enumerate(("_a", "_b")):
        placed = _look_up(placed, _placements(cells, keys, side, bucket[k] if bucket else None), keys, side)
    sums = placed.groupBy(*keys).agg(
        *(F.expr(f"coalesce(sum({c}), 0) AS {out}") for c, out in (("_p", "positives"), ("_n", "negatives"), ("_invalid", "invalid"))),
        *(F.expr(f"sum({weight} * {v}) AS _s{v}") for weight, v in (("_p", "_x_a"), ("_p", "_x_b"), ("_n", "_y_a"), ("_n", "_y_b"))),
        *(F.expr(f"sum({weight} * {v} * {w}) AS _s{v}{w}") for weight, x in (("_p", "_x"), ("_n", "_y"))
          for v, w in ((f"{x}_a", f"{x}_a"), (f"{x}_b", f"{x}_b"), (f"{x}_a", f"{x}_b"))),
    )

    def variance(a: str, b: str) -> str:
        of_positives = _covariance(f"_x{a}", f"_x{b}", "positives", "negatives")
        of_negatives = _covariance(f"_y{a}", f"_y{b}", "negatives", "positives")
        return f"{ratio(of_positives, 'positives')} + {ratio(of_negatives, 'negatives')}"

    auc = {s: f"try_divide(_s_x{s}, cast(positives AS double) * negatives)" for s in ("_a", "_b")}
    tested = sums.selectExpr(
        *keys, "positives", "negatives", "invalid", f"{auc['_a']} AS first_auc", f"{auc['_b']} AS second_auc",
        f"{variance('_a', '_a')} AS _va", f"{variance('_b', '_b')} AS _vb", f"{variance('_a', '_b')} AS auc_covariance",
    ).selectExpr("*", "_va + _vb - 2 * auc_covariance AS _v").selectExpr(
        *keys, "positives", "negatives", "invalid", "first_auc", "second_auc",
        "sqrt(greatest(_va, 0D)) AS first_auc_se", "sqrt(greatest(_vb, 0D)) AS second_auc_se", "auc_covariance",
        "second_auc - first_auc AS auc_gain",
        # what is left of equal terms by rounding is no variance
        "if(_v > 1e-12D * (_va + _vb), (second_auc - first_auc) / sqrt(_v), NULL) AS paired_z")
    return tested.selectExpr(
        "*", f"{two_sided_p('paired_z')} AS paired_p_value", f"coalesce(abs(paired_z) > {z_limit!r}D, false) AS paired_significant")
