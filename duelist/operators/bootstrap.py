"""Distribution of the metrics by a Poisson bootstrap.

By default the rows themselves are drawn, at any size: every usable row is repeated for the replicates inside
its task and summed there, so rows are never shuffled. With ``units`` the rows are first counted per hash bucket of
the key and only these counts are repeated: an approximation whose replicates cost the same for any number of rows.
Rows without a usable label or prediction are left out, as in the metrics.
Weights come from a hash of (group, unit, replicate): runs repeat exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.functions.hashing import hash_sql, poisson_sql, quote
from duelist.functions.stats import ratio
from duelist.operators.decision import CHALLENGER, CHAMPION
from duelist.operators.metrics import COUNTS, metrics_from_cells, score_cells, usable

UNIT_SALT, WEIGHT_SALT = "unit", "weight"


def _unit(key: str, units: int | None) -> str:
    return key if units is None else f"cast(floor({hash_sql(key, quote(UNIT_SALT))} * {units}) AS bigint)"


def _replicated(units: DataFrame, group: str, replicates: int) -> DataFrame:
    """Units times replicates with a Poisson(1) weight. Rows of weight 0 stay: they keep a group without any drawn
    row in the result, and the partial aggregation that follows absorbs them."""
    return (
        units.selectExpr("*", f"explode(sequence(1, {replicates})) AS replicate")
        .selectExpr("*", f"{hash_sql([group, 'unit', 'replicate'], quote(WEIGHT_SALT))} AS _u")
        .selectExpr("*", f"{poisson_sql('_u')} AS weight")
        .drop("_u")
    )


#: Rows of the weight table up to which Spark may choose to broadcast it.
SMALL_WEIGHTS = 100_000


def _weights(spark: SparkSession, group: str, units: int, replicates: int) -> DataFrame:
    """Weights of all hash units: two groups times ``units`` times ``replicates`` rows,
    whatever the size of the data."""
    both = f"explode(array('{CHAMPION}', '{CHALLENGER}')) AS {group}"
    drawn = _replicated(spark.range(units).selectExpr("id AS unit", both), group, replicates).filter("weight > 0")
    # Spark's size estimate does not see the explode: without the hint a huge table would be broadcast
    return drawn if 2 * units * replicates <= SMALL_WEIGHTS else drawn.hint("merge")


def bootstrap_accuracy(
    scored: DataFrame, key: str, label: str, replicates: int = 100, units: int | None = None,
    group: str = "ab_group", prediction: str = "prediction",
) -> DataFrame:
    """Accuracy of every (replicate, group)."""
    rows = scored.filter(usable(label, prediction))
    if units is None:
        counts = rows.selectExpr(group, f"{key} AS unit", "1L AS rows", f"cast({label} = {prediction} AS bigint) AS hits")
    else:
        counts = rows.groupBy(group, F.expr(f"{_unit(key, units)} AS unit")).agg(
            F.expr("count(*) AS rows"), F.expr(f"count_if({label} = {prediction}) AS hits")
        )
    value = ratio("sum(weight * hits)", "sum(weight * rows)")
    return _replicated(counts, group, replicates).groupBy("replicate", group).agg(F.expr(f"{value} AS value"))


def bootstrap_auc(
    scored: DataFrame, key: str, label: str, replicates: int = 100, units: int | None = None,
    group: str = "ab_group", bins: int | None = None, exact: bool = False,
) -> DataFrame:
    """AUC of every (replicate, group).

    ``bins`` bounds the cells of a replicate. Without it every distinct score is a cell of every replicate,
    which ``exact=True`` asks for: right for scores of few values, very dear for continuous ones.
    """
    if bins is None and not exact:
        raise ValueError("set bins, or exact=True to keep every distinct score")
    with_unit = scored.selectExpr("*", f"{_unit(key, units)} AS unit")
    counts = score_cells(with_unit, [group, "unit"], label, bins=bins)
    if units is None:
        weighted = _replicated(counts, group, replicates)
    else:  # one hash per unit and replicate instead of one per cell and replicate
        weighted = counts.join(_weights(counts.sparkSession, group, units, replicates), [group, "unit"])
    cells = weighted.groupBy("replicate", group, "score").agg(*[F.expr(f"sum({c} * weight) AS {c}") for c in COUNTS])
    return metrics_from_cells(cells, ["replicate", group]).selectExpr("replicate", group, "auc AS value")


def summarise(values: DataFrame, group: str = "ab_group") -> DataFrame:
    """Mean, spread and 95 % interval of both groups and of the gain, one row each."""
    wide = values.groupBy("replicate").agg(
        *[F.expr(f"max(value) FILTER (WHERE {group} = '{g}') AS {g}") for g in (CHAMPION, CHALLENGER)]
    )
    series = wide.selectExpr(
        f"stack(3, '{CHAMPION}', {CHAMPION}, '{CHALLENGER}', {CHALLENGER}, 'gain', {CHALLENGER} - {CHAMPION}) "
        "AS (series, value)"
    )
    return series.groupBy("series").agg(
        F.expr("count(value) AS replicates"),
        F.expr("avg(value) AS mean"),
        F.expr("stddev_samp(value) AS sd"),
        F.expr("percentile(value, 0.025) AS low"),
        F.expr("percentile(value, 0.975) AS high"),
        F.expr(f"{ratio('count_if(value > 0)', 'count(value)')} AS share_positive"),
    )
