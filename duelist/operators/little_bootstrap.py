"""Distribution of the metrics by a bag of little bootstraps.

Rows fall into disjoint hash bags. A bag stands for the whole table: each of its replicates draws as many rows as the table
has from the bag alone, which is a weight per row (Poisson with the number of bags as mean, that is multinomial given its
total, and totals cancel in the metrics). So a replicate costs one pass over a bag's sorted scores inside a task; no
row is repeated, none is replaced by a bucket, and the spread is that of the whole table's metric, not of a bag's. The spread
is worked out per bag and averaged over the bags.

Weights come from a hash of (key, replicate): runs repeat exactly. Rows that are alike in key, group, label, score and
prediction have one weight, and are counted before the bags are formed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import hash_sql, quote
from duelist.functions.stats import ratio
from duelist.operators.decision import CHALLENGER, CHAMPION
from duelist.operators.metrics import usable
from duelist.sources.session import importable

BAG_ROWS = 50_000
BAG_SALT, WEIGHT_SALT = "bag", "little"
_MASK = np.uint64(0xFFFFFFFF)


def poisson_steps(mean: float) -> tuple[int, list[float]]:
    """Lowest draw, and the cumulative probabilities above which a uniform draws one more; within 12 standard deviations."""
    low = max(0, int(mean - 12 * math.sqrt(mean) - 12))
    steps, total = [], 0.0
    for k in range(low, int(mean + 12 * math.sqrt(mean) + 30)):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        if total >= 1 - 2.0**-32:
            break
        steps.append(total)
    return low, steps


def uniforms(h1: np.ndarray, h2: np.ndarray, replicate: int) -> np.ndarray:
    """A uniform in [0, 1) per row and replicate from two 32-bit words of the row's hash."""
    x = (h1 + np.uint64(replicate) * (h2 | np.uint64(1))) & _MASK
    # fixed values: multipliers of a public 32-bit finalizer
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(0x85EBCA6B)) & _MASK
    x = ((x ^ (x >> np.uint64(13))) * np.uint64(0xC2B2AE35)) & _MASK
    return (x ^ (x >> np.uint64(16))).astype(np.float64) / 2.0**32


def _bag_values(replicates: int, mean: float):
    low, steps = poisson_steps(mean)
    edges = np.array(steps)

    def values(bag: pa.Table) -> pa.Table:
        number = bag.column("bag")[0].as_py()
        side = np.array(bag.column("side").to_pylist(), object)
        out = []
        for name in sorted(set(side.tolist())):
            mine = np.flatnonzero(side == name)
            column = {c: bag.column(c).to_numpy()[mine] for c in ("y", "score", "hit", "rows", "h1", "h2")}
            order = np.argsort(column["score"], kind="stable")
            column = {c: v[order] for c, v in column.items()}
            h1, h2 = column["h1"].astype(np.uint64), column["h2"].astype(np.uint64)
            starts = np.flatnonzero(np.concatenate(([True], column["score"][1:] != column["score"][:-1])))
            for r in range(1, replicates + 1):
                w = (low + np.searchsorted(edges, uniforms(h1, h2, r), side="right")) * column["rows"]
                p = np.add.reduceat(w * column["y"], starts).astype(np.float64)
                n = np.add.reduceat(w * (1 - column["y"]), starts).astype(np.float64)
                pairs, total = p.sum() * n.sum(), w.sum()
                auc = float((p * (np.cumsum(n) - n / 2)).sum() / pairs) if pairs else None
                out.append((number, r, name, auc, float((w * column["hit"]).sum() / total) if total else None))
        fields = [("bag", pa.int64()), ("replicate", pa.int32()), ("side", pa.string()), ("auc", pa.float64()), ("accuracy", pa.float64())]
        return pa.table({n: pa.array([row[i] for row in out], t) for i, (n, t) in enumerate(fields)})

    return values


def little_bootstrap(scored: DataFrame, key: str, label: str, replicates: int = 50, bags: int | None = None, group: str = "ab_group",
                     score: str = "score", prediction: str = "prediction") -> DataFrame:
    """``bag``, ``replicate``, ``ab_group`` (under its own name), ``auc`` and ``accuracy`` of every replicate of every bag.

    ``bags``: by default so many that a bag has about ``BAG_ROWS`` rows, which a task holds at once. A bag is chosen by
    everything that tells rows apart, so a key with many rows spreads over all bags. Rows without a usable label,
    prediction or score, or without a group, are left out; a metric that does not exist is NULL; no rows give no rows.
    """
    rows = scored.filter(usable(label, prediction, score)).filter(F.col(group).isNotNull())
    if bags is None:
        bags = max(1, -(-rows.count() // BAG_ROWS))
    text = f"md5(concat(coalesce(cast({key} AS string), 'null'), ':', {quote(WEIGHT_SALT)}))"
    step = f"cast(floor(greatest(-1e12D, least(1e12D, cast({score} AS double) * 1000000D))) AS bigint)"
    same = [key, group, f"cast({label} AS bigint)", f"cast({label} = {prediction} AS int)", step]
    counted = rows.selectExpr(
        f"cast(floor({hash_sql(same, quote(BAG_SALT))} * {bags}) AS bigint) AS bag", f"{group} AS side", f"cast({label} AS bigint) AS y",
        f"cast({score} AS double) AS score", f"cast({label} = {prediction} AS bigint) AS hit",
        *(f"cast(conv(substr({text}, {at}, 8), 16, 10) AS bigint) AS {h}" for at, h in ((1, "h1"), (9, "h2"))),
    ).groupBy("bag", "side", "y", "score", "hit", "h1", "h2").agg(F.count("*").alias("rows"))
    values = importable(counted).groupBy("bag").applyInArrow(
        _bag_values(replicates, float(bags)), "bag long, replicate int, side string, auc double, accuracy double")
    return values.withColumnRenamed("side", group)


def summarise_bags(values: DataFrame, metric: str = "auc", group: str = "ab_group") -> DataFrame:
    """Mean, spread and 95 % interval of both groups and of the gain: of each bag, then averaged over the bags."""
    wide = values.groupBy("bag", "replicate").agg(
        *[F.expr(f"max({metric}) FILTER (WHERE {group} = '{g}') AS {g}") for g in (CHAMPION, CHALLENGER)])
    series = wide.selectExpr(
        "bag", f"stack(3, '{CHAMPION}', {CHAMPION}, '{CHALLENGER}', {CHALLENGER}, 'gain', {CHALLENGER} - {CHAMPION}) AS (series, value)")
    per_bag = series.groupBy("series", "bag").agg(
        F.expr("count(value) AS replicates"), F.expr("avg(value) AS mean"), F.expr("stddev_samp(value) AS sd"),
        F.expr("percentile(value, 0.025) AS low"), F.expr("percentile(value, 0.975) AS high"),
        F.expr(f"{ratio('count_if(value > 0)', 'count(value)')} AS share_positive"))
    return per_bag.groupBy("series").agg(
        F.count("*").alias("bags"), F.sum("replicates").alias("replicates"),
        *[F.avg(c).alias(c) for c in ("mean", "sd", "low", "high", "share_positive")])
