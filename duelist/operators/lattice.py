"""Hidden factors: conjunctions of conditions under which a model is wrong more often.

The search goes through the lattice of conjunctions level by level. Rows are counted once into cells (group, all factors);
a level is one grouped pass over the cells. A conjunction is looked at only if each of its parts (one condition
less) has at least ``min_share`` of the group's rows, so a level holds at most ``1 / min_share`` conjunctions for
each set of factors and group, whatever the data, and factors with many rare values cost nothing beyond the first level.

A conjunction counts as a factor of its own only if it differs from the rest of *every* one of its parts: what a
single condition explains is not reported again for each conjunction with it. p values are corrected for all
conjunctions tested in the group.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import quote
from duelist.functions.stats import ratio, two_proportion_z, two_sided_p
from duelist.operators.metrics import usable
from duelist.operators.slices import FALSE_DISCOVERY_RATE
from duelist.sources.session import staged

MIN_SHARE = 0.01


def factor_cells(scored: DataFrame, label: str, factors: list[str], group: str = "ab_group", prediction: str = "prediction") -> DataFrame:
    """Rows and correct predictions per group and values of all factors (as text; NULL is a value of its own)."""
    values = ", ".join(f"cast(`{f}` AS string)" for f in factors)
    return scored.filter(usable(label, prediction)).selectExpr(
        f"`{group}` AS side", f"array({values}) AS vals", f"cast({label} = {prediction} AS bigint) AS hit",
    ).groupBy("side", "vals").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))


def _level(cells: DataFrame, sets: list[tuple[int, ...]], parents: DataFrame | None, totals: DataFrame, min_share: float) -> DataFrame:
    """Counts of the conjunctions over the given factor sets that have enough rows; one grouped pass."""
    structs = ", ".join(
        f"struct(array({', '.join(map(str, s))}) AS fs, array({', '.join(f'vals[{i}]' for i in s)}) AS vs)" for s in sets)
    found = cells.selectExpr("side", "n", "hits", f"explode(array({structs})) AS c").selectExpr("side", "c.fs", "c.vs", "n", "hits")
    if parents is not None:
        for k in range(len(sets[0])):
            part = parents.selectExpr("side AS _side", "fs AS _fs", "vs AS _vs")
            on = (F.col("side").eqNullSafe(F.col("_side")) & (F.expr(f"filter(fs, (f, j) -> j <> {k})") == F.col("_fs"))
                  & (F.expr(f"filter(vs, (v, j) -> j <> {k})") == F.col("_vs")))
            found = found.join(part, on, "left_semi")
    summed = found.groupBy("side", "fs", "vs").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    whole = totals.selectExpr("side AS _side", "n AS all_n", "hits AS all_hits")
    return summed.join(whole, F.col("side").eqNullSafe(F.col("_side"))).filter(F.col("n") >= min_share * F.col("all_n")).drop("_side")


def error_lattice(scored: DataFrame, label: str, factors: list[str], group: str = "ab_group", prediction: str = "prediction",
                  min_share: float = MIN_SHARE, max_depth: int = 2, rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """One row per conjunction of up to ``max_depth`` conditions with enough rows: ``conditions`` (text), ``depth``, ``n``,
    ``accuracy``, ``accuracy_gap`` to the whole group, ``p_value`` (the largest against the rest of its parts; NULL if it is all of one
    of them, or if the rest is alike), ``q_value`` (Benjamini and Hochberg over the group) and ``biased``.

    Rows without a usable label or prediction are left out; a NULL factor value is a condition; an empty table gives no rows.
    """
    if not 0 < min_share <= 1 or max_depth < 1:
        raise ValueError("min_share must lie in (0, 1], max_depth must be at least 1")
    cells = staged(factor_cells(scored, label, factors, group, prediction), "lattice-cells")
    totals = staged(cells.groupBy("side").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), "lattice-totals")
    above = totals.selectExpr("side", "cast(array() AS array<int>) AS fs", "cast(array() AS array<string>) AS vs", "n", "hits")
    sets, parents, tested = [(i,) for i in range(len(factors))], None, []
    for depth in range(1, max_depth + 1):
        if not sets:
            break
        level = staged(_level(cells, sets, parents, totals, min_share), "lattice-level")
        tested.append(_against_parts(level, above, depth))
        parents = above = level.select("side", "fs", "vs", "n", "hits")
        # factor sets, not conjunctions: at most as many as there are combinations of factors
        live = {tuple(r["fs"]) for r in level.select("fs").distinct().collect()}
        joined = {tuple(sorted({*a, *b})) for a, b in combinations(sorted(live), 2) if len({*a, *b}) == depth + 1}
        sets = sorted(s for s in joined if all(p in live for p in combinations(s, depth)))
    if not tested:
        raise ValueError("no factors")
    every = tested[0]
    for more in tested[1:]:
        every = every.union(more)
    names = f"array({', '.join(quote(f) for f in factors)})"
    part = "PARTITION BY side"
    return (
        every.selectExpr(
            "*", f"{ratio('hits', 'n')} AS accuracy", f"{ratio('hits', 'n')} - {ratio('all_hits', 'all_n')} AS accuracy_gap",
            f"p_value * count(p_value) OVER ({part}) / nullif(count(p_value) OVER ({part} ORDER BY p_value), 0) AS _scaled")
        .selectExpr("*", f"if(p_value IS NULL, NULL, least(1D, min(_scaled) OVER ({part} ORDER BY p_value DESC))) AS q_value")
        .selectExpr(
            f"side AS `{group}`",
            f"array_join(zip_with(fs, vs, (f, v) -> concat({names}[f], '=', coalesce(v, '(null)'))), ' & ') AS conditions",
            "size(fs) AS depth", "n", "accuracy", "accuracy_gap", "p_value", "q_value", f"coalesce(q_value <= {rate!r}D, false) AS biased")
    )


def _against_parts(level: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """Adds the p value of a conjunction: the largest against what is left of each part without it."""
    rest = level.selectExpr("*", f"explode(sequence(0, {depth - 1})) AS k").selectExpr(
        "*", "filter(fs, (f, j) -> j <> k) AS part_fs", "filter(vs, (v, j) -> j <> k) AS part_vs")
    part = above.selectExpr("side AS _side", "fs AS _fs", "vs AS _vs", "n AS _n", "hits AS _hits")
    on = F.col("side").eqNullSafe(F.col("_side")) & (F.col("part_fs") == F.col("_fs")) & (F.col("part_vs") == F.col("_vs"))
    z = two_proportion_z("hits", "n", "_hits - hits", "_n - n")
    p = rest.join(part, on).selectExpr("side", "fs", "vs", "n", "hits", "all_n", "all_hits", f"{z} AS z").selectExpr("*", f"{two_sided_p('z')} AS p")
    return p.groupBy("side", "fs", "vs", "n", "hits", "all_n", "all_hits").agg(F.expr("if(count(p) = count(*), max(p), NULL) AS p_value"))
