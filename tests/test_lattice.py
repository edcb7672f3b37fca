"""Search for conjunctions with a systematic error, against counting every combination."""

from __future__ import annotations

from itertools import combinations

import pytest

from duelist.functions.hashing import hash_sql
from duelist.operators import lattice

FACTORS = ["city", "device", "hour", "bank"]


def scored(spark, rows=40_000, error="0.1"):
    """Predictions that are wrong with the given probability (SQL over the factors)."""
    return spark.range(rows).selectExpr(
        "id", "if(id % 50 = 0, NULL, concat('c', id % 7)) AS city", "concat('d', pmod(xxhash64(id), 3)) AS device",
        "cast(pmod(xxhash64(id, 1), 5) AS int) AS hour", "concat('b', pmod(xxhash64(id, 2), 4000)) AS bank",
        f"if({hash_sql('id', repr('side'))} < 0.5, 'challenger', 'champion') AS ab_group", "cast(id % 2 AS int) AS y",
    ).selectExpr("*", f"if({hash_sql('id', repr('wrong'))} < {error}, 1 - y, y) AS prediction")


def test_a_planted_pair_is_found_and_nothing_else(spark):
    rows = scored(spark, error="if(city = 'c3' AND device = 'd1' AND ab_group = 'challenger', 0.35, 0.1)")
    # parts without the pair are better than the group, which holds it: only what is worse is asked for
    found = lattice.error_lattice(rows, "y", FACTORS, max_depth=3).filter("biased AND accuracy_gap < 0").collect()
    assert ("challenger", "city=c3 & device=d1") in {(r["ab_group"], r["conditions"]) for r in found}
    assert all(r["ab_group"] == "challenger" and {"city=c3", "device=d1"} & set(r["conditions"].split(" & ")) for r in found)
    pairs = [r["conditions"] for r in found if r["depth"] >= 2]
    assert pairs == ["city=c3 & device=d1"]
    # a conjunction of three adds nothing to the pair


def test_a_single_factor_is_not_reported_again_in_its_conjunctions(spark):
    found = lattice.error_lattice(scored(spark, error="if(hour = 2, 0.3, 0.1)"), "y", FACTORS).filter("biased AND accuracy_gap < 0").collect()
    assert {r["conditions"] for r in found} == {"hour=2"} and {r["ab_group"] for r in found} == {"champion", "challenger"}


def test_false_discoveries_are_bounded(spark):
    """Forty tables without any factor: at most a few of them report something."""
    rows = scored(spark, 40 * 3000).selectExpr("* EXCEPT (ab_group)", "concat('t', id % 40) AS ab_group")
    out = lattice.error_lattice(rows, "y", ["city", "device", "hour"], min_share=0.02)
    wrong = out.filter("biased").select("ab_group").distinct().count()
    assert out.count() > 40 * 60 and wrong <= 5


def test_counts_are_those_of_every_combination(spark):
    rows = scored(spark, 3000)
    got = {(r["ab_group"], r["conditions"]): (r["n"], round(r["accuracy"], 12)) for r in lattice.error_lattice(rows, "y", FACTORS, min_share=0.03, max_depth=3).collect()}
    every = rows.collect()
    want: dict = {}
    for r in every:
        for depth in (1, 2, 3):
            for fs in combinations(FACTORS, depth):
                key = r["ab_group"], " & ".join(f"{f}={'(null)' if r[f] is None else r[f]}" for f in fs)
                n, hits = want.get(key, (0, 0))
                want[key] = n + 1, hits + (r["y"] == r["prediction"])
    sizes = {g: sum(r["ab_group"] == g for r in every) for g in ("champion", "challenger")}
    want = {k: (n, round(h / n, 12)) for k, (n, h) in want.items() if n >= 0.03 * sizes[k[0]]}
    assert got == want and len(got) > 100


def test_levels_are_bounded_and_not_a_cube(spark):
    """A factor with thousands of rare values makes no conjunctions; every level is one grouped pass over cells."""
    rows = scored(spark, 20_000)
    level = lattice._level(lattice.factor_cells(rows, "y", FACTORS), [(0, 1)], None, rows.selectExpr("ab_group AS side").groupBy("side").count().selectExpr(
        "side", "count AS n", "count AS hits"), 0.01)
    plan = level._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") == 1
    found = lattice.error_lattice(rows, "y", FACTORS, min_share=0.01)
    assert found.filter("conditions LIKE '%bank=%'").count() == 0
    assert found.groupBy("ab_group").count().filter("count > 8 + 3 + 5 + 3 * 100").isEmpty()


def test_edge_input(spark):
    rows = scored(spark, 200)
    assert lattice.error_lattice(rows.limit(0), "y", FACTORS).count() == 0
    broken = rows.selectExpr("* EXCEPT (prediction)", "cast(NULL AS int) AS prediction")
    assert lattice.error_lattice(broken, "y", FACTORS).count() == 0
    whole = lattice.error_lattice(rows.selectExpr("*", "1 AS same", "2 AS n", "3 AS side", "4 AS vals"), "y", ["same", "n"]).collect()
    assert all(r["p_value"] is None and not r["biased"] and r["accuracy_gap"] == 0 for r in whole) and len(whole) == 2 * 3
    for bad in ({"min_share": 0}, {"max_depth": 0}):
        with pytest.raises(ValueError):
            lattice.error_lattice(rows, "y", FACTORS, **bad)
