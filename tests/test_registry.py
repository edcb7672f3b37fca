"""Alias log: last write wins, registration, promotion."""

from __future__ import annotations

import random

import pytest
from duelist.operators import registry
from duelist.plans import fixtures


def log(spark, rows):
    return spark.createDataFrame(rows, registry.ALIAS_EVENTS)


def runs(spark, rows):
    return spark.createDataFrame(rows, "model string, run_id string, path string, run_seq bigint")


def versions(spark, rows=()):
    return spark.createDataFrame(list(rows), registry.VERSIONS)


def state(events):
    return {(r["model"], r["alias"]): (r["version"], r["source"]) for r in registry.resolve(events).collect()}


def test_last_write_wins_and_tags_are_a_fallback(spark):
    events = log(spark, [
        (1, "m", "champion", 1, "set", "alias"), (2, "m", "champion", 2, "set", "alias"),
        (3, "m", "challenger", 3, "set", "alias"), (4, "m", "challenger", 3, "delete", "alias"),
        (5, "m", "champion", 9, "set", "tag"), (6, "m", "challenger", 9, "set", "tag"),
        (1, "t", "champion", 4, "set", "tag"), (2, "t", "champion", 5, "set", "tag"),
        (3, "t", "challenger", 5, "set", "tag"), (4, "t", "challenger", 5, "delete", "tag"),
    ])
    assert state(events) == {("m", "champion"): (2, "alias"), ("t", "champion"): (5, "tag")}


def test_resolve_like_a_replay(spark):
    rng = random.Random(5)
    rows = [(i, f"m{rng.choice([0, 0, 0, 1, 2])}", rng.choice(["champion", "challenger"]), i,
             rng.choice(["set", "set", "delete"]), rng.choice(["alias", "tag", "tag"])) for i in range(60)]
    want, seen = {}, {}
    for _, model, alias, version, op, source in rows:
        seen.setdefault((model, alias), {})[source] = None if op == "delete" else version
    for key, last in seen.items():
        source = "alias" if "alias" in last else "tag"
        if last[source] is not None:
            want[key] = (last[source], source)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    assert state(log(spark, shuffled)) == want


def test_register(spark):
    new = registry.register(
        runs(spark, [("m", "r1", "/1", 10), ("m", "r2", "/2", 30), ("m", "r3", "/3", 20), ("n", "r4", "/4", 5)]),
        versions(spark, [("n", 6, "r0", "/0", 1)]),
        log(spark, [(3, "n", "champion", 6, "set", "alias")]),
        run_order_width=15,  # several ranges of run_seq
    )
    got = {r["run_id"]: (r["model"], r["version"]) for r in registry.version_rows(new).collect()}
    assert got == {"r1": ("m", 1), "r3": ("m", 2), "r2": ("m", 3), "r4": ("n", 7)}
    events = registry.event_rows(new)
    assert len({(r["model"], r["event_seq"]) for r in events.collect()}) == events.count() == 5
    assert state(events.unionByName(log(spark, [(3, "n", "champion", 6, "set", "alias")]))) == {
        ("m", "challenger"): (3, "alias"), ("m", "champion"): (1, "alias"),
        ("n", "challenger"): (7, "alias"), ("n", "champion"): (6, "alias"),
    }


def test_register_twice_changes_nothing(spark):
    batch = runs(spark, [("m", "r1", "/1", 1), ("m", "r2", "/2", 2)])
    first = registry.register(batch, versions(spark), log(spark, []))
    again = registry.register(batch, registry.version_rows(first), registry.event_rows(first))
    assert again.count() == 0


def test_promote(spark):
    events = log(spark, [
        (1, "m", "champion", 1, "set", "alias"), (2, "m", "challenger", 2, "set", "alias"),
        (1, "no_challenger", "champion", 1, "set", "alias"),
        (7, "first", "challenger", 3, "set", "tag"),
        (1, "loser", "champion", 1, "set", "alias"), (2, "loser", "challenger", 2, "set", "alias"),
    ])
    decisions = spark.createDataFrame(
        [("m", True), ("m", True), ("no_challenger", True), ("first", True), ("loser", False)], "model string, promote boolean"
    )
    new = registry.promote(decisions, events)
    after = events.unionByName(new)
    assert state(after) == {
        ("m", "champion"): (2, "alias"), ("no_challenger", "champion"): (1, "alias"), ("first", "champion"): (3, "alias"),
        ("loser", "champion"): (1, "alias"), ("loser", "challenger"): (2, "alias"),
    }
    assert registry.promote(decisions, after).count() == 0


def test_only_the_tested_version_is_promoted(spark):
    """A challenger registered while the test ran keeps its alias."""
    events = log(spark, [(1, "m", "champion", 1, "set", "alias"), (2, "m", "challenger", 2, "set", "alias"),
                         (3, "m", "challenger", 3, "set", "alias")])
    decisions = spark.createDataFrame([("m", True, 2)], "model string, promote boolean, challenger_version bigint")
    after = events.unionByName(registry.promote(decisions, events))
    assert state(after) == {("m", "champion"): (2, "alias"), ("m", "challenger"): (3, "alias")}
    assert registry.promote(decisions, after).count() == 0


def test_first_version_is_champion_and_challenger(spark):
    events = registry.event_rows(registry.register(runs(spark, [("m", "r", "/", 1)]), versions(spark), log(spark, [])))
    decisions = spark.createDataFrame([("m", True)], "model string, promote boolean")
    after = events.unionByName(registry.promote(decisions, events))
    assert state(after) == {("m", "champion"): (1, "alias")}
    assert registry.promote(decisions, after).count() == 0


def test_has_alias(spark):
    events = log(spark, [(1, "a", "champion", 1, "set", "alias"), (2, "a", "challenger", 2, "set", "alias"),
                         (1, "b", "champion", 1, "set", "alias")])
    models = events.select("model").distinct()
    found = registry.has_alias(models, registry.resolve(events), "champion", "challenger")
    assert [r["model"] for r in found.collect()] == ["a"]


def test_one_version_per_alias(spark, sf_dir):
    resolved = registry.resolve(fixtures.alias_log(spark, sf_dir))
    assert resolved.count() == resolved.select("model", "alias").distinct().count() > 0


def test_registration_rejects_nulls_and_takes_a_run_once(spark):
    rows = [("a", "r1", "p", 1), (None, "r2", "p", 2), ("a", "r3", "p", None), ("b", "r4", "p", 5), ("b", "r4", "p", 6)]
    empty = log(spark, [])
    for k in (1, 2):
        with pytest.raises(Exception, match="must not be NULL"):
            registry.register(runs(spark, [rows[0], rows[k]]), versions(spark), empty).collect()
    new = registry.register(runs(spark, [rows[0], *rows[3:]]), versions(spark), empty)
    assert sorted((r["model"], r["version"], r["run_id"], r["created_seq"]) for r in new.collect()) == [("a", 1, "r1", 1), ("b", 1, "r4", 5)]
    assert {(r["model"], r["alias"]) for r in registry.event_rows(new).collect()} == {
        (m, a) for m in "ab" for a in ("champion", "challenger")}


def test_runs_of_a_hot_model_far_apart_in_time(spark):
    """More offset buckets than one run of them, so both levels are summed."""
    df = spark.range(9_000).selectExpr("'hot' AS model", "concat('r', id) AS run_id", "'p' AS path", "id * 3000000 AS run_seq")
    new = registry.version_rows(registry.register(df, versions(spark), log(spark, [])))
    assert new.filter("version <> created_seq / 3000000 + 1").count() == 0 and new.count() == 9_000


def test_promotion_outcome(spark):
    events = log(spark, [(1, "m", "champion", 1, "set", "alias"), (2, "m", "challenger", 2, "set", "alias"),
                         (1, "gone", "champion", 1, "set", "alias"), (1, "lost", "challenger", 1, "set", "alias")])
    report = spark.createDataFrame([("m", True), ("gone", True), ("lost", False)], "model string, promote boolean")
    got = {r["model"]: r["promotion_status"] for r in registry.promotion_outcome(report, events).collect()}
    assert got == {"m": "success", "gone": "failed", "lost": "not_promoted"}
