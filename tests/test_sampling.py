"""Splits and assignment depend on keys only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from duelist.operators import sampling


def keys(df):
    return {r[0] for r in df.select("tx_id").collect()}


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_parts_are_disjoint_complete_and_layout_free(tx, method):
    train, test = sampling.train_test(tx, "tx_id", [0.7, 0.3], method=method)
    assert keys(train) | keys(test) == keys(tx) and not keys(train) & keys(test)
    again, _ = sampling.train_test(tx.repartition(7), "tx_id", [0.7, 0.3], method=method)
    assert keys(again) == keys(train)
    assert abs(len(keys(train)) / tx.count() - 0.7) < 0.05


def test_holdout_is_outside_training(tx):
    train, test = sampling.train_test(tx, "tx_id")
    holdout = keys(sampling.ab_holdout(tx.repartition(5), "tx_id"))
    assert holdout and not holdout & keys(train) and holdout <= keys(test)


def test_weights_are_normalised():
    assert sampling.fractions([0.005, 0.0001]) == [0.005 / 0.0051, 0.0001 / 0.0051]
    with pytest.raises(ValueError):
        sampling.fractions([0.0, 0.0])


def test_shares_may_leave_a_rest(tx):
    split = sampling.split(tx, "tx_id", {"a": 0.2, "b": 0.3})
    rows = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert set(rows) == {"a", "b", None} and sum(rows.values()) == tx.count()
    with pytest.raises(ValueError):
        sampling.split(tx, "tx_id", {"a": 0.7, "b": 0.7})


def test_random_method(tx):
    parts = sampling.split_parts(tx, "tx_id", {"a": 0.6, "b": 0.4}, method="random")
    assert keys(parts["a"]) | keys(parts["b"]) == keys(tx)


def test_sample_and_complement(tx):
    part, rest = sampling.sample(tx, "tx_id", 0.8)
    assert keys(part) | keys(rest) == keys(tx) and not keys(part) & keys(rest)
    assert keys(sampling.complement(tx, part, "tx_id")) == keys(rest)


def test_assignment(tx):
    first = sampling.assign_group(tx, "tx_id", "t1")
    again = sampling.assign_group(tx.repartition(3), "tx_id", "t1")
    other = sampling.assign_group(tx, "tx_id", "t2")
    pick = lambda df: {r["tx_id"]: r["ab_group"] for r in df.select("tx_id", "ab_group").collect()}
    assert pick(first) == pick(again) != pick(other)
    assert set(pick(sampling.assign_group(tx, "tx_id", "t1", 0.0)).values()) == {"champion"}
    assert set(pick(sampling.assign_group(tx, "tx_id", "t1", 1.0)).values()) == {"challenger"}


def test_split_and_traffic_are_independent(tx):
    holdout, _ = sampling.sample(tx, "tx_id", 0.3)
    share = sampling.assign_group(holdout, "tx_id", "ab_test").agg(F.avg((F.col("ab_group") == "challenger").cast("int"))).first()[0]
    assert abs(share - 0.5) < 0.1


@pytest.mark.parametrize("buckets", [1, 7, 65536])
def test_positions_are_dense_whatever_the_buckets(tx, buckets):
    rows = sampling.seeded_shuffle(tx.select("tx_id"), "tx_id", buckets=buckets).collect()
    assert sorted(r["position"] for r in rows) == list(range(tx.count()))
    order = [r["tx_id"] for r in sorted(rows, key=lambda r: r["position"])]
    base = sampling.seeded_shuffle(tx.select("tx_id"), "tx_id").orderBy("position").collect()
    assert order == [r["tx_id"] for r in base] != sorted(order)


def test_positions_per_key(tx):
    numbered = sampling.with_position(tx, "tx_id", "floor(tx_id / 10)", ("customer_id",))
    for customer, rows in _by_customer(numbered).items():
        assert [r[1] for r in sorted(rows)] == list(range(len(rows))), customer


def _by_customer(df):
    out = {}
    for r in df.select("customer_id", "tx_id", "position").collect():
        out.setdefault(r["customer_id"], []).append((r["tx_id"], r["position"]))
    return out


def test_row_label(spark):
    row = spark.createDataFrame([(7,), (123456789,)], "n bigint").select(sampling.row_label("n").alias("t")).collect()
    assert [r["t"] for r in row] == ["tx_00000007", "tx_123456789"]


def test_composite_key(tx):
    assigned = sampling.assign_group(tx, ["customer_id", "tx_id"], "t")
    assert {r[0] for r in assigned.select("ab_group").distinct().collect()} == {"champion", "challenger"}


def test_fractions_of_the_whole(tx):
    train, test = sampling.train_test(tx, "tx_id", [0.5, 0.1], normalise=False)
    holdout = sampling.ab_holdout(tx, "tx_id", [0.5, 0.2], normalise=False)
    n = tx.count()
    for part, share in ((train, 0.5), (test, 0.1), (holdout, 0.2)):
        assert abs(part.count() / n - share) < 0.05
    assert not keys(holdout) & keys(train)
    with pytest.raises(ValueError):
        sampling.ab_holdout(tx, "tx_id", [0.9, 0.2], normalise=False)


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_key_type_does_not_matter(tx, method):
    parts = [
        keys(sampling.train_test(tx.selectExpr(f"cast(tx_id AS {kind}) AS tx_id"), "tx_id", [0.5, 0.5], method=method)[0]
             .selectExpr("cast(tx_id AS bigint) AS tx_id"))
        for kind in ("int", "bigint", "string")
    ]
    assert parts[0] == parts[1] == parts[2]
