"""Tests, bootstrap and slices behave as statistics should."""

from __future__ import annotations

import math

import pytest

from duelist.functions.hashing import hash_sql, poisson_sql, poisson_thresholds
from duelist.functions.stats import two_proportion_z, two_sided_p
from duelist.operators import bootstrap, decision, metrics, significance, slices
from duelist.plans import fixtures


def test_poisson_weight(spark):
    df = spark.range(40000).selectExpr(f"{hash_sql('id', repr('w'))} AS u").selectExpr(f"{poisson_sql('u')} AS w")
    row = df.selectExpr("avg(w) AS m", "var_samp(w) AS v", "max(w) AS x").first()
    assert abs(row["m"] - 1) < 0.03 and abs(row["v"] - 1) < 0.05 and row["x"] < 13
    assert poisson_thresholds()[0] == pytest.approx(math.exp(-1))


def test_p_value(spark):
    for z in (0.0, 0.5, 1.96, -1.96, 4.0):
        p = spark.sql(f"SELECT {two_sided_p(f'cast({z} AS double)')} AS p").first()["p"]
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=2e-7)
    assert spark.sql(f"SELECT {two_sided_p('cast(NULL AS double)')} AS p").first()["p"] is None


def test_equal_groups_have_z_zero(spark):
    assert spark.sql(f"SELECT {two_proportion_z('30', '100', '60', '200')} AS z").first()["z"] == 0
    assert spark.sql(f"SELECT {two_proportion_z('0', '100', '0', '200')} AS z").first()["z"] is None


def test_a_a_test_rejects_about_one_in_twenty(spark, tx):
    """The same model in both groups, under 200 assignments at once."""
    trials = tx.selectExpr("tx_id", "tx_fraud", "explode(sequence(1, 200)) AS trial")
    noise = hash_sql(["tx_id", "trial"], "'noise'")
    scored = trials.selectExpr(
        "trial", "tx_fraud", f"({noise} + 0.3D * tx_fraud) / 1.3D AS score",
        f"if({hash_sql('tx_id', 'cast(trial AS string)')} < 0.5D, 'challenger', 'champion') AS ab_group",
    ).selectExpr("*", "cast(score > 0.5 AS double) AS prediction")
    wide = decision.compare_groups(metrics.group_metrics(scored, ["trial", "ab_group"], "tx_fraud"), ["trial"])
    out = significance.accuracy_test(significance.auc_test(wide)).cache()
    for name in ("auc", "accuracy"):
        rate = out.selectExpr(f"avg(cast({name}_significant AS int)) AS r").first()["r"]
        assert 0.0 < rate < 0.12, name
        spread = out.selectExpr(f"stddev({name}_z) AS s").first()["s"]
        assert 0.85 < spread < 1.15, name


@pytest.mark.parametrize("units", [None, 300])
def test_bootstrap_spread(spark, sf_dir, units):
    """Standard deviation of the replicates against the textbook standard error."""
    scored = fixtures.scored_transactions(spark, sf_dir).cache()
    m = {r["ab_group"]: r for r in metrics.group_metrics(scored, ["ab_group"], "tx_fraud").collect()}
    acc = {r["series"]: r for r in bootstrap.summarise(bootstrap.bootstrap_accuracy(scored, "tx_id", "tx_fraud", 200, units)).collect()}
    auc = {r["series"]: r for r in bootstrap.summarise(bootstrap.bootstrap_auc(scored, "tx_id", "tx_fraud", 200, units, exact=True)).collect()}
    for group, row in m.items():
        a = row["accuracy"]
        se = math.sqrt(a * (1 - a) / row["sample_size"])
        assert acc[group]["sd"] == pytest.approx(se, rel=0.25)
        assert abs(acc[group]["mean"] - a) < se
        assert auc[group]["sd"] == pytest.approx(row["auc_se"], rel=0.25)
        assert abs(auc[group]["mean"] - row["auc"]) < row["auc_se"]
    assert acc["gain"]["low"] < acc["gain"]["mean"] < acc["gain"]["high"]
    scored.unpersist()


def test_weights_table_is_bounded_by_its_parameters(spark):
    drawn = bootstrap._weights(spark, "ab_group", 50, 7)
    assert drawn.count() <= 2 * 50 * 7 and drawn.filter("weight <= 0").count() == 0


def test_bootstrap_leaves_out_rows_without_a_label(spark, sf_dir):
    scored = fixtures.scored_transactions(spark, sf_dir).selectExpr("*", "if(tx_id % 4 = 0, NULL, tx_fraud) AS y")
    point = {r["ab_group"]: r["accuracy"] for r in metrics.group_metrics(scored, ["ab_group"], "y").collect()}
    for units in (None, 200):
        drawn = {r["series"]: r for r in bootstrap.summarise(bootstrap.bootstrap_accuracy(scored, "tx_id", "y", 100, units)).collect()}
        for group, accuracy in point.items():
            assert abs(drawn[group]["mean"] - accuracy) < 3 * drawn[group]["sd"] / 10
    with pytest.raises(ValueError):
        bootstrap.bootstrap_auc(scored, "tx_id", "y")


def test_large_weight_tables_are_not_broadcast(spark, sf_dir, capsys):
    scored = fixtures.scored_transactions(spark, sf_dir)
    bootstrap.bootstrap_auc(scored, "tx_id", "tx_fraud", 1000, 1_000_000, bins=50).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_noise_slices_are_not_called_biased(spark):
    df = spark.range(80_000).selectExpr(
        "if(id % 2 = 0, 'champion', 'challenger') AS ab_group", "concat('s', pmod(xxhash64(id), 40)) AS seg",
        "cast(pmod(xxhash64(id, 1), 2) AS int) AS y", "pmod(xxhash64(id, 2), 1000) / 1000D AS score",
    ).selectExpr("*", "cast(score > 0.5 AS double) AS prediction")
    out = slices.slice_bias(slices.slice_metrics(df, "y", ["seg"]))
    assert out.count() == 80 and out.filter("biased").count() <= 1
    assert out.filter("q_value < p_value - 1e-12").count() == 0


def test_slices_add_up_and_bias_is_found(spark):
    df = spark.range(20000).selectExpr(
        "if(id % 2 = 0, 'champion', 'challenger') AS ab_group", "concat('s', id % 5) AS seg", "cast(id % 3 = 0 AS int) AS y",
        "pmod(id * 7919, 997) / 997D AS score",
    ).selectExpr("*", "cast(if(seg = 's3', y, if(score < 0.9, y, 1 - y)) AS double) AS prediction")
    m = slices.slice_metrics(df, "y", ["seg"])
    rows = {(r["ab_group"], r["segment"]): r for r in m.collect()}
    assert len(rows) == 12
    for g in ("champion", "challenger"):
        assert sum(r["sample_size"] for (h, s), r in rows.items() if h == g and s != slices.ALL) == rows[g, slices.ALL]["sample_size"]
    whole = {r["ab_group"]: r["auc"] for r in metrics.group_metrics(df, ["ab_group"], "y").collect()}
    assert whole["champion"] == pytest.approx(rows["champion", slices.ALL]["auc"])
    biased = {r["segment"] for r in slices.slice_bias(m).filter("biased AND accuracy_gap > 0").collect()}
    assert biased == {"s3"}


def test_null_segment_is_a_segment(spark):
    df = spark.createDataFrame(
        [("champion", None, 1, 0.9, 1.0), ("champion", "a", 0, 0.2, 0.0)], "ab_group string, seg string, y int, score double, prediction double"
    )
    m = slices.slice_metrics(df, "y", ["seg"])
    assert {r["segment"]: r["sample_size"] for r in m.collect()} == {None: 1, "a": 1, "(all)": 2}
    assert slices.slice_bias(m).count() == 2


def test_several_factors_one_at_a_time(spark, sf_dir):
    scored = fixtures.rule_scored(fixtures.customer_transactions(spark, sf_dir))
    both = slices.slice_metrics(scored, "tx_fraud", ["segment", "priority"])
    one = slices.slice_metrics(scored, "tx_fraud", ["priority"])
    assert {r[0] for r in both.select("factor").distinct().collect()} == {"segment", "priority", slices.ALL}
    assert sorted(map(str, both.filter("factor <> 'segment'").collect())) == sorted(map(str, one.collect()))
