"""Pipelines, scoring and both jobs end to end."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from duelist.operators import decision, features, models, registry
from duelist.operators.metrics import group_metrics
from duelist.plans.ab_test import ab_job
from duelist.plans.training import register_runs, train_job
from duelist.sources.runs import RunTables, load_by_alias


@pytest.fixture(scope="module")
def rows(spark):
    """A table whose label does follow its features, with types of every kind."""
    return spark.range(4000).selectExpr(
        "id AS tx_id", "timestamp_ntz'2019-08-22 00:00:00' AS tx_timestamp", "concat('c', id % 7) AS city",
        "pmod(id * 7919, 1000) / 1000D AS amount", "cast(id % 13 AS int) AS hour", "id % 2 = 0 AS flag",
        "cast(pmod(id * 31, 100) / 10 AS decimal(6, 2)) AS ratio", "array(1) AS parts", "date'2019-08-22' AS day",
        "cast(pmod(id * 7919, 1000) + 200 * (id % 3) > 900 AS int) AS tx_fraud",
    )


FEATURES = ["amount", "hour", "flag", "ratio"]


def test_feature_selection(rows):
    assert features.feature_columns(rows, "tx_fraud", "tx_timestamp", ("tx_id",)) == FEATURES
    assert features.dropped_columns(rows, "tx_fraud", "tx_timestamp", ("tx_id",)) == ["city", "parts", "day"]
    slim = features.select_features(rows, "tx_fraud", "tx_timestamp", ("tx_id",), keep=("tx_id",))
    assert slim.columns == ["tx_id", *FEATURES, "tx_fraud"]


@pytest.mark.parametrize("kind", ["rf", "lr"])
def test_scoring_and_metrics_are_those_of_mllib(rows, kind):
    model = models.fit(rows, FEATURES, "tx_fraud", kind)
    theirs = model.transform(rows).select("tx_id", vector_to_array("probability")[1].alias("s"), F.col("prediction").alias("p"),
                                          "rawPrediction", "tx_fraud", "prediction")
    ours = models.score_table(model, rows).select("tx_id", "score", F.col("prediction").alias("mine"))
    both = ours.join(theirs, "tx_id")
    assert both.count() == 4000 and both.filter("s <> score OR p <> mine").count() == 0
    row = models.holdout_metrics(model, rows, "tx_fraud").first()
    auc = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="rawPrediction", numBins=0).evaluate(theirs)
    assert row["auc"] == pytest.approx(auc, abs=1e-9) and row["auc"] > 0.8
    f1 = MulticlassClassificationEvaluator(labelCol="tx_fraud", metricName="f1").evaluate(theirs)
    assert row["f1_weighted"] == pytest.approx(f1, abs=1e-9)


def test_thresholds_are_kept(rows):
    model = models.fit(rows, FEATURES, "tx_fraud", "lr", threshold=0.2)
    ours = models.score_table(model, rows)
    assert ours.filter("prediction <> cast(score > 0.2 AS double)").count() == 0
    pipeline = models.build_pipeline(FEATURES, "tx_fraud", "rf")
    pipeline.getStages()[-1].setThresholds([0.8, 0.2])
    forest = pipeline.fit(rows)
    theirs = forest.transform(rows).select("tx_id", F.col("prediction").alias("p"))
    assert models.score_table(forest, rows).join(theirs, "tx_id").filter("p <> prediction").count() == 0


def test_each_row_gets_the_model_of_its_group(rows):
    champion, challenger = models.fit(rows, FEATURES, "tx_fraud", "rf"), models.fit(rows, FEATURES, "tx_fraud", "lr")
    grouped = rows.withColumn("ab_group", F.when(F.col("tx_id") % 3 == 0, "challenger").otherwise("champion"))
    scored = models.score_groups(grouped, champion, challenger)
    for group, model in (("champion", champion), ("challenger", challenger)):
        want = models.score_table(model, rows).select("tx_id", F.col("score").alias("s"), F.col("prediction").alias("p"))
        mine = scored.filter(F.col("ab_group") == group).join(want, "tx_id")
        assert mine.filter("s <> score OR p <> prediction").count() == 0
    plan = scored.select("tx_id", "score", "prediction")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1 and "UDF(" in plan and "parts#" not in plan
    assert not unconditional(plan, "UDF(")


def unconditional(plan: str, call: str) -> list[str]:
    """Where a plan calls the function outside every CASE branch."""
    depth, out = 0, []
    for token in re.finditer(rf"CASE WHEN|\bEND\b|{re.escape(call)}", plan):
        depth += {"CASE WHEN": 1, "END": -1}.get(token[0], 0)
        if token[0] == call and not depth:
            out.append(plan[max(0, token.start() - 60) : token.end() + 60])
    return out


@pytest.mark.parametrize("on_null", ["error", "skip", "impute"])
def test_no_model_function_outside_its_branch(rows, on_null):
    """Every stage of either model, front stages included, stands below a condition on the group, and a column that only
    the champion reads may be NULL in the challenger's rows."""
    champion = models.fit(rows, FEATURES, "tx_fraud", "lr", on_null=on_null)
    challenger = models.fit(rows, [c for c in FEATURES if c != "amount"], "tx_fraud", "rf", on_null=on_null)
    grouped = rows.withColumn("ab_group", F.when(F.col("tx_id") % 3 == 0, "challenger").otherwise("champion"))
    scored = models.score_groups(grouped, champion, challenger)
    plan = scored.select("tx_id", "score", "prediction")._jdf.queryExecution().executedPlan().toString()
    assert not unconditional(plan, "UDF(")
    holes = grouped.withColumn("amount", F.when(F.col("ab_group") == "champion", F.col("amount")))
    assert models.score_groups(holes, champion, challenger).filter("score IS NULL").count() == 0




def test_same_seed_same_forest(rows):
    fits = [
        models.fit(models.repeatable_rows(rows.repartition(n), "tx_id", 4), FEATURES, "tx_fraud", "rf", seed=1)
        for n in (2, 5)
    ]
    first, second = (f.stages[-1].toDebugString.split("\n", 1)[1] for f in fits)  # less the line with the uid
    assert first == second


def test_nulls(rows):
    holes = rows.withColumn("amount", F.when(F.col("tx_id") % 10 > 0, F.col("amount")))
    with pytest.raises(Exception, match="null"):
        models.fit(holes, FEATURES, "tx_fraud", "lr")
    skipped = models.score_table(models.fit(holes, FEATURES, "tx_fraud", "lr", on_null="skip"), holes)
    assert skipped.count() == 4000 and skipped.filter("score IS NOT NULL AND prediction IS NOT NULL").count() == 3600
    filled = models.score_table(models.fit(holes, FEATURES, "tx_fraud", "rf", on_null="impute"), holes)
    assert filled.filter("score IS NOT NULL").count() == 4000
    with pytest.raises(ValueError):
        models.build_pipeline(FEATURES, "tx_fraud", on_null="ignore")
    with pytest.raises(ValueError):
        models.build_pipeline(FEATURES, "tx_fraud", "svm")


def test_tuned_fit(rows):
    tuned = models.fit_tuned(rows, FEATURES, "tx_fraud", "tx_id", grid={"maxDepth": [1, 4]}, folds=2)
    assert len(tuned.avgMetrics) == 2
    assert dict(models.fitted_params(tuned.bestModel))["best_maxDepth"] == "4"


def test_run_name():
    assert models.run_name("rf", "s3a://bucket/day/2019-08-22.parquet") == "fraud_detection_rf_2019-08-22.parquet"


def test_standardise_like_mllib(rows):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    df = rows.selectExpr("tx_id", "amount", "cast(hour AS double) AS hour", "3D AS fixed")
    cols = ["amount", "hour", "fixed"]
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(df)
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vec).transform(vec)
    theirs = scaled.select("tx_id", vector_to_array("s").alias("s"))
    ours = features.standardise(df, cols, keep=("tx_id",))
    off = " OR ".join(f"abs({c}_scaled - s[{i}]) > 1e-9" for i, c in enumerate(cols))
    assert ours.join(theirs, "tx_id").filter(off).count() == 0


def test_jobs_end_to_end(spark, rows, folder):
    """Train, register, train a better one, test, promote, and test again."""
    at = dt.datetime(2024, 1, 1)
    options = {"key": "tx_id", "weights": [0.7, 0.3]}
    tables = RunTables(spark, folder)
    assert ab_job(spark, rows, folder, **options).reason == "no champion model"

    weak = train_job(spark, rows.drop("amount"), folder, auto_register=True, input_path="/in/day.parquet", now=at, **options)
    assert weak.version == 1 and weak.run_name == "fraud_detection_rf_day.parquet"
    strong = train_job(spark, rows, folder, auto_register=True, stage=True, now=at + dt.timedelta(hours=1), **options)
    assert strong.version == 2 and strong.metrics["auc"] > weak.metrics["auc"]
    assert load_by_alias(tables, "fraud_detection_model", "champion")[1] == 1

    refused = ab_job(spark, rows, folder, key="tx_id", weights=[0.6, 0.4])
    assert (refused.status, refused.reason) == ("failed", "holdout overlaps training rows")
    assert ab_job(spark, rows, folder, hash_method="md5", **options).reason == "training split by another key, salt or hash"
    assert ab_job(spark, rows, folder, key="day", weights=[0.7, 0.3]).reason == "training split by another key, salt or hash"

    test = ab_job(spark, rows, folder, auto_promote=True, **options)
    assert test.status == "ok" and test.report["winner"] == "challenger" and test.report["promotion_status"] == "success"
    assert load_by_alias(tables, "fraud_detection_model", "champion")[1] == 2
    assert ab_job(spark, rows, folder, **options).reason == "no challenger model"

    metrics = {(r["run_id"], r["name"]) for r in tables.read("metrics").collect()}
    assert {n for r, n in metrics if r == strong.run_id} == {"auc", "accuracy", "f1"}
    assert len({n for r, n in metrics if r == test.run_id}) == 11
    params = {r["name"]: r["value"] for r in tables.read("params").filter(F.col("run_id") == test.run_id).collect()}
    assert params["winner"] == "challenger" and len(params) == 8
    reports = {r["run_id"]: r["document"] for r in tables.read("reports").collect()}
    assert '"promotion_status":"success"' in reports[test.run_id]
    assert '"status": "failed"' in reports[refused.run_id] and len(reports) == 6

    # the model that lost its challenger alias goes on as champion against the next one
    train_job(spark, rows, folder, model_type="lr", auto_register=True, now=at + dt.timedelta(hours=2), **options)
    after = ab_job(spark, rows, folder, **options)
    assert after.status == "ok" and after.report["promotion_status"] == "not_promoted"


def test_models_without_a_recorded_split_are_refused(spark, rows, folder):
    from duelist.plans.training import register_run

    trained = train_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3])
    tables = RunTables(spark, folder)
    at = dt.datetime(2024, 1, 1)
    register_run(tables, "unknown", f"{tables.root}/models/{trained.run_id}", "fraud_detection", at)
    assert ab_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3]).reason == "training split of a model is not recorded"


@pytest.mark.parametrize("on_null", ["error", "skip"])
def test_rows_need_only_their_own_model(rows, on_null):
    """A NULL that only the challenger reads costs champion rows nothing."""
    champion = models.fit(rows, ["amount"], "tx_fraud", "lr")
    challenger = models.fit(rows, ["amount", "hour"], "tx_fraud", "lr", on_null=on_null)
    holes = rows.withColumn("hour", F.when(F.col("tx_id") % 5 > 0, F.col("hour")))
    assigned = holes.withColumn("ab_group", F.when(F.col("tx_id") % 2 == 0, "champion").otherwise("challenger"))
    scored = models.score_groups(assigned, champion, challenger)
    got = {r["ab_group"]: (r["sample_size"], r["invalid"]) for r in group_metrics(scored, ["ab_group"], "tx_fraud").collect()}
    assert got == {"champion": (2000, 0), "challenger": (2000, 400)}
    report = decision.ab_report(scored, "tx_fraud").first()
    assert report["status"] == "failed" and report["challenger_invalid"] == 400
    assert decision.ab_report(scored, "tx_fraud", max_invalid_share=0.2).first()["status"] == "ok"


def test_empty_holdout_is_a_failure_record(spark, rows, folder):
    train_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3], auto_register=True)
    run = ab_job(spark, rows.limit(0), folder, key="tx_id")
    assert (run.status, run.reason) == ("failed", "no rows")
    assert RunTables(spark, folder).read("reports").count() == 1


def test_register_runs_in_bulk(spark, folder):
    tables = RunTables(spark, folder)
    batch = spark.range(50).selectExpr(
        "concat('m', id % 3) AS model", "concat('r', id) AS run_id", "'/p' AS path", "id AS run_seq"
    )
    assert register_runs(tables, batch).count() == 50
    assert register_runs(tables, batch).count() == 0
    assert tables.read("versions").count() == 50
    assert registry.resolve(tables.read("alias_events")).count() == 6


def test_command_line(spark, rows, folder):
    from duelist.__main__ import main

    slim = rows.drop("parts", "day")
    slim.write.parquet(f"{folder}/in/day.parquet")
    slim.drop("flag").write.option("header", True).csv(f"{folder}/in/day.csv")
    common = ["--root", f"{folder}/runs", "--key", "tx_id", "--weights", "0.6", "0.4"]
    first = main(["train", "--input", f"{folder}/in/day.csv", "--auto-register", *common])
    assert (first["version"], first["run_name"]) == (1, "fraud_detection_rf_day.csv")
    assert main(["ab", "--input", f"{folder}/in/day.parquet", *common])["status"] == "ok"
    second = main(["train", "--input", f"{folder}/in/day.parquet", "--model-type", "lr", "--output", f"{folder}/lr", "--auto-register", *common])
    assert second["version"] == 2
    test = main(["ab", "--input", f"{folder}/in/day.parquet", "--auto-promote", "--test-name", "t2", *common])
    assert test["status"] == "ok" and test["promotion_status"] in ("success", "not_promoted")


def test_halving_finds_the_winner_of_the_full_grid(rows):
    from itertools import product

    from duelist.functions.hashing import hash_sql, quote

    grid = {"regParam": [5.0, 0.5, 0.02, 0.0], "elasticNetParam": [1.0, 0.0]}
    best, tried = models.halving(rows, FEATURES, "tx_fraud", "tx_id", "lr", grid)
    u = hash_sql("tx_id", quote(f"halving{models.SEED}"), "xxhash64")
    fitted, held_out = rows.filter(f"{u} < 0.8D"), rows.filter(f"{u} >= 0.8D")
    full = {}
    for values in product(*grid.values()):
        model = models.fit(fitted, FEATURES, "tx_fraud", "lr", **dict(zip(grid, values)))
        full[values] = models.holdout_metrics(model, held_out, "tx_fraud").first()["auc"]
    assert min(full.values()) == 0.5 and full[tuple(best.values())] >= max(full.values()) - 0.005
    assert sum(t.share for t in tried) < 8 * 0.8 / 2 and [t.rung for t in tried] == [0] * 8 + [1] * 2
    assert models.halving(rows, FEATURES, "tx_fraud", "tx_id", "lr", {"regParam": [0.1]}) == ({"regParam": 0.1}, [])
    one_class, none = models.halving(rows.filter("tx_fraud = 1"), FEATURES, "tx_fraud", "tx_id", "lr", {"regParam": [0.1, 0.2]})
    assert one_class == {"regParam": 0.1} and none == []
    with pytest.raises(ValueError):
        models.halving(rows, FEATURES, "tx_fraud", "tx_id", "lr", {"regParam": []})


def test_tuned_job_keeps_its_trials(spark, rows, folder):
    run = train_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3], model_type="lr", tune={"regParam": [0.0, 5.0]})
    params = {r["name"]: r["value"] for r in RunTables(spark, folder).read("params").filter(F.col("run_id") == run.run_id).collect()}
    assert sum(name.startswith("tune_") for name in params) == 2 and params["regParam"] in ("0.0", "5.0")
    assert params["dropped_columns"] == ",".join(run.dropped) and set(run.dropped) == {"city", "parts", "day"}


def test_a_test_that_breaks_leaves_a_record(spark, rows, folder):
    train_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3], auto_register=True)
    broken = rows.withColumn("amount", F.raise_error(F.lit("lost disk")).cast("double"))
    with pytest.raises(Exception, match="lost disk"):
        ab_job(spark, broken, folder, key="tx_id", weights=[0.7, 0.3], now=dt.datetime(2024, 1, 1))
    (record,) = RunTables(spark, folder).read("reports").collect()
    assert '"status": "error"' in record["document"] and "lost disk" in record["document"]
    assert ab_job(spark, rows, folder, key="tx_id", weights=[0.7, 0.3]).profile.filter("name = 'amount' AND rows = 4000").count() == 1


def test_csv_schema_on_the_command_line(spark, folder):
    from duelist.__main__ import arguments, load

    spark.createDataFrame([("a", 7)], "k string, v int").write.option("header", True).csv(f"{folder}/t.csv")
    args = arguments(["train", "--input", f"{folder}/t.csv", "--root", folder, "--key", "k", "--schema", "k string, v decimal(9, 2)"])
    assert dict(load(spark, args.input, args.schema).dtypes) == {"k": "string", "v": "decimal(9,2)"}
    assert len(load(spark, f"{folder}/t.csv", "transactions").columns) == 13
