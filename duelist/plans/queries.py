"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.functions.hashing import hash_sql, quote
from duelist.operators import bootstrap, combine, decision, features, lattice, little_bootstrap, metrics, models, paired, profile, registry, sampling, sequential, significance, slices
from duelist.plans import fixtures as fx
from duelist.plans.periodic import report_by_period, with_period
from duelist.plans.training import register_run, train_job
from duelist.sources.runs import RunTables, load_by_alias, save_model
from duelist.sources.session import shared_dir
from duelist.sources.tables import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA, read_csv, write_csv
from duelist.streaming.period_cells import PeriodCells, run_tick
from duelist.streaming.scored_log import append_new, scored_rows, table_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LABEL = "tx_fraud"
TX_EXCLUDE = ("tx_id", "customer_id")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Rounds doubles for comparison with another engine; -0.0 becomes 0.0."""
    return df.selectExpr(*[
        f"round(`{c}`, {places}) + 0D AS `{c}`" if c in columns else f"`{c}`" for c in df.columns
    ])


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks -------------------------------------------------------------------


@query
def scan_transactions(spark, sf_dir):
    return fx.transactions(spark, sf_dir)


@query
def csv_round_trip(spark, sf_dir):
    path = work_dir(spark, "csv")
    write_csv(features.reorder(fx.event_transactions(spark, sf_dir), TRANSACTION_COLUMNS), path)
    return read_csv(spark, path, TRANSACTION_SCHEMA)


@query
def metrics_long(spark, sf_dir):
    tables = RunTables(spark, work_dir(spark, "runs"))
    report = decision.ab_report(fx.scored_many(spark, sf_dir), LABEL, ["test"])
    rows = decision.metrics_long(report, ["test"]).select(
        F.col("test").alias("run_id"), "name", "value", F.lit(0).alias("step"), F.current_timestamp().alias("logged_at")
    )
    tables.append("metrics", rows)
    return rounded(tables.read("metrics").select("run_id", "name", "value"), "value")


@query
def params_long(spark, sf_dir):
    tables = RunTables(spark, work_dir(spark, "runs"))
    report = decision.ab_report(fx.scored_many(spark, sf_dir), LABEL, ["test"])
    stamped = report.withColumn("timestamp", F.lit("2001-08-01 00:00:00"))
    tables.append("params", decision.params_long(stamped, ["test AS run_id"]))
    return tables.read("params")


@query
def ab_report_json(spark, sf_dir):
    """Writes the result documents as JSON and reads them back."""
    path = work_dir(spark, "documents")
    report = decision.ab_report(fx.scored_many(spark, sf_dir), LABEL, ["test"])
    doc = decision.document(report.withColumn("timestamp", F.lit("2001-08-01 00:00:00")), ["test"])
    doc.write.json(path)
    back = spark.read.schema(doc.schema).json(path)
    flat = back.select(
        "test", "timestamp", "test_name", "traffic_split",
        F.col("champion_metrics.auc").alias("champion_auc"),
        F.col("champion_metrics.sample_size").alias("champion_sample_size"),
        F.col("challenger_metrics.auc").alias("challenger_auc"),
        F.col("challenger_metrics.accuracy").alias("challenger_accuracy"),
        F.col("challenger_metrics.f1").alias("challenger_f1"),
        F.col("improvements.auc").alias("auc_improvement"),
        F.col("improvements.f1").alias("f1_improvement"),
        "statistical_significance", "winner", "should_promote", "improvement_message",
        "confidence_threshold", "status",
    )
    return rounded(flat, "champion_auc", "challenger_auc", "challenger_accuracy", "challenger_f1",
                   "auc_improvement", "f1_improvement")


# --- profiling ---------------------------------------------------------------------------


def _labelled_documents(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(fx.table(spark, sf_dir, "labels"), "doc_id", "left")


@query
def schema_rows(spark, sf_dir):
    return profile.column_profile(fx.transactions(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return profile.null_counts(_labelled_documents(spark, sf_dir))


@query
def preview(spark, sf_dir):
    return profile.preview(fx.transactions(spark, sf_dir), "tx_id")


@query
def class_balance(spark, sf_dir):
    return rounded(profile.class_balance(fx.transactions(spark, sf_dir), LABEL), "positive_rate")


@query
def split_counts(spark, sf_dir):
    train, test = sampling.fractions(sampling.TRAIN_TEST_WEIGHTS)
    split = sampling.split(fx.transactions(spark, sf_dir), "tx_id", {"train": train, "test": test})
    return split.groupBy("split").agg(F.count("*").alias("rows"))


# --- projections, filters, splits --------------------------------------------------------


@query
def select_features(spark, sf_dir):
    return features.select_features(
        fx.customer_transactions(spark, sf_dir), LABEL, "tx_timestamp", TX_EXCLUDE, keep=("tx_id",)
    )


@query
def assign_ab(spark, sf_dir):
    return sampling.assign_group(fx.transactions(spark, sf_dir).select("tx_id"), "tx_id", fx.TEST_NAME)


@query
def group_filter(spark, sf_dir):
    rows = fx.transactions(spark, sf_dir).select("tx_id", "tx_amount")
    assigned = sampling.assign_group(rows, "tx_id", fx.TEST_NAME, 0.3)
    return assigned.filter(F.col("ab_group") == decision.CHALLENGER)


@query
def reorder_columns(spark, sf_dir):
    return features.reorder(fx.event_transactions(spark, sf_dir), TRANSACTION_COLUMNS)


@query
def format_tx_id(spark, sf_dir):
    """Row ids by position in the seeded order."""
    shuffled = sampling.seeded_shuffle(fx.transactions(spark, sf_dir).select("tx_id"), "tx_id")
    return shuffled.select("tx_id", sampling.row_label("position").alias("transaction_id"))


@query
def split_train_test(spark, sf_dir):
    train, test = sampling.train_test(fx.transactions(spark, sf_dir).select("tx_id", LABEL), "tx_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def ab_holdout(spark, sf_dir):
    return sampling.ab_holdout(fx.transactions(spark, sf_dir).select("tx_id", LABEL), "tx_id")


@query
def sample_fraction(spark, sf_dir):
    return sampling.sample(fx.transactions(spark, sf_dir).select("tx_id", LABEL), "tx_id", 0.8)[0]


@query
def sample_complement(spark, sf_dir):
    return sampling.sample(fx.transactions(spark, sf_dir).select("tx_id", LABEL), "tx_id", 0.8)[1]


@query
def sample_exact(spark, sf_dir):
    """Exactly four fifths of the transactions of each class."""
    rows = fx.transactions(spark, sf_dir).select("tx_id", LABEL)
    return sampling.exact_split(rows, "tx_id", 0.8, by=(LABEL,))


@query
def sample_exact_total(spark, sf_dir):
    """Exactly a third of all transactions, none of them told apart by class."""
    return sampling.exact_sample(fx.transactions(spark, sf_dir).select("tx_id", "tx_amount"), "tx_id", 1 / 3)[0]


@query
def anti_complement(spark, sf_dir):
    """Documents without a label: the complement of a part that no hash describes."""
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.complement(documents, fx.table(spark, sf_dir, "labels"), "doc_id")


@query
def union_classes(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    fraud = F.col("event_type") == "error"
    return features.union_classes(rows.filter(~fraud), rows.filter(fraud), "fraud")


@query
def shuffle_rows(spark, sf_dir):
    return sampling.seeded_shuffle(fx.transactions(spark, sf_dir).select("tx_id", "tx_amount"), "tx_id")


# --- metrics -----------------------------------------------------------------------------


@query
def group_counts(spark, sf_dir):
    rows = fx.transactions(spark, sf_dir).select("tx_id")
    assigned = sampling.assign_group(rows, "tx_id", fx.TEST_NAME)
    return metrics.group_counts(assigned, names=[decision.CHAMPION, decision.CHALLENGER])


@query
def auc_by_group(spark, sf_dir):
    m = metrics.group_metrics(fx.scored_transactions(spark, sf_dir), ["ab_group"], LABEL)
    return rounded(m.select("ab_group", "positives", "negatives", "auc", "auc_se"), "auc", "auc_se")


@query
def auc_one_shuffle(spark, sf_dir):
    """The same from counts made before the only shuffle."""
    m = combine.combined_metrics(fx.scored_transactions(spark, sf_dir), ["ab_group"], LABEL)
    return rounded(m.select("ab_group", "positives", "negatives", "auc", "auc_se", "tied_pairs", "accuracy"), "auc", "auc_se", "tied_pairs", "accuracy")


@query
def confusion_by_group(spark, sf_dir):
    """Long documents as a guess of quality, per language; unlabelled ones are invalid."""
    rows = _labelled_documents(spark, sf_dir).select("lang", "quality", (F.col("n_chars") > 1000).cast("int").alias("prediction"))
    return metrics.confusion(rows, ["lang"], "quality")


@query
def accuracy_by_group(spark, sf_dir):
    counts = metrics.confusion(fx.scored_transactions(spark, sf_dir), ["ab_group"], LABEL)
    return rounded(metrics.with_rates(counts).select("ab_group", "sample_size", "accuracy"), "accuracy")


@query
def f1_by_group(spark, sf_dir):
    counts = metrics.confusion(fx.scored_transactions(spark, sf_dir), ["ab_group"], LABEL)
    return rounded(metrics.with_rates(counts).select("ab_group", "f1_positive", "f1_weighted"), "f1_positive", "f1_weighted")


@query
def holdout_metrics(spark, sf_dir):
    """One model on the whole test table."""
    model = fx.rule_models()[0]
    m = models.holdout_metrics(model, fx.transactions(spark, sf_dir).select("tx_id", LABEL), LABEL)
    return rounded(m, "auc", "auc_se", "tied_pairs", "accuracy", "f1_positive", "f1_weighted")


@query
def standardise(spark, sf_dir):
    rows = fx.customer_transactions(spark, sf_dir)
    return rounded(
        features.standardise(rows, ["tx_amount", "acct_bal"], keep=("tx_id",)), "tx_amount_scaled", "acct_bal_scaled"
    )


# --- decision ----------------------------------------------------------------------------

REPORT_COLUMNS = [
    "champion_sample_size", "challenger_sample_size", "champion_auc", "champion_accuracy", "champion_f1_weighted",
    "challenger_auc", "challenger_accuracy", "challenger_f1_weighted", "auc_improvement", "accuracy_improvement",
    "f1_improvement", "is_balanced", "status", "reason", "winner", "should_promote", "improvement_message", "hold_reason",
]
REPORT_DOUBLES = [c for c in REPORT_COLUMNS if c.split("_")[-1] in ("auc", "accuracy", "weighted", "improvement")]


def _report(df: DataFrame, *keys: str) -> DataFrame:
    return rounded(df.select(*keys, *REPORT_COLUMNS), *REPORT_DOUBLES)


@query
def ab_report(spark, sf_dir):
    """Does the challenger win, and should it be promoted?"""
    return _report(decision.ab_report(fx.scored_transactions(spark, sf_dir), LABEL))


@query
def metric_deltas(spark, sf_dir):
    m = metrics.group_metrics(fx.scored_transactions(spark, sf_dir), ["priority", "ab_group"], LABEL)
    deltas = decision.with_deltas(decision.compare_groups(m, ["priority"]))
    gains = ["auc_improvement", "accuracy_improvement", "f1_improvement"]
    return rounded(deltas.select("priority", *gains), *gains)


@query
def ab_decision(spark, sf_dir):
    """Four tests on the same rows, one for each branch of the decision."""
    return _report(decision.ab_report(fx.scored_many(spark, sf_dir), LABEL, ["test"]), "test")


@query
def ab_failures(spark, sf_dir):
    """Tests of single customers, many of them too small for a decision."""
    report = decision.ab_report(fx.scored_transactions(spark, sf_dir), LABEL, ["customer_id"])
    return decision.failures(report, ["customer_id"])


@query
def ab_report_by_period(spark, sf_dir):
    return _report(report_by_period(fx.scored_events(spark, sf_dir), "ts", "is_error"), "period_start")


@query
def period_report_incremental(spark, sf_dir):
    """The same report from a log that a stream of the events keeps up to date."""
    root = work_dir(spark, "log")
    events = table_stream(spark, f"{sf_dir}/events.parquet", fx.table(spark, sf_dir, "events").schema)
    rows = events.select("event_id", "ts", (F.col("event_type") == "error").cast("int").alias("is_error"))
    scored = scored_rows(rows, "event_id", "ts", "is_error", *fx.rule_models("event_id", "is_error"))
    append_new(scored, f"{root}/rows", f"{root}/checkpoint")
    log = spark.read.parquet(f"{root}/rows")
    return _report(decision.ab_report(log, "is_error", ["period_start"]), "period_start")


@query
def period_report_stateful(spark, sf_dir):
    """The same report from cells of three ticks, each with a third of the events of every period."""
    root = work_dir(spark, "cells")
    state = PeriodCells(f"{root}/state", "is_error", compact_every=2)
    events = fx.table(spark, sf_dir, "events")
    for tick in range(3):
        events.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == tick).write.mode("append").parquet(f"{root}/in")
        rows = table_stream(spark, f"{root}/in", events.schema).select(
            "event_id", "ts", (F.col("event_type") == "error").cast("int").alias("is_error"))
        run_tick(scored_rows(rows, "event_id", "ts", "is_error", *fx.rule_models("event_id", "is_error")), state, f"{root}/checkpoint")
    return _report(state.current(spark), "period_start")


@query
def sequential_report(spark, sf_dir):
    """After every hour: the gain so far, and whether it may be acted on although one looks every hour."""
    scored = with_period(fx.scored_events(spark, sf_dir), "ts")
    out = sequential.report_by_look(scored, "is_error", bins=100)
    return rounded(out.select("look", "champion_sample_size", "challenger_sample_size", "auc_improvement", "log_ratio", "sequential_p",
                              "sequentially_significant", "promote_now"), "auc_improvement", "log_ratio", "sequential_p")


@query
def holdout_leak_check(spark, sf_dir):
    """Keys of the jobs' default training part that are also in the default holdout: none."""
    tx = fx.transactions(spark, sf_dir).select("tx_id")
    train, _ = sampling.train_test(tx, "tx_id", method="xxhash64")
    held_out = sampling.ab_holdout(tx, "tx_id", method="xxhash64")
    return held_out.join(train, "tx_id", "left_semi").agg(F.count("*").alias("common_rows"))


# --- versions and aliases ----------------------------------------------------------------


@query
def resolve_alias(spark, sf_dir):
    return registry.resolve(fx.alias_log(spark, sf_dir))


@query
def alias_exists(spark, sf_dir):
    """Models that have both a champion and a challenger."""
    log = fx.alias_log(spark, sf_dir)
    return registry.has_alias(log.select("model").distinct(), registry.resolve(log), "champion", "challenger")


def _registered(spark, sf_dir):
    return registry.register(
        fx.training_runs(spark, sf_dir), fx.version_log(spark, sf_dir), fx.alias_log(spark, sf_dir)
    )


@query
def register_version(spark, sf_dir):
    return registry.version_rows(_registered(spark, sf_dir))


@query
def register_aliases(spark, sf_dir):
    return registry.event_rows(_registered(spark, sf_dir))


def _model_decisions(spark, sf_dir):
    scored = fx.scored_events(spark, sf_dir).withColumn("model", F.concat(F.lit("model_"), F.col("user_id")))
    return decision.promotion_gate(decision.ab_report(scored, "is_error", ["model"]), auto_promote=True)


@query
def promotion_status(spark, sf_dir):
    """What became of every test; some winners have lost their challenger alias meanwhile."""
    outcome = registry.promotion_outcome(_model_decisions(spark, sf_dir), fx.alias_log(spark, sf_dir))
    return outcome.select("model", "winner", "should_promote", "promotion_status")


@query
def promote(spark, sf_dir):
    """Alias events of all models whose test was won."""
    return registry.promote(_model_decisions(spark, sf_dir), fx.alias_log(spark, sf_dir))


# --- significance, distribution, slices --------------------------------------------------


@query
def ztest_accuracy(spark, sf_dir):
    m = metrics.with_rates(metrics.confusion(fx.scored_many(spark, sf_dir), ["test", "ab_group"], LABEL))
    out = significance.accuracy_test(decision.compare_groups(m, ["test"]))
    return rounded(out.select("test", "accuracy_z", "accuracy_p_value", "accuracy_significant"), "accuracy_z", "accuracy_p_value")


@query
def ztest_auc(spark, sf_dir):
    m = metrics.group_metrics(fx.scored_many(spark, sf_dir), ["test", "ab_group"], LABEL)
    out = significance.auc_test(decision.compare_groups(m, ["test"]))
    return rounded(out.select("test", "champion_auc_se", "challenger_auc_se", "auc_z", "auc_p_value", "auc_significant"),
                   "champion_auc_se", "challenger_auc_se", "auc_z", "auc_p_value")


def _scored_twice(spark, sf_dir):
    """Every transaction with the scores of both rule models."""
    rows = fx.transactions(spark, sf_dir).select("tx_id", "priority", LABEL)
    for model, name in zip(fx.rule_models(), (decision.CHAMPION, decision.CHALLENGER)):
        rows = models.score_table(model, rows).withColumnRenamed("score", f"{name}_score").drop("prediction")
    return rows


PAIRED_DOUBLES = ["first_auc", "second_auc", "first_auc_se", "second_auc_se", "auc_gain", "paired_z", "paired_p_value"]


@query
def paired_auc(spark, sf_dir):
    """Champion against challenger on the same rows, per priority."""
    out = paired.paired_auc(_scored_twice(spark, sf_dir), ["priority"], LABEL, "champion_score", "challenger_score")
    return rounded(rounded(out, *PAIRED_DOUBLES), "auc_covariance", places=9)


SUMMARY = ["mean", "sd", "low", "high", "share_positive"]


@query
def bootstrap_accuracy(spark, sf_dir):
    values = bootstrap.bootstrap_accuracy(fx.scored_transactions(spark, sf_dir), "tx_id", LABEL, replicates=50, units=1000)
    return rounded(bootstrap.summarise(values), *SUMMARY)


@query
def bootstrap_auc(spark, sf_dir):
    values = bootstrap.bootstrap_auc(fx.scored_transactions(spark, sf_dir), "tx_id", LABEL, replicates=20, units=200, exact=True)
    return rounded(bootstrap.summarise(values), *SUMMARY)


@query
def bootstrap_accuracy_rows(spark, sf_dir):
    values = bootstrap.bootstrap_accuracy(fx.scored_transactions(spark, sf_dir), "tx_id", LABEL, replicates=50)
    return rounded(bootstrap.summarise(values), *SUMMARY)


@query
def bootstrap_auc_rows(spark, sf_dir):
    values = bootstrap.bootstrap_auc(fx.scored_transactions(spark, sf_dir), "tx_id", LABEL, replicates=20, exact=True)
    return rounded(bootstrap.summarise(values), *SUMMARY)


@query
def bootstrap_auc_little(spark, sf_dir):
    values = little_bootstrap.little_bootstrap(fx.scored_transactions(spark, sf_dir), "tx_id", LABEL, replicates=40, bags=8)
    return rounded(little_bootstrap.summarise_bags(values), *SUMMARY)


SLICE_DOUBLES = ["auc", "auc_se", "tied_pairs", "accuracy", "f1_positive", "f1_weighted"]


def _segment_metrics(spark, sf_dir):
    scored = fx.rule_scored(fx.customer_transactions(spark, sf_dir))
    return slices.slice_metrics(scored, LABEL, ["segment", "priority"])


@query
def slice_metrics(spark, sf_dir):
    return rounded(_segment_metrics(spark, sf_dir), *SLICE_DOUBLES)


@query
def slice_bias(spark, sf_dir):
    out = slices.slice_bias(_segment_metrics(spark, sf_dir))
    return rounded(out.select("ab_group", "factor", "segment", "accuracy", "accuracy_gap", "z", "p_value", "q_value", "biased"),
                   "accuracy", "accuracy_gap", "z", "p_value", "q_value")


@query
def slice_lattice(spark, sf_dir):
    """Conditions and pairs of conditions under which a model is wrong more often than their parts explain."""
    scored = fx.rule_scored(fx.customer_transactions(spark, sf_dir)).withColumn("quarter", F.quarter("tx_timestamp"))
    out = lattice.error_lattice(scored, LABEL, ["segment", "priority", "quarter"])
    return rounded(out, "accuracy", "accuracy_gap", "p_value", "q_value")


# --- fitted models -----------------------------------------------------------------------

MODEL_FEATURES = ["tx_amount", "acct_bal"]


def _model_rows(spark, sf_dir):
    """Key, features and a label that follows the features with noise; joined once and written, since a fit reads
    its rows several times."""
    path = work_dir(spark, "model-rows")
    noise = hash_sql("tx_id", quote("noise"))
    rows = fx.customer_transactions(spark, sf_dir).withColumn(
        LABEL, F.expr(f"cast(tx_amount / 500000D + acct_bal / 20000D + {noise} / 2D > 0.9D AS int)"))
    features.select_features(rows, LABEL, "tx_timestamp", TX_EXCLUDE, keep=("tx_id",)).write.parquet(path)
    return spark.read.parquet(path)


MODEL_WEIGHTS = [0.8, 0.2]
AUC_FLOOR = 0.8


def _train_test(rows):
    return sampling.train_test(rows, "tx_id", MODEL_WEIGHTS)


def _fit(rows, model_type, **options):
    return models.fit(_train_test(rows)[0], MODEL_FEATURES, LABEL, model_type, **options)


def _checked(model, test):
    """Holdout size and classes, and whether the metrics are those of MLlib's own evaluators."""
    scored = model.transform(test)
    theirs = {"auc": BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="probability", numBins=0).evaluate(scored)}
    for ours, name in (("accuracy", "accuracy"), ("f1_weighted", "f1")):
        theirs[ours] = MulticlassClassificationEvaluator(labelCol=LABEL, metricName=name).evaluate(scored)
    return models.holdout_metrics(model, test, LABEL).selectExpr(
        "sample_size", "positives", "negatives", "invalid",
        *(f"abs({n} - {v!r}D) < 1e-9 AS {n}_as_mllib" for n, v in theirs.items()), f"auc > {AUC_FLOOR}D AS auc_above_floor")


@query
def train_rf(spark, sf_dir):
    """A whole training job; its stored metrics are compared with the model's."""
    rows, root = _model_rows(spark, sf_dir).withColumn("tx_timestamp", F.lit("")), work_dir(spark, "runs")
    run = train_job(spark, rows, root, key="tx_id", weights=MODEL_WEIGHTS, hash_method="md5")
    stored = {r["name"]: r["value"] for r in RunTables(spark, root).read("metrics").filter(F.col("run_id") == run.run_id).collect()}
    return _checked(run.model, _train_test(rows)[1]).withColumn("metrics_stored", F.lit(stored == run.metrics))


@query
def train_lr(spark, sf_dir):
    rows = _model_rows(spark, sf_dir)
    return _checked(_fit(rows, "lr"), _train_test(rows)[1])


@query
def train_cv(spark, sf_dir):
    train, test = _train_test(_model_rows(spark, sf_dir))
    tuned = models.fit_tuned(train, MODEL_FEATURES, LABEL, "tx_id", grid={"maxDepth": [2, 5]}, folds=2)
    return _checked(tuned.bestModel, test)


@query
def train_halving(spark, sf_dir):
    """Depth and number of trees by successive halving; does it find the winner of the full grid at less than half of its row passes?"""
    train, test = _train_test(_model_rows(spark, sf_dir))
    grid = {"maxDepth": [1, 4], "numTrees": [5, 10], "minInstancesPerNode": [1, 50]}
    best, tried = models.halving(train, MODEL_FEATURES, LABEL, "tx_id", "rf", grid)
    passes, full = sum(t.share for t in tried), 8 * 0.8
    model = models.fit(train, MODEL_FEATURES, LABEL, "rf", **best)
    return _checked(model, test).withColumns({
        "trials": F.lit(len(tried)).cast("bigint"), "deeper_wins": F.lit(best["maxDepth"] == 4), "under_half_of_the_rows": F.lit(passes < full / 2)})


@query
def model_params(spark, sf_dir):
    """Parameters of both kinds of model; of weights only whether the model uses the feature."""
    tables, rows = RunTables(spark, work_dir(spark, "runs")), _model_rows(spark, sf_dir)
    for kind in ("rf", "lr"):
        model = _fit(rows, kind)
        pairs = [(kind, name, value) for name, value in models.fitted_params(model)]
        pairs += [(kind, f"weight_{f}", "used" if w else "unused") for f, w in models.feature_importance(model, MODEL_FEATURES)]
        tables.append("params", spark.createDataFrame(pairs, "run_id string, name string, value string"))
    return tables.read("params")


def _champion_challenger(spark, sf_dir):
    """Champion without the balance, challenger with it; a fifth of the rows have no balance when tested."""
    rows = _model_rows(spark, sf_dir)
    champion = models.fit(_train_test(rows)[0], ["tx_amount"], LABEL, "rf")
    holes = rows.withColumn("acct_bal", F.expr("if(tx_id % 5 = 0, NULL, acct_bal)"))
    assigned = sampling.assign_group(holes, "tx_id", fx.TEST_NAME)
    return models.score_groups(assigned, champion, _fit(rows, "lr"))


@query
def score_champion_challenger(spark, sf_dir):
    """Champion rows are all scored, whatever the challenger needs."""
    return _champion_challenger(spark, sf_dir).selectExpr(
        "tx_id", "ab_group", "score IS NOT NULL AS scored", "coalesce(score BETWEEN 0 AND 1, true) AS in_range",
        "prediction <=> cast(score > 0.5 AS double) AS prediction_follows")


@query
def ab_report_rf(spark, sf_dir):
    report = decision.ab_report(_champion_challenger(spark, sf_dir), LABEL, max_invalid_share=0.2)
    sides = [f"{g}_{c}" for g in ("champion", "challenger") for c in ("sample_size", "invalid", "positives", "negatives")]
    return report.select(*sides, "winner", "status")


@query
def model_round_trip(spark, sf_dir):
    """Saves a model, registers it, loads it by alias; counts rows whose score changed."""
    tables, rows = RunTables(spark, work_dir(spark, "runs")), _model_rows(spark, sf_dir)
    model = _fit(rows, "rf")
    path = f"{tables.root}/models/first"
    save_model(model, path)
    register_run(tables, "first", path, "round_trip", dt.datetime(2001, 8, 1))
    loaded, version = load_by_alias(tables, registry.model_name("round_trip"), decision.CHAMPION)
    before = models.score_table(model, rows).withColumnsRenamed({"score": "_s", "prediction": "_p"})
    both = models.score_table(loaded, before)
    return both.agg(
        F.lit(version).cast("bigint").alias("version"),
        F.count("*").alias("rows"),
        F.count_if((F.col("score") != F.col("_s")) | (F.col("prediction") != F.col("_p"))).alias("changed"),
    )
