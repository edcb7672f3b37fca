"""Views over the test tables that play the part of transactions, models and runs.

Labels of the tables do not depend on their amounts, so no real model can do well on
them. The rule models look at the label instead: they exercise metrics and decisions and
say nothing about model quality.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.functions.hashing import hash_sql, quote, unit_hash
from duelist.operators.decision import CHALLENGER
from duelist.operators.models import rule_model, score_groups
from duelist.operators.sampling import assign_group, assign_group_by
from duelist.sources.tables import read_parquet

TEST_NAME = "ab_test"
CHAMPION_PULL, CHALLENGER_PULL = 0.3, 0.6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions; status F is fraud."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("tx_amount"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("tx_timestamp"),
        (F.col("o_orderstatus") == "F").cast("int").alias("tx_fraud"),
    )


def customer_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with balance and segment of the customer."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_acctbal").alias("acct_bal"),
        F.col("c_mktsegment").alias("segment"),
    )
    return transactions(spark, sf_dir).join(customer, "customer_id", "left")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of the transaction CSV, in another order; errors are fraud."""
    def flag(salt: str, share: float):
        return (unit_hash("event_id", salt) < F.lit(share)).cast("int")

    def distance(salt: str):
        return F.floor(unit_hash("event_id", salt) * 10000) / F.lit(100.0)

    return table(spark, sf_dir, "events").select(
        (F.col("event_type") == "error").cast("int").alias("fraud"),
        F.col("value").alias("amount"),
        F.format_string("tx_%08d", "event_id").alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.hour("ts").alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
        distance("home").alias("distance_from_home"),
        distance("last").alias("distance_from_last_transaction"),
        (F.col("value") / F.lit(16.0)).alias("ratio_to_median_purchase_price"),
        flag("retailer", 0.5).alias("repeat_retailer"),
        flag("chip", 0.8).alias("used_chip"),
        flag("pin", 0.7).alias("used_pin_number"),
        flag("online", 0.4).alias("online_order"),
    )


def rule_score(key: str, label: str, salt: str, pull: float) -> Transformer:
    """Noise plus ``pull`` for positives, scaled to [0, 1), three decimals."""
    return rule_model(f"round(({hash_sql(key, quote(salt))} + {pull}D * {label}) / {1 + pull}D, 3)")


def rule_models(key: str = "tx_id", label: str = "tx_fraud", champion_pull: float = CHAMPION_PULL,
                challenger_pull: float = CHALLENGER_PULL) -> tuple[Transformer, Transformer]:
    return rule_score(key, label, "champ", champion_pull), rule_score(key, label, "chal", challenger_pull)


def rule_scored(df: DataFrame, key: str = "tx_id", label: str = "tx_fraud") -> DataFrame:
    """Group, score and prediction of every row under the two rule models."""
    champion, challenger = rule_models(key, label)
    return score_groups(assign_group(df, key, TEST_NAME), champion, challenger)


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_scored(transactions(spark, sf_dir))


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", (F.col("event_type") == "error").cast("int").alias("is_error")
    )
    return rule_scored(rows, "event_id", "is_error")


# Several tests on the same rows: name, pull of champion and challenger, traffic to the challenger.
MANY_TESTS = [
    ("clear_gain", 0.3, 0.6, 0.5),
    ("small_gain", 0.6, 0.605, 0.5),
    ("loss", 0.6, 0.3, 0.5),
    ("unbalanced", 0.3, 0.6, 0.05),
]


def scored_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all tests at once; the test's name is the salt of its traffic."""
    tests = ", ".join(f"'{n}', {a}D, {b}D, {t}D" for n, a, b, t in MANY_TESTS)
    stack = f"stack({len(MANY_TESTS)}, {tests}) AS (test, champion_pull, challenger_pull, traffic)"
    rows = transactions(spark, sf_dir).selectExpr("tx_id", "tx_fraud", stack)
    noise = hash_sql("tx_id", f"if(ab_group = '{CHALLENGER}', 'chal', 'champ')")
    return (
        assign_group_by(rows, "tx_id", "test", "traffic")
        .selectExpr("*", f"if(ab_group = '{CHALLENGER}', challenger_pull, champion_pull) AS pull")
        .selectExpr("test", "tx_fraud", "ab_group", f"floor(({noise} + pull * tx_fraud) / (1 + pull) * 1000) / 1000D AS score")
        .selectExpr("*", "if(score > 0.5D, 1D, 0D) AS prediction")
    )


def alias_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of alias changes: a model per user, mostly version tags."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("event_seq"),
        F.concat(F.lit("model_"), F.col("user_id")).alias("model"),
        F.when(kind.isin("signup", "purchase"), "champion").otherwise("challenger").alias("alias"),
        F.col("event_id").alias("version"),
        F.when(kind.isin("purchase", "error"), "delete").otherwise("set").alias("op"),
        F.when(F.col("event_id") % 40 == 0, "alias").otherwise("tag").alias("source"),
    )


def version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions that the alias log speaks of."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("model_"), F.col("user_id")).alias("model"),
        F.col("event_id").alias("version"),
        F.concat(F.lit("event_run_"), F.col("event_id")).alias("run_id"),
        F.lit(None).cast("string").alias("path"),
        F.col("event_id").alias("created_seq"),
    )


def training_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as finished training runs, of known models and of new ones."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey") % 400).alias("model"),
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        F.concat(F.lit("/models/"), F.col("o_orderkey")).alias("path"),
        F.col("o_orderkey").alias("run_seq"),
    )
