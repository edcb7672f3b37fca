"""A/B job: resolve models, take the holdout, score, decide, promote, store."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from duelist.functions.hashing import quote
from duelist.operators import decision, models, registry
from duelist.operators.features import select_features
from duelist.operators.profile import column_profile
from duelist.operators.sampling import ab_holdout, assign_group, holdout_start
from duelist.plans.training import split_record
from duelist.sources.runs import RunTables, load_by_alias

#: Characters of an error's text that its record keeps.
MAX_REASON = 4000


@dataclass
class AbRun:
    run_id: str
    status: str
    reason: str | None
    report: Row | None = None
    #: Types and NULL counts of the input columns; lazy, costs a pass over the input when shown.
    profile: DataFrame | None = None


def ab_job(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    key: str,
    label: str = "tx_fraud",
    time: str = "tx_timestamp",
    exclude: tuple[str, ...] = (),
    weights: list[float] | None = None,
    experiment: str = models.EXPERIMENT,
    traffic_split: float = 0.5,
    test_name: str = "ab_test",
    auto_promote: bool = False,
    normalise: bool = True,
    bins: int | None = None,
    max_invalid_share: float = 0.0,
    hash_method: str = "xxhash64",
    now: dt.datetime | None = None,
) -> AbRun:
    """One A/B test of the experiment's champion against its challenger.

    Missing models, refused holdouts and undefined metrics end in a typed status with a stored result
    document; other errors are stored with the status ``error`` and raised. Everything is decided before anything is written, aliases move last.
    ``bins`` trades the exact AUC for one on that many score steps, without the sort of all distinct scores.
    ``max_invalid_share`` is the share of rows without a usable label or score that a test survives.
    """
    tables, run_id, now = RunTables(spark, root), uuid.uuid4().hex, now or dt.datetime.now()
    try:
        run = _test(tables, rows, run_id, now, key, label, time, exclude, weights, experiment, traffic_split, test_name, auto_promote,
                    normalise, bins, max_invalid_share, hash_method)
    except Exception as error:
        try:
            refused(tables, run_id, test_name, now, "error", f"{type(error).__name__}: {str(error)[:MAX_REASON]}")
        except Exception as second:  # the first error is the one to see
            error.add_note(f"and no record could be written: {second}")
        raise
    run.profile = column_profile(rows)
    return run


def _test(tables: RunTables, rows: DataFrame, run_id: str, now: dt.datetime, key: str, label: str, time: str, exclude: tuple[str, ...],
          weights: list[float] | None, experiment: str, traffic_split: float, test_name: str, auto_promote: bool, normalise: bool,
          bins: int | None, max_invalid_share: float, hash_method: str) -> AbRun:
    spark, name = tables.spark, registry.model_name(experiment)
    loaded = {}
    for alias in (decision.CHAMPION, decision.CHALLENGER):
        loaded[alias] = load_by_alias(tables, name, alias)
        if loaded[alias] is None:
            return refused(tables, run_id, test_name, now, "skipped", f"no {alias} model")
    champion, challenger = loaded[decision.CHAMPION][0], loaded[decision.CHALLENGER][0]
    tested = loaded[decision.CHALLENGER][1]
    start = holdout_start(weights, normalise)
    problem = holdout_problem(tables, name, [v for _, v in loaded.values()], split_record(key, start, hash_method))
    if problem:
        return refused(tables, run_id, test_name, now, "failed", problem)

    slim = select_features(rows, label, time, (key, *exclude), keep=(key,))
    test = ab_holdout(slim, key, weights, method=hash_method, normalise=normalise)
    scored = models.score_groups(assign_group(test, key, test_name, traffic_split, hash_method), champion, challenger)
    report = decision.promotion_gate(
        decision.ab_report(scored, label, test_name=test_name, traffic_split=traffic_split, bins=bins,
                           max_invalid_share=max_invalid_share), auto_promote
    ).withColumns({"run_id": F.lit(run_id), "timestamp": F.lit(now), "model": F.lit(name),
                    "challenger_version": F.lit(tested)})
    decided = spark.createDataFrame([report.first()], report.schema)  # one row per test; the scored rows are not read again
    log = tables.read("alias_events").filter(F.col("model") == name)
    events = registry.promote(decided, log).collect()  # at most three rows
    row = registry.promotion_outcome(decided, log).first()
    store(tables, spark.createDataFrame([row], report.schema))
    if events:
        tables.append("alias_events", spark.createDataFrame(events, registry.ALIAS_EVENTS))
    return AbRun(run_id, row["status"], row["reason"], row)


def refused(tables: RunTables, run_id: str, test_name: str, now: dt.datetime, status: str, reason: str) -> AbRun:
    """Stores the record of a test that was not run."""
    row = [(run_id, test_name, json.dumps({"timestamp": str(now), "test_name": test_name, "status": status, "reason": reason}))]
    tables.append("reports", tables.spark.createDataFrame(row, "run_id string, test_name string, document string"))
    return AbRun(run_id, status, reason)


def holdout_problem(tables: RunTables, model: str, versions: list[int], holdout: dict[str, str]) -> str | None:
    """Why a holdout may hold rows that one of the versions was trained on; None if it cannot.

    ``holdout`` is a split record whose end is where the holdout starts. A version's own record must
    name the same key, salt and hash, and end no later. Without a complete record nothing can be said.
    """
    same = " AND ".join(f"max(value) FILTER (WHERE name = '{n}') = {quote(holdout[n])}" for n in ("split_key", "split_salt", "split_hash"))
    end = "try_cast(max(value) FILTER (WHERE name = 'split_end') AS double)"
    known = (
        tables.read("versions")
        .filter((F.col("model") == model) & F.col("version").isin(versions))
        .select("version", "run_id").join(tables.read("params").filter(F.col("name").startswith("split_")), "run_id", "left")
        .groupBy("version")
        .agg(F.count_distinct("name").alias("n"), F.expr(f"coalesce({same}, false)").alias("same"), F.expr(end).alias("end"))
        .collect()  # one row per version of the test, so two at most
    )
    if len(known) < len(set(versions)) or any(r["n"] < len(holdout) or r["end"] is None for r in known):
        return "training split of a model is not recorded"
    if not all(r["same"] for r in known):
        return "training split by another key, salt or hash"
    if any(r["end"] > float(holdout["split_end"]) for r in known):
        return "holdout overlaps training rows"
    return None


def store(tables: RunTables, report: DataFrame) -> None:
    """Metrics, parameters and the result document of finished tests."""
    metrics = decision.metrics_long(report, ["run_id", "timestamp"])
    tables.append("metrics", metrics.withColumn("step", F.lit(0)).withColumnRenamed("timestamp", "logged_at"))
    tables.append("params", decision.params_long(report, ["run_id"]))
    documents = decision.document_json(report, ["run_id"]).withColumn("test_name", F.get_json_object("document", "$.test_name"))
    tables.append("reports", documents)

