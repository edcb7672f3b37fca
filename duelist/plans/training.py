"""Training job: scan, profile, split, fit, evaluate, store, register."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.operators import models, registry
from duelist.operators.features import dropped_columns, feature_columns, select_features
from duelist.operators.profile import column_profile
from duelist.operators.sampling import SPLIT_SALT, train_test, training_end
from duelist.sources.runs import RunTables, save_model

# Names of the logged training metrics and the columns they come from.
TRAINING_METRICS = {"auc": "auc", "accuracy": "accuracy", "f1": "f1_weighted"}


@dataclass
class TrainingRun:
    run_id: str
    run_name: str
    model: PipelineModel
    features: list[str]
    metrics: dict[str, float | None]
    profile: DataFrame
    version: int | None = None
    #: Columns that are no features because of their type.
    dropped: list[str] = field(default_factory=list)


def train_job(
    spark: SparkSession,
    rows: DataFrame,
    root: str,
    key: str,
    label: str = "tx_fraud",
    time: str = "tx_timestamp",
    exclude: tuple[str, ...] = (),
    model_type: str = "rf",
    tune: dict[str, list] | None = None,
    weights: list[float] | None = None,
    on_null: str = "error",
    experiment: str = models.EXPERIMENT,
    run_name: str | None = None,
    input_path: str = "table",
    output_path: str | None = None,
    auto_register: bool = False,
    stage: bool = False,
    partitions: int | None = None,
    normalise: bool = True,
    bins: int | None = None,
    hash_method: str = "xxhash64",
    now: dt.datetime | None = None,
    **params,
) -> TrainingRun:
    """One training run. ``rows`` is any table, e.g. ``read_parquet(spark, input_path)``.

    A fit reads its rows about five times. ``stage`` writes key, features and label once to
    shared storage and reads them from there: set it when ``rows`` is dear to compute (a
    join, CSV), not for a plain parquet scan, where column pruning does as well.
    ``partitions`` fixes placement and order of the training rows, for a forest that repeats.
    ``tune`` maps parameters to values; the combination is found by successive halving, see ``models.halving``,
    inside the training part, and what every rung found is stored with the run's parameters.
    ``hash_method`` must be the same here and in the A/B job: it decides which rows are held out.
    Any failure is raised. Metrics and parameters go to the run tables under ``root``.
    """
    tables = RunTables(spark, root)
    run_id = uuid.uuid4().hex
    name = run_name or models.run_name(model_type, input_path, experiment)
    now = now or dt.datetime.now()

    excluded = (key, *exclude)
    features = feature_columns(rows, label, time, excluded)
    slim = select_features(rows, label, time, excluded, keep=(key,))
    if stage:
        staged = f"{tables.root}/staging/{run_id}"
        slim.write.parquet(staged)
        slim = spark.read.parquet(staged)
    train, test = train_test(slim, key, weights, method=hash_method, normalise=normalise)
    if partitions:
        train = models.repeatable_rows(train, key, partitions)

    tried = []
    if tune:
        best, tried = models.halving(train, features, label, key, model_type, tune, bins=bins, on_null=on_null, **params)
        params = {**params, **best}
    model = models.fit(train, features, label, model_type, on_null=on_null, **params)
    row = models.holdout_metrics(model, test, label, bins).first()
    metrics = {n: row[c] if row else None for n, c in TRAINING_METRICS.items()}

    settings = {**({"numTrees": models.NUM_TREES, "maxDepth": models.MAX_DEPTH} if model_type == "rf" else {}), **params}
    split = list(split_record(key, training_end(weights, normalise), hash_method).items())
    dropped = dropped_columns(rows, label, time, excluded)
    pairs = [("run_name", name), *split, ("dropped_columns", ",".join(dropped)), *models.tuning_params(tried), *((k, str(v)) for k, v in settings.items()), *models.fitted_params(model)]
    tables.append("params", spark.createDataFrame([(run_id, k, v) for k, v in pairs], "run_id string, name string, value string"))
    tables.append(
        "metrics",
        spark.createDataFrame(
            [(run_id, k, v, 0, now) for k, v in metrics.items()],
            "run_id string, name string, value double, step bigint, logged_at timestamp",
        ),
    )

    path = output_path or f"{tables.root}/models/{run_id}"
    save_model(model, path)
    version = register_run(tables, run_id, path, experiment, now) if auto_register else None
    return TrainingRun(run_id, name, model, features, metrics, column_profile(rows), version, dropped)


def split_record(key: str, end: float, hash_method: str, salt: str = SPLIT_SALT) -> dict[str, str]:
    """What a later test must know to keep its rows apart from the training rows: which part of which hash."""
    return {"split_key": key, "split_salt": salt, "split_hash": hash_method, "split_start": repr(0.0), "split_end": repr(end)}


def register_runs(tables: RunTables, runs: DataFrame) -> DataFrame:
    """Registers any number of runs (model, run_id, path, run_seq); returns the new versions.

    The new rows are staged as a table first: both appends then come from the same rows,
    whatever happens to executors or to the registry tables meanwhile.
    """
    staged = f"{tables.root}/staging/{uuid.uuid4().hex}"
    registry.register(runs, tables.read("versions"), tables.read("alias_events")).write.parquet(staged)
    new = tables.spark.read.parquet(staged)
    tables.append("versions", registry.version_rows(new))
    tables.append("alias_events", registry.event_rows(new))
    return registry.version_rows(new)


def register_run(tables: RunTables, run_id: str, path: str, experiment: str, now: dt.datetime) -> int:
    """Registers one run as the next version of the experiment's model."""
    run = tables.spark.createDataFrame(
        [(registry.model_name(experiment), run_id, path, int(now.timestamp() * 1_000_000))],
        "model string, run_id string, path string, run_seq bigint",
    )
    register_runs(tables, run)
    return tables.read("versions").filter(F.col("run_id") == run_id).first()["version"]
