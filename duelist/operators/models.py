"""Model stages: pipeline, fit, tuned fit, scoring, read-back of parameters."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, ProbabilisticClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from duelist.functions.hashing import hash_sql, quote, unit_hash
from duelist.operators.decision import CHALLENGER
from duelist.operators.features import ON_NULL
from duelist.operators.metrics import group_metrics

# Forest size and depth, default experiment name.
NUM_TREES, MAX_DEPTH = 10, 5
EXPERIMENT = "fraud_detection"
SEED = 42


def run_name(model_type: str, input_path: str, experiment: str = EXPERIMENT) -> str:
    """Default name of a training run: experiment, model type and last part of the input path."""
    return f"{experiment}_{model_type}_{os.path.basename(input_path)}"


def build_pipeline(
    features: list[str],
    label: str,
    model_type: str = "rf",
    on_null: str = "error",
    seed: int = SEED,
    **params,
) -> Pipeline:
    """Assemble, standardise, classify. ``on_null``: fail, skip the row, or impute the mean."""
    if on_null not in ON_NULL:
        raise ValueError(f"on_null must be one of {ON_NULL}")
    stages, inputs = [], list(features)
    if on_null == "impute":
        casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}__num`" for c in features)
        inputs = [f"{c}__filled" for c in features]
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
        stages.append(Imputer(inputCols=[f"{c}__num" for c in features], outputCols=inputs))
    stages.append(
        VectorAssembler(
            inputCols=inputs, outputCol="features_raw", handleInvalid="skip" if on_null == "skip" else "error"
        )
    )
    stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    if model_type == "rf":
        forest = {"numTrees": NUM_TREES, "maxDepth": MAX_DEPTH, **params}
        stages.append(RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **forest))
    elif model_type == "lr":
        stages.append(LogisticRegression(labelCol=label, featuresCol="features", **params))
    else:
        raise ValueError(f"unknown model type: {model_type}")
    return Pipeline(stages=stages)


def repeatable_rows(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Fixed placement and order of rows. A forest's bootstrap depends on both, so this makes
    the fit depend on data and seed only, at the price of one shuffle of the training part."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def fit(train: DataFrame, features: list[str], label: str, model_type: str = "rf", **options) -> PipelineModel:
    return build_pipeline(features, label, model_type, **options).fit(train)


def fit_tuned(
    train: DataFrame,
    features: list[str],
    label: str,
    key: str,
    model_type: str = "rf",
    grid: dict[str, list] | None = None,
    folds: int = 3,
    parallelism: int = 2,
    seed: int = SEED,
    **options,
):
    """Cross-validated fit by AUC. Folds come from the key's hash, so they repeat.

    Returns the ``CrossValidatorModel``; its ``bestModel`` is a ``PipelineModel``.
    """
    pipeline = build_pipeline(features, label, model_type, seed=seed, **options)
    classifier = pipeline.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in (grid or {"maxDepth": [3, MAX_DEPTH]}).items():
        builder.addGrid(classifier.getParam(name), values)
    folded = train.withColumn("_fold", F.floor(unit_hash(key, f"fold{seed}") * folds).cast("int"))
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
        seed=seed,
    )
    return validator.fit(folded)


@dataclass
class Trial:
    """One fit of a tuning: rung, parameters, share of the training rows it saw, AUC on the validation rows."""

    rung: int
    params: dict
    share: float
    auc: float | None


def halving(train: DataFrame, features: list[str], label: str, key: str, model_type: str = "rf", grid: dict[str, list] | None = None,
            eta: int = 4, widen: int | None = None, validation: float = 0.2, bins: int | None = None, seed: int = SEED, **options) -> tuple[dict, list[Trial]]:
    """The best combination of ``grid`` by successive halving, and all that was tried.

    Every rung fits the combinations still in play on a band of the key's hash, keeps the best ``1 / eta`` of them
    by AUC on validation rows, and makes the band ``widen`` times as wide (default: twice ``eta``), up to all rows that
    are not validation rows. Bands are nested and depend on keys only, so a repeated tuning sees the same rows. At most
    ``eta`` combinations are fitted on all rows, and every earlier rung costs half of the next or less. Ties and undefined AUCs (NULL, the worst): the earlier in the grid wins.
    A grid of one combination is returned without a fit; a band that holds one class only is skipped.
    Narrow bands misjudge what depends on the number of rows, such as ``minInstancesPerNode``: tune that with a
    smaller ``widen`` or by ``fit_tuned``.
    """
    if eta < 2 or not 0 < validation < 1:
        raise ValueError("eta must be at least 2 and the validation share between 0 and 1")
    widen = widen or 2 * eta
    grid = grid or {"maxDepth": [3, MAX_DEPTH]}
    left = [dict(zip(grid, values)) for values in product(*grid.values())]
    if not left:
        raise ValueError("a parameter of the grid has no values")
    rungs, n = 0, len(left)
    while n > 1:
        rungs, n = rungs + 1, -(-n // eta)
    u, tried = hash_sql(key, quote(f"halving{seed}"), "xxhash64"), []
    held_out = train.filter(f"{u} >= {1 - validation!r}D")
    for rung in range(rungs):
        share = (1 - validation) * widen ** (rung + 1.0 - rungs)
        band = train.filter(f"{u} < {share!r}D")
        classes = band.filter(f"`{label}` IS NOT NULL").select(label).distinct().limit(2).count()
        if classes < 2:
            continue  # too few rows to tell combinations apart; the next band is wider
        for params in left:
            model = fit(band, features, label, model_type, seed=seed, **{**options, **params})
            row = holdout_metrics(model, held_out, label, bins).first()
            tried.append(Trial(rung, params, share, row["auc"] if row else None))
        order = sorted((t for t in tried if t.rung == rung), key=lambda t: -1.0 if t.auc is None else t.auc, reverse=True)
        left = [t.params for t in order[: -(-len(left) // eta)]]
    return left[0], tried


def tuning_params(tried: list[Trial]) -> list[tuple[str, str]]:
    """The trials of a tuning as (name, value) pairs of its run."""
    return [(f"tune_{k:03d}", json.dumps({"rung": t.rung, "share": t.share, "auc": t.auc, **t.params})) for k, t in enumerate(tried)]


def _stages(model: Transformer) -> list[Transformer]:
    return list(model.stages) if isinstance(model, PipelineModel) else [model]


def _cut(model: Transformer) -> float | None:
    """Probability above which a two-class model says 1, or None if it has no such rule."""
    last = _stages(model)[-1]
    if not isinstance(last, ProbabilisticClassificationModel):
        return None
    if last.isDefined("thresholds") and last.getThresholds():
        return None
    return last.getThreshold() if last.hasParam("threshold") else 0.5


def _columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns]


def _assembled(stage: VectorAssembler, df: DataFrame) -> DataFrame:
    """The stage's vector, NULLs as NaN. MLlib's own assembler is a function that the optimizer must not move;
    for plain numbers this form says the same and can go into a branch."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    inputs = stage.getInputCols()
    if not all(isinstance(kinds.get(c), (NumericType, BooleanType)) for c in inputs):
        return stage.copy({stage.handleInvalid: "keep"}).transform(df)
    values = ", ".join(f"coalesce(cast(`{c}` AS double), double('NaN'))" for c in inputs)
    return df.withColumn(stage.getOutputCol(), array_to_vector(F.expr(f"array({values})")))


def _prepared(model: Transformer, df: DataFrame, name: str, mine: Column | None = None) -> DataFrame:
    """All stages but the classifier; adds ``_<name>_features`` and ``_<name>_ready``.

    With ``mine`` the stages see NULLs in the rows of the other group, and no row is ever dropped or
    raises: a row with a NULL among the assembled columns is not ready.
    """
    if _cut(model) is None:
        return df
    *front, last = _stages(model)
    inputs = [c for s in front if isinstance(s, VectorAssembler) for c in s.getInputCols()]
    own = {c: f"_own_{name}_{i}" for i, c in enumerate(df.columns)}
    out = df
    if mine is not None:
        seen = [F.when(mine, F.col(f"`{c}`")).alias(c) for c in df.columns]
        out = df.select(*[F.col(f"`{c}`").alias(k) for c, k in own.items()], *seen, mine.alias(f"_mine_{name}"))
    for stage in front:
        out = _assembled(stage, out) if isinstance(stage, VectorAssembler) else stage.transform(out)
    ready = " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(cast(`{c}` AS double))" for c in inputs) or "true"
    kept = _columns(df) if mine is None else [F.col(k).alias(c) for c, k in own.items()]
    ready = ready if mine is None else f"_mine_{name} AND {ready}"
    # the condition keeps the stages in a branch even where the optimizer does not merge the projections
    vector = F.when(F.expr(ready), F.col(last.getFeaturesCol()))
    return out.select(*kept, vector.alias(f"_{name}_features"), F.expr(ready).alias(f"_{name}_ready"))


def _scored(model: Transformer, df: DataFrame, name: str) -> DataFrame:
    """Adds ``_<name>_score`` and ``_<name>_given``, the prediction if the score does not fix it.

    A classifier writes only its probability: one function of the features, which the
    optimizer can move into a branch that runs for the rows that need it.
    """
    if _cut(model) is not None:
        last = _stages(model)[-1]
        lean = {last.featuresCol: f"_{name}_features", last.probabilityCol: "_probability",
                last.rawPredictionCol: "", last.predictionCol: ""}
        out = last.copy(lean).transform(df)
        score, given = F.when(F.col(f"_{name}_ready"), vector_to_array("_probability")[1]), F.lit(None)
    else:
        out = model.transform(df)
        score = vector_to_array("probability")[1] if "probability" in out.columns else F.col("score")
        given = F.col("prediction") if "prediction" in out.columns else F.lit(None)
    return out.select(*_columns(df), score.alias(f"_{name}_score"), given.cast("double").alias(f"_{name}_given"))


def _above(score: Column, cut: float | None) -> Column:
    return F.when(score > F.lit(0.5 if cut is None else cut), F.lit(1.0)).when(score.isNotNull(), F.lit(0.0))


def score_table(model: Transformer, df: DataFrame) -> DataFrame:
    """Adds ``score`` (probability of class 1) and ``prediction`` to a table; both are NULL where the model
    cannot take a row, so that the metrics count it as invalid."""
    out = _scored(model, _prepared(model, df, "m"), "m").withColumn("score", F.col("_m_score"))
    prediction = F.coalesce("_m_given", _above(F.col("score"), _cut(model)))
    return out.select(*_columns(df), "score", prediction.alias("prediction"))


def score_groups(df: DataFrame, champion: Transformer, challenger: Transformer, group: str = "ab_group") -> DataFrame:
    """Every row scored by the model of its group, and by that one only: one scan, and one run of one
    model per row, because both models end up in the branches of a CASE, all their stages included. A row that its model cannot take (a NULL
    feature) keeps its place with a NULL score; what the other model needs does not matter to it."""
    mine = F.coalesce(F.col(group) == CHALLENGER, F.lit(False))
    ready = _prepared(challenger, _prepared(champion, df, "champion", ~mine), "challenger", mine)
    both = _scored(challenger, _scored(champion, ready, "champion"), "challenger")
    scored = both.select(
        *_columns(df),
        F.when(mine, F.col("_challenger_score")).otherwise(F.col("_champion_score")).alias("score"),
        F.when(mine, F.col("_challenger_given")).otherwise(F.col("_champion_given")).alias("_given"),
    )
    above = F.when(mine, _above(F.col("score"), _cut(challenger))).otherwise(_above(F.col("score"), _cut(champion)))
    return scored.select(*_columns(df), "score", F.coalesce("_given", above).alias("prediction"))


def rule_model(score_sql: str) -> SQLTransformer:
    """A model that is a SQL expression over the columns; class 1 above 0.5."""
    return SQLTransformer(statement=f"SELECT *, {score_sql} AS score FROM __THIS__")


def holdout_metrics(model: Transformer, test: DataFrame, label: str, bins: int | None = None) -> DataFrame:
    """Metrics of one model on a whole test table, scored once."""
    return group_metrics(score_table(model, test), [], label, bins=bins)


def fitted_params(model: PipelineModel) -> list[tuple[str, str]]:
    """Parameters of the fitted classifier as (name, value) pairs."""
    last = model.stages[-1]
    out = [("model_type", type(last).__name__)]
    if hasattr(last, "getNumTrees"):
        out += [("best_numTrees", str(last.getNumTrees)), ("best_maxDepth", str(last.getMaxDepth()))]
        out += [("seed", str(last.getSeed()))]
    if hasattr(last, "getRegParam"):
        out += [("best_regParam", str(last.getRegParam())), ("best_maxIter", str(last.getMaxIter()))]
    return out


def feature_importance(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    """Weight of each feature in the fitted forest or regression."""
    last = model.stages[-1]
    vector = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    return [(f, float(v)) for f, v in zip(features, vector.toArray(), strict=True)]
