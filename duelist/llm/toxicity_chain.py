"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic regressions over words and word beginnings (insults
take endings). A later model also sees the log odds that the earlier ones give. For training these are out-of-fold: rows of a fold are
scored by a model that has not seen them, so a later model learns to trust its predecessors only as far as they
carry over to new texts. In use the models trained on all rows take their place.

Training reads a bounded sample of labelled rows, about ``MAX_TRAIN``, those with the smallest hash of the id; folds are hashes as
well, so nothing depends on row order. The vocabulary is all that occurs in ``MIN_TEXTS`` texts and a share ``MIN_SHARE`` of the sample; an L1
penalty leaves some thousand weights that matter. One grouped count finds the vocabulary, and fitting runs as Spark ML jobs. Scoring
keeps only entries with a weight in some model, and works out once per different word which of them it is or begins with; every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from duelist.llm.common import fresh, importable, plain_words, staged

CATEGORIES = ("quality", "toxic")
MAX_TRAIN = 20_000
#: A vocabulary entry occurs in so many texts of the sample, and in this share of them: rarer ones carry no weight to speak of.
MIN_TEXTS, MIN_SHARE = 5, 0.001
PREFIXES = (3, 4, 5, 6, 7)
FOLDS = 3
MAX_ITER = 30
REG = 3e-4
#: The sample is bounded, so few tasks hold it; up to four tasks add up their gradients in one stage an iteration.
FIT_TASKS = 4
CACHE_WORDS = 500_000
#: What ``plain_words`` splits a lower-case text into.
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Chain:
    """One model per category, in order; ``constants`` holds the probability where labels know one class only."""

    categories: tuple[str, ...]
    vocabulary: CountVectorizerModel | None
    models: list[LogisticRegressionModel | None]
    constants: list[float]


def _tokens(words: str) -> Column:
    """Different words and word beginnings. How often does not count, so long texts do not outweigh short ones."""
    begins = ", ".join(map(str, PREFIXES))
    return F.expr(
        f"transform(array(array_distinct({words})), w -> array_distinct(concat(w, flatten(transform(w, x -> "
        f"transform(filter(array({begins}), n -> n < length(x)), n -> concat(left(x, n), '*')))))))[0]")


def _inputs(df: DataFrame, k: int) -> DataFrame:
    """``_x``: word indicators and the log odds of the first ``k`` categories."""
    if not k:
        return df.withColumn("_x", F.col("_words"))
    return VectorAssembler(inputCols=["_words", *(f"_odds{i}" for i in range(k))], outputCol="_x").transform(df)


def _odds(p: Column) -> Column:
    """Log odds, bounded, and scaled so that a sure predecessor is one feature among others."""
    return F.log(F.greatest(p, F.lit(1e-4)) / F.greatest(1 - p, F.lit(1e-4))) / 4


def _fit(df: DataFrame, label: str):
    learner = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=MAX_ITER, regParam=REG, elasticNetParam=1.0, standardization=False,
                                 probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_y")
    return learner.fit(df.coalesce(FIT_TASKS))


def _probability(df: DataFrame, model: LogisticRegressionModel | None, constant: float, out: str) -> DataFrame:
    if model is None:
        return df.withColumn(out, F.lit(constant))
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("_p")[1]).drop("_raw", "_p", "_y")


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, text: str = "text", doc_id: str = "doc_id",
        max_train: int = MAX_TRAIN) -> Chain:
    """Trains the chain on documents that have all labels. Rows with a NULL label or id are left out; NULL texts have no
    words. Without labelled rows, or with labels of one class, a category is that constant (0 without rows)."""
    known = labels.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in categories)).groupBy(doc_id).agg(
        *(F.max(c).cast("double").alias(c) for c in categories))
    share = min(1.0, max_train / max(known.count(), 1))
    chosen = F.pmod(F.xxhash64(doc_id), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = known.filter(chosen).select(F.col(doc_id).alias("_id"), *categories)
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(sample, "_id")
    rows = staged(texts.select("_id", *categories, F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).alias("_fold"),
                               plain_words(F.col("_text")).alias("_plain")).withColumn("_tokens", _tokens("_plain")).drop("_plain"),
                  "toxicity-tokens")
    enough = max(MIN_TEXTS, MIN_SHARE * rows.count())
    often = rows.select(F.explode("_tokens").alias("t")).groupBy("t").count().filter(F.col("count") >= enough)
    names = [t for t, _ in sorted(often.collect(), key=lambda r: (-r["count"], r["t"]))]
    vocabulary = CountVectorizerModel.from_vocabulary(names, "_tokens", "_words", binary=True) if names else None
    chain = Chain(categories, vocabulary, [], [])
    if vocabulary is not None:
        rows = staged(vocabulary.transform(rows).drop("_tokens"), "toxicity-train")
    for k, category in enumerate(categories):
        if vocabulary is not None:
            rows = _inputs(rows, k)
        by_fold = {r["_fold"]: (r["n"], r["y"]) for r in rows.groupBy("_fold").agg(F.count("*").alias("n"), F.sum(category).alias("y")).collect()}
        n, y = (sum(v[i] for v in by_fold.values()) for i in (0, 1))
        constant = y / n if n else 0.0
        chain.constants.append(constant)
        chain.models.append(_fit(rows, category) if vocabulary is not None and 0 < y < n else None)
        if k + 1 == len(categories):
            break
        held_out = None
        for fold in sorted(by_fold):
            rest_n, rest_y = n - by_fold[fold][0], y - by_fold[fold][1]
            other = rows.filter(F.col("_fold") != fold)
            model = _fit(other, category) if vocabulary is not None and 0 < rest_y < rest_n else None
            part = _probability(rows.filter(F.col("_fold") == fold), model, rest_y / rest_n if rest_n else constant, "_now")
            held_out = part if held_out is None else held_out.unionByName(part)
        if held_out is None:
            held_out = rows.withColumn("_now", F.lit(constant))
        rows = staged(held_out.withColumn(f"_odds{k}", _odds(F.col("_now"))).drop("_now", "_x"), "toxicity-train")
    return chain


def _entries(chain: Chain) -> tuple[dict[str, int], np.ndarray]:
    """Vocabulary entries with a weight in some model, numbered, and their weights (entries x categories)."""
    if chain.vocabulary is None:
        return {}, np.zeros((0, len(chain.categories)))
    names = chain.vocabulary.vocabulary
    weights = np.zeros((len(names), len(chain.categories)))
    for k, model in enumerate(chain.models):
        if model is not None:
            weights[:, k] = model.coefficients.toArray()[: len(names)]
    used = np.flatnonzero(weights.any(axis=1))
    return {names[i]: k for k, i in enumerate(used)}, weights[used]


def _scores(chain: Chain, column: str, names: list[str]):
    entries, weights = _entries(chain)
    later = [None if m is None else (m.intercept, m.coefficients.toArray()[len(m.coefficients) - k :] if k else np.empty(0))
             for k, m in enumerate(chain.models)]
    constants = chain.constants
    begins = sorted({len(t) - 1 for t in entries if t.endswith("*")})

    def found(word: str) -> tuple[int, ...]:
        own = [word, *(word[:n] + "*" for n in begins if n < len(word))]
        return tuple(entries[t] for t in own if t in entries)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            texts = batch.column(column)
            sums = np.zeros((batch.num_rows, len(names)))
            for i in range(batch.num_rows):
                if not (own := set(_WORD.findall((texts[i].as_py() or "").lower()))):
                    continue
                if len(known) > CACHE_WORDS:
                    known.clear()
                for word in own.difference(known):
                    known[word] = found(word)
                if hits := set().union(*filter(None, map(known.__getitem__, own))):
                    sums[i] = weights[sorted(hits)].sum(axis=0)
            odds, out = [], []
            for k, model in enumerate(later):
                p = np.full(batch.num_rows, constants[k])
                if model is not None:
                    margin = sums[:, k] + model[0] + sum((w * o for w, o in zip(model[1], odds)), np.zeros(batch.num_rows))
                    p = 1 / (1 + np.exp(-margin))
                out.append(pa.array(p))
                odds.append(np.log(np.maximum(p, 1e-4) / np.maximum(1 - p, 1e-4)) / 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, *names])

    return scored


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` for every category of the chain; all other columns pass through. NULL, empty and
    wordless texts have the models' intercepts for a score; repeated rows are scored alike; an empty table stays empty."""
    names = [fresh(docs, f"p_{c}") for c in chain.categories]
    schema = StructType([*docs.schema.fields, *(StructField(n, DoubleType()) for n in names)])
    return importable(docs).mapInArrow(_scores(chain, text, names), schema)


def flag(docs: DataFrame, chain: Chain, category: str = "toxic", threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Documents at or above the threshold in one category."""
    return score(docs, chain, text).filter(F.col(fresh(docs, f"p_{category}")) >= threshold)
