"""Exact metrics whose rows are shuffled once, for scores that hardly repeat.

``metrics.score_cells`` shuffles by (keys, score) and the running sums shuffle the cells again by score bucket. With
few distinct scores the second shuffle is nothing; with continuous ones every row travels twice. Here tasks count their rows per
(keys, score) before any shuffle, in Arrow batches, and the counts are dealt out by (keys, bucket). That one shuffle also
serves the final count per score, the running sums and the bucket totals.

A hot score leaves a task once for every half ``COMBINE_ROWS`` other cells at most, so a third of all rows on one score makes
no hot partition. A count always goes where its score goes: a task that runs again may cut its counts elsewhere and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from duelist.functions.scores import logit_bucket
from duelist.operators.metrics import metrics_from_cells, score_value, usable
from duelist.sources.session import importable

#: Rows and cells that a task holds before it merges them; it passes the cells on if merging does not halve them.
COMBINE_ROWS = 500_000
# what a row says: 0 if it is not usable, else 1 + 2 * label + prediction
_COUNTED = {"positives": "_code >= 3", "negatives": "_code IN (1, 2)", "tp": "_code = 4", "fp": "_code = 2", "invalid": "_code = 0"}


def _counting(names: list[str], limit: int):
    def merged(tables: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(tables).group_by(names, use_threads=False).aggregate([("_n", "sum")])
        return out.select([*names, "_n_sum"]).rename_columns([*names, "_n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]).append_column("_n", pa.repeat(pa.scalar(1, pa.int64()), batch.num_rows)))
            if sum(map(len, held)) >= limit:
                held = [merged(held)]
                if 2 * len(held[0]) > limit:
                    yield from held.pop().to_batches()
        if held:
            yield from merged(held).to_batches()

    return counted


def combined_cells(df: DataFrame, keys: list[str], label: str, score: str = "score", prediction: str = "prediction",
                   bins: int | None = None, bucket: str | None = None, combine_rows: int = COMBINE_ROWS) -> DataFrame:
    """Cells as ``score_cells`` makes them, with their ``_bucket``, dealt out by (keys, bucket).

    Rows that are not usable are counted as invalid under the NULL score. Keys are names of columns of plain types; NULL is a
    key like others. Other columns are not read. No rows give no cells.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    ok = usable(label, prediction, score)
    flat = df.select(
        *(F.col(k).alias(o) for k, o in zip(keys, own)),
        F.expr(f"if({ok}, {score_value(score, bins)}, NULL)").alias("_score"),
        F.expr(f"cast(if({ok}, 1 + 2 * {label} + {prediction}, 0) AS int)").alias("_code"),
    )
    schema = StructType([*flat.schema.fields[: len(own)], StructField("_score", DoubleType()), StructField("_code", IntegerType()),
                         StructField("_n", LongType())])
    counts = importable(flat).mapInArrow(_counting([*own, "_score", "_code"], combine_rows), schema)
    dealt = counts.withColumnRenamed("_score", "score").withColumn("_bucket", F.expr(bucket or logit_bucket("score")))
    cells = dealt.repartition(*own, "_bucket").groupBy(*own, "_bucket", "score").agg(
        *(F.expr(f"sum(if({test}, _n, 0)) AS {c}") for c, test in _COUNTED.items()))
    return cells.withColumnsRenamed(dict(zip(own, keys)))


def combined_metrics(df: DataFrame, keys: list[str], label: str, score: str = "score", prediction: str = "prediction",
                     bins: int | None = None, bucket: str | None = None, combine_rows: int = COMBINE_ROWS) -> DataFrame:
    """What ``group_metrics`` gives, from one shuffle of counts. Worth it where most scores are distinct."""
    return metrics_from_cells(combined_cells(df, keys, label, score, prediction, bins, bucket, combine_rows), keys, "_bucket")
