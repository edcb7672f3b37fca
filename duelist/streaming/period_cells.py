"""The periodic report from cells that a stream keeps up to date.

A tick counts its new rows once into cells (period, group, score step). Cells add up, so the state of a period is the sum of
the cells of all ticks, and no row is kept or read again. What a tick writes is named by its batch id and
overwritten as a whole: a tick that is run again after a failure leaves the same state. Only periods that a tick has
touched get a new report row; late rows touch their own, old period.

Below the root: ``cells/batch_id=N`` (what tick N counted), ``snapshot/upto=N`` (the sum of all ticks up to N) and
``reports/batch_id=N`` (the rows of the periods that tick N touched). A snapshot never holds the newest tick, the only one
that can be repeated, and counts only once its writer has committed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.operators.decision import report_from_metrics
from duelist.operators.metrics import COUNTS, merge_cells, metrics_from_cells, score_cells

KEYS = ["period_start", "ab_group"]


class PeriodCells:
    """Cells and reports of one test below ``root``; ``report`` options are those of ``report_from_metrics``.

    ``bins`` bounds the cells of a period, ``None`` keeps every distinct score. Every ``compact_every`` ticks the cells of the
    ticks before are summed up into a snapshot, so a tick reads at most that many folders beside it.
    """

    def __init__(self, root: str, label: str, bins: int | None = None, compact_every: int = 24, **report):
        if compact_every < 1:
            raise ValueError("compact_every must be at least 1")
        self.root, self.label, self.bins, self.compact_every, self.report = root.rstrip("/"), label, bins, compact_every, report

    def absorb(self, scored: DataFrame, batch_id: int) -> None:
        """Takes the rows of one tick (``period_start``, ``ab_group``, label, score, prediction) and renews the reports of
        their periods. The rows are read once, for the counts."""
        spark = scored.sparkSession
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(spark, batch_id - 1)
        counted = score_cells(scored, KEYS, self.label, bins=self.bins).sortWithinPartitions("period_start")
        counted.write.mode("overwrite").parquet(f"{self.root}/cells/batch_id={batch_id}")
        self.touched_report(spark, batch_id).write.mode("overwrite").parquet(f"{self.root}/reports/batch_id={batch_id}")

    def touched_report(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Report rows of the periods that tick ``batch_id`` has touched, from cells alone."""
        touched = spark.read.parquet(f"{self.root}/cells/batch_id={batch_id}").select("period_start").distinct()
        low, high, unknown = touched.agg(F.min("period_start"), F.max("period_start"), F.max(F.col("period_start").isNull())).first()
        # the bounds reach the scan; a row without a time belongs to the period NULL
        near = F.col("period_start").between(low, high) if low is not None else F.lit(False)
        known = self.cells(spark, batch_id).filter(near | F.col("period_start").isNull() if unknown else near)
        mine = known.join(touched.withColumnRenamed("period_start", "_touched"), F.col("period_start").eqNullSafe(F.col("_touched")), "left_semi")
        return self._reported(mine)

    def _reported(self, cells: DataFrame) -> DataFrame:
        return report_from_metrics(metrics_from_cells(merge_cells(cells, KEYS), KEYS), ["period_start"], **self.report)

    def cells(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """Cells of the last snapshot and of the ticks after it, not yet added up."""
        snapshot, batches = self._snapshot(spark, upto), self._batches(spark, upto)
        paths = [f"{self.root}/cells/batch_id={b}" for b in batches if b > snapshot]
        paths += [f"{self.root}/snapshot/upto={snapshot}"] if snapshot >= 0 else []
        if not paths:
            raise ValueError(f"no tick has been absorbed below {self.root}")
        return spark.read.parquet(*paths).select(*KEYS, "score", *COUNTS)

    def current(self, spark: SparkSession) -> DataFrame:
        """The newest report row of every period."""
        stored = spark.read.parquet(f"{self.root}/reports")
        newest = stored.groupBy("period_start").agg(F.expr("max_by(struct(*), batch_id) AS row"))
        return newest.select("row.*").drop("batch_id")

    def recomputed(self, spark: SparkSession) -> DataFrame:
        """All report rows from the cells, for instance under other options than the stored ones."""
        return self._reported(self.cells(spark))

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Writes the sum of all ticks up to one that can no longer be repeated."""
        if any(b <= upto for b in self._batches(spark, upto)):
            merged = merge_cells(self.cells(spark, upto), KEYS).sortWithinPartitions("period_start")
            if self._snapshot(spark, upto) < upto:
                merged.write.mode("overwrite").parquet(f"{self.root}/snapshot/upto={upto}")

    def _numbers(self, spark: SparkSession, folder: str, name: str) -> list[int]:
        """Numbers of the committed folders ``<name>=N``."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}/{name}=*/_SUCCESS")
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def _batches(self, spark: SparkSession, upto: int | None) -> list[int]:
        return [b for b in self._numbers(spark, "cells", "batch_id") if upto is None or b <= upto]

    def _snapshot(self, spark: SparkSession, upto: int | None) -> int:
        return max((n for n in self._numbers(spark, "snapshot", "upto") if upto is None or n <= upto), default=-1)


def run_tick(scored: DataFrame, state: PeriodCells, checkpoint: str) -> None:
    """Absorbs what the stream has that is new and stops; call it once per schedule tick."""
    query = (
        scored.writeStream.foreachBatch(state.absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
