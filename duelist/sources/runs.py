"""Append-only tables of runs: metrics, parameters, reports, model versions, alias events.

They take the place of a tracking service. One writer at a time per model is assumed;
readers may come at any time, since nothing is changed in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.operators import registry
from duelist.sources.tables import is_missing

SCHEMAS = {
    "metrics": "run_id string, name string, value double, step bigint, logged_at timestamp",
    "params": "run_id string, name string, value string",
    "reports": "run_id string, test_name string, document string",
    "versions": registry.VERSIONS,
    "alias_events": registry.ALIAS_EVENTS,
}


class RunTables:
    """The tables under one folder of shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table, empty if nothing was written yet."""
        try:
            return self.spark.read.schema(SCHEMAS[table]).parquet(self.path(table))
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return self.spark.createDataFrame([], SCHEMAS[table])

    def append(self, table: str, rows: DataFrame) -> None:
        """Appends rows in the table's column order."""
        columns = self.spark.createDataFrame([], SCHEMAS[table]).columns
        rows.select(*columns).write.mode("append").parquet(self.path(table))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_by_alias(tables: RunTables, model: str, alias: str) -> tuple[PipelineModel, int] | None:
    """The fitted model that an alias of one registered model points to, with its version."""
    aliases = registry.resolve(tables.read("alias_events").filter(F.col("model") == model))
    row = (
        aliases.filter(F.col("alias") == alias)
        .join(tables.read("versions"), ["model", "version"])
        .select("path", "version")
        .first()
    )
    return None if row is None else (PipelineModel.load(row["path"]), row["version"])
