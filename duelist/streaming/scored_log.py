"""Incremental scoring for periodic reports.

Each scheduled run takes the files that came since the last one, scores them and appends
them to a log; the checkpoint makes every input row appear once, also after a failed run.
The period report then reads the log. No row is too late: it lands in its own period.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duelist.operators.models import score_groups
from duelist.operators.sampling import assign_group
from duelist.plans.periodic import PERIOD, with_period


def scored_rows(
    rows: DataFrame, key: str, time: str, label: str, champion: Transformer, challenger: Transformer,
    test_name: str = "ab_test", traffic_split: float = 0.5, period: str = PERIOD,
) -> DataFrame:
    """The few columns a report needs, for a batch or a stream."""
    scored = score_groups(assign_group(rows, key, test_name, traffic_split), champion, challenger)
    return with_period(scored, time, period).select(
        F.to_date("period_start").alias("period_date"), "period_start", "ab_group", label, "score", "prediction"
    )


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_tick: int = 1000) -> DataFrame:
    """A stream of a Parquet table's files, whether ``path`` is a folder of part files or one file.

    A tick works through everything that is new, at most ``files_per_tick`` files at a time.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_tick)
    # a file source lists folders; a folder that is named like the file is found by its parts
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(folder)


def append_new(scored: DataFrame, log_path: str, checkpoint: str) -> None:
    """Processes what is there now and stops; call it once per schedule tick. Rows are clustered by date, so a tick
    writes few files for each."""
    query = (
        scored.repartition("period_date").writeStream.format("parquet")
        .partitionBy("period_date")
        .option("path", log_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
