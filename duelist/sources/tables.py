"""Table readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Columns of the transaction CSV, in order.
TRANSACTION_COLUMNS = [
    "transaction_id",
    "timestamp",
    "amount",
    "hour_of_day",
    "day_of_week",
    "distance_from_home",
    "distance_from_last_transaction",
    "ratio_to_median_purchase_price",
    "repeat_retailer",
    "used_chip",
    "used_pin_number",
    "online_order",
    "fraud",
]
_TYPES = {"transaction_id": "string", "timestamp": "timestamp_ntz"} | {
    c: "double" for c in TRANSACTION_COLUMNS if c == "amount" or c.startswith(("distance", "ratio"))
}
TRANSACTION_SCHEMA = ", ".join(f"`{c}` {_TYPES.get(c, 'int')}" for c in TRANSACTION_COLUMNS)


# Text form of times, to the microsecond; Spark's default keeps milliseconds.
_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_parquet(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Parquet scan. A given schema saves reading footers to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, mode: str = "FAILFAST",
             times: dict[str, str] | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which reads the data twice.

    ``times`` gives time formats as reader options; by default Spark takes ISO text of any precision.
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.options(**(times or {})).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV parts with a header each, written where the rows are."""
    df.write.mode(mode).option("header", True).options(**_TIMES).csv(path)


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"
