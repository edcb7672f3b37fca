"""Feature selection by type, standardising, column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ON_NULL = ("error", "skip", "impute")


def feature_columns(df: DataFrame, label: str, time: str | None = None, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns a vector can hold: numeric, boolean or decimal, less label, time and ``exclude``."""
    out = {label, time, *exclude}
    return [
        f.name
        for f in df.schema.fields
        if f.name not in out and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def dropped_columns(df: DataFrame, label: str, time: str | None = None, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns that ``feature_columns`` leaves out because of their type."""
    kept = set(feature_columns(df, label, time, exclude))
    return [c for c in df.columns if c not in kept and c not in {label, time, *exclude}]


def select_features(
    df: DataFrame, label: str, time: str | None = None, exclude: tuple[str, ...] = (), keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep`` columns, features and label only, so that the scan reads nothing else."""
    return df.select(*keep, *feature_columns(df, label, time, exclude), label)


def standardise(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """(x - mean) / sample standard deviation per column; a constant column becomes 0.

    The moments are computed at once, by a job over these columns only, and enter the plan as one row of
    numbers; the result itself then reads ``df`` a single time.
    """
    values = [F.expr(f"{f}(`{c}`)").cast("double") for c in columns for f in ("avg", "stddev_samp")]
    row = df.agg(*values).first()
    number = lambda v: "cast(NULL AS double)" if v is None else f"{v!r}D"
    scaled = [
        f"CASE WHEN {number(row[2 * i + 1])} > 0 THEN (`{c}` - {number(row[2 * i])}) / {number(row[2 * i + 1])} "
        f"WHEN `{c}` IS NOT NULL THEN 0D END AS `{c}_scaled`"
        for i, c in enumerate(columns)
    ]
    return df.selectExpr(*keep, *scaled)


def reorder(df: DataFrame, order: list[str]) -> DataFrame:
    """The given columns in the given order."""
    return df.select(*order)


def union_classes(negative: DataFrame, positive: DataFrame, label: str) -> DataFrame:
    """Stacks the two class parts, with a constant class column on each."""
    return negative.withColumn(label, F.lit(0)).unionByName(positive.withColumn(label, F.lit(1)))
