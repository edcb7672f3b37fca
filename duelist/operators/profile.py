"""Profiling: one aggregation for all columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import quote


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with ``rows`` and ``<column>_nulls`` for every column, in one pass."""
    return df.agg(
        F.expr("count(*) AS rows"),
        *[F.expr(f"count_if(`{c}` IS NULL) AS `{c}_nulls`") for c in columns or df.columns],
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, nullable, rows, nulls, has_nulls (worth a warning)."""
    entries = ", ".join(
        f"{quote(f.name)}, {quote(f.dataType.simpleString())}, {str(f.nullable).lower()}, `{f.name}_nulls`"
        for f in df.schema.fields
    )
    stacked = f"stack({len(df.columns)}, {entries}) AS (name, type, nullable, nulls)"
    return null_counts(df).selectExpr("rows", stacked).selectExpr("*", "nulls > 0 AS has_nulls")


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First rows in key order (a top-n, no full sort)."""
    return df.orderBy(key).limit(n)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows, positive rows and their rate."""
    return df.agg(
        F.count("*").alias("rows"),
        F.sum(F.col(label).cast("bigint")).alias("positives"),
        F.avg(label).alias("positive_rate"),
    )
