"""The A/B report per event-time period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelist.operators.decision import ab_report

# Fixed value: period of the train-and-test schedule.
PERIOD = "60 minutes"


def with_period(df: DataFrame, time: str, period: str = PERIOD, column: str = "period_start") -> DataFrame:
    """Start of the tumbling window a row's event time falls in, NULL without a time.

    ``window`` on its own would drop rows without a time.
    """
    kind = df.schema[time].dataType.simpleString()
    start = F.window(F.expr(f"coalesce({time}, cast('2000-01-01' AS {kind}))"), period)["start"]
    return df.withColumn("_start", start).selectExpr("*", f"if({time} IS NULL, NULL, _start) AS {column}").drop("_start")


def report_by_period(scored: DataFrame, time: str, label: str, period: str = PERIOD, **options) -> DataFrame:
    """One report row per period."""
    return ab_report(with_period(scored, time, period), label, ["period_start"], **options)
