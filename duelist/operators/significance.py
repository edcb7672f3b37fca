"""Is the effect real? Independent-sample tests, since the groups hold different rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duelist.functions.stats import Z_95, two_proportion_z, two_sided_p


def accuracy_test(wide: DataFrame, z_limit: float = Z_95) -> DataFrame:
    """Two-proportion z of the accuracies; needs the columns of ``compare_groups``."""
    sides = [
        (f"{g}_tp + {g}_tn", f"{g}_positives + {g}_negatives") for g in ("challenger", "champion")
    ]
    z = two_proportion_z(*sides[0], *sides[1])
    return _verdict(wide.selectExpr("*", f"{z} AS accuracy_z"), "accuracy", z_limit)


def auc_test(wide: DataFrame, z_limit: float = Z_95) -> DataFrame:
    """z of the AUC difference with DeLong standard errors of the two groups."""
    se = "sqrt(challenger_auc_se * challenger_auc_se + champion_auc_se * champion_auc_se)"
    z = f"try_divide(challenger_auc - champion_auc, {se})"
    return _verdict(wide.selectExpr("*", f"{z} AS auc_z"), "auc", z_limit)


def _verdict(df: DataFrame, name: str, z_limit: float) -> DataFrame:
    z = f"{name}_z"
    return df.selectExpr(
        "*",
        f"{two_sided_p(z)} AS {name}_p_value",
        f"coalesce(abs({z}) > {z_limit!r}D, false) AS {name}_significant",
    )
