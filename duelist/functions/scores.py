"""Monotone buckets of a score, used to split a long running sum into short ones (SQL text)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Buckets per unit of log-odds: scores between 1e-6 and 1 - 1e-6 use 28,000 buckets, all
# doubles in (0, 1) at most 750,000. So 10^11 distinct scores make some millions per bucket,
# while the bucket totals of a group stay a small sort.
BUCKETS_PER_LOGIT = 1024
_LOW, _HIGH = 1e-300, 1.0 - 1e-16


def logit_bucket(score: str) -> str:
    """Bucket number that never decreases with the score.

    Log-odds keep fine resolution near 0 and 1, where fraud scores crowd. Outside (0, 1), where raw
    margins lie, buckets follow the logarithm of the distance, so they spread too. For other
    distributions cut points can be fitted: ``score_splits`` and ``split_bucket``.
    """
    inside = f"least(greatest({score}, {_LOW!r}D), {_HIGH!r}D)"
    above, below = f"least(greatest({score} - 1D, 0D), 1e300D)", f"least(greatest(0D - {score}, 0D), 1e300D)"
    return (
        f"cast(floor({BUCKETS_PER_LOGIT}D * ln({inside} / (1D - {inside}))) "
        f"+ floor({BUCKETS_PER_LOGIT}D * asinh({above})) - floor({BUCKETS_PER_LOGIT}D * asinh({below})) AS int)"
    )


def split_bucket(score: str, splits: list[float]) -> str:
    """Bucket number from sorted cut points, as a balanced tree of comparisons."""
    cuts = sorted(set(splits))

    def pick(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"if({score} < {cuts[mid]!r}D, {pick(lo, mid)}, {pick(mid + 1, hi)})"

    return pick(0, len(cuts))


def score_splits(df: DataFrame, score: str, buckets: int = 256, error: float = 1e-3) -> list[float]:
    """Cut points of about equally full buckets; only these few numbers reach the driver."""
    probs = [i / buckets for i in range(1, buckets)]
    return df.approxQuantile(score, probs, error)
