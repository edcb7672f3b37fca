"""Normal tail and z statistics, as SQL text."""

from __future__ import annotations

# Abramowitz and Stegun, Handbook of Mathematical Functions, formula 7.1.26
# (error function, absolute error below 1.5e-7).
ERF_P = 0.3275911
ERF_A = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]

# Two-sided 5 % point of the standard normal.
Z_95 = 1.959963984540054


def ratio(a: str, b: str) -> str:
    """a / b as a double, NULL where b is 0."""
    return f"try_divide(cast({a} AS double), cast({b} AS double))"


def two_sided_p(z: str) -> str:
    """P(|Z| > |z|) = erfc(|z| / sqrt 2) for a standard normal Z."""
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1D / (1D + {ERF_P}D * {x}))"
    poly = "0D"
    for a in reversed(ERF_A):
        poly = f"(({poly} + {a}D) * {t})"
    return f"if({z} IS NULL, NULL, least(1D, greatest(0D, {poly} * exp(-{x} * {x}))))"


def two_proportion_z(hits_a: str, n_a: str, hits_b: str, n_b: str) -> str:
    """Pooled two-proportion z of a minus b; NULL where it is undefined."""
    pooled = ratio(f"({hits_a}) + ({hits_b})", f"({n_a}) + ({n_b})")
    variance = f"{pooled} * (1D - {pooled}) * ({ratio('1', n_a)} + {ratio('1', n_b)})"
    return f"try_divide({ratio(hits_a, n_a)} - {ratio(hits_b, n_b)}, sqrt({variance}))"
