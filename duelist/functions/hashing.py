"""Uniform numbers that depend only on a row's key, never on file layout or run.

Expressions are SQL text: one round trip to the JVM each, however long they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("md5", "xxhash64")


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hash_sql(key: str | list[str], salt: str, method: str = "md5") -> str:
    """SQL text of a double in [0, 1) from the key (SQL text, or parts of it) and a salt (SQL text).

    ``md5`` can be recomputed in any SQL engine: the first 32 bits of
    ``md5(key || ':' || salt)``. ``xxhash64`` keeps 53 bits and costs a small
    part of the CPU time, for use where nothing outside Spark has to agree.
    Parts of a composite key are joined with ``|``. Keys are hashed as text, so a key has
    the same place whether a file holds it as int, bigint or string.
    """
    parts = [key] if isinstance(key, str) else key
    text = [f"coalesce(cast({p} AS string), 'null')" for p in parts]
    if method == "xxhash64":
        return f"shiftrightunsigned(xxhash64({', '.join(text)}, {salt}), 11) / {2**53}.0D"
    if method != "md5":
        raise ValueError(f"unknown hash method: {method}")
    joined = text[0] if len(text) == 1 else f"concat_ws('|', {', '.join(text)})"
    return f"cast(conv(substr(md5(concat({joined}, ':', {salt})), 1, 8), 16, 10) AS bigint) / {2**32}.0D"


def unit_hash(key: str | list[str], salt: str, method: str = "md5") -> Column:
    """Column form of ``hash_sql``; here the salt is plain text."""
    return F.expr(hash_sql(key, quote(salt), method))


def poisson_thresholds(resolution: float = 2.0**-32) -> list[float]:
    """Cumulative Poisson(1) probabilities, up to the resolution of the uniform."""
    term = cumulative = 2.718281828459045**-1
    out, k = [], 0
    while 1.0 - cumulative > resolution:
        out.append(cumulative)
        k += 1
        term /= k
        cumulative += term
    return out


def poisson_sql(u: str) -> str:
    """Poisson(1) draw by inverting the distribution function at a uniform."""
    return " + ".join(f"cast({u} >= {c!r}D AS int)" for c in poisson_thresholds())
