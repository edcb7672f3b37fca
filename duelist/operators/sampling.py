"""Splits, samples, traffic assignment and seeded order, all from a hash of the key.

Because a row's place depends only on its key, parts stay disjoint and complete for
any file layout, number of executors or retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelist.functions.hashing import hash_sql, quote

SPLIT_SALT = "42"
POSITION_BUCKETS = 1 << 16
#: Buckets whose offsets are summed in one task.
OFFSET_RUN = 4096

# Default split weights of the training job and of the A/B job.
TRAIN_TEST_WEIGHTS = [0.005, 0.0001]
AB_HOLDOUT_WEIGHTS = [0.005, 0.00001]


def fractions(weights: list[float]) -> list[float]:
    """Weights scaled to sum to 1, which is how ``randomSplit`` reads them."""
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    return [w / sum(weights) for w in weights]


def _cuts(shares: dict[str, float]) -> list[tuple[str, float, float]]:
    if min(shares.values()) < 0 or sum(shares.values()) > 1 + 1e-9:
        raise ValueError("shares must be non-negative and sum to at most 1")
    out, low = [], 0.0
    for name, share in shares.items():
        out.append((name, low, low + share))
        low += share
    if low >= 1 - 1e-9:  # a full split must reach 1 whatever the rounding
        name, start, _ = out[-1]
        out[-1] = (name, start, 1.0)
    return out


def _bands(u: str, shares: dict[str, float]) -> str:
    whens = " ".join(f"WHEN {u} < {high!r}D THEN {quote(name)}" for name, _, high in _cuts(shares))
    return f"CASE {whens} END"


def split(df: DataFrame, key: str | list[str], shares: dict[str, float],
          salt: str = SPLIT_SALT, method: str = "md5", column: str = "split") -> DataFrame:
    """Adds the band name (NULL above the last band), for one-pass work over several parts."""
    u = df.selectExpr("*", f"{hash_sql(key, quote(salt), method)} AS _u")
    return u.selectExpr("*", f"{_bands('_u', shares)} AS {column}").drop("_u")


def split_parts(df: DataFrame, key: str | list[str], shares: dict[str, float],
                salt: str = SPLIT_SALT, method: str = "md5") -> dict[str, DataFrame]:
    """One lazy DataFrame per band. ``method='random'`` uses ``randomSplit`` (layout dependent)."""
    if method == "random":
        rest = 1.0 - sum(shares.values())
        weights = [*shares.values(), *([rest] if rest > 1e-9 else [])]
        return dict(zip(shares, df.randomSplit(weights, seed=int(salt)), strict=False))
    u = hash_sql(key, quote(salt), method)
    return {name: df.filter(_inside(u, low, high)) for name, low, high in _cuts(shares)}


def _inside(u: str, low: float, high: float) -> str:
    """low <= u < high, without the bounds that always hold (each would hash once more)."""
    parts = [f"{u} >= {low!r}D"] * (low > 0) + [f"{u} < {high!r}D"] * (high < 1)
    return " AND ".join(parts) or "true"


def train_test(df: DataFrame, key: str | list[str], weights: list[float] | None = None, salt: str = SPLIT_SALT,
               method: str = "md5", normalise: bool = True) -> tuple[DataFrame, DataFrame]:
    """Train and test parts in the ratio of two weights.

    ``normalise=False`` takes the weights as fractions of the whole table, the rest is unused.
    """
    weights = weights or TRAIN_TEST_WEIGHTS
    train, test = fractions(weights) if normalise else weights
    parts = split_parts(df, key, {"train": train, "test": test}, salt, method)
    return parts["train"], parts["test"]


def ab_holdout(df: DataFrame, key: str | list[str], weights: list[float] | None = None, salt: str = SPLIT_SALT,
               method: str = "md5", normalise: bool = True) -> DataFrame:
    """Top band of the training split's own hash, as wide as the second weight's share.

    No training row can be in it as long as the training share and it fit into 1.
    """
    low = holdout_start(weights, normalise)
    return df.filter(_inside(hash_sql(key, quote(salt), method), low, 1.0))


def training_end(weights: list[float] | None = None, normalise: bool = True) -> float:
    """Hash value at which the training band ends."""
    weights = weights or TRAIN_TEST_WEIGHTS
    return fractions(weights)[0] if normalise else weights[0]


def holdout_start(weights: list[float] | None = None, normalise: bool = True) -> float:
    """Hash value at which the holdout band starts."""
    weights = weights or AB_HOLDOUT_WEIGHTS
    if not normalise and sum(weights) > 1 + 1e-9:
        raise ValueError("fractions must sum to at most 1")
    return fractions(weights)[0] if normalise else 1.0 - weights[1]


def sample(df: DataFrame, key: str | list[str], fraction: float,
           salt: str = SPLIT_SALT, method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """A sample without replacement and its complement, both by predicate (no join)."""
    u = hash_sql(key, quote(salt), method)
    return df.filter(f"{u} < {fraction!r}D"), df.filter(f"{u} >= {fraction!r}D")


def exact_split(df: DataFrame, key: str | list[str], fraction: float, by: tuple[str, ...] = (), salt: str = SPLIT_SALT,
                method: str = "md5", column: str = "sampled") -> DataFrame:
    """Marks exactly ``floor(fraction * rows + 0.5)`` rows, per class if ``by`` names columns, whatever the layout.

    The marked rows are those with the smallest hash of the key. Where the hash has to end is found by counting,
    without a sort of the table: rows per 16 bits of hash and class, a running sum over these at most 65,536
    counts of a class, and a closer look at the one step where the sum passes the wanted number. Only rows of that
    step are shuffled and ordered, by the rest of the hash and then by a hash of the whole row; equal rows are one
    row with a number there, so neither a key nor a row that makes up much of the table is a task of its own.

    Rows with equal keys, NULL keys too, are told apart by their other columns; of equal rows any are taken. NULL
    classes are a class. An empty table stays empty. Columns must be of types that can be grouped (no maps).
    The table is read three times: counts, rows off the step, rows on it.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    if column in df.columns or any(c.startswith("_ex_") for c in df.columns):
        raise ValueError(f"the table has a column {column} or one that starts with _ex_")
    u = hash_sql(key, quote(salt), method)
    hashed = df.selectExpr("*", f"cast(floor({u} * {2**32}D) AS bigint) AS _ex_h")
    steps = hashed.groupBy(*by, F.expr("shiftright(_ex_h, 16) AS _ex_step")).agg(F.expr("count(*) AS _ex_rows"))
    part = f"PARTITION BY {', '.join(f'`{c}`' for c in by)}" if by else "PARTITION BY 1"
    edge = steps.selectExpr(
        "*", f"sum(_ex_rows) OVER ({part} ORDER BY _ex_step) AS _ex_upto",
        f"cast(floor({fraction!r}D * sum(_ex_rows) OVER ({part}) + 0.5D) AS bigint) AS _ex_want",
    ).selectExpr(
        # the first step that reaches the wanted number; its rows before are all marked
        *(f"`{c}`" for c in by), "_ex_step AS _ex_edge", "_ex_want - (_ex_upto - _ex_rows) AS _ex_left", "_ex_want", "_ex_upto",
        "_ex_rows").filter("_ex_upto >= _ex_want AND (_ex_upto - _ex_rows < _ex_want OR (_ex_want = 0 AND _ex_upto = _ex_rows))")
    edge = edge.select(*by, "_ex_edge", "_ex_left")
    names = [f"`{c}`" for c in df.columns]
    if by:
        joined = _join_null_safe(hashed, edge, list(by))
    else:  # one row, or none for an empty table
        row = edge.first()
        joined = hashed.selectExpr("*", f"{row['_ex_edge'] if row else 0}L AS _ex_edge", f"{row['_ex_left'] if row else 0}L AS _ex_left")
    off = joined.filter("shiftright(_ex_h, 16) <> _ex_edge").selectExpr(*names, f"shiftright(_ex_h, 16) < _ex_edge AS `{column}`")
    on = joined.filter("shiftright(_ex_h, 16) = _ex_edge").groupBy(*df.columns, "_ex_h", "_ex_left").agg(F.expr("count(*) AS _ex_copies"))
    on = on.selectExpr("*", f"xxhash64({', '.join(names)}) AS _ex_row")
    keys = [key] if isinstance(key, str) else key
    order = ", ".join(["_ex_h", "shiftright(_ex_row, 48)", *keys, "_ex_row"])
    placed = with_position(on, order, "(_ex_h & 65535) * 65536 + shiftright(_ex_row, 48) + 32768", by, "_ex_at", weight="_ex_copies")
    marked = placed.selectExpr(*names, "explode(sequence(1L, _ex_copies)) AS _ex_k", "_ex_at", "_ex_left").selectExpr(
        *names, f"_ex_at + _ex_k <= _ex_left AS `{column}`")
    return off.unionByName(marked)


def exact_sample(df: DataFrame, key: str | list[str], fraction: float, by: tuple[str, ...] = (),
                 salt: str = SPLIT_SALT, method: str = "md5") -> tuple[DataFrame, DataFrame]:
    """A sample of exact size, see ``exact_split``, and its complement."""
    marked = exact_split(df, key, fraction, by, salt, method, "_sampled")
    return marked.filter("_sampled").drop("_sampled"), marked.filter("NOT _sampled").drop("_sampled")


def complement(df: DataFrame, part: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is not in ``part``, for parts that did not come from a hash.

    Keys are made distinct first, so a key with very many rows in ``part`` is one row of the join.
    """
    keys = [key] if isinstance(key, str) else key
    return df.join(part.select(*keys).distinct(), keys, "left_anti")


def assign_group(df: DataFrame, key: str | list[str], test_name: str = "ab_test",
                 traffic_split: float = 0.5, method: str = "md5", column: str = "ab_group") -> DataFrame:
    """``challenger`` for a share of keys, else ``champion``. The salt is the test name, so
    assignment is repeatable, independent of the split and new for every test."""
    return assign_group_by(df, key, quote(test_name), f"{float(traffic_split)!r}D", method, column)


def assign_group_by(df: DataFrame, key: str | list[str], test_name: str, traffic_split: str,
                    method: str = "md5", column: str = "ab_group") -> DataFrame:
    """The same with test name and traffic given as columns (SQL text): many tests at once."""
    u = hash_sql(key, test_name, method)
    return df.selectExpr("*", f"if({u} < {traffic_split}, 'challenger', 'champion') AS {column}")


def with_position(df: DataFrame, order: str, bucket: str, keys: tuple[str, ...] = (),
                  column: str = "position", weight: str | None = None) -> DataFrame:
    """Dense position 0, 1, 2, ... in the given total order (SQL text), per ``keys``.

    With ``weight`` (SQL text) a row stands for so many equal ones; its position is that of the first.

    ``bucket`` (SQL text) must never decrease along the order. Rows are numbered inside a
    bucket and shifted by the number of rows in earlier buckets, so no task holds a whole
    key. Offsets are one row per (keys, bucket). They are summed on two levels, inside runs of
    ``OFFSET_RUN`` buckets and over the runs, so a key with very many buckets is not one task either.
    NULL keys and NULL order values are values like others.
    """
    by = ", ".join([*keys, "_bucket"])
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    rows = df.selectExpr("*", f"{bucket} AS _bucket")
    counted = rows.groupBy(*keys, "_bucket").agg(F.expr(f"sum({weight or 1}) AS _rows")).selectExpr("*", f"floor(_bucket / {OFFSET_RUN}) AS _run")
    inner = counted.selectExpr(
        *keys, "_bucket", "_run",
        f"coalesce(sum(_rows) OVER (PARTITION BY {', '.join([*keys, '_run'])} ORDER BY _bucket {earlier}), 0) AS _inner",
    )
    outer = counted.groupBy(*keys, "_run").agg(F.expr("sum(_rows) AS _rows")).selectExpr(
        *keys, "_run", f"coalesce(sum(_rows) OVER ({part}ORDER BY _run {earlier}), 0) AS _outer"
    )
    offsets = _join_null_safe(inner, outer, [*keys, "_run"]).selectExpr(*keys, "_bucket", "_inner + _outer AS _offset")
    window = f"OVER (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    numbered = rows.selectExpr("*", f"sum({weight}) {window} - {weight} + 1 AS _rn" if weight else f"row_number() {window} AS _rn")
    return (
        _join_null_safe(numbered, offsets, [*keys, "_bucket"])
        .selectExpr("*", f"_offset + _rn - 1 AS {column}")
        .drop("_bucket", "_rn", "_offset")
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    return left.join(renamed, on).drop(*(f"_right_{k}" for k in keys))


def seeded_shuffle(df: DataFrame, key: str, salt: str = SPLIT_SALT, buckets: int = POSITION_BUCKETS,
                   column: str = "position", method: str = "md5") -> DataFrame:
    """Position of every row in a random order that depends only on key and salt.

    Hash buckets are even by construction: 10^11 rows make about 1.5 million per bucket.
    """
    shuffled = df.selectExpr("*", f"{hash_sql(key, quote(salt), method)} AS _u")
    return with_position(shuffled, f"_u, {key}", f"cast(floor(_u * {buckets}) AS int)", column=column).drop("_u")


def row_label(position: str) -> Column:
    """Row id text, at least eight digits."""
    # Fixed value: id format.
    return F.format_string("tx_%08d", position)
