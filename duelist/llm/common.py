"""What the operators share: word arrays, row keys and staged tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.sources.session import shared_dir

# Fixed value: the white space that separates words in the contracts of these operators.
SPACE = r"[\x20\x09-\x0D]"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(df: DataFrame) -> DataFrame:
    """Lets Python workers on this machine import the package from where the driver did; on a cluster, install it or
    pass it with ``--py-files``."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    return df


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of an installed public tokenizer file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet below ``spark.checkpoint.dir`` and read again.

    Used where a result is read more than once, or where later steps rely on row positions: a lost
    executor then costs a reread, never other values. The folder is new for every call.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Runs of characters other than white space; NULL and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def plain_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; NULL texts have none."""
    plain = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]++", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def word_hashes(array: Column) -> Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def window_hashes(hashes: str, size: int) -> Column:
    """Hash of every ``size`` consecutive elements of the named array column; none if it is shorter."""
    parts = ", ".join(f"a[i + {k}]" for k in range(size))
    # the one-element array binds the column to a lambda variable, which is read faster than a column
    return F.expr(
        f"if(size({hashes}) < {size}, cast(array() as array<bigint>), transform(array({hashes}), a -> "
        f"transform(sequence(0, size(a) - {size}), i -> xxhash64({parts})))[0])"
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
