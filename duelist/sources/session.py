"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def engine_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings the plans rely on; on a cluster give about one shuffle partition per 128 MB."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def object_store_conf(endpoint: str, path_style: bool = True, ssl: bool = True) -> dict[str, str]:
    """Settings of an S3-compatible store. Credentials are not taken here: give them to the
    cluster through its Hadoop configuration or credential provider."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**engine_conf(), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in a local session without it, one below the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/duelist-work"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet below the shared folder and read again: computed once, and a lost executor costs
    a reread. The folder is new for every call."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(df: DataFrame) -> DataFrame:
    """Lets Python workers on this machine import the package from where the driver did; on a cluster, install it or
    pass it with ``--py-files``."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    return df
