"""Intermediate tables: computed once, read many times, safe against lost executors."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or the
    warehouse where a session names none. On a cluster a warehouse in the
    driver's own file system is no such folder and is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
    return warehouse.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/loadtide/{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; tables read from it end here."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    safe = re.sub(r"\W+", "_", name)
    return f"{_own_dir(spark)}/{safe}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For results that a job uses several times: the plan below is computed once,
    later reads prune columns, and the planner knows the true size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
