"""Files in, files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.functions.exprs import nan_to_null


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in this package is UTC; pin the session to it.

    The Java compiler skips methods above 8000 bytes of code, and the generated
    code of a hundred feature columns is longer. With the limit set to that
    size, Spark splits such plans into smaller methods that do get compiled.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet or CSV by suffix, or a directory of Parquet files.

    With ``schema`` the columns arrive with its types and NaN becomes NULL.
    """
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2] if "." in path.rsplit("/", 1)[-1] else ""
    if suffix == "csv":
        reader = spark.read.option("header", True)
        df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    elif suffix in ("parquet", ""):
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file format: {path}")
    return conform(df, schema) if schema else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` that exist, cast, with NaN as NULL."""
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            col = F.col(f.name).cast(f.dataType)
            out.append((nan_to_null(col) if isinstance(f.dataType, T.DoubleType) else col).alias(f.name))
    if not out:
        raise ValueError("none of the expected columns is present")
    return df.select(*out)


def select_available(df: DataFrame, cols: list[str]) -> DataFrame:
    """The requested columns that exist, in the requested order."""
    present = [c for c in cols if c in df.columns]
    if not present:
        raise ValueError(f"none of the requested columns is present: {cols}")
    return df.select(*present)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    rows_per_file: int = 5_000_000,
) -> None:
    """Parquet sink. Rows of one partition value are spread over as many tasks
    as the shuffle has, then cut at ``rows_per_file``, so that neither a hot
    partition value nor a flood of small files hurts."""
    writer = df
    if partition_by:
        # rebalance lets AQE both split large partition values and merge small ones
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = writer.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def with_year(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Partition column for long histories."""
    return df.withColumn("year", F.year(ts))


def write_scorecard(df: DataFrame, path: str) -> None:
    """JSON lines, one object per scorecard row."""
    df.write.mode("overwrite").json(path)


def read_scorecard(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_state(df: DataFrame, path: str, run_id: str) -> None:
    """Model parameters (coefficients, scalers, weights) of one run."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def read_state(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("run_id") == run_id).drop("run_id")
