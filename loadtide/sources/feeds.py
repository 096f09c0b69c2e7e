"""Landed fuel pages, station files and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.schemas import FUEL_COLUMNS, FUEL_PAGE, FUELS, KEYS


def load_fuel_pages(
    spark: SparkSession,
    path: str,
    respondents: list[str] | None = None,
    fuels: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    page_per_line: bool = False,
) -> DataFrame:
    """Rows of all landed JSON pages under ``path``, filtered and typed.

    A file holds one page, or with ``page_per_line`` a page in each line, which
    lets Spark split large files.

    ``start`` and ``end`` are inclusive hour texts such as ``2023-12-31T23``.
    All of ``fuels`` are kept. Unparseable hours are dropped.
    """
    rows = (
        spark.read.schema(FUEL_PAGE)
        .option("multiLine", not page_per_line)
        .json(path)
        .select(F.explode("response.data").alias("r"))
        .select("r.*")
    )
    if respondents:
        rows = rows.filter(F.col("respondent").isin(respondents))
    if fuels:
        rows = rows.filter(F.col("fueltype").isin(fuels))
    # fixed-width hour texts order like the hours themselves
    if start:
        rows = rows.filter(F.col("period") >= start)
    if end:
        rows = rows.filter(F.col("period") <= end)
    return rows.select(
        F.col("respondent").alias("series_id"),
        F.try_to_timestamp(F.col("period"), F.lit("yyyy-MM-dd'T'HH")).alias("ts"),
        "fueltype",
        F.col("value").try_cast("double").alias("value_mw"),
    ).filter(F.col("ts").isNotNull())


def pivot_fuel_mix(
    feed: DataFrame, keys: list[str] = KEYS, ts: str = "ts", fuels: list[str] = FUELS
) -> DataFrame:
    """Long feed to one row per hour with a column per fuel.

    One conditional sum per fuel: a ``pivot`` would shuffle twice, first by
    (hour, fuel) and then by hour. The sums combine on the map side whatever
    hour or series is hot.
    """
    value, fuel = F.col("value_mw"), F.col("fueltype")
    return feed.groupBy(*keys, ts).agg(
        *[F.sum(F.when(fuel == f, value)).alias(FUEL_COLUMNS.get(f, f)) for f in fuels]
    )


def load_stations(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All station CSV files under ``path``; the file name carries the station."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .csv(path)
        .withColumn(
            "station_id",
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:_\d{4})?\.csv[^/]*$", 1),
        )
    )


def union_stations(frames: dict[str, DataFrame]) -> DataFrame:
    """Stack per-station frames, which need not have the same columns."""
    tagged = [df.withColumn("station_id", F.lit(name)) for name, df in frames.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def load_forecast(spark: SparkSession, path: str, ts: str = "ts") -> DataFrame:
    """Latest exported forecast; a textual time column is parsed."""
    df = spark.read.parquet(path)
    return df.withColumn(ts, F.to_timestamp(ts))


def publish_forecast(df: DataFrame, path: str, run: str) -> None:
    """Add a forecast as the run named ``run``; names grow from run to run. Publishing one again replaces it.

    The rows come first, the entry that makes them visible last, so a run that was not written to its end is never read.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/runs/run={run}")
    rows = spark.read.parquet(f"{path}/runs/run={run}").count()
    spark.createDataFrame([(run, rows)], "run string, rows long").coalesce(1).write.mode("overwrite").parquet(f"{path}/published/entry={run}")


def published_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run, rows`` of all complete runs."""
    return spark.read.parquet(f"{path}/published").select("run", "rows")


def latest_forecast(
    spark: SparkSession, path: str, as_of: str | None = None, keys: list[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Of every hour the row of the newest complete run, or of the newest up to ``as_of``, with its ``run``.

    Only the folders of complete runs are listed for reading; the list has a name per run.
    """
    runs = published_runs(spark, path)
    names = [r.run for r in (runs.filter(F.col("run") <= as_of) if as_of else runs).select("run").distinct().collect()]
    if not names:
        raise ValueError(f"{path}: no run is complete")
    rows = spark.read.option("basePath", f"{path}/runs").parquet(*[f"{path}/runs/run={n}" for n in sorted(names)])
    rows = rows.withColumn("run", F.col("run").cast("string"))
    rest = [c for c in rows.columns if c not in (*keys, ts)]
    newest = rows.groupBy(*keys, ts).agg(F.max_by(F.struct(*rest), "run").alias("_r"))
    return newest.select(*keys, ts, *[F.col(f"_r.{c}").alias(c) for c in rest])


EXPORTED_ACTUALS = {
    "curtailment_mw": "actual_curtailment_mw",
    "net_load_mw": "net_load_mw",
    "solar_generation_mw": "solar_generation_mw",
    "wind_generation_mw": "wind_generation_mw",
    "temperature_c": "temperature_c",
}


def export_forecast(
    forecast: DataFrame, dispatch: DataFrame, keys: list[str] = KEYS, ts: str = "ts"
) -> DataFrame:
    """Forecast rows with the observed values of the same hour next to them."""
    observed = dispatch.select(
        *keys, ts, *[F.col(c).alias(name) for c, name in EXPORTED_ACTUALS.items()]
    )
    return forecast.join(observed, [*keys, ts], "left")
