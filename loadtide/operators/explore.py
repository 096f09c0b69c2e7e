"""Profiles, correlations and the data behind the exploratory plots."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.functions.calendar import local_time
from loadtide.functions.exprs import PLOT_SEASONS, half_even, overgeneration, season
from loadtide.operators.ordering import exact_quantiles
from loadtide.operators.splits import with_row_ramp
from loadtide.schemas import CORRELATED, KEYS, LOCAL_TZ, TS

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def column_info(df: DataFrame) -> DataFrame:
    """``column_name, data_type, non_null`` for every column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*[F.count(c).alias(c) for c in types])
    kind = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return counts.unpivot([], list(types), "column_name", "non_null").select(
        "column_name", kind[F.col("column_name")].alias("data_type"), "non_null"
    )


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum, exact quartiles and maximum per column,
    to two places."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value"
    )
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, ["column_name"], "value", QUARTILES)
    out = basic.join(quartiles, "column_name", "left")
    return out.withColumns(
        {c: half_even(c, 2) for c in ("mean", "std", "min", "q1", "median", "q3", "max")}
    )


def correlations(df: DataFrame, cols: list[str] = CORRELATED) -> DataFrame:
    """Pearson correlations over rows with both values: ``a, b, r``.

    All pairs come from one aggregation. A constant column has none (NULL).
    """
    cols = [c for c in cols if c in df.columns]
    pairs = list(combinations(cols, 2))

    def both(a: str, b: str, c: str) -> Column:
        return F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(c))

    def pearson(a: str, b: str) -> Column:
        scale = F.sqrt(F.var_pop(both(a, b, a)) * F.var_pop(both(a, b, b)))
        return F.try_divide(F.covar_pop(a, b), scale)

    one = df.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ]
    entries += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in cols]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def curtailment_heatmap(df: DataFrame, tz: str = "UTC", ts: str = TS) -> DataFrame:
    """Mean curtailment, one row per month and one column ``h0..h23`` per hour."""
    at = local_time(ts, tz)
    rows = df.select(F.month(at).alias("month"), F.hour(at).alias("hour"), "curtailment_mw")
    of_hour = {h: F.when(F.col("hour") == h, F.col("curtailment_mw")) for h in range(24)}
    return rows.groupBy("month").agg(*[F.avg(v).alias(f"h{h}") for h, v in of_hour.items()])


def net_load_profile(df: DataFrame, tz: str = "UTC", ts: str = TS) -> DataFrame:
    """Mean net load by hour and season."""
    at = local_time(ts, tz)
    return df.groupBy(
        F.hour(at).alias("hour"), season(F.month(at), PLOT_SEASONS).alias("season")
    ).agg(F.avg("net_load_mw").alias("avg_net_load_mw"), F.count("net_load_mw").alias("hours"))


def ramp_boxplot(
    df: DataFrame, hours: int = 3, keys: list[str] = KEYS, tz: str = "UTC", ts: str = TS
) -> DataFrame:
    """Box-plot figures of the net-load ramp per hour of day: quartiles,
    whiskers at the outermost readings within 1.5 box heights, outlier count."""
    rows = df.select(*keys, ts, "net_load_mw")
    ramps = (
        with_row_ramp(rows, "net_load_mw", hours, "ramp", keys, ts)
        .filter(F.col("ramp").isNotNull())
        .select(F.hour(local_time(ts, tz)).alias("hour"), "ramp")
    )
    box = exact_quantiles(ramps, ["hour"], "ramp", QUARTILES)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("ramp").between(F.col("q1") - reach, F.col("q3") + reach)
    # at most 24 boxes, so they are broadcast
    return (
        ramps.join(F.broadcast(box), "hour")
        .groupBy("hour", *QUARTILES)
        .agg(
            F.min(F.when(inside, F.col("ramp"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("ramp"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def estimate_overgeneration(
    df: DataFrame, tz: str = LOCAL_TZ, ts: str = TS, **rule
) -> DataFrame:
    """``overgeneration_mw``: what-if surplus of each hour (see ``overgeneration``)."""
    return df.withColumn("overgeneration_mw", overgeneration(F.hour(local_time(ts, tz)), **rule))
