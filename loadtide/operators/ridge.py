"""Additive-seasonal ridge: trend, daily harmonics and regressors per series.

A fit needs only the sums of products X'X and X'y. They are plain aggregates,
so they combine on the map side whatever series dominates, and they add up over
time blocks, so any number of backtest windows costs one pass over the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.functions.calendar import elapsed_hours, fourier_columns
from loadtide.functions.exprs import epoch_hours, floor_zero, total
from loadtide.operators import cholesky
from loadtide.schemas import KEYS, LOCAL_TZ, SEASONAL_REGRESSORS, TS

WIDE_DESIGN = 16
#: Hours of one matrix product of a wide design.
GRAM_HOURS = 4096


@dataclass(frozen=True)
class SeasonalSpec:
    """Columns of the design matrix and how the target enters.

    ``cycles`` maps a name to (period in hours, harmonics). ``log_target`` makes
    the parts multiply instead of add.
    """

    regressors: list[str] = field(default_factory=lambda: list(SEASONAL_REGRESSORS))
    cycles: dict[str, tuple[float, int]] = field(default_factory=lambda: {"d": (24.0, 3)})
    alpha: float = 10.0
    log_target: bool = False

    def design(self, df: DataFrame, ts: str, origin: Column | str) -> list[Column]:
        t = elapsed_hours(ts, origin)
        waves = list(fourier_columns(t, self.cycles).values())
        extra = [
            F.coalesce(F.col(r).cast("double"), F.lit(0.0)) if r in df.columns else F.lit(0.0)
            for r in self.regressors
        ]
        return [F.lit(1.0), t / F.lit(8760.0), *waves, *extra]


# The configured full model: yearly and weekly waves, a finer day, holidays,
# multiplied instead of added.
FULL_SPEC = SeasonalSpec(
    regressors=[*SEASONAL_REGRESSORS, "is_holiday"],
    cycles={"d": (24.0, 8), "w": (168.0, 3), "a": (8766.0, 10)},
    log_target=True,
)


def model_frame(
    df: DataFrame,
    target: str = "curtailment_mw",
    regressors: list[str] = SEASONAL_REGRESSORS,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """``ds``, ``y`` and the regressors; an absent or missing regressor is 0."""
    extra = [
        (F.coalesce(F.col(r).cast("double"), F.lit(0.0)) if r in df.columns else F.lit(0.0)).alias(r)
        for r in regressors
    ]
    return df.select(*keys, F.col(ts).alias("ds"), F.col(target).cast("double").alias("y"), *extra)


def train_blocks(
    df: DataFrame, windows: DataFrame, keys: list[str] = KEYS, at: str | Column = TS
) -> DataFrame:
    """Attach ``_block``: the number of the first window whose train span holds
    the row, and ``_windows``, their count. Window ``w`` trains on the blocks up
    to ``w``. Rows after the last train end are dropped."""
    ends = windows.groupBy(*keys).agg(F.sort_array(F.collect_list("train_end")).alias("_ends"))
    moment = F.col(at) if isinstance(at, str) else at
    passed = F.size(F.filter("_ends", lambda e: e <= moment))
    return (
        df.join(ends, keys)
        .withColumns({"_block": passed + 1, "_windows": F.size("_ends")})
        .filter(F.col("_block") <= F.col("_windows"))
        .drop("_ends")
    )


def seasonal_grams(
    df: DataFrame,
    target: str = "curtailment_mw",
    spec: SeasonalSpec = SeasonalSpec(),
    keys: list[str] = KEYS,
    ts: str = TS,
    windows: DataFrame | None = None,
) -> DataFrame:
    """``origin, n, xtx, xty`` per series, and per ``window`` if given.

    ``xtx`` is flattened row by row. The origin of time is the start of the
    series, which all windows share.
    """
    first = df.groupBy(*keys).agg(F.min(ts).alias("origin"))
    rows = df.filter(F.col(target).isNotNull())
    by = list(keys)
    if windows is not None:
        rows = train_blocks(rows, windows, keys, ts)
        by = [*keys, "_block", "_windows"]
    rows = rows.join(first, keys)
    y = F.col(target).cast("double")
    y = F.log1p(F.greatest(y, F.lit(0.0))) if spec.log_target else y
    xs = spec.design(rows, ts, "origin")
    p = len(xs)
    named = rows.select(
        *by, "origin", *[x.alias(f"x{i}") for i, x in enumerate(xs)], y.alias("y"), F.floor(epoch_hours(ts) / GRAM_HOURS).alias("_chunk")
    )
    if p <= WIDE_DESIGN:
        blocks = _summed_products(named, [*by, "origin"], p)
    else:
        blocks = _partial_grams(named, [*by, "origin"], p)
    if windows is None:
        return blocks
    # a block counts for its own and all later windows; one small row per block
    grown = blocks.withColumn("window", F.explode(F.sequence("_block", "_windows")))
    sums = grown.withColumn("sums", F.concat(F.array(F.col("n").cast("double")), "xtx", "xty"))
    return _sum_arrays(sums, [*keys, "window", "origin"], p)


def _summed_products(rows: DataFrame, by: list[str], p: int) -> DataFrame:
    names = [f"x{i}" for i in range(p)]
    sums = {
        f"g{i}_{j}": F.sum(F.col(names[i]) * F.col(names[j])) for i in range(p) for j in range(i, p)
    } | {f"r{i}": F.sum(F.col(names[i]) * F.col("y")) for i in range(p)}
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[s.alias(k) for k, s in sums.items()])
    square = [F.col(f"g{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)]
    return out.select(
        *by, "n", F.array(*square).alias("xtx"), F.array(*[f"r{i}" for i in range(p)]).alias("xty")
    )


def _partial_grams(rows: DataFrame, by: list[str], p: int) -> DataFrame:
    """For wide designs: rows are brought together by group and stretch of time, one matrix product is made for each, and the
    products are added up. ``_chunk`` names the stretch; a group may have any number of them."""
    names = [f"x{i}" for i in range(p)]
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("sums", T.ArrayType(T.DoubleType()))])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, part in pdf.groupby([*by, "_chunk"], sort=False, dropna=False):
                x, y = part[names].to_numpy(), part["y"].to_numpy()
                out.append((*key[:-1], [float(len(part)), *(x.T @ x).ravel(), *(x.T @ y)]))
            if out:
                yield pd.DataFrame(out, columns=[*by, "sums"])

    dealt = rows.repartition(*by, "_chunk").sortWithinPartitions(*by, "_chunk")
    return _sum_arrays(dealt.mapInPandas(partial, schema), by, p)


def _sum_arrays(df: DataFrame, by: list[str], p: int) -> DataFrame:
    """Add up ``sums`` (n, the p x p products, the p right sides) position by position, in one pass: ``n, xtx, xty``."""
    cells = df.select(*by, F.posexplode("sums").alias("_pos", "_v")).groupBy(*by, "_pos").agg(F.sum("_v").alias("_v"))
    whole = cells.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_pos", "_v")))["_v"].alias("_all"))
    return whole.select(
        *by, F.get("_all", F.lit(0)).cast("long").alias("n"), F.slice("_all", 2, p * p).alias("xtx"), F.slice("_all", 2 + p * p, p).alias("xty")
    )


def solve_ridge(grams: DataFrame, alpha: float) -> DataFrame:
    """Replace ``xtx`` and ``xty`` by ``beta``: (X'X + alpha I) beta = X'y."""
    return cholesky.solve(grams, "xtx", "xty", "beta", alpha)


def fit_seasonal_ridge(
    df: DataFrame,
    target: str = "curtailment_mw",
    spec: SeasonalSpec = SeasonalSpec(),
    keys: list[str] = KEYS,
    ts: str = TS,
    windows: DataFrame | None = None,
) -> DataFrame:
    """Coefficients per series (and window): ``origin, n, beta``."""
    return solve_ridge(seasonal_grams(df, target, spec, keys, ts, windows), spec.alpha)


def score_seasonal_ridge(
    df: DataFrame,
    coef: DataFrame,
    spec: SeasonalSpec = SeasonalSpec(),
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """``yhat, yhat_lower, yhat_upper`` for the rows of ``df``.

    ``keys`` name a batch (series, or series and window): the band's width
    comes from the spread of the batch's forecasts. Time counts from the origin
    stored with the coefficients, so trend and daily phase continue.
    """
    rows = df.join(coef.select(*keys, "origin", "beta"), keys)
    xs = spec.design(rows, ts, "origin")
    linear = total([F.get("beta", F.lit(i)) * x for i, x in enumerate(xs)])
    linear = F.expm1(linear) if spec.log_target else linear
    scored = rows.withColumn("yhat", floor_zero(linear)).drop("origin", "beta")
    spread = scored.groupBy(*keys).agg(
        (F.stddev_pop("yhat") * F.lit(0.15) + F.lit(20.0)).alias("_sigma")
    )
    reach = F.lit(1.96) * F.col("_sigma")
    return (
        scored.join(spread, keys)
        .withColumns(
            {"yhat_lower": floor_zero(F.col("yhat") - reach), "yhat_upper": F.col("yhat") + reach}
        )
        .drop("_sigma")
    )


def us_holidays(spark: SparkSession, first_year: int, last_year: int, observed: bool = True) -> DataFrame:
    """Federal holidays by rule: ``date, holiday``, one row per date."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    return _holidays(years, observed)


def holidays_of(df: DataFrame, tz: str = LOCAL_TZ, ts: str = TS, observed: bool = True) -> DataFrame:
    """The holidays of all years that ``df`` has dates in, and of their neighbours."""
    year = F.year(F.from_utc_timestamp(ts, tz))
    near = F.explode(F.array(year - 1, year, year + 1)).alias("y")
    return _holidays(df.select(near).filter("y is not null").distinct(), observed)


def _holidays(years: DataFrame, observed: bool) -> DataFrame:
    """A fixed holiday on a Saturday is also observed on the Friday before, on
    a Sunday on the Monday after."""
    # fixed values: (name, month, day) and (name, month, weekday name, nth; 0 = last)
    fixed = [
        ("New Year's Day", 1, 1),
        ("Juneteenth", 6, 19),
        ("Independence Day", 7, 4),
        ("Veterans Day", 11, 11),
        ("Christmas Day", 12, 25),
    ]
    floating = [
        ("Martin Luther King Jr. Day", 1, "MON", 3),
        ("Washington's Birthday", 2, "MON", 3),
        ("Memorial Day", 5, "MON", 0),
        ("Labor Day", 9, "MON", 1),
        ("Columbus Day", 10, "MON", 2),
        ("Thanksgiving", 11, "THU", 4),
    ]
    days = []
    for name, month, day in fixed:
        date = F.make_date("y", F.lit(month), F.lit(day))
        days.append(F.struct(date.alias("date"), F.lit(name).alias("holiday")))
        if observed:
            moved = F.when(F.dayofweek(date) == 7, F.date_sub(date, 1)).when(F.dayofweek(date) == 1, F.date_add(date, 1))
            days.append(F.struct(moved.alias("date"), F.lit(f"{name} (observed)").alias("holiday")))
    for name, month, weekday, nth in floating:
        start = F.make_date("y", F.lit(month), F.lit(1))
        if nth:
            date = F.date_add(F.next_day(F.date_sub(start, 1), weekday), 7 * (nth - 1))
        else:
            date = F.date_sub(F.next_day(F.last_day(start), weekday), 7)
        days.append(F.struct(date.alias("date"), F.lit(name).alias("holiday")))
    return (
        years.select("y", F.explode(F.array(*days)).alias("d"))
        .select("y", "d.*")
        .filter(F.col("date").isNotNull() & (~F.col("holiday").startswith("Juneteenth") | (F.col("y") >= 2021)))
        .drop("y")
    )
