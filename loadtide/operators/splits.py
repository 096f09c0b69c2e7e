"""Temporal splits, rolling windows and horizons.

Positions are hours before the newest hour of the series, found by one
aggregation per series, never by numbering all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.functions.exprs import epoch_hours, plus_hours
from loadtide.operators.chunking import row_lag
from loadtide.schemas import KEYS, TS


def with_age(df: DataFrame, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """``_age``: hours before the newest hour; ``_hours``: length of the series."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_first"), F.max(ts).alias("_end"))
    return (
        df.join(ends, keys)
        .withColumns(
            {
                "_age": epoch_hours("_end") - epoch_hours(ts),
                "_hours": epoch_hours("_end") - epoch_hours("_first") + 1,
            }
        )
        .drop("_first", "_end")
    )


def _long_enough(needed: int, what: str, on_short: str) -> Column:
    """Filter condition: drop or reject series shorter than ``needed`` hours."""
    ok = F.col("_hours") >= needed
    if on_short == "skip":
        return ok
    return F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"a series is too short for {what}: {needed} hours needed")).cast("boolean")
    )


def label_splits(
    df: DataFrame,
    test_hours: int = 48,
    val_hours: int = 168,
    keys: list[str] = KEYS,
    ts: str = TS,
    on_short: str = "error",
) -> DataFrame:
    """``split``: train, val or test by time, on a gap-free grid."""
    aged = with_age(df, keys, ts).filter(
        _long_enough(test_hours + val_hours + 100, "the splits", on_short)
    )
    split = (
        F.when(F.col("_age") < test_hours, "test")
        .when(F.col("_age") < test_hours + val_hours, "val")
        .otherwise("train")
    )
    return aged.withColumn("split", split).drop("_age", "_hours")


def rolling_windows(
    df: DataFrame,
    n: int = 4,
    size: int = 48,
    val_hours: int = 168,
    include_last: bool = False,
    keys: list[str] = KEYS,
    ts: str = TS,
    on_short: str = "error",
) -> DataFrame:
    """One row per series and backtest window, oldest first:
    ``window, train_end, test_start, test_end`` (ends exclusive).

    ``train_end`` leaves out the validation hours before the test. The newest
    ``size`` hours are tested only with ``include_last``.
    """
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_first"), F.max(ts).alias("_end"))
    ends = ends.withColumn("_hours", epoch_hours("_end") - epoch_hours("_first") + 1).filter(
        _long_enough(size * n + 168 + 48, "the backtest windows", on_short)
    )
    back = F.lit(n) - F.col("window") + (0 if include_last else 1)
    test_end = plus_hours("_end", (F.lit(1) - back * size).cast("int"))
    return (
        ends.withColumn("window", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("test_end", test_end)
        .withColumn("test_start", plus_hours("test_end", -size))
        .withColumn("train_end", plus_hours("test_start", -val_hours))
        .select(*keys, "window", "train_end", "test_start", "test_end")
    )


def window_rows(
    df: DataFrame, windows: DataFrame, start: str, end: str, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Rows of each window's span ``[start, end)``, by an equi-join on the hour.

    The spans are short (days), so their hours are listed instead of comparing
    every row with every window.
    """
    hours = windows.withColumn(
        ts, F.explode(F.sequence(F.col(start), plus_hours(end, -1), F.expr("interval 1 hour")))
    )
    return df.join(hours, [*keys, ts])


def cutoff_windows(
    df: DataFrame,
    initial_days: int = 730,
    period_days: int = 90,
    horizon_days: int = 2,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Cross-validation windows with growing train: cutoffs every ``period_days``
    back from the last possible one, as long as ``initial_days`` come before."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_first"), F.max(ts).alias("_end"))
    room = epoch_hours("_end") - epoch_hours("_first") - 24 * (initial_days + horizon_days)
    return (
        ends.withColumn("_room", room)
        .filter("_room >= 0")
        .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_room") / (24 * period_days)))))
        .withColumn("test_end", plus_hours("_end", (F.lit(1) - F.col("_k") * 24 * period_days).cast("int")))
        .withColumn("test_start", plus_hours("test_end", -24 * horizon_days))
        .withColumn(
            "window", (F.floor(F.col("_room") / (24 * period_days)) - F.col("_k") + 1).cast("int")
        )
        .select(*keys, "window", F.col("test_start").alias("train_end"), "test_start", "test_end")
    )


def first_hours(df: DataFrame, n: int, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """The first ``n`` hours of each series."""
    start = df.groupBy(*keys).agg(F.min(ts).alias("_start"))
    return df.join(start, keys).filter(F.col(ts) < plus_hours("_start", n)).drop("_start")


def sample_window(
    df: DataFrame, start: int, hours: int, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Hours ``start`` to ``start + hours`` of each series of a gap-free grid."""
    begin = df.groupBy(*keys).agg(F.min(ts).alias("_start"))
    at = epoch_hours(ts) - epoch_hours("_start")
    return df.join(begin, keys).filter(at.between(start, start + hours - 1)).drop("_start")


def fit_to_horizon(
    fc: DataFrame, hours: int, cols: list[str], keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Cut a forecast to ``hours`` rows per series, or repeat its last values."""
    span = fc.groupBy(*keys).agg(
        F.min(ts).alias("_start"), F.max(F.struct(ts, *cols)).alias("_last")
    )
    axis = span.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))).select(
        *keys, plus_hours("_start", F.col("_k")).alias(ts), "_last"
    )
    rows = axis.join(fc.select(*keys, ts, *cols), [*keys, ts], "left")
    beyond = F.col(ts) > F.col("_last")[ts]
    return rows.select(
        *keys, ts, *[F.when(beyond, F.col("_last")[c]).otherwise(F.col(c)).alias(c) for c in cols]
    )


def persistence(
    df: DataFrame,
    col: str = "curtailment_mw",
    lag_hours: int = 168,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """``persistence_mw``: the value of the same hour ``lag_hours`` earlier.

    A join on the shifted time, which is exact with gaps too and spreads each
    series by its hours.
    """
    earlier = df.select(
        *keys, plus_hours(ts, lag_hours).alias(ts), F.col(col).alias("persistence_mw")
    )
    return df.join(earlier, [*keys, ts], "left")


def with_row_ramp(
    df: DataFrame, col: str, hours: int, name: str, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """``name``: change of ``col`` against the row ``hours`` rows before."""
    lagged = row_lag(df, {col: f"_before_{col}"}, hours, keys, ts)
    return lagged.withColumn(name, F.col(col) - F.col(f"_before_{col}"))
