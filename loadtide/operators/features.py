"""Leak-free features per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from loadtide.functions.calendar import (
    calendar_columns,
    elapsed_hours,
    fourier_columns,
    is_daylight,
    solar_steps,
)
from loadtide.functions.exprs import event_label, net_load, penetration
from loadtide.operators.chunking import CHUNK_HOURS, over_chunks
from loadtide.schemas import (
    EVENT_MW,
    KEYS,
    LAG_HOURS,
    LAGGED,
    RAMP_HOURS,
    ROLLED,
    ROLLING_HOURS,
    SITE_LATITUDE,
    SITE_LONGITUDE,
    TS,
)


def with_net_load(df: DataFrame) -> DataFrame:
    return df.withColumn("net_load_mw", net_load())


def with_calendar(df: DataFrame, tz: str = "UTC", ts: str = TS) -> DataFrame:
    return df.withColumns(calendar_columns(ts, tz))


def with_solar(
    df: DataFrame, lat: float = SITE_LATITUDE, lon: float = SITE_LONGITUDE, ts: str = TS
) -> DataFrame:
    out, done = df, {}
    for name, step in solar_steps(ts, lat, lon):
        out = out.withColumn(name, step(done))
        done[name] = F.col(name)
    helpers = [n for n in done if n.startswith("_")]
    return out.withColumn("is_daylight", is_daylight("solar_elevation_deg")).drop(*helpers)


def with_origin(df: DataFrame, keys: list[str] = KEYS, ts: str = TS, name: str = "_origin") -> DataFrame:
    """First time of each series, from a map-side combined aggregate."""
    first = df.groupBy(*keys).agg(F.min(ts).alias(name))
    return df.join(first, keys)


def with_fourier(
    df: DataFrame,
    orders: dict[str, tuple[float, int]] | None = None,
    origin: Column | str | None = None,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Harmonics of the hours since ``origin`` (default: start of the series)."""
    out = df if origin is not None else with_origin(df, keys, ts)
    elapsed = elapsed_hours(ts, "_origin" if origin is None else origin)
    out = out.withColumn("_elapsed", elapsed).withColumns(fourier_columns(F.col("_elapsed"), orders))
    return out.drop("_elapsed") if origin is not None else out.drop("_elapsed", "_origin")


# ---- lags and ramps ---------------------------------------------------------
def lag_columns(
    w: WindowSpec, cols: list[str], lags: list[int] = LAG_HOURS, ramps: list[int] = RAMP_HOURS
) -> dict[str, Column]:
    out = {f"{c}_lag_{k}h": F.lag(c, k).over(w) for c in cols for k in lags}
    return out | {f"{c}_ramp_{k}h": F.col(c) - F.lag(c, k).over(w) for c in cols for k in ramps}


def with_lags_and_ramps(
    df: DataFrame,
    cols: list[str] = LAGGED,
    lags: list[int] = LAG_HOURS,
    ramps: list[int] = RAMP_HOURS,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """Lags and ramps of a gap-free grid, and the renewable share of demand."""
    cols = [c for c in cols if c in df.columns]
    out = over_chunks(
        df,
        lambda rows, w: rows.withColumns(lag_columns(w, cols, lags, ramps)),
        back=max([*lags, *ramps]),
        keys=keys,
        ts=ts,
        size=size,
    )
    return _with_penetration(out)


def _with_penetration(df: DataFrame) -> DataFrame:
    if {"net_load_mw", "system_demand_mw"} <= set(df.columns):
        return df.withColumn("renewable_penetration_ratio", penetration())
    return df


# ---- rolling statistics -----------------------------------------------------
# A rolling state is a struct: count n, mean m, squared deviations q, low, high.
def _direct_states(w: WindowSpec, cols: list[str], h: int) -> dict[str, Column]:
    frame = w.rowsBetween(-h, -1)
    return {
        f"_s{h}_{c}": F.struct(
            F.count(c).over(frame).alias("n"),
            F.avg(c).over(frame).alias("m"),
            (F.var_pop(c).over(frame) * F.count(c).over(frame)).alias("q"),
            F.min(c).over(frame).alias("low"),
            F.max(c).over(frame).alias("high"),
        )
        for c in cols
    }


def _merged(df: DataFrame, cols: list[str], h: int, parts: dict[str, list[str]]) -> DataFrame:
    """States of unions of disjoint row sets, from the states of the sets.

    Counts and means come first, as columns: the squared deviations use them.
    """
    sizes, states = {}, {}
    for c in cols:
        n = " + ".join(f"coalesce({p}.n, 0L)" for p in parts[c])
        weighed = " + ".join(f"coalesce({p}.n * {p}.m, 0D)" for p in parts[c])
        sizes[f"_n{h}_{c}"] = F.expr(n)
        sizes[f"_m{h}_{c}"] = F.expr(f"({weighed}) / nullif({n}, 0L)")
        mean = f"_m{h}_{c}"
        q = " + ".join(
            f"coalesce({p}.q + {p}.n * ({p}.m - {mean}) * ({p}.m - {mean}), 0D)" for p in parts[c]
        )
        low = ", ".join(f"{p}.low" for p in parts[c])
        high = ", ".join(f"{p}.high" for p in parts[c])
        states[f"_s{h}_{c}"] = F.expr(
            f"named_struct('n', _n{h}_{c}, 'm', {mean}, 'q', {q}, 'low', least({low}), 'high', greatest({high}))"
        )
    return df.withColumns(sizes).withColumns(states).drop(*sizes)


def rolling_columns(
    df: DataFrame, w: WindowSpec, cols: list[str], windows: list[int] = ROLLING_HOURS
) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of the ``h`` rows before.

    A window that is a multiple of a shorter one is put together from lagged
    states of the shorter (168 h = 7 x 24 h, 24 h = 4 x 6 h), so a row costs 6 +
    4 + 7 steps instead of 6 + 24 + 168. All windows share one sort.
    """
    kept = df.columns
    done: list[int] = []
    for h in sorted(windows):
        base = max((d for d in done if h % d == 0), default=None)
        if base is None:
            df = df.withColumns(_direct_states(w, cols, h))
        else:
            lagged = {
                f"_s{base}_{c}_{k}": F.lag(f"_s{base}_{c}", base * k).over(w)
                for c in cols
                for k in range(1, h // base)
            }
            parts = {
                c: [f"_s{base}_{c}", *[f"_s{base}_{c}_{k}" for k in range(1, h // base)]] for c in cols
            }
            df = _merged(df.withColumns(lagged), cols, h, parts).drop(*lagged)
        done.append(h)
    out = {}
    for c in cols:
        for h in windows:
            s, enough = f"_s{h}_{c}", f"_s{h}_{c}.n >= {max(1, h // 4)}"
            out[f"{c}_roll_{h}h_mean"] = f"if({enough}, {s}.m, null)"
            out[f"{c}_roll_{h}h_std"] = f"if({enough} and {s}.n > 1, sqrt({s}.q / ({s}.n - 1)), 0D)"
            out[f"{c}_roll_{h}h_min"] = f"if({enough}, {s}.low, null)"
            out[f"{c}_roll_{h}h_max"] = f"if({enough}, {s}.high, null)"
    return df.select(*kept, *[F.expr(x).alias(name) for name, x in out.items()])


def with_rolling(
    df: DataFrame,
    cols: list[str] = ROLLED,
    windows: list[int] = ROLLING_HOURS,
    thr: float = EVENT_MW,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """Rolling statistics of a gap-free grid, never including the row itself,
    and the 0/1 curtailment event label."""
    cols = [c for c in cols if c in df.columns]
    out = over_chunks(
        df,
        lambda rows, w: rolling_columns(rows, w, cols, windows),
        back=max(windows),
        keys=keys,
        ts=ts,
        size=size,
    )
    return _with_event(out, thr)


def _with_event(df: DataFrame, thr: float = EVENT_MW) -> DataFrame:
    if "curtailment_mw" in df.columns:
        return df.withColumn("curtailment_event", event_label("curtailment_mw", thr))
    return df


def build_features(
    df: DataFrame,
    drop_na: bool = True,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """All features. Lags and rolling statistics share one shuffle and sort;
    the remaining columns are row-wise and added to the own rows only."""
    lagged = [c for c in LAGGED if c in df.columns]
    rolled = [c for c in ROLLED if c in df.columns]

    def windowed(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rolling_columns(rows.withColumns(lag_columns(w, lagged)), w, rolled)

    out = over_chunks(
        with_origin(df, keys, ts), windowed, back=max(LAG_HOURS + ROLLING_HOURS), keys=keys, ts=ts, size=size
    )
    if drop_na:
        # Before the row-wise columns, which are NULL only where their inputs are;
        # of the rolling figures the mean is NULL whenever another one is.
        empty = [c for c in out.columns if "_roll_" not in c or c.endswith("_mean")]
        out = out.dropna("any", subset=empty)
    out = with_solar(with_calendar(out, ts=ts), ts=ts)
    out = with_fourier(out, origin="_origin", ts=ts).drop("_origin")
    return _with_event(_with_penetration(out))


def feature_importance(
    features: DataFrame,
    cols: list[str],
    target: str = "curtailment_mw",
    trees: int = 100,
    depth: int = 12,
    seed: int = 42,
) -> DataFrame:
    """Random-forest importances, ascending: ``feature, importance``."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    points = VectorAssembler(inputCols=cols, outputCol="_x").transform(
        features.select(*cols, F.col(target).cast("double").alias("_y"))
    )
    forest = RandomForestRegressor(
        featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(points.select("_x", "_y"))
    rows = [(c, float(v)) for c, v in zip(cols, forest.featureImportances.toArray())]
    out = features.sparkSession.createDataFrame(rows, "feature string, importance double")
    return out.orderBy("importance", "feature")
