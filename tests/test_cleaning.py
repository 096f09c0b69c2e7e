import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import random_series, to_pandas, to_spark

from loadtide.operators import cleaning

MEASURES = ["system_demand_mw", "solar_generation_mw", "curtailment_mw"]


def holed(seed, n=400, cut=()):
    pdf = random_series(n, seed, holes=0.25)[["series_id", "ts", *MEASURES]]
    keep = np.ones(n, bool)
    rng = np.random.default_rng(seed + 99)
    keep[1:-1] = rng.random(max(n - 2, 0)) > 0.1
    for a, b in cut:
        keep[a:b] = False
    return pdf[keep]


def pandas_filled(pdf):
    out = []
    for sid, part in pdf.groupby("series_id"):
        part = part.set_index("ts")
        grid = part.reindex(pd.date_range(part.index.min(), part.index.max(), freq="h"))
        cols = grid[MEASURES].interpolate(method="time", limit=3, limit_direction="both").bfill().ffill()
        out.append(cols.assign(series_id=sid).rename_axis("ts").reset_index())
    return pd.concat(out).sort_values(["series_id", "ts"]).reset_index(drop=True)


@pytest.mark.parametrize("size", [7, 50, 2160])
def test_grid_and_fill_equal_pandas(spark, size):
    pdf = pd.concat([holed(1, cut=[(50, 56), (100, 107), (200, 300)]), holed(2), holed(3, n=1), holed(4, n=2)])
    got = to_pandas(cleaning.regular_series(to_spark(spark, pdf), size=size), "series_id", "ts")
    want = pandas_filled(pdf)
    assert len(got) == len(want)
    assert (got["ts"] == want["ts"]).all()
    np.testing.assert_allclose(got[MEASURES].astype(float), want[MEASURES], rtol=1e-9)


def test_fill_of_grid_equals_fused_fill(spark):
    df = to_spark(spark, holed(5))
    a = to_pandas(cleaning.fill_gaps(cleaning.hourly_grid(df, size=20), size=30), "ts")
    b = to_pandas(cleaning.regular_series(df), "ts")
    np.testing.assert_allclose(a[MEASURES], b[MEASURES], rtol=1e-12)


def test_all_null_column_stays_null(spark):
    pdf = holed(6, n=60)
    pdf["curtailment_mw"] = np.nan
    got = cleaning.regular_series(to_spark(spark, pdf)).toPandas()
    assert got["curtailment_mw"].isna().all()
    assert got["system_demand_mw"].notna().all()


def test_off_grid_reading_is_lost_and_empty_input_is_empty(spark):
    pdf = holed(7, n=30)
    extra = pdf.iloc[[3]].assign(ts=pdf["ts"].iloc[3] + dt.timedelta(minutes=30))
    df = to_spark(spark, pd.concat([pdf, extra]))
    grid = cleaning.hourly_grid(df)
    assert grid.count() == 30
    assert grid.filter("minute(ts) <> 0").count() == 0
    assert cleaning.regular_series(df.filter("false")).count() == 0


@pytest.mark.parametrize("size", [100, 2160])
def test_bounds_equal_pandas(spark, size):
    pdf = pd.concat([random_series(500, 11, spikes=9), random_series(300, 12, spikes=5), random_series(20, 13)])
    cols = ["solar_generation_mw", "wind_generation_mw", "system_demand_mw", "curtailment_mw"]
    got = to_pandas(cleaning.apply_physical_bounds(to_spark(spark, pdf), size=size), "series_id", "ts")
    out, capped = [], 0
    for _, part in pdf.groupby("series_id"):
        part = part.copy()
        for c in cols:
            x = part[c].clip(lower=0)
            roll = x.rolling(168, min_periods=24, center=True)
            top = roll.median() + 4 * roll.std()
            hit = (x > top) & top.notna() & (x > 100)
            capped += hit.sum()
            part[c] = x.where(~hit, top)
        limit = part["solar_generation_mw"] + part["wind_generation_mw"]
        part["curtailment_mw"] = np.minimum(part["curtailment_mw"], limit)
        part["net_load_mw"] = part["system_demand_mw"] - limit
        out.append(part)
    want = pd.concat(out).sort_values(["series_id", "ts"]).reset_index(drop=True)
    assert capped > 10
    np.testing.assert_allclose(got[[*cols, "net_load_mw"]], want[[*cols, "net_load_mw"]], rtol=1e-9, atol=1e-6)


def local_rows(spark, rows):
    return spark.createDataFrame(rows, "series_id int, record_seq int, local_text string")


def test_local_times_around_clock_changes(spark):
    rows = [
        (1, 1, "2024-03-10 01:30:00"),
        (1, 2, "2024-03-10 02:30:00"),
        (1, 3, "2024-03-10 03:00:00"),
        (1, 4, "2024-11-03 00:00:00"),
        (1, 5, "2024-11-03 01:00:00"),
        (1, 6, "2024-11-03 01:00:00"),
        (1, 7, "2024-11-03 02:00:00"),
        (1, 8, "2023-11-05 00:00:00"),
        (1, 9, "2023-11-05 01:00:00"),
        (1, 10, "2023-11-05 02:00:00"),
        (1, 11, "not a time"),
        (2, 1, "2024-11-03 01:00:00"),
        (2, 2, "2024-11-03 01:30:00"),
        (2, 3, "2024-11-03 01:00:00"),
        (2, 4, "2024-11-03 01:30:00"),
        (3, 1, "2024-11-03 01:00:00"),
        (3, 2, "2024-11-03 01:00:00"),
        (3, 3, "2024-11-03 01:00:00"),
    ]
    out = cleaning.local_to_utc(local_rows(spark, rows), "local_text")
    got = {
        (r.series_id, r.record_seq): r.t
        for r in out.selectExpr("series_id", "record_seq", "date_format(ts, 'yyyy-MM-dd HH:mm') t").collect()
    }
    assert got == {
        (1, 1): "2024-03-10 09:30",
        (1, 2): "2024-03-10 10:00",
        (1, 3): "2024-03-10 10:00",
        (1, 4): "2024-11-03 07:00",
        (1, 5): "2024-11-03 08:00",
        (1, 6): "2024-11-03 09:00",
        (1, 7): "2024-11-03 10:00",
        (1, 8): "2023-11-05 07:00",
        (1, 10): "2023-11-05 10:00",
        (2, 1): "2024-11-03 08:00",
        (2, 2): "2024-11-03 08:30",
        (2, 3): "2024-11-03 09:00",
        (2, 4): "2024-11-03 09:30",
    }


def test_dedupe_mean_skips_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 3.0), (1, "a", None), (2, "b", None)], "series_id int, ts string, x double"
    )
    got = {r.series_id: r.x for r in cleaning.dedupe_mean(df).collect()}
    assert got == {1: 2.0, 2: None}


def test_station_blend_weights(spark):
    rows = [("72295023174", "t", 10.0), ("72494023234", "t", None), ("elsewhere", "t", 30.0)]
    df = spark.createDataFrame(rows, "station_id string, ts string, temperature_c double")
    plain = cleaning.blend_stations(df).first().temperature_c
    aware = cleaning.blend_stations(df, null_aware=True).first().temperature_c
    assert plain == pytest.approx((10 * 0.35 + 30 * 0.1) / 0.7)
    assert aware == pytest.approx((10 * 0.35 + 30 * 0.1) / 0.45)


def test_duplicate_hours_are_averaged(spark):
    df = spark.sql(
        "select 1L series_id, timestamp'2024-01-01 00:00:00' ts, x from values (1.0D), (3.0D), (null) t(x)"
        " union all select 1L, timestamp'2024-01-01 02:00:00', 5.0D"
    )
    got = [(r.ts.hour, r.x) for r in cleaning.hourly_grid(df).orderBy("ts").collect()]
    assert got == [(0, 2.0), (1, None), (2, 5.0)]


def test_zoned_and_typed_times_are_not_shifted(spark):
    texts = ["2024-07-01 12:00:00-07:00", "2024-07-01T12:00:00Z", "2024-07-01 12:00:00", "2024-11-03 01:30:00-0800", "2024-07-01"]
    df = spark.createDataFrame([(1, k, t) for k, t in enumerate(texts)], "series_id int, record_seq int, t string")
    hour = "date_format(ts, 'yyyy-MM-dd HH:mm') x"
    got = [r.x for r in cleaning.local_to_utc(df, "t").orderBy("record_seq").selectExpr(hour).collect()]
    assert got == ["2024-07-01 19:00", "2024-07-01 12:00", "2024-07-01 19:00", "2024-11-03 09:30", "2024-07-01 07:00"]
    typed = df.selectExpr("series_id", "record_seq", "timestamp'2024-07-01 12:00:00' t")
    assert cleaning.local_to_utc(typed, "t").selectExpr(hour).first().x == "2024-07-01 12:00"
    wall = df.selectExpr("series_id", "record_seq", "timestamp_ntz'2024-07-01 12:00:00' t")
    assert cleaning.local_to_utc(wall, "t").selectExpr(hour).first().x == "2024-07-01 19:00"
