import numpy as np
import pandas as pd
import pytest
from conftest import random_series, to_pandas, to_spark
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadtide.operators import chunking, features

COLS = ["solar_generation_mw", "wind_generation_mw", "net_load_mw"]


def pandas_rolling(pdf, windows):
    out = []
    for _, part in pdf.groupby("series_id"):
        part = part.copy()
        for c in COLS:
            for w in windows:
                r = part[c].shift(1).rolling(w, min_periods=max(1, w // 4))
                part[f"{c}_roll_{w}h_mean"] = r.mean()
                part[f"{c}_roll_{w}h_std"] = r.std().fillna(0)
                part[f"{c}_roll_{w}h_min"] = r.min()
                part[f"{c}_roll_{w}h_max"] = r.max()
        out.append(part)
    return pd.concat(out).sort_values(["series_id", "ts"]).reset_index(drop=True)


@pytest.mark.parametrize("size,windows", [(200, [6, 24, 168]), (2160, [6, 24, 168]), (60, [5, 12, 24])])
def test_rolling_equals_pandas_with_nulls(spark, size, windows):
    pdf = pd.concat([random_series(400, 1, holes=0.2), random_series(250, 2), random_series(3, 3)])
    pdf.loc[(pdf.series_id == 2) & (pdf.index < 60), "wind_generation_mw"] = 1234.5
    got = to_pandas(features.with_rolling(to_spark(spark, pdf), windows=windows, size=size), "series_id", "ts")
    want = pandas_rolling(pdf, windows)
    names = [c for c in want.columns if "_roll_" in c]
    np.testing.assert_allclose(got[names].astype(float), want[names].astype(float), rtol=1e-7, atol=1e-6)


def test_lags_do_not_depend_on_chunk_size(spark):
    df = to_spark(spark, pd.concat([random_series(300, 1), random_series(120, 2)]))
    a = to_pandas(features.with_lags_and_ramps(df, size=50), "series_id", "ts")
    b = to_pandas(features.with_lags_and_ramps(df), "series_id", "ts")
    pd.testing.assert_frame_equal(a, b)
    one = a[a.series_id == 1]
    pd.testing.assert_series_equal(
        one["net_load_mw_lag_48h"], one["net_load_mw"].shift(48), check_names=False
    )
    pd.testing.assert_series_equal(
        one["curtailment_mw_ramp_3h"], one["curtailment_mw"].diff(3), check_names=False
    )


def test_features_ignore_the_future(spark):
    pdf = random_series(260, 5)
    later = pdf.copy()
    later.loc[200:, COLS + ["curtailment_mw", "system_demand_mw"]] *= 3
    a = to_pandas(features.build_features(to_spark(spark, pdf)), "ts")
    b = to_pandas(features.build_features(to_spark(spark, later)), "ts")
    cut = pdf["ts"].iloc[200]
    past = [c for c in a.columns if "_lag_" in c or "_roll_" in c]
    pd.testing.assert_frame_equal(a[a.ts <= cut][past], b[b.ts <= cut][past])
    assert len(a) == 260 - 48


@pytest.mark.parametrize("size", [3, 10, 2160])
def test_row_lag_equals_plain_lag_over_gaps(spark, size):
    pdf = random_series(200, 1)[["series_id", "ts", "net_load_mw"]].sample(90, random_state=3)
    other = random_series(40, 2)[["series_id", "ts", "net_load_mw"]]
    df = to_spark(spark, pd.concat([pdf, other]))
    got = chunking.row_lag(df, {"net_load_mw": "before"}, 3, size=size)
    w = Window.partitionBy("series_id").orderBy("ts")
    want = df.withColumn("before", F.lag("net_load_mw", 3).over(w))
    pd.testing.assert_frame_equal(to_pandas(got, "series_id", "ts"), to_pandas(want, "series_id", "ts"))


def test_solar_elevation_known_points(spark):
    df = spark.sql("select timestamp'2024-06-20 20:00:00' ts union all select timestamp'2024-06-20 08:00:00'")
    noon, night = [r.solar_elevation_deg for r in features.with_solar(df).orderBy(F.desc("ts")).collect()]
    assert 76 < noon < 77
    assert night == 0


def test_importance_finds_the_driver(spark):
    pdf = random_series(300, 8)
    pdf["curtailment_mw"] = pdf["net_load_mw"] * 0.01
    out = features.feature_importance(
        to_spark(spark, pdf), ["net_load_mw", "temperature_c"], trees=5, depth=4
    ).collect()
    assert out[-1].feature == "net_load_mw"
    assert sum(r.importance for r in out) == pytest.approx(1.0)
