import numpy as np
import pandas as pd
import pytest
from conftest import hours, random_series, to_pandas, to_spark
from pyspark.sql import functions as F

from loadtide.operators import blend, cholesky, features, horizon, ridge, splits
from loadtide.plans import forecasting
from loadtide.schemas import FUTURE_DRIVERS
from loadtide.sources.stages import staged

FEATURES = ["net_load_mw", "solar_generation_mw", "temperature_c"]
REGRESSORS = ["net_load_mw", "solar_elevation_deg", "temperature_c", "wind_speed_mps"]


def design(pdf, origin=None):
    t = (pdf["ts"] - (origin if origin is not None else pdf["ts"].min())).dt.total_seconds() / 3600
    cols = [np.ones(len(pdf)), t / 8760]
    for k in (1, 2, 3):
        cols += [np.sin(2 * np.pi * k * t / 24), np.cos(2 * np.pi * k * t / 24)]
    cols += [pdf[r].fillna(0) if r in pdf else np.zeros(len(pdf)) for r in REGRESSORS]
    return np.column_stack(cols)


def ridge_fit(x, y, alpha):
    return np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ y)


def direct_fit(pdf, alpha=50.0, back=48, ahead=48):
    """Scale, flatten, solve: the plain way."""
    x, y = pdf[FEATURES].to_numpy(), pdf["curtailment_mw"].to_numpy()
    center = np.median(x, axis=0)
    scale = np.quantile(x, 0.75, axis=0) - np.quantile(x, 0.25, axis=0)
    low, span = y.min(), y.max() - y.min()
    xs, ys = (x - center) / scale, (y - low) / span
    idx = range(back, len(pdf) - ahead + 1)
    a = np.array([np.r_[1.0, xs[i - back : i].ravel()] for i in idx])
    b = np.array([ys[i : i + ahead] for i in idx])
    w = ridge_fit(a, b, alpha)

    def predict(history):
        h = ((history[FEATURES].to_numpy()[-back:] - center) / scale).ravel()
        return np.maximum(0, np.maximum(0, np.r_[1.0, h] @ w) * span + low)

    return predict


@pytest.fixture(scope="module")
def series(spark):
    pdf = pd.concat([random_series(520, 1), random_series(480, 2)], ignore_index=True)
    return pdf, staged(to_spark(spark, pdf), "model_test")


def test_seasonal_ridge_equals_numpy(series):
    pdf, df = series
    coef = to_pandas(ridge.fit_seasonal_ridge(df), "series_id")
    for _, r in coef.iterrows():
        part = pdf[pdf.series_id == r.series_id]
        want = ridge_fit(design(part), part["curtailment_mw"].to_numpy(), 10.0)
        np.testing.assert_allclose(r.beta, want, rtol=1e-6, atol=1e-8)


def test_wide_design_takes_the_matrix_path(series):
    pdf, df = series
    spec = ridge.SeasonalSpec(regressors=REGRESSORS, cycles={"d": (24.0, 6), "w": (168.0, 3)})
    grams = ridge.seasonal_grams(df, spec=spec)
    got = to_pandas(ridge.solve_ridge(grams, 10.0), "series_id")
    assert len(got.beta[0]) == 2 + 18 + 4
    scored = ridge.score_seasonal_ridge(df, ridge.solve_ridge(grams, 10.0), spec)
    assert scored.filter("yhat is null or yhat < 0 or yhat_lower > yhat").count() == 0


def test_window_fits_equal_refits(series):
    pdf, df = series
    windows = splits.rolling_windows(df, 3, 48)
    coef = to_pandas(ridge.fit_seasonal_ridge(df, windows=windows), "series_id", "window")
    ends = to_pandas(windows, "series_id", "window")
    assert len(coef) == 6
    for r, w in zip(coef.itertuples(), ends.itertuples()):
        part = pdf[(pdf.series_id == r.series_id) & (pdf.ts < w.train_end)]
        want = ridge_fit(design(part), part["curtailment_mw"].to_numpy(), 10.0)
        assert r.n == len(part)
        np.testing.assert_allclose(r.beta, want, rtol=1e-5, atol=1e-7)


@pytest.mark.parametrize("size", [100, 17520])
def test_direct_ridge_equals_numpy_per_window(series, size):
    pdf, df = series
    windows = staged(splits.rolling_windows(df, 2, 48), "windows")
    model = horizon.fit_horizon_ridge(df, windows, FEATURES, size=size)
    origins = windows.select("series_id", "window", F.col("test_start").alias("origin_ts"))
    got = to_pandas(
        horizon.score_horizon_ridge(df, model, origins, FEATURES), "series_id", "window", "step"
    )
    assert len(got) == 4 * 48
    for w in to_pandas(windows, "series_id", "window").itertuples():
        part = pdf[pdf.series_id == w.series_id]
        want = direct_fit(part[part.ts < w.train_end])(part[part.ts < w.test_start])
        mine = got[(got.series_id == w.series_id) & (got.window == w.window)]
        np.testing.assert_allclose(mine.yhat, want, rtol=1e-6, atol=1e-6)
        assert mine.ts.iloc[0] == w.test_start


def test_sequences(series):
    pdf, df = series
    got = to_pandas(
        horizon.sequences(df, FEATURES[:2], back=5, ahead=3, size=40).filter("series_id = 1"), "ts"
    )
    part = pdf[pdf.series_id == 1].reset_index(drop=True)
    assert len(got) == 520 - 5 - 3 + 1
    np.testing.assert_allclose(got.x[0], part[FEATURES[:2]].iloc[:5].to_numpy().ravel())
    np.testing.assert_allclose(got.y[10], part["curtailment_mw"].iloc[15:18])


def test_scaler_round_trip(series):
    pdf, df = series
    stats = horizon.fit_scaler(df, FEATURES)
    scaled = horizon.apply_scaler(df, stats, FEATURES, "curtailment_mw")
    back = to_pandas(horizon.invert_target(scaled, stats, "curtailment_mw"), "series_id", "ts")
    np.testing.assert_allclose(back.curtailment_mw, pdf.curtailment_mw)
    assert abs(scaled.filter("series_id = 1").toPandas()["net_load_mw"].median()) < 1e-12


def test_holdout_leaves_the_last_sequences(series):
    pdf, df = series
    row = horizon.holdout_windows(df).filter("series_id = 1").first()
    kept = int(0.85 * (520 - 95))
    assert row.train_end == pdf[pdf.series_id == 1].ts.iloc[0] + pd.Timedelta(hours=kept + 95)


def test_blend_is_the_constrained_optimum(spark):
    rng = np.random.default_rng(3)
    for k in range(4):
        y = rng.normal(100, 30, 80)
        p1, p2 = y + rng.normal(10 * k, 20, 80), y + rng.normal(0, 5 + 20 * k, 80)
        df = to_spark(spark, pd.DataFrame({"series_id": 1, "y": y, "p1": p1, "p2": p2}))
        r = blend.blend_weights(df, "p1", "p2", "y").first()
        grid = np.linspace(0, 1, 2001)
        best = grid[np.argmin([np.mean((y - g * p1 - (1 - g) * p2) ** 2) for g in grid])]
        assert r.w1 == pytest.approx(best, abs=1e-3) and r.w1 + r.w2 == 1
        assert r.residual_std == pytest.approx(np.std(y - r.w1 * p1 - r.w2 * p2))
    same = to_spark(spark, pd.DataFrame({"series_id": 1, "y": y, "p1": p1, "p2": p1}))
    assert blend.blend_weights(same, "p1", "p2", "y").first().w1 == 0.5


def test_stacked_tiers_go_by_the_unrounded_value(spark):
    pdf = pd.DataFrame({"series_id": 1, "ts": hours(4), "a": [249.99, 250.0, 999.99, 1000.0]})
    weights = spark.createDataFrame([(1, 0.5, 0.5, 10.0)], "series_id int, w1 double, w2 double, residual_std double")
    got = to_pandas(blend.stack_forecasts(to_spark(spark, pdf), "a", "a", weights), "ts")
    assert list(got.curtailment_alert) == ["LOW (Green)", "MODERATE (Amber)", "MODERATE (Amber)", "CRITICAL (Red)"]
    assert list(got.ensemble_mw) == [250.0, 250.0, 1000.0, 1000.0]
    assert got.upper_bound_mw[3] == pytest.approx(1000 + 1.645 * 25, abs=0.05)
    assert list(got.curtailment_event_prob) == [0.4, 0.4, 1.0, 1.0]


def test_splits_and_short_series(spark, series):
    pdf, df = series
    parts = splits.label_splits(df).groupBy("series_id", "split").count().collect()
    sizes = {(r.series_id, r.split): r["count"] for r in parts}
    assert sizes[1, "train"] == 520 - 216 and sizes[1, "val"] == 168 and sizes[2, "test"] == 48
    short = to_spark(spark, random_series(315, 9))
    with pytest.raises(Exception, match="too short"):
        splits.label_splits(short).collect()
    assert splits.label_splits(short, on_short="skip").count() == 0


def test_backtest_scores_every_window(series):
    pdf, df = series
    windows = staged(splits.rolling_windows(df, 2, 48), "windows")
    preds = forecasting.backtest_predictions(df, windows, features=FEATURES)
    rows = to_pandas(preds, "model", "series_id", "ts")
    assert rows.groupby("model").size().to_dict() == {m: 192 for m in forecasting.MODELS}
    naive = rows[(rows.model == "Persistence_168h") & (rows.series_id == 1)]
    part = pdf[pdf.series_id == 1]
    np.testing.assert_allclose(naive.yhat, part.curtailment_mw.shift(168).iloc[-144:-48])
    p = rows.pivot_table(index=["series_id", "ts"], columns="model", values="yhat")
    np.testing.assert_allclose(
        p["Stacked_Ensemble"], np.round(0.4 * p["Prophet"] + 0.6 * p["LSTM"], 1), atol=0.1001
    )


def test_next_forecast_and_cross_validation(series):
    _, df = series
    fc = forecasting.forecast_next(df, features=FEATURES).toPandas()
    assert len(fc) == 96 and (fc.lower_bound_mw <= fc.upper_bound_mw).all()
    cv = forecasting.cross_validate(df, 10, 3, 2).toPandas()
    assert (cv.horizons == 48).all() and (cv.mae > 0).all()


def test_a_series_without_one_feature_is_forecast(spark):
    pdf = random_series(520, 1)
    pdf["wind_speed_mps"] = np.nan
    df = features.with_fourier(features.with_solar(features.with_calendar(to_spark(spark, pdf))))
    fc = forecasting.forecast_next(df, features=FEATURES + ["wind_speed_mps"]).toPandas()
    assert len(fc) == 48 and fc.ensemble_mw.notna().all()


def test_array_solver_equals_numpy(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for i, p in enumerate([1, 2, 12, 40]):
        x, y = rng.normal(size=(100, p)) * 10.0 ** rng.integers(0, 4, p), rng.normal(size=100)
        rows.append((i, (x.T @ x).ravel().tolist(), (x.T @ y).tolist()))
        want[i] = np.linalg.solve(x.T @ x + 10 * np.eye(p), x.T @ y)
    rows.append((9, None, None))
    df = spark.createDataFrame(rows, "id int, g array<double>, b array<double>")
    got = {r.id: r.beta for r in cholesky.solve(df, "g", "b", "beta", 10.0).collect()}
    assert got.pop(9) is None
    for i, beta in want.items():
        assert np.allclose(got[i], beta, rtol=1e-9, atol=1e-9 * np.abs(beta).max())


def test_seasonal_fit_needs_no_python_worker(series):
    _, df = series
    plan = ridge.fit_seasonal_ridge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan


def test_future_forecast_equals_the_one_of_a_held_back_span(series):
    """Readings cut off two days early, their drivers given as forecast runs: the same table as over the whole series."""
    _, df = series
    df = features.with_solar(features.with_calendar(df))
    end = df.groupBy("series_id").agg(F.max("ts").alias("hi"))
    aged = df.join(end, "series_id").withColumn("late", F.expr("ts > hi - interval 48 hours"))
    history = staged(aged.filter("not late").drop("hi", "late"), "history")
    late = aged.filter("late").select("series_id", "ts", "hi", *FUTURE_DRIVERS)
    wrong = [(F.col(c) * 0 - 1.0).alias(c) for c in FUTURE_DRIVERS]
    at = lambda h: F.expr(f"hi - interval {h} hours").alias("issued_ts")
    runs = late.select("series_id", "ts", at(50), *FUTURE_DRIVERS)
    runs = runs.unionByName(late.select("series_id", "ts", at(90), *wrong)).unionByName(late.select("series_id", "ts", at(40), *wrong))
    got = to_pandas(forecasting.forecast_future(history, runs), "series_id", "ts")
    want = to_pandas(forecasting.forecast_next(df), "series_id", "ts")
    assert len(got) == 96
    pd.testing.assert_frame_equal(got[want.columns], want)
    naive = to_pandas(forecasting.forecast_future(history, runs, hours=60, second="persistence"), "series_id", "ts")
    assert len(naive) == 120
    longer = to_pandas(forecasting.forecast_future(history, runs, hours=60), "series_id", "ts")
    assert (longer.groupby("series_id").lstm_mw.apply(lambda x: x.iloc[47:].nunique()) == 1).all()


def test_future_hours_without_a_run_take_the_week_before(series):
    _, df = series
    none = df.select("series_id", "ts", F.col("ts").alias("issued_ts"), *FUTURE_DRIVERS).filter("false")
    frame = to_pandas(forecasting.future_frame(df, none, 24), "series_id", "ts")
    past = to_pandas(df.withColumn("ts", F.expr("ts + interval 168 hours")), "series_id", "ts")
    both = frame.merge(past, on=["series_id", "ts"], suffixes=("", "_past"))
    assert len(both) == 48
    for c in FUTURE_DRIVERS:
        np.testing.assert_allclose(both[c], both[f"{c}_past"])


def test_simplex_minimum_equals_the_best_face():
    rng = np.random.default_rng(0)
    for trial in range(200):
        k = int(rng.integers(1, 6))
        e = rng.normal(size=(30, k)) * rng.uniform(0.5, 3, k) + rng.normal(size=(30, 1)) * rng.uniform(0, 3)
        g = e.T @ e
        best = (np.inf, None)
        for face in range(1, 2**k):
            at = [i for i in range(k) if face >> i & 1]
            w = np.linalg.solve(g[np.ix_(at, at)], np.ones(len(at)))
            w = w / w.sum()
            if (w >= 0).all():
                best = min(best, (w @ g[np.ix_(at, at)] @ w, dict(zip(at, w))), key=lambda b: b[0])
        got = blend.simplex_minimum(g)
        assert got.min() >= 0 and abs(got.sum() - 1) < 1e-12
        np.testing.assert_allclose(got, [best[1].get(i, 0.0) for i in range(k)], atol=1e-8)


def test_blends_of_agreeing_forecasts_are_even(spark):
    rows = [(1, float(i), i + 3.0, i + 3.0, i + 3.0) for i in range(20)] + [(2, float(i), i + 1.0, i - 2.0, i + 1.0) for i in range(20)]
    rows += [(2, None, 1.0, 1.0, 1.0), (2, 1.0, None, 1.0, 1.0), (3, float("nan"), 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "series_id int, y double, a double, b double, c double")
    df = df.withColumn("y", F.nanvl("y", F.lit(None).cast("double")))
    got = {r.series_id: r for r in blend.simplex_weights(df, ["a", "b", "c"], "y").collect()}
    assert set(got) == {1, 2} and got[2].n == 20
    np.testing.assert_allclose(got[1].weights, [1 / 3] * 3)
    # two of three agree: they share their weight
    np.testing.assert_allclose(got[2].weights, [1 / 3, 1 / 3, 1 / 3], atol=1e-6)
    two = blend.blend_weights(df.filter("series_id = 2"), "a", "b", "y").first()
    both = blend.simplex_weights(df.filter("series_id = 2"), ["a", "b"], "y").first()
    np.testing.assert_allclose(both.weights, [two.w1, two.w2], atol=1e-6)
    assert abs(both.residual_std - two.residual_std) < 1e-6


def test_window_scaler_equals_one_scaler_per_window(series):
    pdf, df = series
    windows = splits.rolling_windows(df, 3)
    got = to_pandas(horizon.fit_window_scaler(df, windows, FEATURES), "series_id", "window")
    assert len(got) == 6
    for _, r in got.iterrows():
        end = windows.filter(f"series_id = {r.series_id} and window = {r.window}").first().train_end
        want = horizon.fit_scaler(df.filter(F.col("series_id") == int(r.series_id)).filter(F.col("ts") < F.lit(end)), FEATURES).first()
        np.testing.assert_allclose(r.center, want.center)
        np.testing.assert_allclose(r.scale, want.scale)
        assert (r.y_min, r.y_range) == (want.y_min, want.y_range)


def test_moments_grow_with_their_data(series):
    """Blocks of an appended stretch are added to the kept ones; the fit equals one over everything."""
    _, df = series
    windows = staged(splits.rolling_windows(df, 3), "windows")
    ends = windows.select("series_id", "train_end")
    last = windows.groupBy("series_id").agg(F.max("train_end").alias("hi"))
    early = df.join(last, "series_id").filter(F.expr("ts < hi - interval 48 hours")).drop("hi")
    kept = staged(horizon.horizon_moments(early, ends.filter("train_end is not null").join(last, "series_id").filter("train_end < hi").drop("hi"), FEATURES), "moments")
    added = staged(horizon.horizon_moments(df, ends, FEATURES, known=kept), "more_moments")
    assert added.select("series_id", "block_end").distinct().count() == 2
    got = to_pandas(horizon.fit_from_moments(df, kept.unionByName(added), windows, FEATURES), "series_id", "window")
    want = to_pandas(horizon.fit_horizon_ridge(df, windows, FEATURES), "series_id", "window")
    for a, b in zip(got.weights, want.weights):
        np.testing.assert_allclose(np.frombuffer(a), np.frombuffer(b), rtol=1e-6, atol=1e-9)


def test_short_blocks_travel_as_their_hours(series, monkeypatch):
    """Moments take no more than a few times their input, and the fit is that of summed products."""
    _, df = series
    windows = staged(splits.rolling_windows(df, 3), "windows")
    moments = staged(horizon.horizon_moments(df, windows.select("series_id", "train_end"), FEATURES), "moments")
    size = moments.agg(F.sum(F.length("products"))).first()[0]
    assert size < 4 * df.count() * 8 * (len(FEATURES) + 1)
    got = to_pandas(horizon.fit_from_moments(df, moments, windows, FEATURES), "series_id", "window")
    monkeypatch.setattr(horizon, "SMALLER", 10**9)
    summed = staged(horizon.horizon_moments(df, windows.select("series_id", "train_end"), FEATURES), "summed")
    assert summed.filter(F.col("band") == horizon.HOURS).isEmpty() and summed.agg(F.sum(F.length("products"))).first()[0] > 4 * size
    want = to_pandas(horizon.fit_from_moments(df, summed, windows, FEATURES), "series_id", "window")
    for a, b in zip(got.weights, want.weights, strict=True):
        np.testing.assert_allclose(np.frombuffer(a), np.frombuffer(b), rtol=1e-9, atol=1e-12)


def test_weights_are_shuffled_once(series):
    _, df = series
    conf, limit = df.sparkSession.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(limit)
    conf.set(limit, "-1")
    windows = staged(splits.rolling_windows(df, 2), "windows")
    model = staged(horizon.fit_horizon_ridge(df, windows, FEATURES), "model")
    origins = windows.select("series_id", "window", F.col("test_start").alias("origin_ts"))
    scored = horizon.score_horizon_ridge(df, model, origins, FEATURES)
    plan = scored._jdf.queryExecution().explainString(scored.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    conf.set(limit, before)
    parts = plan.split("\n\n")
    assert sum(") Exchange" in p and "weights" in p for p in parts) == 1 and not any(") CoGroup" in p for p in parts)
    assert scored.count() == windows.count() * 48


def test_backtest_keeps_no_weights(series, monkeypatch):
    """With fitted blends too, one scoring reads the weights, and no table of them is written."""
    _, df = series
    kept = []
    monkeypatch.setattr(forecasting, "staged", lambda d, name: kept.append((name, d.columns)) or staged(d, name))
    for fitted in (False, True):
        assert forecasting.backtest(df, n=2, features=FEATURES, fitted_blend=fitted).count() == 4
    assert len(kept) > 4 and not any("weights" in columns for _, columns in kept)
