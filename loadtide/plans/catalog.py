"""Every operator as a query over the given tables.

Doubles are rounded for comparison only: last digits of sums depend on the
order of the rows. The small shift moves exact ties off the rounding boundary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.functions.exprs import season
from loadtide.operators import blend, cleaning, explore, features, horizon, metrics, ridge, splits
from loadtide.plans import forecasting, preparation, reports
from loadtide.schemas import (
    BOUNDED,
    DISPATCH_MEASURES,
    GENERATION,
    IMPORTANCE_FEATURES,
    KEYS,
    LAGGED,
    ROLLED,
    RULES,
    WEATHER_MEASURES,
)
from loadtide.sources import adapters, constraints, feeds
from loadtide.sources.stages import new_path, staged
from loadtide.sources.tables import (
    read_scorecard,
    read_state,
    read_table,
    select_available,
    use_utc,
    with_year,
    write_scorecard,
    write_state,
    write_table,
)
from loadtide.streaming import telemetry

Query = Callable[[SparkSession, str], DataFrame]
TIE_SHIFT = 3.7e-8
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame, places: int = 4) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(TIE_SHIFT), places)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(use_utc(spark), sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def grid(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """Hourly dispatch without gaps, only the measures needed; every step after
    it reads the staged table."""
    dispatch = adapters.dispatch_events(spark, sf_dir)
    if cols:
        dispatch = dispatch.select(*KEYS, "ts", *cols)
    # the grid reads its input several times, the raw events only once
    return staged(cleaning.regular_series(staged(dispatch, "dispatch")), "grid")


# ---- reports ----------------------------------------------------------------
@query
def duck_curve(spark, sf):
    return reports.duck_curve(adapters.dispatch_long(spark, sf))


@query
def evening_ramp_top50(spark, sf):
    return reports.evening_ramps(adapters.dispatch_events(spark, sf))


@query
def weekly_hydro_solar(spark, sf):
    return reports.weekly_surplus(adapters.dispatch_long(spark, sf))


@query
def forecast_scorecard(spark, sf):
    return reports.forecast_scorecard(
        adapters.forecast_log(spark, sf), adapters.dispatch_events(spark, sf)
    )


@query
def kpi_summary(spark, sf):
    return reports.kpi_summary(adapters.forecast_wide(spark, sf))


@query
def kpi_summary_24h(spark, sf):
    return reports.kpi_summary(adapters.forecast_wide(spark, sf), model="lstm_mw", thr=500.0, hours=24)


@query
def alert_table(spark, sf):
    return reports.alert_table(adapters.forecast_wide(spark, sf))


# ---- sources ----------------------------------------------------------------
@query
def fuel_mix_wide(spark, sf):
    return feeds.pivot_fuel_mix(adapters.fuel_feed(spark, sf))


@query
def fuel_pages(spark, sf):
    """The feed landed as JSON pages of 5000 records, then loaded for two fuels
    of two areas and one span of hours."""
    feed = adapters.fuel_feed(spark, sf)
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("series_id").cast("string").alias("respondent"),
        "fueltype",
        F.col("value_mw").cast("string").alias("value"),
    )
    path = new_path(spark, "fuel_pages")
    page = F.floor(F.monotonically_increasing_id() / 5000).alias("page")
    pages = feed.select(page, record.alias("r")).groupBy("page").agg(F.collect_list("r").alias("data"))
    pages.select(F.struct("data", F.size("data").cast("bigint").alias("total")).alias("response")).write.json(path)
    rows = feeds.load_fuel_pages(
        spark,
        path,
        ["0", "2"],
        ["SUN", "WND"],
        "1996-01-01T00",
        "1999-12-31T23",
        page_per_line=True,
    )
    return rows.groupBy("series_id", "fueltype", F.to_date("ts").alias("day")).agg(
        F.sum(F.col("value_mw").cast("decimal(18,3)")).alias("value_mw"), F.count(F.lit(1)).alias("n")
    )


@query
def forecast_export(spark, sf):
    return adapters.forecast_wide(spark, sf)


@query
def constraint_violations(spark, sf):
    log = adapters.forecast_log(spark, sf)
    sparse = adapters.dispatch_sparse(spark, sf)
    parts = {
        "dispatch": constraints.validate(sparse, RULES["dispatch"]),
        "weather": constraints.validate(adapters.weather(spark, sf), RULES["weather"]),
        "forecast_log": constraints.validate(log, RULES["forecast_log"]),
    }
    tagged = [df.withColumn("table_name", F.lit(name)) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query
def dispatch_defaults(spark, sf):
    return constraints.apply_defaults(adapters.dispatch_sparse(spark, sf), RULES["dispatch"])


# ---- sources and sinks ------------------------------------------------------
@query
def parquet_round_trip(spark, sf):
    """Dispatch written by year and read back by schema."""
    dispatch = adapters.dispatch_sparse(spark, sf)
    path = new_path(spark, "by_year")
    write_table(with_year(dispatch), path, ["year"])
    return read_table(spark, path, dispatch.schema)


@query
def csv_round_trip(spark, sf):
    dispatch = adapters.dispatch_sparse(spark, sf)
    path = f"{new_path(spark, 'dispatch')}.csv"
    dispatch.write.option("header", True).csv(path)
    return read_table(spark, path, dispatch.schema)


@query
def scorecard_round_trip(spark, sf):
    card = reports.forecast_scorecard(adapters.forecast_log(spark, sf), adapters.dispatch_events(spark, sf))
    path = new_path(spark, "scorecard")
    write_scorecard(card, path)
    return read_scorecard(spark, path, card.schema)


@query
def station_stack(spark, sf):
    """Per-station frames, one of them without a column, stacked."""
    weather = adapters.weather(spark, sf).select("station_id", "ts", "temperature_c", "wind_speed_mps")
    names = [r.station_id for r in weather.select("station_id").distinct().orderBy("station_id").collect()]
    frames = {n: weather.filter(F.col("station_id") == n).drop("station_id") for n in names}
    frames[names[0]] = frames[names[0]].drop("wind_speed_mps")
    return feeds.union_stations(frames).select("station_id", "ts", "temperature_c", "wind_speed_mps")


@query
def model_state(spark, sf):
    """Blend weights of two runs, of which one is read back."""
    path = new_path(spark, "state")
    wide = adapters.forecast_wide(spark, sf)
    for run_id, (a, b) in {"one": ("prophet_mw", "lstm_mw"), "two": ("lstm_mw", "prophet_mw")}.items():
        write_state(blend.blend_weights(wide, a, b, "actual_curtailment_mw"), path, run_id)
    return read_state(spark, path, "one")


@query
def scaled_and_inverted(spark, sf):
    """Scaled features and the target scaled and brought back."""
    cols = ["net_load_mw", "solar_generation_mw"]
    rows = grid(spark, sf, [*cols, "curtailment_mw"])
    stats = staged(horizon.fit_scaler(rows, cols), "scaler")
    scaled = horizon.apply_scaler(rows, stats, cols, "curtailment_mw")
    return horizon.invert_target(scaled, stats, "curtailment_mw").select("series_id", "ts", *cols, "curtailment_mw")


# ---- cleaning ---------------------------------------------------------------
@query
def local_to_utc(spark, sf):
    return cleaning.local_to_utc(adapters.local_records(spark, sf), "local_text").select(
        "series_id", "record_seq", "ts", "value"
    )


@query
def zoned_to_utc(spark, sf):
    """Texts with and without a zone in one column."""
    return cleaning.local_to_utc(adapters.zoned_records(spark, sf), "local_text").select(
        "series_id", "record_seq", "ts", "value"
    )


@query
def dedupe_mean(spark, sf):
    return cleaning.dedupe_mean(adapters.weather(spark, sf), keys=["station_id"])


@query
def station_blend(spark, sf):
    return cleaning.blend_stations(adapters.weather(spark, sf))


@query
def station_blend_null_aware(spark, sf):
    return cleaning.blend_stations(adapters.weather(spark, sf), null_aware=True)


@query
def dispatch_with_weather(spark, sf):
    blend = cleaning.blend_stations(adapters.weather(spark, sf))
    dispatch = adapters.dispatch_events(spark, sf)
    return cleaning.join_weather(dispatch, blend).select(
        "series_id", "ts", "system_demand_mw", *WEATHER_MEASURES
    )


@query
def hourly_grid(spark, sf):
    return cleaning.hourly_grid(staged(adapters.dispatch_sparse(spark, sf), "dispatch"))


@query
def gap_fill(spark, sf):
    return cleaning.regular_series(staged(adapters.dispatch_sparse(spark, sf), "dispatch"))


@query
def outlier_cap(spark, sf):
    return cleaning.apply_physical_bounds(grid(spark, sf, BOUNDED)).select(
        "series_id", "ts", *BOUNDED, "net_load_mw"
    )


# ---- features ---------------------------------------------------------------
@query
def calendar_features(spark, sf):
    dispatch = adapters.dispatch_events(spark, sf).select("series_id", "ts")
    return features.with_calendar(dispatch)


@query
def solar_elevation(spark, sf):
    return features.with_solar(adapters.dispatch_long(spark, sf).select("series_id", "ts"))


@query
def fourier_terms(spark, sf):
    return features.with_fourier(adapters.dispatch_events(spark, sf).select("series_id", "ts"))


@query
def lags_and_ramps(spark, sf):
    base = grid(spark, sf, [*LAGGED, "system_demand_mw"])
    return features.with_lags_and_ramps(base).drop(*DISPATCH_MEASURES, "net_load_mw")


@query
def rolling_stats(spark, sf):
    base = grid(spark, sf, [*ROLLED, "curtailment_mw"])
    return features.with_rolling(base).drop(*DISPATCH_MEASURES, "net_load_mw")


@query
def feature_table(spark, sf):
    return features.build_features(grid(spark, sf))


@query
def clean_features(spark, sf):
    """Readings to features in one job: duplicates, grid, gaps, bounds, spikes, features."""
    return preparation.clean_features(adapters.dispatch_events(spark, sf))


@query
def feature_importance(spark, sf):
    table = features.build_features(grid(spark, sf))
    return features.feature_importance(table, IMPORTANCE_FEATURES)


# ---- splits and evaluation --------------------------------------------------
@query
def time_split_counts(spark, sf):
    parts = splits.label_splits(grid(spark, sf, ["curtailment_mw"]))
    return parts.groupBy(*KEYS, "split").agg(
        F.count(F.lit(1)).alias("hours"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query
def backtest_windows(spark, sf):
    return splits.rolling_windows(grid(spark, sf, ["curtailment_mw"]))


@query
def sample_week(spark, sf):
    return splits.sample_window(grid(spark, sf, ["system_demand_mw", "net_load_mw"]), 100, 168).select(
        "series_id", "ts", "system_demand_mw", "net_load_mw"
    )


@query
def horizon_padding(spark, sf):
    """A 48 h forecast cut to 24 h and one of 30 h padded to 48 h."""
    fc = adapters.forecast_models_wide(spark, sf).select("series_id", "ts", "prophet_mw", "lstm_mw")
    short = splits.fit_to_horizon(splits.first_hours(fc, 30), 48, ["prophet_mw", "lstm_mw"])
    long = splits.fit_to_horizon(splits.first_hours(fc, 48), 24, ["prophet_mw", "lstm_mw"])
    return short.withColumn("kind", F.lit("padded")).unionByName(long.withColumn("kind", F.lit("cut")))


@query
def persistence_eval(spark, sf):
    """Same hour last week and yesterday as forecasts, scored per series."""
    base = grid(spark, sf, ["curtailment_mw"])
    out = None
    for lag in (24, 168):
        rows = splits.persistence(base, lag_hours=lag).filter(F.col("persistence_mw").isNotNull())
        keys = ["series_id"]
        scores = metrics.regression_metrics(rows, "curtailment_mw", "persistence_mw", keys).join(
            metrics.event_metrics(rows, "curtailment_mw", "persistence_mw", by=keys), keys
        )
        scores = scores.withColumn("lag_hours", F.lit(lag))
        out = scores if out is None else out.unionByName(scores)
    return out


@query
def roc_pr_auc(spark, sf):
    return metrics.rank_metrics(adapters.evaluated_log(spark, sf), "y", "yhat", by=["model_name"])


@query
def roc_pr_curve(spark, sf):
    return metrics.curves(adapters.evaluated_log(spark, sf), "y", "yhat", by=["model_name"])


@query
def roc_pr_areas(spark, sf):
    return metrics.curve_areas(adapters.evaluated_log(spark, sf), "y", "yhat", by=["model_name"])


@query
def model_benchmark(spark, sf):
    log = adapters.evaluated_log(spark, sf)
    return metrics.model_benchmark(log, by=["model_name"])


@query
def model_benchmark_severe(spark, sf):
    """Event scores at the severe threshold, per season."""
    log = adapters.evaluated_log(spark, sf).withColumn("season", season(F.month("target_ts")))
    return metrics.event_metrics(log, "y", "yhat", thr=1000.0, by=["model_name", "season"])


# ---- exploration ------------------------------------------------------------
@query
def curtailment_heatmap(spark, sf):
    return explore.curtailment_heatmap(adapters.dispatch_long(spark, sf))


@query
def net_load_profile(spark, sf):
    return explore.net_load_profile(adapters.dispatch_long(spark, sf))


@query
def ramp_boxplot(spark, sf):
    return explore.ramp_boxplot(adapters.dispatch_events(spark, sf))


@query
def event_hours(spark, sf):
    return reports.event_hours(adapters.dispatch_events(spark, sf)).select("series_id", "ts", "curtailment_mw")


@query
def numeric_profile(spark, sf):
    cols = [*DISPATCH_MEASURES, "net_load_mw"]
    return explore.profile(adapters.dispatch_sparse(spark, sf), cols)


@query
def column_info(spark, sf):
    return explore.column_info(adapters.dispatch_sparse(spark, sf))


@query
def correlation_matrix(spark, sf):
    return explore.correlations(adapters.dispatch_events(spark, sf))


@query
def overgeneration_estimate(spark, sf):
    return explore.estimate_overgeneration(adapters.dispatch_events(spark, sf)).select(
        "series_id", "ts", "net_load_mw", "solar_generation_mw", "overgeneration_mw"
    )


# ---- forecasting ------------------------------------------------------------
def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid with the row-wise features the models use."""
    cols = [*GENERATION, "net_load_mw", "curtailment_mw", *WEATHER_MEASURES]
    out = features.with_solar(features.with_calendar(grid(spark, sf_dir, cols)))
    return staged(features.with_fourier(out), "model_input")


@query
def model_frame(spark, sf):
    """A regressor the table lacks is 0, as is a missing reading."""
    sparse = adapters.dispatch_sparse(spark, sf)
    return ridge.model_frame(features.with_solar(sparse).drop("temperature_c")).drop("solar_elevation_deg")


@query
def blend_weights(spark, sf):
    """Weights of two models per series and over all hours."""
    wide = adapters.forecast_wide(spark, sf)
    per_series = blend.blend_weights(wide, "prophet_mw", "lstm_mw", "actual_curtailment_mw")
    pooled = blend.blend_weights(wide, "prophet_mw", "lstm_mw", "actual_curtailment_mw", keys=[])
    return per_series.unionByName(pooled.withColumn("series_id", F.lit(-1).cast("bigint")))


@query
def stacked_forecast(spark, sf):
    wide = adapters.forecast_wide(spark, sf)
    weights = blend.blend_weights(wide, "prophet_mw", "lstm_mw", "actual_curtailment_mw")
    return blend.stack_forecasts(wide, "prophet_mw", "lstm_mw", weights)


@query
def seasonal_ridge_grams(spark, sf):
    """The sums of products behind the fit, in long form, loads in GW."""
    df = model_input(spark, sf)
    df = df.withColumns({c: F.col(c) / 1000 for c in ("net_load_mw", "curtailment_mw")})
    grams = ridge.seasonal_grams(df)
    cells = F.transform(F.col("xtx"), lambda v, i: F.struct(i.alias("cell"), v.alias("value")))
    right = F.transform(F.col("xty"), lambda v, i: F.struct((i - 12).alias("cell"), v.alias("value")))
    return grams.select("series_id", F.explode(F.concat(cells, right)).alias("c")).select(
        "series_id", "c.*"
    )


@query
def seasonal_ridge_fit(spark, sf):
    coef = ridge.fit_seasonal_ridge(model_input(spark, sf))
    return coef.select("series_id", "n", F.posexplode("beta").alias("term", "beta"))


@query
def seasonal_ridge_forecast(spark, sf):
    df = model_input(spark, sf)
    windows = splits.rolling_windows(df, 1, 48, include_last=True)
    coef = ridge.fit_seasonal_ridge(df, windows=windows).drop("window")
    test = splits.window_rows(df, windows, "test_start", "test_end")
    scored = ridge.score_seasonal_ridge(test, coef)
    return scored.select("series_id", "ts", "curtailment_mw", "yhat", "yhat_lower", "yhat_upper")


@query
def full_seasonal_cross_validation(spark, sf):
    """Yearly and weekly waves, holidays and multiplied effects."""
    df = model_input(spark, sf)
    df = cleaning.with_holidays(df, ridge.holidays_of(df))
    return forecasting.cross_validate(df, 15, 5, 2, spec=ridge.FULL_SPEC)


@query
def cross_validation(spark, sf):
    return forecasting.cross_validate(model_input(spark, sf), 15, 5, 2)


@query
def holiday_lookup(spark, sf):
    rows = adapters.dispatch_long(spark, sf).select("series_id", "ts", "curtailment_mw")
    days = cleaning.with_holidays(rows, ridge.holidays_of(rows))
    return days.groupBy("holiday", "is_holiday").agg(
        F.count(F.lit(1)).alias("hours"), F.avg("curtailment_mw").alias("avg_curtailment_mw")
    )


@query
def sequences(spark, sf):
    """Sums over the feature windows and the targets of every sequence."""
    cols = ["net_load_mw", "solar_generation_mw"]
    seqs = horizon.sequences(grid(spark, sf, [*cols, "curtailment_mw"]), cols)
    add = lambda a, b: a + b
    return seqs.select(
        "series_id",
        "ts",
        F.size("x").alias("x_size"),
        F.get("x", F.lit(0)).alias("first_net_load"),
        F.get("x", F.lit(95)).alias("last_solar"),
        F.aggregate("x", F.lit(0.0), add).alias("x_sum"),
        F.aggregate("y", F.lit(0.0), add).alias("y_sum"),
    )


@query
def scaler_statistics(spark, sf):
    cols = ["net_load_mw", "solar_generation_mw", "thermal_gas_mw"]
    stats = horizon.fit_scaler(grid(spark, sf, [*cols, "curtailment_mw"]), cols)
    return stats.select(
        "series_id",
        "y_min",
        "y_range",
        *[F.get("center", F.lit(i)).alias(f"center_{c}") for i, c in enumerate(cols)],
        *[F.get("scale", F.lit(i)).alias(f"scale_{c}") for i, c in enumerate(cols)],
    )


@query
def multi_horizon_ridge(spark, sf):
    df = model_input(spark, sf)
    windows = staged(splits.rolling_windows(df, 1, 48, include_last=True), "windows")
    model = horizon.fit_horizon_ridge(df, windows)
    origins = windows.select("series_id", "window", F.col("test_start").alias("origin_ts"))
    scored = horizon.score_horizon_ridge(df, model, origins)
    return scored.select("series_id", "ts", "step", "yhat")


@query
def backtest_persistence(spark, sf):
    """The baseline of the backtest, per window over all series."""
    df = grid(spark, sf, ["curtailment_mw"])
    rows = forecasting.persistence_predictions(df, splits.rolling_windows(df))
    by = ["window"]
    return metrics.regression_metrics(rows, "y", "yhat", by).join(
        metrics.event_metrics(rows, "y", "yhat", by=by), by
    )


@query
def rolling_backtest(spark, sf):
    return forecasting.backtest(model_input(spark, sf))


@query
def rolling_backtest_fitted_blend(spark, sf):
    return forecasting.backtest(model_input(spark, sf), n=3, include_last=True, fitted_blend=True)


@query
def seasonal_backtest_scores(spark, sf):
    """Backtest scores per model and season at the severe threshold."""
    return forecasting.backtest(model_input(spark, sf), n=2, thr=1000.0, by=["model", "season"])


@query
def forecast_48h(spark, sf):
    return forecasting.forecast_next(model_input(spark, sf))


@query
def future_frame(spark, sf):
    """Model inputs for the two days after the last reading of each series."""
    cols = ["net_load_mw", "curtailment_mw", *WEATHER_MEASURES]
    return forecasting.future_frame(grid(spark, sf, cols), adapters.driver_runs(spark, sf))


@query
def forecast_future_naive(spark, sf):
    """Hours after the data: seasonal model and the week before, blended by the last week."""
    return forecasting.forecast_future(model_input(spark, sf), adapters.driver_runs(spark, sf), second="persistence")


@query
def forecast_future(spark, sf):
    return forecasting.forecast_future(model_input(spark, sf), adapters.driver_runs(spark, sf))


@query
def multi_horizon_ridge_net_load(spark, sf):
    """The direct model with one feature, which SQL can follow."""
    df = model_input(spark, sf)
    windows = staged(splits.rolling_windows(df, 1, 48, include_last=True), "windows")
    model = horizon.fit_horizon_ridge(df, windows, ["net_load_mw"])
    origins = windows.select("series_id", "window", F.col("test_start").alias("origin_ts"))
    return horizon.score_horizon_ridge(df, model, origins, ["net_load_mw"]).select("series_id", "ts", "step", "yhat")


@query
def forecast_48h_net_load(spark, sf):
    """Train, blend on the validation origins and forecast the newest two days, the direct model with one feature."""
    return forecasting.forecast_next(model_input(spark, sf), features=["net_load_mw"])


@query
def holdout_net_load(spark, sf):
    """The direct model scored on the last 15 % of the sequences."""
    return horizon.holdout_scores(model_input(spark, sf), ["net_load_mw"])


@query
def simplex_blend(spark, sf):
    """Weights of three forecasts per series."""
    preds = ["prophet_mw", "lstm_mw", "ensemble_mw"]
    fitted = blend.simplex_weights(adapters.forecast_wide(spark, sf), preds, "actual_curtailment_mw")
    return fitted.select("series_id", "n", "residual_std", *[F.get("weights", F.lit(i)).alias(f"w{i + 1}") for i in range(3)])


@query
def blend_evaluation(spark, sf):
    return forecasting.evaluate_blend(adapters.forecast_wide(spark, sf), "prophet_mw", "lstm_mw", "actual_curtailment_mw")


@query
def latest_forecast(spark, sf):
    """Three runs, of which the second revises the later half of the hours and the third was never finished."""
    path = new_path(spark, "forecasts")
    wide = adapters.forecast_wide(spark, sf).select("series_id", "ts", "ensemble_mw", "net_load_mw")
    late = wide.filter(F.expr("hour(ts) >= 12")).withColumn("ensemble_mw", F.col("ensemble_mw") + 10)
    feeds.publish_forecast(wide, path, "2024-01-01")
    feeds.publish_forecast(late, path, "2024-01-02")
    wide.withColumn("ensemble_mw", F.lit(-1.0)).write.parquet(f"{path}/runs/run=2024-01-03")
    return feeds.latest_forecast(spark, path)


@query
def available_columns(spark, sf):
    """A list of columns of which the table lacks two."""
    return select_available(adapters.dispatch_events(spark, sf), ["ts", "humidity", "net_load_mw", "series_id", "uv_index"])


@query
def rolling_backtest_net_load(spark, sf):
    """The whole backtest with the direct model of one feature."""
    return forecasting.backtest(model_input(spark, sf), features=["net_load_mw"])


# ---- streaming --------------------------------------------------------------
def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = adapters.load(spark, sf_dir, "events").schema
    raw = telemetry.read_stream(spark, sf_dir, schema, name_filter="events.parquet")
    return telemetry.drop_replays(adapters.telemetry_events(raw))


def _drained(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    return telemetry.run_available(df, new_path(spark, name), new_path(spark, f"{name}_progress"))


@query
def stream_hourly_rollup(spark, sf):
    """Closed hours only: the last ones, which late records may still change, are not written."""
    return _drained(telemetry.hourly_rollup(_event_stream(spark, sf)), "hourly")


@query
def stream_replays(spark, sf):
    """Every event arrives twice, in files of their own; the rollup counts it once."""
    path = new_path(spark, "replayed")
    events = adapters.load(spark, sf, "events")
    for _ in range(2):
        events.write.mode("append").parquet(path)
    raw = telemetry.read_stream(spark, path, events.schema)
    return _drained(telemetry.hourly_rollup(telemetry.drop_replays(adapters.telemetry_events(raw))), "hourly")


@query
def stream_ramp(spark, sf):
    """The rollup's table as the source of the next stream; hours still open at its end are not written."""
    path = new_path(spark, "hourly")
    hourly = telemetry.hourly_rollup(_event_stream(spark, sf))
    table = telemetry.run_available(hourly, path, new_path(spark, "hourly_progress"))
    feed = telemetry.read_stream(spark, path, table.schema)
    return _drained(telemetry.live_ramps(feed), "ramps")


def _forecast_stream(spark: SparkSession, sf_dir: str, files: int = 1) -> DataFrame:
    """The forecast table as a stream; several files split it by the hour and
    arrive one per micro-batch."""
    path = new_path(spark, "forecast")
    table = adapters.forecast_wide(spark, sf_dir)
    (table.repartition(files, "ts") if files > 1 else table).write.parquet(path)
    per_batch = {"files_per_trigger": 1} if files > 1 else {}
    return telemetry.read_stream(spark, path, spark.read.parquet(path).schema, **per_batch)


@query
def stream_alerts(spark, sf):
    return _drained(telemetry.alert_feed(_forecast_stream(spark, sf)), "alerts")


@query
def stream_kpi_refresh(spark, sf):
    path = new_path(spark, "kpis")
    telemetry.refresh_kpis(
        _forecast_stream(spark, sf, files=3), path, new_path(spark, "kpis_progress")
    ).awaitTermination()
    return telemetry.latest_kpis(spark, path)
