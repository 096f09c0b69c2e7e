"""The given test tables, seen as grid telemetry.

Sums run over DECIMAL copies of the money-like values, so each adapter gives
the same doubles whatever the order of rows or partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.functions.exprs import alert_tier, epoch_hours, event_prob, hour_start, net_load, plus_hours
from loadtide.schemas import FUTURE_DRIVERS, STATION_WEIGHTS
from loadtide.sources.feeds import export_forecast


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _cents(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def _scaled_sum(factor: int, kind: str | None = None, empty: float | None = 0.0) -> Column:
    """``factor * sum(value)``, of one event type if given."""
    value = _cents("value") if kind is None else F.when(F.col("event_type") == kind, _cents("value"))
    out = (F.sum(value) * F.lit(factor)).cast("double")
    return out if empty is None else F.coalesce(out, F.lit(empty))


def _exact_avg() -> Column:
    return F.sum(_cents("value")).cast("double") / F.count("value")


def _dispatch(events: DataFrame, users_per_series: int, empty: float | None) -> DataFrame:
    series = F.floor(F.col("user_id") / users_per_series).cast("bigint")
    out = events.groupBy(
        series.alias("series_id"), hour_start(F.col("ts").cast("timestamp")).alias("ts")
    ).agg(
        _scaled_sum(60, empty=empty).alias("system_demand_mw"),
        _scaled_sum(60, "click", empty).alias("solar_generation_mw"),
        _scaled_sum(60, "view", empty).alias("wind_generation_mw"),
        _scaled_sum(60, "signup", empty).alias("nuclear_mw"),
        _scaled_sum(60, "purchase", empty).alias("hydro_mw"),
        F.lit(0.0).alias("thermal_gas_mw"),
        _scaled_sum(3, "error", empty).alias("curtailment_mw"),
        (_exact_avg() - 40).alias("lmp_usd"),
        (_exact_avg() / 2).alias("temperature_c"),
        (_exact_avg() / 10).alias("wind_speed_mps"),
        (F.max("value") * 10).alias("ghi_estimated"),
    )
    return out.withColumn("net_load_mw", net_load())


def dispatch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dispatch(load(spark, sf_dir, "events"), 50, 0.0)


def dispatch_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dispatch(load(spark, sf_dir, "events"), 10, None)


def _order_hour() -> Column:
    return F.timestamp_add(
        "HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate").cast("timestamp")
    )


def dispatch_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = _cents("o_totalprice")
    tenth = F.sum(price).cast("double") / 10
    tilt = 1 + F.sum(F.col("o_orderkey") % 7).cast("double") / F.count(F.lit(1)) / 10
    fifth = F.sum(F.when(F.col("o_orderkey") % 5 == 0, price)).cast("double")
    hourly = (
        load(spark, sf_dir, "orders")
        .groupBy(_order_hour().alias("ts"))
        .agg(
            tenth.alias("system_demand_mw"),
            tilt.alias("tilt"),
            F.coalesce(fifth / 4000, F.lit(0.0)).alias("curtailment_mw"),
            (F.pmod(F.sum(price).cast("double") / F.count(F.lit(1)), F.lit(100.0)) - 30).alias(
                "lmp_usd"
            ),
        )
    )
    demand, tilt = F.col("system_demand_mw"), F.col("tilt")
    return hourly.select(
        F.lit(0).cast("bigint").alias("series_id"),
        "ts",
        "system_demand_mw",
        (demand * 0.30 * tilt).alias("solar_generation_mw"),
        (demand * 0.15 * tilt).alias("wind_generation_mw"),
        (demand * 0.05 * tilt).alias("nuclear_mw"),
        (demand * 0.10 * tilt).alias("hydro_mw"),
        F.lit(0.0).alias("thermal_gas_mw"),
        "curtailment_mw",
        "lmp_usd",
    ).withColumn("net_load_mw", net_load())


# returnflag + linestatus -> fuel
FLAG_FUELS = {"AF": "SUN", "AO": "WND", "NF": "NG", "NO": "WAT", "RF": "NUC", "RO": "OTH"}


def fuel_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.concat("l_returnflag", "l_linestatus")
    fuel = F.lit(None).cast("string")
    for code, name in FLAG_FUELS.items():
        fuel = F.when(flag == code, name).otherwise(fuel)
    return load(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 4).alias("series_id"),
        F.timestamp_add(
            "HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate").cast("timestamp")
        ).alias("ts"),
        fuel.alias("fueltype"),
        (F.col("l_extendedprice").cast("decimal(18,2)") / 10).cast("decimal(18,3)").alias("value_mw"),
    )


def weather(spark: SparkSession, sf_dir: str, hourly: bool = True) -> DataFrame:
    """Station readings: raw times, or times cut to the hour (with repeats)."""
    station = F.element_at(
        F.array(*[F.lit(s) for s in STATION_WEIGHTS], F.lit("99999999999")),
        (F.col("user_id") % 5 + 1).cast("int"),
    )
    ts = F.col("ts").cast("timestamp")
    return load(spark, sf_dir, "events").select(
        station.alias("station_id"),
        (hour_start(ts) if hourly else ts).alias("ts"),
        F.when(F.col("event_type") != "error", F.col("value") / 4).alias("temperature_c"),
        (F.col("value") / 20).alias("wind_speed_mps"),
        (F.col("value") * 3).alias("ghi_estimated"),
    )


# model -> multiplier of its pseudo-random error pattern
LOG_MODELS = {"prophet": 17, "lstm": 29, "ensemble": 41}


def forecast_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = dispatch_events(spark, sf_dir).select("series_id", "ts", "curtailment_mw")
    model = F.explode(
        F.array(*[F.struct(F.lit(m).alias("name"), F.lit(k).alias("k")) for m, k in LOG_MODELS.items()])
    )
    wobble = F.pmod(epoch_hours("ts") * F.col("m.k") + F.col("series_id"), F.lit(61)) / F.lit(100.0)
    predicted = F.col("curtailment_mw") * (F.lit(0.7) + wobble)
    return (
        base.withColumn("m", model)
        .withColumn("p", predicted)
        .select(
            F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
            "series_id",
            F.timestamp_add("HOUR", F.lit(-48), "ts").alias("generated_at"),
            F.col("ts").alias("target_ts"),
            F.col("m.name").alias("model_name"),
            F.col("p").alias("predicted_curtailment_mw"),
            F.greatest(F.lit(0.0), F.col("p") - 80).alias("lower_bound_mw"),
            (F.col("p") + 80).alias("upper_bound_mw"),
            alert_tier("p").alias("alert_tier"),
        )
    )


def forecast_models_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hour, one prediction column per model, ensemble bounds."""
    log = forecast_log(spark, sf_dir)

    def of(model: str, col: str) -> Column:
        return F.max(F.when(F.col("model_name") == model, F.col(col)))

    wide = log.groupBy("series_id", F.col("target_ts").alias("ts")).agg(
        *[of(m, "predicted_curtailment_mw").alias(f"{m}_mw") for m in LOG_MODELS],
        of("ensemble", "lower_bound_mw").alias("lower_bound_mw"),
        of("ensemble", "upper_bound_mw").alias("upper_bound_mw"),
    )
    return wide.select(
        "series_id",
        "ts",
        "prophet_mw",
        "lstm_mw",
        "ensemble_mw",
        "lower_bound_mw",
        "upper_bound_mw",
        alert_tier("ensemble_mw").alias("curtailment_alert"),
        event_prob("ensemble_mw").alias("curtailment_event_prob"),
    )


def forecast_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_forecast(forecast_models_wide(spark, sf_dir), dispatch_events(spark, sf_dir))


def driver_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast runs of the drivers for the week after each series: the readings of the last week, a percent higher with every run.
    The third of the runs comes out after the series has ended."""
    dispatch = dispatch_events(spark, sf_dir).select("series_id", "ts", *FUTURE_DRIVERS)
    last = dispatch.groupBy("series_id").agg(F.max("ts").alias("hi"))
    runs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(h).alias("h")) for k, h in ((1, -36), (2, -12), (3, 6))]))
    week = dispatch.join(last, "series_id").filter(F.col("ts") > plus_hours("hi", -168)).withColumn("run", runs)
    return week.select(
        "series_id",
        plus_hours("ts", 168).alias("ts"),
        F.timestamp_add("HOUR", F.col("run.h") + 1, "hi").alias("issued_ts"),
        *[(F.col(c) * (1 + F.col("run.k") * F.lit(0.01))).alias(c) for c in FUTURE_DRIVERS],
    )


def evaluated_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast log rows with the observed curtailment: model_name, y, yhat."""
    actual = dispatch_events(spark, sf_dir).select(
        "series_id", F.col("ts").alias("target_ts"), F.col("curtailment_mw").alias("y")
    )
    return (
        forecast_log(spark, sf_dir)
        .join(actual, ["series_id", "target_ts"])
        .select(
            "series_id",
            "target_ts",
            "model_name",
            "y",
            F.col("predicted_curtailment_mw").alias("yhat"),
        )
    )


def local_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times as wall-clock texts of the local zone; some are unreadable."""
    text = F.date_format(_order_hour(), "yyyy-MM-dd HH:mm:ss")
    return load(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 2).alias("series_id"),
        F.col("o_orderkey").alias("record_seq"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("n/a")).otherwise(text).alias("local_text"),
        F.col("o_totalprice").alias("value"),
    )


def zoned_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order times as texts, of which two in three name their zone."""
    text = F.date_format(_order_hour(), "yyyy-MM-dd HH:mm:ss")
    suffix = F.element_at(F.array(F.lit("Z"), F.lit("-07:00"), F.lit("")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return load(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 2).alias("series_id"),
        F.col("o_orderkey").alias("record_seq"),
        F.concat(text, suffix).alias("local_text"),
        F.col("o_totalprice").alias("value"),
    )


def telemetry_events(events: DataFrame) -> DataFrame:
    """Raw events, batch or stream, as telemetry records with a record id."""
    return events.select(
        F.col("event_id").alias("record_id"),
        F.floor(F.col("user_id") / 50).cast("bigint").alias("series_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        "value",
    )
