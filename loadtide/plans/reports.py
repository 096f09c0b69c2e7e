"""Operational reports over dispatch, forecast log and forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.functions.calendar import local_time
from loadtide.functions.exprs import (
    DETECTION_CLASSES,
    amount,
    detection_class,
    dollars,
    half_up,
    long_time,
    numeric,
    ramp_tier,
    season,
    short_time,
    system_status,
)
from loadtide.operators.splits import first_hours
from loadtide.operators.chunking import row_lag
from loadtide.schemas import EVENT_MW, KEYS, LOCAL_TZ, TS


def duck_curve(
    dispatch: DataFrame, tz: str = LOCAL_TZ, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Mean day by local hour and season, the season by UTC month."""

    def mean(c: str):
        return F.avg(numeric(c))

    demand, net = mean("system_demand_mw"), mean("net_load_mw")
    return (
        dispatch.groupBy(
            *keys, F.hour(local_time(ts, tz)).alias("hour_pst"), season(F.month(ts)).alias("season")
        )
        .agg(
            half_up(demand, 1).alias("avg_demand_mw"),
            half_up(mean("solar_generation_mw"), 1).alias("avg_solar_mw"),
            half_up(net, 1).alias("avg_net_load_mw"),
            half_up(mean("curtailment_mw"), 1).alias("avg_curtailment_mw"),
            half_up(demand - net, 1).alias("solar_penetration_mw"),
        )
        .orderBy(*keys, "season", "hour_pst")
    )


def evening_ramps(
    dispatch: DataFrame,
    tz: str = LOCAL_TZ,
    hours: tuple[int, int] = (17, 21),
    min_ramp: float = 8000.0,
    limit: int = 50,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """The steepest rises of net load over three readings that end in the evening."""
    rows = dispatch.select(*keys, ts, numeric("net_load_mw").alias("net"))
    lagged = row_lag(rows, {"net": "start"}, 3, keys, ts).withColumn("ramp", F.col("net") - F.col("start"))
    local = local_time(ts, tz)
    return (
        lagged.filter(F.hour(local).between(*hours) & (F.col("ramp") >= min_ramp))
        .select(
            *keys,
            ts,
            F.to_date(local).alias("dispatch_date"),
            F.hour(local).alias("ramp_end_hour_pst"),
            half_up("start", 1).alias("start_net_load_mw"),
            half_up("net", 1).alias("end_net_load_mw"),
            half_up("ramp", 1).alias("upward_ramp_3h_mw"),
            ramp_tier("ramp").alias("ramp_severity_tier"),
        )
        .orderBy(F.desc("upward_ramp_3h_mw"), *keys, ts)
        .limit(limit)
        .drop(ts)
    )


def weekly_surplus(
    dispatch: DataFrame,
    min_sum: float = 500.0,
    limit: int = 25,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """The weeks (from Monday) with the most curtailment: hydro, solar, prices."""
    week = F.to_date(F.date_trunc("WEEK", ts))
    return (
        dispatch.groupBy(*keys, week.alias("dispatch_week"))
        .agg(
            half_up(F.avg(numeric("hydro_mw")), 1).alias("weekly_avg_hydro_mw"),
            half_up(F.avg(numeric("solar_generation_mw")), 1).alias("weekly_avg_solar_mw"),
            half_up(F.min(numeric("net_load_mw")), 1).alias("weekly_min_net_load_mw"),
            F.sum(numeric("curtailment_mw")).alias("_sum"),
            F.count_if(F.col("lmp_usd") < 0).alias("negative_price_hours"),
            half_up(F.avg(numeric("lmp_usd")), 2).alias("avg_wholesale_lmp_usd"),
        )
        .filter(F.col("_sum") > min_sum)
        .withColumn("total_weekly_curtailment_mwh", half_up("_sum", 1))
        .drop("_sum")
        .orderBy(F.desc("total_weekly_curtailment_mwh"), *keys, "dispatch_week")
        .limit(limit)
    )


def forecast_scorecard(
    log: DataFrame,
    dispatch: DataFrame,
    as_of: dt.datetime | None = None,
    days: int = 30,
    thr: float = EVENT_MW,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Errors and event detection per model over the trailing ``days``.

    ``as_of`` is the moment to look back from, by default the newest target.
    """
    newest = log.agg(F.max("target_ts")).scalar() if as_of is None else F.lit(as_of)
    recent = log.filter(F.col("target_ts") >= newest - F.expr(f"INTERVAL {days} DAYS"))
    actual = dispatch.select(
        *keys, F.col(ts).alias("target_ts"), numeric("curtailment_mw").alias("_y")
    )
    error = F.abs(F.col("_p") - F.col("_y"))
    hit, false_alarm, miss, _ = DETECTION_CLASSES
    scored = (
        recent.select(
            *keys, "target_ts", "model_name", numeric("predicted_curtailment_mw").alias("_p")
        )
        .join(actual, [*keys, "target_ts"])
        .select("model_name", error.alias("e"), detection_class("_p", "_y", thr).alias("cls"))
    )
    out = scored.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("total_forecast_hours"),
        half_up(F.avg("e"), 2).alias("mae_mw"),
        half_up(F.sqrt(F.avg(F.col("e") * F.col("e")).cast("double")), 2).alias("rmse_mw"),
        F.count_if(F.col("cls") == hit).alias("tp"),
        F.count_if(F.col("cls") == false_alarm).alias("fp"),
        F.count_if(F.col("cls") == miss).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return out.withColumns(
        {
            "precision_score": half_up(F.try_divide(tp, tp + fp), 4),
            "recall_score": half_up(F.try_divide(tp, tp + fn), 4),
        }
    ).orderBy("mae_mw", "model_name")


def kpi_summary(
    fc: DataFrame,
    model: str = "ensemble_mw",
    thr: float = EVENT_MW,
    hours: int = 48,
    usd_per_mwh: float = 25.0,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Key figures of the first ``hours`` of each series' forecast."""
    value = F.col(model)
    # the earliest hour of the highest value
    order = F.when(value.isNotNull(), F.struct(-value, F.col(ts)))
    sums = (
        first_hours(fc, hours, keys, ts)
        .groupBy(*keys)
        .agg(
            F.max(value).alias("peak_mw"),
            F.min(order)[ts].alias("peak_ts"),
            F.sum(value).alias("total_mwh"),
            F.min("net_load_mw").alias("min_net_load_mw"),
        )
    )
    loss = F.col("total_mwh") * usd_per_mwh
    return sums.withColumn("economic_loss_usd", loss).withColumns(
        {
            "status": system_status("peak_mw", thr),
            "peak_text": amount("peak_mw"),
            "peak_time_text": F.concat(F.lit("At "), short_time("peak_ts")),
            "total_text": amount("total_mwh", "MWh"),
            "loss_text": dollars("economic_loss_usd"),
            "min_net_load_text": amount("min_net_load_mw"),
        }
    )


def alert_table(
    fc: DataFrame,
    model: str = "ensemble_mw",
    thr: float = EVENT_MW,
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Hours at or above the threshold, with display names."""
    return fc.filter(F.col(model) >= thr).select(
        *keys,
        long_time(ts).alias("Event Timestamp"),
        F.col(model).alias("Curtailed Volume (MW)"),
        F.col("net_load_mw").alias("Net Load (MW)"),
        F.col("curtailment_alert").alias("Risk Tier"),
        F.col("curtailment_event_prob").alias("Event Probability"),
    )


def event_hours(dispatch: DataFrame, thr: float = EVENT_MW) -> DataFrame:
    """Readings above the event threshold; the threshold itself is no event."""
    return dispatch.filter(F.col("curtailment_mw") > thr)
