"""Table layouts, column groups and fixed values shared by every module."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEYS = ["series_id"]
TS = "ts"

# ---- fixed values -----------------------------------------------------------
FUELS = ["SUN", "WND", "NG", "WAT", "NUC", "OTH"]
FUEL_COLUMNS = {
    "SUN": "solar_generation_mw",
    "WND": "wind_generation_mw",
    "NG": "thermal_gas_mw",
    "WAT": "hydro_mw",
    "NUC": "nuclear_mw",
    "OTH": "other_mw",
}
STATION_WEIGHTS = {
    "72295023174": 0.35,
    "72494023234": 0.25,
    "72389093193": 0.25,
    "72290003131": 0.15,
}
UNKNOWN_STATION_WEIGHT = 0.1
LOCAL_TZ = "America/Los_Angeles"
SITE_LATITUDE = 36.7783
SITE_LONGITUDE = -119.4179
EVENT_MW = 250.0
SEVERE_MW = 1000.0
LAG_HOURS = [1, 2, 3, 6, 12, 24, 48]
RAMP_HOURS = [1, 3]
ROLLING_HOURS = [6, 24, 168]
# name -> (period in hours, number of harmonics)
FOURIER_ORDERS = {"d": (24.0, 5), "w": (168.0, 3), "a": (8766.0, 4)}
PRIOR_BLEND = (0.40, 0.60)

# ---- column groups ----------------------------------------------------------
GENERATION = ["solar_generation_mw", "wind_generation_mw"]
BOUNDED = GENERATION + ["system_demand_mw", "curtailment_mw"]
LAGGED = GENERATION + ["net_load_mw", "curtailment_mw"]
ROLLED = GENERATION + ["net_load_mw"]
WEATHER_MEASURES = ["temperature_c", "wind_speed_mps", "ghi_estimated"]
DISPATCH_MEASURES = [
    "system_demand_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "nuclear_mw",
    "hydro_mw",
    "thermal_gas_mw",
    "curtailment_mw",
    "lmp_usd",
    "temperature_c",
    "wind_speed_mps",
    "ghi_estimated",
]
CORRELATED = [
    "system_demand_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "nuclear_mw",
    "hydro_mw",
    "net_load_mw",
    "temperature_c",
    "wind_speed_mps",
    "ghi_estimated",
    "curtailment_mw",
]
SEASONAL_REGRESSORS = ["net_load_mw", "solar_elevation_deg", "temperature_c", "wind_speed_mps"]
# what has to be known of an hour that is still to come
FUTURE_DRIVERS = ["net_load_mw", "temperature_c", "wind_speed_mps"]
SEQUENCE_FEATURES = [
    "net_load_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "temperature_c",
    "ghi_estimated",
    "hour_sin",
    "hour_cos",
    "day_of_week_sin",
    "day_of_week_cos",
    "fourier_d1_sin",
    "fourier_d1_cos",
]
IMPORTANCE_FEATURES = [
    "net_load_mw",
    "solar_generation_mw",
    "wind_generation_mw",
    "system_demand_mw",
    "solar_elevation_deg",
    "temperature_c",
    "wind_speed_mps",
    "ghi_estimated",
    "renewable_penetration_ratio",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "net_load_mw_lag_1h",
    "net_load_mw_lag_24h",
    "solar_generation_mw_lag_24h",
    "net_load_mw_roll_24h_mean",
    "fourier_d1_sin",
    "fourier_d1_cos",
]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_d, _s, _l, _t = T.DoubleType(), T.StringType(), T.LongType(), T.TimestampType()

DISPATCH = T.StructType(
    [T.StructField("series_id", _l, False), T.StructField("ts", _t, False)]
    + [T.StructField(c, _d) for c in DISPATCH_MEASURES]
)
WEATHER = _struct(
    station_id=_s,
    ts=_t,
    temperature_c=_d,
    dew_point_c=_d,
    wind_speed_mps=_d,
    ghi_estimated=_d,
    cloud_ceiling_m=T.IntegerType(),
)
FUEL_FEED = _struct(series_id=_l, ts=_t, fueltype=_s, value_mw=_d)
FORECAST_LOG = _struct(
    run_id=_s,
    series_id=_l,
    generated_at=_t,
    target_ts=_t,
    model_name=_s,
    predicted_curtailment_mw=_d,
    lower_bound_mw=_d,
    upper_bound_mw=_d,
    alert_tier=_s,
)
FORECAST = _struct(
    series_id=_l,
    ts=_t,
    prophet_mw=_d,
    lstm_mw=_d,
    ensemble_mw=_d,
    lower_bound_mw=_d,
    upper_bound_mw=_d,
    curtailment_alert=_s,
    curtailment_event_prob=_d,
)
# One landed page of the fuel feed: {"response": {"data": [...], "total": n}}
FUEL_PAGE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "data",
                        T.ArrayType(_struct(period=_s, respondent=_s, fueltype=_s, value=_s)),
                    ),
                    T.StructField("total", _l),
                ]
            ),
        )
    ]
)


@dataclass(frozen=True)
class TableRules:
    """What a table promises: a unique key, required columns, defaults."""

    key: list[str]
    required: list[str]
    defaults: dict[str, float] = field(default_factory=dict)


RULES = {
    "dispatch": TableRules(
        key=["series_id", "ts"],
        required=[
            "series_id",
            "ts",
            "system_demand_mw",
            "solar_generation_mw",
            "wind_generation_mw",
            "nuclear_mw",
            "hydro_mw",
            "thermal_gas_mw",
            "curtailment_mw",
        ],
        defaults={
            "solar_generation_mw": 0.0,
            "wind_generation_mw": 0.0,
            "nuclear_mw": 0.0,
            "hydro_mw": 0.0,
            "thermal_gas_mw": 0.0,
            "curtailment_mw": 0.0,
            "lmp_usd": 35.0,
        },
    ),
    "weather": TableRules(key=["station_id", "ts"], required=["station_id", "ts"]),
    "forecast_log": TableRules(
        key=["run_id", "series_id", "target_ts", "model_name"],
        required=["run_id", "generated_at", "target_ts", "model_name", "predicted_curtailment_mw"],
    ),
}
