"""Arithmetic, tiers and formats used by reports, cleaning and forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadtide.schemas import EVENT_MW, SEVERE_MW

ColumnLike = Column | str


def _c(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- numbers ----------------------------------------------------------------
def numeric(value: ColumnLike) -> Column:
    """Fixed-point copy of a double. Sums of it do not depend on row order."""
    return _c(value).cast("decimal(16,4)")


def half_up(value: ColumnLike, places: int) -> Column:
    """SQL ROUND: ties away from zero, decided on the decimal digits."""
    return F.round(_c(value).cast("decimal(38,8)"), places).cast("double")


def half_even(value: ColumnLike, places: int) -> Column:
    """Banker's rounding of a double, scaled to an integer as array libraries do."""
    scale = float(10**places)
    return F.rint(_c(value) * F.lit(scale)) / F.lit(scale)


def nan_to_null(value: ColumnLike) -> Column:
    """Spark treats NaN as a value; here it means missing."""
    col = _c(value)
    return F.when(~F.isnan(col), col)


def clip(value: ColumnLike, low: float, high: float) -> Column:
    col = _c(value)
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def floor_zero(value: ColumnLike) -> Column:
    col = _c(value).cast("double")
    # greatest() skips NULL, so a missing reading must be kept missing explicitly.
    return F.when(col.isNotNull(), F.greatest(F.lit(0.0), col))


def capped(value: ColumnLike, limit: ColumnLike) -> Column:
    """``value``, or ``limit`` where it exceeds it; an unknown limit caps nothing."""
    col, top = _c(value), _c(limit)
    return F.when(col > top, top).otherwise(col)


def epoch_hours(ts: ColumnLike) -> Column:
    return F.floor(F.unix_seconds(_c(ts)) / 3600)


def hour_start(ts: ColumnLike) -> Column:
    return F.date_trunc("HOUR", _c(ts))


def plus_hours(ts: ColumnLike, hours: Column | int) -> Column:
    return F.timestamp_add("HOUR", hours if isinstance(hours, Column) else F.lit(hours), _c(ts))


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


# ---- grid quantities --------------------------------------------------------
def net_load() -> Column:
    return F.col("system_demand_mw") - (F.col("solar_generation_mw") + F.col("wind_generation_mw"))


def renewables() -> Column:
    return F.col("solar_generation_mw") + F.col("wind_generation_mw")


def penetration() -> Column:
    return clip(renewables() / (F.col("system_demand_mw") + F.lit(1e-5)), 0.0, 2.5)


def overgeneration(
    hour: ColumnLike,
    net: ColumnLike = "net_load_mw",
    solar: ColumnLike = "solar_generation_mw",
    floor_mw: float = 4500.0,
    solar_mw: float = 11000.0,
    factor: float = 1.25,
    dead_band: float = 150.0,
    hours: tuple[int, int] = (9, 17),
    cap: float = 4800.0,
) -> Column:
    """What-if surplus below the must-run floor during daylight hours.

    Unfixed variant for short outlooks: ``solar_mw=None`` applies the factor
    always and ``dead_band=None`` keeps every positive surplus.
    """
    surplus = F.lit(floor_mw) - _c(net)
    if solar_mw is None:
        surplus = surplus * F.lit(factor)
    else:
        surplus = surplus * F.when(_c(solar) > solar_mw, F.lit(factor)).otherwise(F.lit(1.0))
    raw = F.when(surplus.isNotNull(), F.greatest(F.lit(0.0), surplus))
    keep = _c(hour).between(*hours)
    if dead_band is not None:
        keep = keep & (raw > dead_band)
    return F.when(keep, F.least(raw, F.lit(cap))).otherwise(F.lit(0.0))


# ---- labels (fixed values) --------------------------------------------------
REPORT_SEASONS = ("1_Spring", "2_Summer", "3_Fall", "4_Winter")
PLOT_SEASONS = (
    "Spring (Runoff & Solar Peak)",
    "Summer (High A/C Peak)",
    "Fall (Moderate Load)",
    "Winter (Heating & Low Solar)",
)
RAMP_TIERS = ("CRITICAL RAMP (>12 GW)", "SEVERE RAMP (8-12 GW)", "MODERATE RAMP")
ALERT_TIERS = ("LOW (Green)", "MODERATE (Amber)", "CRITICAL (Red)")
STATUS_LABELS = ("CRITICAL OVER-SUPPLY ALERT", "ELEVATED CURTAILMENT RISK", "SYSTEM BALANCED")
DETECTION_CLASSES = ("TRUE_POSITIVE", "FALSE_POSITIVE", "FALSE_NEGATIVE", "TRUE_NEGATIVE")


def season(month: ColumnLike, labels: tuple[str, ...] = REPORT_SEASONS) -> Column:
    quarter_index = F.floor((_c(month) - 3) / 3)
    return (
        F.when(quarter_index == 0, labels[0])
        .when(quarter_index == 1, labels[1])
        .when(quarter_index == 2, labels[2])
        .otherwise(labels[3])
    )


def ramp_tier(ramp: ColumnLike) -> Column:
    critical, severe, moderate = RAMP_TIERS
    col = _c(ramp)
    return F.when(col >= 12000, critical).when(col >= 8000, severe).otherwise(moderate)


def alert_tier(mw: ColumnLike, thr: float = EVENT_MW, severe: float = SEVERE_MW) -> Column:
    low, moderate, critical = ALERT_TIERS
    col = _c(mw)
    return F.when(col < thr, low).when(col < severe, moderate).when(col.isNotNull(), critical)


def system_status(peak: ColumnLike, thr: float = EVENT_MW, severe: float = SEVERE_MW) -> Column:
    critical, elevated, balanced = STATUS_LABELS
    col = _c(peak)
    return F.when(col >= severe, critical).when(col >= thr, elevated).otherwise(balanced)


def event_label(mw: ColumnLike, thr: float = EVENT_MW) -> Column:
    return F.coalesce(_c(mw) >= thr, F.lit(False)).cast("int")


def detection_class(predicted: ColumnLike, actual: ColumnLike, thr: float = EVENT_MW) -> Column:
    hit, false_alarm, miss, quiet = DETECTION_CLASSES
    warned, happened = _c(predicted) >= thr, _c(actual) >= thr
    return (
        F.when(warned & happened, hit)
        .when(warned & ~happened, false_alarm)
        .when(~warned & happened, miss)
        .otherwise(quiet)
    )


def event_prob(mw: ColumnLike, thr: float = EVENT_MW) -> Column:
    return half_even(clip(_c(mw) / F.lit(2.5 * thr), 0.0, 1.0), 3)


def interval(
    mw: ColumnLike, sigma: ColumnLike, z: float = 1.645, min_sigma: float = 25.0
) -> tuple[Column, Column]:
    """Lower (not below zero) and upper prediction bound."""
    col = _c(mw)
    half = F.lit(z) * F.greatest(_c(sigma), F.lit(min_sigma))
    return floor_zero(col - half), col + half


# ---- display text -----------------------------------------------------------
def short_time(ts: ColumnLike) -> Column:
    return F.date_format(_c(ts), "MMM dd, HH:mm 'UTC'")


def long_time(ts: ColumnLike) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm 'UTC'")


def amount(value: ColumnLike, unit: str = "MW") -> Column:
    return F.concat(F.format_number(half_even(value, 0), 0), F.lit(f" {unit}"))


def dollars(value: ColumnLike) -> Column:
    return F.concat(F.lit("$"), F.format_number(half_even(value, 0), 0))
