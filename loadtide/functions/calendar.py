"""Calendar, solar-geometry and Fourier columns."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadtide.functions.exprs import _c, total
from loadtide.schemas import FOURIER_ORDERS, SITE_LATITUDE, SITE_LONGITUDE

TWO_PI = 2 * math.pi


def local_time(ts: Column | str, tz: str) -> Column:
    """Wall-clock time in ``tz`` of a UTC timestamp."""
    return _c(ts) if tz == "UTC" else F.from_utc_timestamp(_c(ts), tz)


def calendar_columns(ts: Column | str = "ts", tz: str = "UTC") -> dict[str, Column]:
    """Hour, weekday (Monday = 0), day of year, month, quarter, weekend flag
    and a sine/cosine pair for each cyclic part."""
    at = local_time(ts, tz)
    raw = {
        "hour": F.hour(at),
        "day_of_week": F.weekday(at),
        "day_of_year": F.dayofyear(at),
        "month": F.month(at),
        "quarter": F.quarter(at),
        "is_weekend": (F.weekday(at) >= 5).cast("int"),
    }
    # part -> (zero-based position, cycle length)
    cycles = {
        "hour": (raw["hour"], 24.0),
        "day_of_week": (raw["day_of_week"], 7.0),
        "month": (raw["month"] - 1, 12.0),
        "day_of_year": (raw["day_of_year"] - 1, 365.25),
    }
    pairs = {}
    for part, (position, length) in cycles.items():
        angle = F.lit(TWO_PI) * position / F.lit(length)
        pairs[f"{part}_sin"] = F.sin(angle)
        pairs[f"{part}_cos"] = F.cos(angle)
    return raw | pairs


# Harmonic coefficients of the published low-accuracy solar
# position series. Each entry is (harmonic, cosine weight, sine weight).
EQUATION_OF_TIME = [(0, 0.000075, 0.0), (1, 0.001868, -0.032077), (2, -0.014615, -0.040849)]
DECLINATION = [
    (0, 0.006918, 0.0),
    (1, -0.399912, 0.070257),
    (2, -0.006758, 0.000907),
    (3, -0.002697, 0.00148),
]
MINUTES_PER_EQT_UNIT = 229.18
DAYLIGHT_DEG = 2.0


def _harmonics(angle: Column, series: list[tuple[int, float, float]]) -> Column:
    terms = []
    for k, cos_weight, sin_weight in series:
        if k == 0:
            terms.append(F.lit(cos_weight))
        else:
            terms.append(F.lit(cos_weight) * F.cos(angle * k))
            terms.append(F.lit(sin_weight) * F.sin(angle * k))
    return total(terms)


def solar_steps(
    ts: Column | str, lat: float = SITE_LATITUDE, lon: float = SITE_LONGITUDE
) -> list[tuple[str, Callable[[dict[str, Column]], Column]]]:
    """The elevation as named steps, each a function of the steps before.

    As columns of a table every step is computed once per row; nested into one
    expression the early steps would be repeated a dozen times.
    """
    at = _c(ts)
    site = math.radians(lat)

    def hour_angle(s: dict[str, Column]) -> Column:
        offset = F.lit(MINUTES_PER_EQT_UNIT) * _harmonics(s["_angle"], EQUATION_OF_TIME)
        # pmod, since % keeps the sign and sites west of Greenwich go below zero
        solar_minutes = F.pmod(s["_clock"] * 60 + (offset + F.lit(4 * lon)), F.lit(1440.0))
        return F.radians(solar_minutes / 4 - 180)

    def elevation(s: dict[str, Column]) -> Column:
        high = F.lit(math.sin(site)) * F.sin(s["_tilt"])
        wide = F.lit(math.cos(site)) * F.cos(s["_tilt"]) * F.cos(s["_turn"])
        cosine = F.least(F.greatest(high + wide, F.lit(-1.0)), F.lit(1.0))
        return F.greatest(F.lit(0.0), F.lit(90.0) - F.degrees(F.acos(cosine)))

    return [
        ("_clock", lambda s: F.hour(at) + F.minute(at) / F.lit(60.0)),
        (
            "_angle",
            lambda s: F.lit(TWO_PI / 365.0) * (F.dayofyear(at) - 1 + (s["_clock"] - 12) / F.lit(24.0)),
        ),
        ("_tilt", lambda s: _harmonics(s["_angle"], DECLINATION)),
        ("_turn", hour_angle),
        ("solar_elevation_deg", elevation),
    ]


def solar_elevation(
    ts: Column | str = "ts", lat: float = SITE_LATITUDE, lon: float = SITE_LONGITUDE
) -> Column:
    """Degrees of the sun above the horizon at a UTC timestamp, 0 at night."""
    done: dict[str, Column] = {}
    for name, step in solar_steps(ts, lat, lon):
        done[name] = step(done)
    return done["solar_elevation_deg"]


def is_daylight(elevation: Column | str) -> Column:
    return (_c(elevation) > DAYLIGHT_DEG).cast("int")


def elapsed_hours(ts: Column | str, origin: Column | str) -> Column:
    return (F.unix_micros(_c(ts)) - F.unix_micros(_c(origin))) / F.lit(3.6e9)


def fourier_columns(
    hours: Column, orders: dict[str, tuple[float, int]] | None = None
) -> dict[str, Column]:
    """``fourier_{name}{k}_sin`` and ``_cos`` for each cycle and harmonic."""
    out = {}
    for name, (period, order) in (orders or FOURIER_ORDERS).items():
        for k in range(1, order + 1):
            angle = F.lit(TWO_PI * k) * hours / F.lit(period)
            out[f"fourier_{name}{k}_sin"] = F.sin(angle)
            out[f"fourier_{name}{k}_cos"] = F.cos(angle)
    return out
