"""From raw readings to a clean feature table, as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadtide.operators import cleaning, features
from loadtide.schemas import KEYS, LOCAL_TZ, TS
from loadtide.sources.stages import staged


def clean_series(
    df: DataFrame, local_time: str | None = None, tz: str = LOCAL_TZ, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Readings in any order to one clean row per hour: clock changes repaired (where ``local_time`` names a column of local times),
    duplicates averaged, gaps filled, and physical bounds with the spike cap applied. The filled grid is written once, because the
    bounds read every hour twice (its own row and as a neighbour's)."""
    if local_time is not None:
        df = cleaning.local_to_utc(df, local_time, tz, keys=keys, ts=ts)
    grid = cleaning.regular_series(staged(cleaning.dedupe_mean(df, keys, ts), "readings"), keys=keys, ts=ts)
    return cleaning.apply_physical_bounds(staged(grid, "grid"), keys=keys, ts=ts)


def clean_features(df: DataFrame, local_time: str | None = None, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """All features over the clean series."""
    return features.build_features(staged(clean_series(df, local_time, keys=keys, ts=ts), "clean"), keys=keys, ts=ts)
