from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from loadtide.sources.tables import use_utc  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("loadtide-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def hours(n: int, start: str = "2024-01-01") -> list[dt.datetime]:
    return [t.to_pydatetime() for t in pd.date_range(start, periods=n, freq="h")]


def random_series(n: int, seed: int, holes: float = 0.0, spikes: int = 0) -> pd.DataFrame:
    """One series per call: hourly dispatch with optional NULLs and spikes."""
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    demand = 20000 + 3000 * np.sin(2 * np.pi * t / 24) + rng.normal(0, 300, n)
    solar = np.maximum(0, 6000 * np.sin(2 * np.pi * (t - 6) / 24)) + rng.normal(0, 50, n)
    wind = 2000 + rng.normal(0, 400, n)
    curtailment = np.maximum(0, rng.normal(150, 200, n))
    out = pd.DataFrame(
        {
            "series_id": seed,
            "ts": hours(n),
            "system_demand_mw": demand,
            "solar_generation_mw": solar,
            "wind_generation_mw": wind,
            "curtailment_mw": curtailment,
            "temperature_c": rng.normal(15, 5, n),
            "wind_speed_mps": rng.normal(5, 1, n),
            "ghi_estimated": np.maximum(0, solar / 6),
        }
    )
    out["net_load_mw"] = demand - (solar + wind)
    measures = [c for c in out.columns if c not in ("series_id", "ts")]
    for i in rng.choice(n, spikes, replace=False):
        out.loc[i, "system_demand_mw"] *= 6
    if holes:
        out[measures] = out[measures].mask(rng.random((n, len(measures))) < holes)
    return out


def to_spark(spark, pdf: pd.DataFrame):
    rows = pdf.astype(object).where(pdf.notna(), None).values.tolist()
    kinds = []
    for c in pdf.columns:
        if pdf[c].dtype.kind in "iu":
            kinds.append(f"`{c}` bigint")
        elif pdf[c].dtype.kind == "M":
            kinds.append(f"`{c}` timestamp")
        elif pdf[c].dtype.kind == "f":
            kinds.append(f"`{c}` double")
        else:
            kinds.append(f"`{c}` string")
    rows = [
        [v.to_pydatetime().replace(tzinfo=dt.timezone.utc) if isinstance(v, pd.Timestamp) else v for v in r]
        for r in rows
    ]
    return spark.createDataFrame(rows, ", ".join(kinds))


def to_pandas(df, *order: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)
