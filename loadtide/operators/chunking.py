"""Windows over long series without putting a series into one task.

A window partitioned by the series alone hands the whole history of a series
to one task. Here every series is cut into time chunks. Rows near a chunk's
edge are copied to the neighbour whose frames reach them (the halo), each
chunk is windowed on its own, and only the chunk's own rows are kept. On a
gap-free hourly grid that is exact, and a chunk never holds more than
``size + back + ahead`` rows, however long or dominant its series is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadtide.functions.exprs import epoch_hours
from loadtide.schemas import KEYS, TS

CHUNK_HOURS = 2160
CHUNK = "_chunk"
OWN = "_own"


def chunk_of(ts: str = TS, size: int = CHUNK_HOURS) -> Column:
    return F.floor(epoch_hours(ts) / size)


def spread(
    df: DataFrame, back: int, ahead: int = 0, ts: str = TS, size: int = CHUNK_HOURS
) -> DataFrame:
    """Copy each row to every chunk with a row whose frame
    ``[-back, +ahead]`` hours reaches it; ``_own`` marks the original."""
    hour = epoch_hours(ts)
    first, last = F.floor((hour - ahead) / size), F.floor((hour + back) / size)
    return df.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn(
        OWN, F.col(CHUNK) == chunk_of(ts, size)
    )


def chunk_window(keys: list[str] = KEYS, ts: str = TS) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(ts)


def owned(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OWN)).drop(CHUNK, OWN)


def over_chunks(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int,
    ahead: int = 0,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """Run ``build(rows, window)`` per chunk and keep the own rows.

    ``df`` must be gap-free per series, so that row frames are hour frames.
    """
    return owned(build(spread(df, back, ahead, ts, size), chunk_window(keys, ts)))


def row_lag(
    df: DataFrame,
    columns: dict[str, str],
    k: int,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """``LAG(column, k)`` by row order per series, gaps and all, chunk by chunk.

    ``columns`` maps source to result names. Where a chunk's first ``k`` rows
    look past its start, they read the last rows of the chunks before it, which
    travel as one small array per chunk.
    """
    rows = df.withColumn(CHUNK, chunk_of(ts, size))
    w = chunk_window(keys, ts)
    names = list(columns)
    numbered = rows.withColumns(
        {"_rn": F.row_number().over(w)} | {f"_lag_{c}": F.lag(c, k).over(w) for c in names}
    )
    last_rows = rows.withColumn("_more", F.lead(F.lit(1), k).over(w)).filter(F.col("_more").isNull())
    tails = last_rows.groupBy(*keys, CHUNK).agg(
        F.sort_array(F.collect_list(F.struct(ts, *names))).alias("_tail")
    )
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-k, -1)
    carry = tails.select(*keys, CHUNK, F.flatten(F.collect_list("_tail").over(before)).alias("_carry"))
    # NULL when the index falls before the start of the series
    carried = F.get("_carry", F.size("_carry") - (F.lit(k + 1) - F.col("_rn")))
    return (
        numbered.join(carry, [*keys, CHUNK], "left")
        .withColumns(
            {
                new: F.when(F.col("_rn") > k, F.col(f"_lag_{c}")).otherwise(carried[c])
                for c, new in columns.items()
            }
        )
        .drop(CHUNK, "_rn", "_carry", *[f"_lag_{c}" for c in names])
    )
