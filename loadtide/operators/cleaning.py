"""Time repair, duplicates, hourly grid, gap filling, bounds, station blend."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide.functions.exprs import capped, epoch_hours, floor_zero, net_load, plus_hours, renewables
from loadtide.operators.chunking import CHUNK, CHUNK_HOURS, OWN, chunk_of, over_chunks
from loadtide.schemas import (
    BOUNDED,
    KEYS,
    LOCAL_TZ,
    STATION_WEIGHTS,
    TS,
    UNKNOWN_STATION_WEIGHT,
    WEATHER_MEASURES,
)


def numeric_columns(df: DataFrame, without: list[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


# ---- local time -------------------------------------------------------------
ZONE_SUFFIX = r"\d(\.\d+)?\s*(Z|UTC|[+-]\d{2}:?\d{2})$"


def local_to_utc(
    df: DataFrame,
    col: str,
    tz: str = LOCAL_TZ,
    seq_col: str = "record_seq",
    keys: list[str] = KEYS,
    ts: str = TS,
) -> DataFrame:
    """Wall-clock texts or times to UTC in ``ts``; unreadable ones are dropped.

    Only what has no zone is read as local time: a text that ends in Z or an
    offset, and a column of type timestamp, already name the moment.

    A time skipped by the spring change moves to the change itself. In the
    repeated autumn hour the arrival order decides: readings before the one
    step back are daylight time, from it on standard time. Where the order
    shows no step back, or several, the series' readings of that hour are
    ambiguous and dropped.
    """
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        wall = F.try_to_timestamp(F.col(col))
        zoned = F.trim(F.col(col)).rlike(ZONE_SUFFIX)
    else:
        wall, zoned = F.col(col).cast("timestamp"), F.lit(isinstance(kind, T.TimestampType))
    read = df.withColumns({"_wall": wall, "_zoned": zoned}).filter(F.col("_wall").isNotNull())
    utc = F.to_utc_timestamp("_wall", tz)
    skipped = F.from_utc_timestamp(utc, tz) != F.col("_wall")
    shifted = F.to_utc_timestamp(plus_hours(F.date_trunc("HOUR", "_wall"), 1), tz)
    marked = read.withColumns(
        {
            ts: F.when(F.col("_zoned"), F.col("_wall")).when(skipped, shifted).otherwise(utc),
            # an hour later the same wall time shows again only in a repeated hour
            "_fold": ~F.col("_zoned") & (F.from_utc_timestamp(plus_hours(utc, 1), tz) == F.col("_wall")),
        }
    )
    # Only the rows of one hour a year are ordered; all others stay where they are.
    hour = Window.partitionBy(*keys, F.to_date("_wall"))
    arrival = hour.orderBy(seq_col)
    back = (F.col("_wall") <= F.lag("_wall").over(arrival)).cast("int")
    repeated = (
        marked.filter("_fold")
        .withColumn("_back", F.coalesce(back, F.lit(0)))
        .withColumns(
            {
                "_steps": F.sum("_back").over(hour),
                "_after": F.sum("_back").over(arrival.rowsBetween(Window.unboundedPreceding, 0)),
            }
        )
        .filter(F.col("_steps") == 1)
        .withColumn(ts, plus_hours(ts, F.col("_after").cast("int")))
        .drop("_back", "_steps", "_after")
    )
    plain = marked.filter(~F.col("_fold"))
    return plain.unionByName(repeated).drop("_wall", "_zoned", "_fold")


# ---- duplicates -------------------------------------------------------------
def dedupe_mean(
    df: DataFrame, keys: list[str] = KEYS, ts: str = TS, cols: list[str] | None = None
) -> DataFrame:
    """One row per key and time: the mean of the numeric columns.

    The averages combine on the map side, so replays of one hour by the
    million reach the shuffle as one row per task.
    """
    cols = cols or numeric_columns(df, without=keys)
    return df.groupBy(*keys, ts).agg(*[F.avg(c).alias(c) for c in cols])


# ---- hourly grid ------------------------------------------------------------
def _calendar(df: DataFrame, keys: list[str], ts: str, size: int) -> DataFrame:
    """Every hour from the first to the last reading of each series.

    Hours are generated in the executors, chunk after chunk.
    """
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    hours = F.floor((F.unix_seconds("_hi") - F.unix_seconds("_lo")) / 3600)
    return (
        span.withColumn("_n", hours)
        .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n"), F.lit(size).cast("long"))))
        .withColumn(
            "_h", F.explode(F.sequence("_from", F.least(F.col("_from") + (size - 1), F.col("_n"))))
        )
        .select(*keys, plus_hours("_lo", F.col("_h").cast("int")).alias(ts))
    )


def _grid_chunks(df: DataFrame, keys: list[str], ts: str, size: int) -> DataFrame:
    """Grid rows, shuffled once by (series, chunk), with the ``_chunk`` column.

    Calendar and readings are stacked and grouped instead of joined: a join on
    (series, ts) would shuffle by ts, and the gap filler would need another
    shuffle by chunk. Grouping inside (series, chunk) partitions needs none.
    """
    measures = [c for c in df.columns if c not in (*keys, ts)]
    # Stated here, these filters are the same wherever the grid is used, and the
    # gap filler's summary can reuse the shuffle of the rows.
    for c in (*keys, ts):
        df = df.filter(F.col(c).isNotNull())
    stacked = df.withColumn("_grid", F.lit(0)).unionByName(
        _calendar(df, keys, ts, size).withColumn("_grid", F.lit(1)), allowMissingColumns=True
    )
    by_chunk = stacked.withColumn(CHUNK, chunk_of(ts, size)).repartition(*keys, CHUNK)
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    # readings of one hour are averaged; other columns take the smallest value
    return (
        by_chunk.groupBy(*keys, CHUNK, ts)
        .agg(
            F.max("_grid").alias("_grid"),
            *[(F.avg if c in numbers else F.min)(c).alias(c) for c in measures],
        )
        .filter("_grid = 1")
        .drop("_grid")
    )


def hourly_grid(
    df: DataFrame, keys: list[str] = KEYS, ts: str = TS, size: int = CHUNK_HOURS
) -> DataFrame:
    """Left join of the full hourly calendar with the readings.

    Several readings of one (series, ts) are averaged; missing hours come out
    as NULL rows and readings between grid points are lost.
    """
    return _grid_chunks(df, keys, ts, size).drop(CHUNK)


# ---- gap filling ------------------------------------------------------------
def _fill_chunks(df: DataFrame, cols: list[str], limit: int, keys: list[str], ts: str) -> DataFrame:
    """Fill ``cols`` of a grid that already carries ``_chunk``.

    Each row looks up the nearest valid reading before (``_a``) and after
    (``_b``): its hour ``t`` and its value ``v``. Mostly they lie in the chunk.
    For those that do not, each chunk's first and last valid reading per column
    are carried over the chunks in a summary with one row per chunk.
    """
    df = df.withColumn("_pos", epoch_hours(ts))
    series = ", ".join(f"`{k}`" for k in keys)
    hour = {c: f"if(`{c}` is not null, _pos, null)" for c in cols}
    value = {c: f"cast(`{c}` as double)" for c in cols}
    firsts = {f"_bt_{c}": f"min({hour[c]})" for c in cols} | {
        f"_bv_{c}": f"min_by({value[c]}, {hour[c]})" for c in cols
    }
    lasts = {f"_at_{c}": f"max({hour[c]})" for c in cols} | {
        f"_av_{c}": f"max_by({value[c]}, {hour[c]})" for c in cols
    }
    summary = df.groupBy(*keys, CHUNK).agg(
        *[F.expr(x).alias(name) for name, x in (firsts | lasts).items()]
    )

    # Looking ahead is a running frame over the reversed order: a frame that
    # shrinks towards the end would be aggregated anew for every row.
    def nearest(source: str, side: str, part: str, order: str, until: str) -> str:
        way = "" if side == "a" else " desc"
        return (
            f"last({source}, true) over (partition by {part} order by {order}{way} "
            f"rows between unbounded preceding and {until})"
        )

    carried = {
        f"_carry{n}": nearest(n, n[1], series, CHUNK, "1 preceding") for n in (*firsts, *lasts)
    }
    carry = summary.select(*keys, CHUNK, *[F.expr(x).alias(n) for n, x in carried.items()])
    found = {}
    for side in "ab":
        for c in cols:
            for name, source in ((f"_{side}t_{c}", hour[c]), (f"_{side}v_{c}", value[c])):
                inside = nearest(source, side, f"{series}, {CHUNK}", f"`{ts}`", "current row")
                found[name] = F.expr(f"coalesce({inside}, _carry{name})")
    # A left join: an inner one would filter the left side below its shuffle, and
    # the summary could not reuse that shuffle any more.
    near = df.join(carry, [*keys, CHUNK], "left").withColumns(found)
    filled = {c: F.expr(_filled(c, limit)) for c in cols}
    return near.withColumns(filled).select(*[c for c in df.columns if c != "_pos"])


def _filled(c: str, limit: int) -> str:
    """Closed form of: time-linear up to ``limit`` rows from either side, the
    rest takes the next filled value, and beyond the last reading the last.

    Far from both sides the next filled value is the one ``limit`` before b.
    """
    at, av, bt, bv = (f"_{n}_{c}" for n in ("at", "av", "bt", "bv"))
    x = f"if(_pos - {at} <= {limit} or {bt} - _pos <= {limit}, _pos, {bt} - {limit})"
    line = f"{av} + ({bv} - {av}) * ({x} - {at}) / ({bt} - {at})"
    return (
        f"case when `{c}` is not null then cast(`{c}` as double) "
        f"when {at} is not null and {bt} is not null then {line} else coalesce({av}, {bv}) end"
    )


def fill_gaps(
    df: DataFrame,
    cols: list[str] | None = None,
    limit: int = 3,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """Fill NULLs of an hourly grid, column by column."""
    cols = cols or numeric_columns(df, without=keys)
    chunked = df.withColumn(CHUNK, chunk_of(ts, size)).repartition(*keys, CHUNK)
    return _fill_chunks(chunked, cols, limit, keys, ts).drop(CHUNK)


def regular_series(
    df: DataFrame,
    cols: list[str] | None = None,
    limit: int = 3,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """``fill_gaps(hourly_grid(df))`` with one shuffle of the readings."""
    cols = cols or numeric_columns(df, without=keys)
    return _fill_chunks(_grid_chunks(df, keys, ts, size), cols, limit, keys, ts).drop(CHUNK)


# ---- physical bounds --------------------------------------------------------
def bounded_columns(
    df: DataFrame, w: WindowSpec, cols: list[str], window: int, min_obs: int, cutoff: float, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Floor, spike cap, curtailment cap and net load over the rows of chunks.

    The frame is centred and has ``window`` rows, the row itself included: for
    an even size it starts half a window back and ends one short of it ahead.

    Values are capped at median + cutoff * deviation of their frame. A median is never more than one deviation from the mean, so only
    a value above mean + (cutoff - 1) * deviation can exceed its cap: at most a tenth of a frame, about one row in a hundred. Running
    sums find these candidates, a few steps per row whatever the frame. Median and deviation are taken for candidates alone, by a
    range join with the rows of their chunk; rows, candidates and neighbours read one shuffle, and the caps come back as one small
    map per chunk.
    """
    cols = [c for c in cols if c in df.columns]
    group = [*keys, CHUNK]
    back, ahead = window // 2, (window - 1) // 2
    rows = df.withColumns({c: floor_zero(c) for c in cols})
    before, whole = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(*group)
    # sums of the distance from the chunk's mean, which keeps them small
    centred = rows.withColumns({f"_x_{c}": F.col(c) - F.avg(c).over(whole) for c in cols})
    parts = {f"_n_{c}": F.count(f"_x_{c}") for c in cols} | {f"_s_{c}": F.sum(f"_x_{c}") for c in cols}
    parts |= {f"_q_{c}": F.sum(F.col(f"_x_{c}") * F.col(f"_x_{c}")) for c in cols}
    running = centred.withColumns({n: F.coalesce(x.over(before), F.lit(0)) for n, x in parts.items()})
    sums = {n: F.coalesce(F.lead(n, ahead).over(w), F.last(n).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            - F.coalesce(F.lag(n, back + 1).over(w), F.lit(0)) for n in parts}
    framed = running.withColumns(sums)

    def near(c: str) -> Column:
        n, mean = F.col(f"_n_{c}"), F.try_divide(f"_s_{c}", f"_n_{c}")
        var = F.try_divide(F.greatest(F.col(f"_q_{c}") - mean * F.col(f"_s_{c}"), F.lit(0.0)), n - 1)
        return F.col(OWN) & (n >= min_obs) & (F.col(c) > 100) & (F.col(f"_x_{c}") > mean + F.lit(0.999 * (cutoff - 1)) * F.sqrt(var))

    marked = framed.withColumns({f"_near_{c}": F.coalesce(near(c), F.lit(False)) for c in cols})
    marked = marked.drop(*[f"_{x}_{c}" for c in cols for x in "xnsq"])
    some = marked.filter(reduce(operator.or_, [F.col(f"_near_{c}") for c in cols]))
    some = some.select(*group, F.col(ts).alias("_at"), *[f"_near_{c}" for c in cols])
    beside = rows.select(*group, F.col(ts).alias("_beside"), *cols)
    reach = F.col("_beside").between(plus_hours("_at", -back), plus_hours("_at", ahead))
    caps = some.join(beside, group).filter(reach).groupBy(*group, "_at").agg(
        *[
            (F.percentile(F.when(F.col(f"_near_{c}"), F.col(c)), 0.5) + F.lit(cutoff) * F.stddev_samp(F.when(F.col(f"_near_{c}"), F.col(c)))).alias(f"_cap_{c}")
            for c in cols
        ]
    )
    packed = caps.groupBy(*group).agg(
        *[F.map_from_entries(F.collect_list(F.when(F.col(f"_cap_{c}").isNotNull(), F.struct("_at", f"_cap_{c}")))).alias(f"_caps_{c}") for c in cols]
    )
    out = marked.join(packed, group, "left").withColumns(
        {c: F.when(F.col(f"_near_{c}"), capped(c, F.try_element_at(f"_caps_{c}", F.col(ts)))).otherwise(F.col(c)) for c in cols}
    )
    out = out.drop(*[f"_{x}_{c}" for c in cols for x in ("near", "caps")])
    if {"solar_generation_mw", "wind_generation_mw"} <= set(out.columns):
        if "curtailment_mw" in out.columns:
            out = out.withColumn("curtailment_mw", capped("curtailment_mw", renewables()))
        if "system_demand_mw" in out.columns:
            out = out.withColumn("net_load_mw", net_load())
    return out


def apply_physical_bounds(
    df: DataFrame,
    cols: list[str] = BOUNDED,
    window: int = 168,
    min_obs: int = 24,
    cutoff: float = 4.0,
    keys: list[str] = KEYS,
    ts: str = TS,
    size: int = CHUNK_HOURS,
) -> DataFrame:
    """Physical and statistical limits on a gap-free hourly grid."""
    return over_chunks(
        df,
        lambda rows, w: bounded_columns(rows, w, cols, window, min_obs, cutoff, keys, ts),
        back=window // 2,
        ahead=(window - 1) // 2,
        keys=keys,
        ts=ts,
        size=size,
    )


# ---- weather ----------------------------------------------------------------
def station_weights(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The few station weights as a table, scaled to sum to one."""
    weights = weights or STATION_WEIGHTS
    scale = sum(weights.values())
    rows = [(s, v / scale) for s, v in weights.items()]
    return df.sparkSession.createDataFrame(rows, "station_id string, weight double")


def blend_stations(
    weather: DataFrame,
    weights: dict[str, float] | None = None,
    default: float = UNKNOWN_STATION_WEIGHT,
    null_aware: bool = False,
    ts: str = TS,
) -> DataFrame:
    """Weighted mean of all stations' readings per time.

    A missing reading still counts its weight below the line, unless
    ``null_aware``. The weight table is as long as the given dict, so it is
    broadcast.
    """
    cols = [c for c in WEATHER_MEASURES if c in weather.columns]
    tagged = weather.join(F.broadcast(station_weights(weather, weights)), "station_id", "left")
    weight = F.coalesce("weight", F.lit(default))

    def blend(c: str) -> Column:
        weighed = F.sum(F.col(c) * weight)
        if null_aware:
            return F.try_divide(weighed, F.sum(F.when(F.col(c).isNotNull(), weight)))
        return F.coalesce(weighed, F.lit(0.0)) / F.sum(weight)

    return tagged.groupBy(ts).agg(*[blend(c).alias(c) for c in cols])


def join_weather(dispatch: DataFrame, blend: DataFrame, ts: str = TS) -> DataFrame:
    """Attach the station blend of the same hour; the blend's columns win."""
    return dispatch.drop(*[c for c in blend.columns if c != ts]).join(blend, ts, "left")


def with_holidays(df: DataFrame, holidays: DataFrame, tz: str = LOCAL_TZ, ts: str = TS) -> DataFrame:
    """``holiday`` name and ``is_holiday`` flag by local date.

    ``holidays`` has the columns ``date`` and ``holiday``, one row per date.
    """
    local_date = F.to_date(F.from_utc_timestamp(ts, tz))
    out = df.withColumn("_date", local_date).join(
        holidays.select(F.col("date").alias("_date"), "holiday"), "_date", "left"
    )
    return out.withColumn("is_holiday", F.col("holiday").isNotNull().cast("int")).drop("_date")
