"""Hourly rollup, replay removal, alerts, live ramps and key-figure refresh.

All functions take and return streaming DataFrames; ``run_available`` drains a
source into a Parquet table and stops, ``start`` keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loadtide.functions.exprs import alert_tier, event_prob, net_load
from loadtide.operators.splits import first_hours
from loadtide.plans.reports import kpi_summary
from loadtide.schemas import EVENT_MW, KEYS, TS

LATE = "2 hours"


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """New Parquet files of a folder, optionally only those whose name matches."""
    reader = spark.readStream.schema(schema)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def start(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Write a stream to a Parquet table; without ``every`` only what is there."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drain the source once and return the table written."""
    start(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- telemetry --------------------------------------------------------------
def drop_replays(
    records: DataFrame, id_cols: list[str] = ("record_id",), ts: str = TS, late: str = LATE
) -> DataFrame:
    """Keep the first copy of each record. Ids are forgotten once the watermark
    has passed them, so the state stays bounded."""
    return records.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(id_cols))


# event type of a record -> telemetry column
RECORD_COLUMNS = {
    "click": "solar_generation_mw",
    "view": "wind_generation_mw",
    "signup": "nuclear_mw",
    "purchase": "hydro_mw",
}


def hourly_rollup(records: DataFrame, keys: list[str] = KEYS, ts: str = TS) -> DataFrame:
    """One dispatch row per series and closed hour.

    The same plan serves a batch. On a stream it needs a watermark (see
    ``drop_replays``); an hour comes out once it can receive no more records.
    Sums are map-side combined before the state shuffle, so a hot series costs
    one row per task and hour.
    """
    value = F.col("value").cast("decimal(18,2)")

    def scaled(factor: int, kind: str | None = None) -> Column:
        part = value if kind is None else F.when(F.col("event_type") == kind, value)
        return F.coalesce((F.sum(part) * F.lit(factor)).cast("double"), F.lit(0.0))

    hourly = records.groupBy(*keys, F.window(ts, "1 hour").alias("_hour")).agg(
        scaled(60).alias("system_demand_mw"),
        *[scaled(60, kind).alias(c) for kind, c in RECORD_COLUMNS.items()],
        scaled(3, "error").alias("curtailment_mw"),
        F.count(F.lit(1)).alias("records"),
    )
    measures = [c for c in hourly.columns if c not in (*keys, "_hour")]
    return hourly.select(*keys, F.col("_hour.start").alias(ts), *measures).withColumn(
        "net_load_mw", net_load()
    )


def alert_feed(
    forecast: DataFrame, model: str = "ensemble_mw", thr: float = EVENT_MW, keys: list[str] = KEYS, ts: str = TS
) -> DataFrame:
    """Grade each new forecast row and pass on those at or above the threshold."""
    return forecast.filter(F.col(model) >= thr).select(
        *keys,
        ts,
        F.col(model).alias("mw"),
        alert_tier(model, thr).alias("tier"),
        event_prob(model, thr).alias("probability"),
    )


def live_ramps(
    hourly: DataFrame,
    col: str = "net_load_mw",
    rows_back: int = 3,
    keys: list[str] = KEYS,
    ts: str = TS,
    late: str = LATE,
) -> DataFrame:
    """Ramp over ``rows_back`` readings on a feed of hours.

    Hours may arrive out of order by up to ``late``. A series' state is its last
    few readings and the hours the watermark has not passed yet; these come out
    in time order once it has.
    """
    source = hourly.select(*keys, ts, col).withWatermark(ts, late)
    out = T.StructType([*source.schema.fields, T.StructField("ramp", T.DoubleType())])

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        recent, times, values = state.get if state.exists else ([], [], [])
        waiting = pd.Series(values, index=np.asarray(times, dtype="int64"), dtype="float64")
        if not state.hasTimedOut:
            for pdf in batches:
                micros = pdf[ts].astype("datetime64[us]").astype("int64").to_numpy()
                waiting = pd.concat([waiting, pd.Series(pdf[col].to_numpy("float64"), index=micros)])
        waiting = waiting.sort_index()
        passed = state.getCurrentWatermarkMs()
        ready = waiting[waiting.index < passed * 1000]
        waiting = waiting[waiting.index >= passed * 1000]
        history = np.concatenate([np.asarray(recent, dtype="float64"), ready.to_numpy()])
        state.update((history[-rows_back:].tolist(), waiting.index.tolist(), waiting.tolist()))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting.index[0] // 1000), passed + 1))
        if len(ready):
            before = np.concatenate([np.full(rows_back, np.nan), history])[-len(ready) - rows_back : -rows_back]
            rows = {k: v for k, v in zip(keys, key)}
            yield pd.DataFrame(
                {**rows, ts: pd.to_datetime(ready.index, unit="us"), col: ready.to_numpy(), "ramp": ready.to_numpy() - before}
            )[[*keys, ts, col, "ramp"]]

    ramps = source.groupBy(*keys).applyInPandasWithState(
        advance,
        out,
        "recent array<double>, times array<bigint>, readings array<double>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return ramps.withColumn("ramp", F.when(~F.isnan("ramp"), F.col("ramp")))


# ---- key figures ------------------------------------------------------------
BUCKETS = 64


class _Versions:
    """Which micro-batch wrote the newest state of each bucket: a table of at most ``BUCKETS`` rows per micro-batch.

    A micro-batch writes its buckets into folders of its own and its versions last, so a repeated one starts from the versions of the
    one before. Folders that neither of the two newest versions names are deleted.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.files = self.folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _listed(self) -> list[int]:
        root = self.folder(f"{self.path}/versions")
        found = self.files.listStatus(root) if self.files.exists(root) else []
        named = [f.getPath().getName() for f in found if self.files.exists(self.folder(f.getPath(), "_SUCCESS"))]
        return sorted(int(n.partition("=")[2]) for n in named if n.startswith("batch="))

    def before(self, batch_id: int | None = None) -> tuple[int, dict[int, int]]:
        """The newest micro-batch before ``batch_id`` (-1: none) and its versions: bucket to micro-batch."""
        known = [b for b in self._listed() if batch_id is None or b < batch_id]
        if not known:
            return -1, {}
        rows = self.spark.read.parquet(f"{self.path}/versions/batch={known[-1]}").collect()
        return known[-1], {r["bucket"]: r["version"] for r in rows}

    def paths(self, name: str, versions: dict[int, int]) -> list[str]:
        return [f"{self.path}/{name}/version={v}/bucket={b}" for b, v in sorted(versions.items())]

    def commit(self, batch_id: int, versions: dict[int, int]) -> None:
        older, held = self.before(batch_id)
        oldest, gone = self.before(older)
        table = self.spark.createDataFrame(sorted(versions.items()), "bucket int, version long").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/versions/batch={batch_id}")
        used = {*versions.items(), *held.items()}
        for name in ("rows", "figures"):
            for path in self.paths(name, {b: v for b, v in gone.items() if (b, v) not in used}):
                self.files.delete(self.folder(path), True)
        if oldest >= 0:
            self.files.delete(self.folder(f"{self.path}/versions/batch={oldest}"), True)


def kpi_sink(
    path: str,
    keys: list[str] = KEYS,
    ts: str = TS,
    run: str | None = None,
    hours: int = 48,
    buckets: int = BUCKETS,
    arrival: str | None = None,
    **rule,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that keeps the key figures per series.

    The state is the newest forecast row of each of the first ``hours`` of a series, in ``buckets`` by series. A micro-batch reads
    the buckets of its own series only and writes them anew with their figures, so what it reads does not grow with the number of
    micro-batches, and a forecast may be spread over any number of them. A row of a later micro-batch replaces an earlier one of the
    same hour; inside a micro-batch the greatest ``arrival`` counts, a column of the feed, and without it the greatest values. With
    ``run``, a column that grows from run to run, only the newest run of a series counts. A repeated micro-batch changes nothing.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def newest(rows: DataFrame) -> DataFrame:
        if run:
            last = rows.groupBy(*keys).agg(F.max(run).alias(run))
            rows = rows.join(last, [*keys, run], "left_semi")
        rest = [c for c in rows.columns if c not in (*keys, ts)]
        order = ["_batch", *([arrival] if arrival else []), *(c for c in rest if c not in ("_batch", arrival))]
        rows = rows.groupBy(*keys, ts).agg(F.max(F.struct(*order)).alias("r")).select(*keys, ts, *[F.col(f"r.{c}").alias(c) for c in rest])
        return first_hours(rows, hours, keys, ts)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _Versions(spark, path)
        batch = batch.withColumn("_batch", F.lit(batch_id).cast("long")).persist()
        try:
            touched = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most ``buckets`` numbers
            _, versions = state.before(batch_id)
            old = state.paths("rows", {b: v for b, v in versions.items() if b in touched})
            rows = batch.unionByName(spark.read.schema(batch.schema).parquet(*old)) if old else batch
            new = newest(rows).withColumn("bucket", bucket)
            new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows/version={batch_id}")
        finally:
            batch.unpersist()
        mine = dict.fromkeys(touched, batch_id)
        if touched:
            kept = spark.read.schema(batch.schema).parquet(*state.paths("rows", mine)).drop("_batch")
            figures = kpi_summary(kept, hours=hours, keys=keys, ts=ts, **rule).withColumn("bucket", bucket)
            figures.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/figures/version={batch_id}")
        state.commit(batch_id, versions | mine)

    return refresh


def latest_kpis(spark: SparkSession, path: str) -> DataFrame:
    """The newest figures of every series."""
    state = _Versions(spark, path)
    _, versions = state.before()
    if not versions:
        raise ValueError(f"{path}: no micro-batch has come yet")
    return spark.read.parquet(*state.paths("figures", versions))


def refresh_kpis(
    forecast: DataFrame, path: str, checkpoint: str, every: str | None = None, **rule
) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        forecast.writeStream.foreachBatch(kpi_sink(path, **rule))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
