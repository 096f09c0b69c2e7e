import datetime as dt

import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from loadtide.operators.splits import with_row_ramp
from loadtide.plans import catalog
from loadtide.plans.reports import kpi_summary
from loadtide.sources import adapters
from loadtide.sources.stages import new_path
from loadtide.streaming import telemetry


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    """Events in several files in time order, some records replayed."""
    root = tmp_path_factory.mktemp("landed")
    events = adapters.load(spark, sf, "events")
    for i in range(4):
        part = events.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == i)
        part.unionByName(part.filter("event_id % 5 = 0")).coalesce(1).write.parquet(str(root / f"in/b{i}"))
    return str(root), events


def stream(spark, landed, events):
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{landed}/in/*")
    return telemetry.drop_replays(adapters.telemetry_events(raw))


def closed_hours(spark, sf, events):
    batch = telemetry.hourly_rollup(adapters.telemetry_events(events))
    last = events.agg(F.max("ts").cast("timestamp")).first()[0]
    return batch.filter(F.col("ts") + F.expr("interval 3 hours") <= F.lit(last))


def test_rollup_and_ramps_equal_batch(spark, sf, landed):
    root, events = landed
    hourly = telemetry.hourly_rollup(stream(spark, root, events))
    table = telemetry.run_available(hourly, f"{root}/hourly", f"{root}/hourly_cp")
    want = closed_hours(spark, sf, events)
    pd.testing.assert_frame_equal(to_pandas(table, "series_id", "ts"), to_pandas(want, "series_id", "ts"))

    # one file at a time: the hours of a series arrive out of order by days
    feed = telemetry.read_stream(spark, f"{root}/hourly", table.schema, files_per_trigger=1)
    live = telemetry.live_ramps(feed, late="10 days")
    ramps = telemetry.run_available(live, f"{root}/ramps", f"{root}/ramps_cp")
    batch = with_row_ramp(want.select("series_id", "ts", "net_load_mw"), "net_load_mw", 3, "ramp")
    last = want.agg(F.max("ts")).first()[0]
    batch = batch.select("series_id", "ts", "net_load_mw", "ramp")
    batch = batch.filter(F.col("ts") < F.lit(last) - F.expr("interval 10 days"))
    assert batch.count() > 200
    pd.testing.assert_frame_equal(to_pandas(ramps, "series_id", "ts"), to_pandas(batch, "series_id", "ts"))


def test_kpi_refresh_keeps_the_latest_run(spark, sf, landed):
    root, _ = landed
    wide = adapters.forecast_wide(spark, sf)
    path = f"{root}/fc"
    wide.write.parquet(path)
    schema = spark.read.parquet(path).schema
    for run in (1, 2):
        feed = telemetry.read_stream(spark, path, schema)
        telemetry.refresh_kpis(feed, f"{root}/kpis", f"{root}/kpis_cp").awaitTermination()
        if run == 1:
            wide.withColumn("ensemble_mw", F.col("ensemble_mw") * 2).write.mode("append").parquet(path)
    got = to_pandas(telemetry.latest_kpis(spark, f"{root}/kpis"), "series_id")
    want = to_pandas(kpi_summary(wide.withColumn("ensemble_mw", F.col("ensemble_mw") * 2)), "series_id")
    pd.testing.assert_frame_equal(got[["series_id", "peak_mw", "peak_ts"]], want[["series_id", "peak_mw", "peak_ts"]])


def test_alert_feed_is_a_filter(spark, sf):
    wide = adapters.forecast_wide(spark, sf)
    alerts = telemetry.alert_feed(wide)
    assert alerts.count() == wide.filter("ensemble_mw >= 250").count() > 0
    assert {r.tier for r in alerts.select("tier").distinct().collect()} <= {"MODERATE (Amber)", "CRITICAL (Red)"}


def test_kpi_refresh_over_several_batches_equals_the_batch(spark, sf, tmp_path):
    wide = adapters.forecast_wide(spark, sf)
    wide.repartition(5, "ts").write.parquet(f"{tmp_path}/fc")
    feed = telemetry.read_stream(spark, f"{tmp_path}/fc", spark.read.parquet(f"{tmp_path}/fc").schema, files_per_trigger=1)
    telemetry.refresh_kpis(feed, f"{tmp_path}/kpis", f"{tmp_path}/cp").awaitTermination()
    got = to_pandas(telemetry.latest_kpis(spark, f"{tmp_path}/kpis"), "series_id")
    want = to_pandas(kpi_summary(wide), "series_id")
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)])


def test_replays_are_written_in_parallel(spark, sf, tmp_path, monkeypatch):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    paths = {}

    def kept_path(session, name):
        paths[name] = new_path(session, name)
        return paths[name]

    monkeypatch.setattr(catalog, "new_path", kept_path)
    out = catalog.stream_replays(spark, str(tmp_path))
    assert out.count() > 0
    assert spark.read.parquet(paths["replayed"]).count() == 2 * events.count()
    assert len(spark.read.parquet(paths["replayed"]).inputFiles()) > 2


def test_kpi_state_stays_flat_and_repeats_change_nothing(spark, tmp_path):
    """Fifty micro-batches revise the hours of two series: the state read stays as large as after the first."""
    sink = telemetry.kpi_sink(f"{tmp_path}/k", buckets=4, run="run", arrival="seq")
    schema = "series_id long, ts timestamp, ensemble_mw double, net_load_mw double, run long, seq long"
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    every, sizes = [], []
    for batch in range(50):
        rows = []
        for h in range(60):
            # of two rows of one hour the later arrival counts, though its value is less
            rows += [(batch % 2, start + dt.timedelta(hours=h), 900.0 + h, 5.0, batch // 10, 1), (batch % 2, start + dt.timedelta(hours=h), float((batch * 7 + h) % 400), 5.0 + batch, batch // 10, 2)]
        every.append(rows)
        df = spark.createDataFrame(rows, schema)
        sink(df, batch)
        if batch in (20, 49):
            before = to_pandas(telemetry.latest_kpis(spark, f"{tmp_path}/k"), "series_id")
            sink(df, batch)
            pd.testing.assert_frame_equal(to_pandas(telemetry.latest_kpis(spark, f"{tmp_path}/k"), "series_id"), before)
        sizes.append(sum(f.stat().st_size for f in (tmp_path / "k" / "rows").rglob("*.parquet")))
    assert max(sizes[4:]) < 2 * sizes[4]
    assert len(list((tmp_path / "k" / "versions").iterdir())) <= 3
    last = spark.createDataFrame([r for rows in every[-2:] for r in rows if r[-1] == 2], schema).drop("run", "seq")
    want = to_pandas(kpi_summary(last), "series_id")
    got = to_pandas(telemetry.latest_kpis(spark, f"{tmp_path}/k"), "series_id")
    pd.testing.assert_frame_equal(got[want.columns], want)
