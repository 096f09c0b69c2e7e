import json

import pandas as pd
import pytest
from conftest import hours, random_series, to_pandas, to_spark
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadtide import schemas
from loadtide.operators import cleaning, ridge, splits
from loadtide.plans import reports
from loadtide.sources import adapters, constraints, feeds, stages, tables


def test_fuel_pages_keep_all_fuels(spark, tmp_path):
    def rec(period, fuel, value, who="AREA"):
        return {"period": period, "fueltype": fuel, "respondent": who, "value": value}

    pages = [
        [rec("2024-01-01T00", "SUN", "10"), rec("2024-01-01T00", "WND", "5"), rec("bad", "SUN", "1")],
        [rec("2024-01-01T01", "SUN", "7"), rec("2024-01-02T00", "SUN", "9"), rec("2024-01-01T01", "NG", "3", "X")],
    ]
    for i, data in enumerate(pages):
        (tmp_path / f"p{i}.json").write_text(json.dumps({"response": {"data": data, "total": 6}}, indent=1))
    rows = feeds.load_fuel_pages(spark, str(tmp_path), ["AREA"], ["SUN", "WND"], "2024-01-01T00", "2024-01-01T23")
    assert sorted((r.fueltype, r.value_mw) for r in rows.collect()) == [("SUN", 7.0), ("SUN", 10.0), ("WND", 5.0)]
    wide = feeds.pivot_fuel_mix(rows)
    first = wide.orderBy("ts").first()
    assert (first.solar_generation_mw, first.wind_generation_mw, first.nuclear_mw) == (10.0, 5.0, None)


def test_station_files(spark, tmp_path):
    (tmp_path / "72295023174_2023.csv").write_text("ts,temperature_c\n2023-01-01 00:00:00,5.5\n")
    (tmp_path / "72494023234.csv").write_text("ts,temperature_c\n2023-01-01 00:00:00,\n")
    schema = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("temperature_c", T.DoubleType())])
    got = {r.station_id: r.temperature_c for r in feeds.load_stations(spark, str(tmp_path), schema).collect()}
    assert got == {"72295023174": 5.5, "72494023234": None}
    a = spark.createDataFrame([(1, 2.0)], "h int, t double")
    b = spark.createDataFrame([(1,)], "h int")
    assert {r.station_id: r.t for r in feeds.union_stations({"a": a, "b": b}).collect()} == {"a": 2.0, "b": None}


def test_table_round_trips(spark, tmp_path):
    df = to_spark(spark, random_series(50, 1)).withColumn("curtailment_mw", F.lit(float("nan")))
    path = str(tmp_path / "dispatch.parquet")
    tables.write_table(tables.with_year(df), path, ["series_id", "year"])
    back = tables.read_table(spark, path, schemas.DISPATCH)
    assert back.count() == 50
    assert back.filter("curtailment_mw is not null").count() == 0
    csv = str(tmp_path / "t.csv")
    df.select("ts", "net_load_mw").write.option("header", True).csv(csv)
    typed = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("net_load_mw", T.DoubleType())])
    assert tables.read_table(spark, csv, typed).count() == 50
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError):
        tables.select_available(df, ["nope"])
    assert tables.select_available(df, ["nope", "ts"]).columns == ["ts"]


def test_state_and_scorecard(spark, tmp_path):
    df = to_spark(spark, random_series(100, 1))
    coef = ridge.fit_seasonal_ridge(df)
    path = str(tmp_path / "state")
    tables.write_state(coef, path, "r1")
    tables.write_state(coef.withColumn("n", F.lit(0)), path, "r2")
    back = tables.read_state(spark, path, "r1")
    assert back.first().n == 100 and list(back.first().beta) == pytest.approx(list(coef.first().beta))
    card = spark.createDataFrame([("m", 1.5)], "model string, mae double")
    tables.write_scorecard(card, str(tmp_path / "card"))
    assert tables.read_scorecard(spark, str(tmp_path / "card"), card.schema).collect() == card.collect()


def test_forecast_load_parses_times(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 05:00:00", 1.0)], "ts string, ensemble_mw double").write.parquet(str(tmp_path / "f"))
    assert feeds.load_forecast(spark, str(tmp_path / "f")).schema["ts"].dataType == T.TimestampType()


def test_constraints_and_defaults(spark):
    pdf = pd.DataFrame({"series_id": [1, 1, 1], "ts": hours(3), "system_demand_mw": [1.0, None, 3.0]})
    pdf.loc[2, "ts"] = pdf.loc[0, "ts"]
    df = to_spark(spark, pdf)
    found = {(r.rule, r.column_name): r.violations for r in constraints.validate(df, schemas.RULES["dispatch"]).collect()}
    assert found["not_null", "system_demand_mw"] == 1
    assert found["unique", "series_id,ts"] == 1
    assert found["not_null", "hydro_mw"] == 3
    full = constraints.apply_defaults(df, schemas.RULES["dispatch"]).orderBy("ts", "system_demand_mw").first()
    assert (full.lmp_usd, full.hydro_mw, full.net_load_mw) == (35.0, 0.0, 1.0)


def test_staged_uses_the_shared_folder(spark):
    df = stages.staged(spark.range(5), "five")
    assert df.count() == 5
    assert stages.shared_dir(spark) in df.inputFiles()[0].replace("file://", "").replace("file:", "")


def test_horizon_padding_and_persistence(spark):
    df = to_spark(spark, random_series(200, 1))
    short = splits.first_hours(df, 5)
    long = to_pandas(splits.fit_to_horizon(short, 8, ["net_load_mw"]), "ts")
    assert len(long) == 8 and (long.net_load_mw[4:] == long.net_load_mw[4]).all()
    assert splits.fit_to_horizon(df, 8, ["net_load_mw"]).count() == 8
    p = to_pandas(splits.persistence(df, lag_hours=24), "ts")
    pd.testing.assert_series_equal(p.persistence_mw, p.curtailment_mw.shift(24), check_names=False)


def test_report_edges(spark, sf):
    dispatch = adapters.dispatch_events(spark, sf)
    empty = dispatch.filter("false")
    for report in (reports.duck_curve, reports.evening_ramps, reports.weekly_surplus):
        assert report(empty).count() == 0
    log = adapters.forecast_log(spark, sf)
    assert reports.forecast_scorecard(log, empty).count() == 0
    calm = dispatch.withColumn("curtailment_mw", F.lit(0.0))
    quiet = log.withColumn("predicted_curtailment_mw", F.lit(0.0))
    row = reports.forecast_scorecard(quiet, calm).first()
    assert row.precision_score is None and row.recall_score is None and row.mae_mw == 0


def test_holidays(spark):
    days = {r.holiday: str(r.date) for r in ridge.us_holidays(spark, 2024, 2024).collect()}
    assert days["Thanksgiving"] == "2024-11-28" and days["Memorial Day"] == "2024-05-27"
    df = spark.sql("select 1 series_id, timestamp'2024-07-05 03:00:00' ts union all select 1, timestamp'2024-07-05 12:00:00'")
    got = cleaning.with_holidays(df, ridge.us_holidays(spark, 2024, 2024)).orderBy("ts").collect()
    assert [r.is_holiday for r in got] == [1, 0]


def test_observed_holidays_follow_the_data(spark):
    df = spark.sql("select explode(array(timestamp'2021-07-05 20:00:00', timestamp'2031-07-04 20:00:00', timestamp'2021-12-31 20:00:00', timestamp'1987-01-02 20:00:00')) ts")
    got = {str(r.ts.date()): r.holiday for r in cleaning.with_holidays(df, ridge.holidays_of(df)).collect()}
    assert got == {
        "2021-07-05": "Independence Day (observed)",
        "2031-07-04": "Independence Day",
        "2021-12-31": "New Year's Day (observed)",
        "1987-01-02": None,
    }
    days = ridge.us_holidays(spark, 1990, 2040)
    assert days.count() == days.select("date").distinct().count()


def test_only_complete_forecast_runs_are_read(spark, tmp_path):
    rows = lambda v, hours_: spark.createDataFrame([(1, f"2024-01-01 {h:02}:00:00", v) for h in hours_], "series_id long, t string, mw double").select("series_id", F.to_timestamp("t").alias("ts"), "mw")
    path = f"{tmp_path}/fc"
    feeds.publish_forecast(rows(1.0, range(4)), path, "a")
    feeds.publish_forecast(rows(2.0, range(2, 6)), path, "b")
    rows(9.0, range(6)).write.parquet(f"{path}/runs/run=c")  # never published
    read = lambda **k: [(r.mw, r.run) for r in feeds.latest_forecast(spark, path, **k).orderBy("ts").collect()]
    assert read() == [(1.0, "a")] * 2 + [(2.0, "b")] * 4
    assert read(as_of="a") == [(1.0, "a")] * 4
    feeds.publish_forecast(rows(3.0, range(3)), path, "b")
    assert read() == [(3.0, "b")] * 3 + [(1.0, "a")]
    assert {(r.run, r.rows) for r in feeds.published_runs(spark, path).collect()} == {("a", 4), ("b", 3)}
    with pytest.raises(ValueError):
        feeds.latest_forecast(spark, path, as_of="0")
