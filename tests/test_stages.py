"""From CSV drop to the station screen, twice."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import sources as drops
from checks import tables as given
from stationflow.operators import forecast
from stationflow.plans import stages
from stationflow.sources import schemas, tables

GRID = {
    "changepoint_prior_scale": [0.05],
    "seasonality_prior_scale": [1, 3],
    "seasonality_mode": ["additive"],
}


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name, rows in (
        ("trips", drops.trips_text(spark, sf)),
        ("weather", drops.weather_text(spark, sf)),
    ):
        rows.write.option("header", True).csv(str(root / "drop" / name))
    stages.prepare(spark, str(root / "drop/trips"), str(root / "drop/weather"), str(root))
    return str(root)


@pytest.fixture(scope="module")
def status(spark, sf):
    return given.status(spark, sf).withColumn("station_id", F.col("station_id").cast("string"))


def publish(spark, sf, lake, status, before, run, promote):
    live = given.live_weather(spark, sf)
    return stages.train_and_publish(
        spark, lake, status, live, given.SPLIT, before, run, 4, promote, GRID, 14, 3, 5
    )


def test_silver_tables(spark, sf, lake):
    trips = tables.read_table(spark, lake, "silver", "trips")
    weather = tables.read_table(spark, lake, "silver", "weather")
    assert trips.columns == schemas.SILVER_TRIPS and weather.columns == schemas.SILVER_WEATHER
    assert trips.count() == given.trips(spark, sf).count()
    assert weather.count() == given.weather(spark, sf).count()
    typed = dict(stages.typed_weather(weather).dtypes)
    assert typed["temp"] == "double" and typed["ts_hour"] == "timestamp_ntz"


def test_publish_twice(spark, sf, lake, status):
    stages.create_gold(spark, lake)
    with pytest.raises(ValueError):
        publish(spark, sf, lake, status, "0", "0", False)
    first = publish(spark, sf, lake, status, "0", "1", False)
    assert first.count() > 0 and first.schema == schemas.GOLD
    assert {r.model_type for r in first.select("model_type").distinct().collect()} == {"Staging"}
    assert first.filter("yhat IS NULL OR model_res IS NULL").count() == 0
    # The same model again is no better, so nothing changes; forced, it goes live beside the staged one.
    again = publish(spark, sf, lake, status, "1", "2", False)
    assert again.exceptAll(first).count() == 0 and again.count() == first.count()
    live = publish(spark, sf, lake, status, "2", "3", True)
    assert live.count() == 2 * first.count()
    versions = tables.read_table(spark, lake, "gold", "model_registry", "3")
    kinds = {r.stage: r["count"] for r in versions.groupBy("stage").count().collect()}
    assert kinds["Staging"] == kinds["Archived"] == kinds["Production"]
    view = stages.station_view(
        live,
        status,
        given.live_weather(spark, sf),
        given.station_info(spark, sf).withColumn("station_id", F.col("station_id").cast("string")),
        given.AS_OF,
    )
    assert view["status"].count() > 0
    assert view["weather"].columns == schemas.LIVE_WEATHER
    unknown = (F.col("level_state").isNull()) != F.col("num_bikes_available").isNull()
    assert view["forecast"].filter(unknown).count() == 0


def test_forecast_beats_the_hourly_mean(spark, lake):
    rows = tables.read_table(spark, lake, "gold", "training_frame", "1")
    folds = forecast.cv_folds(rows, 14, 3, 5)
    plain = forecast.forecast_metrics(forecast.seasonal_mean_backtest(rows, folds, 5), ["station_id"])
    tuned = tables.read_table(spark, lake, "gold", "tuning", "1")
    both = tuned.select("station_id", F.col("mae").alias("ours")).join(plain, "station_id")
    ours, theirs = both.agg(F.avg("ours"), F.avg("mae")).first()
    assert ours < theirs * 1.2
    assert dt.date(2024, 1, 1) <= rows.agg(F.min("ds")).first()[0].date()


def test_months_follow_from_the_time_not_from_its_text(spark, tmp_path):
    starts = ["2022-01-05 10:00:00", "2022-1-6 10:00:00", " 2022-01-07 10:00:00", "soon", "2022-02-01 00:00:00"]
    columns = schemas.TRIPS.fieldNames()
    rows = [tuple(str(i) if c == "ride_id" else s if c == "started_at" else None for c in columns)
            for i, s in enumerate(starts)]
    trips = spark.createDataFrame(rows, schemas.TRIPS)
    trips.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(str(tmp_path / "drop"))
    raw = stages.ingest_trips(spark, str(tmp_path / "drop"), str(tmp_path))
    assert {r.start_month for r in raw.collect()} == {"2022-01", "2022-02", None}
    january = stages.clean_trips(raw, dt.date(2022, 1, 1), dt.date(2022, 1, 31))
    assert {r.ride_id for r in january.collect()} == {"0", "1", "2"}


def test_the_most_complete_report_of_an_hour_is_kept(spark):
    at = dt.datetime(2022, 1, 1)
    rows = [(at, "9", None, 1.0, 50.0), (at, "1", 2.0, 1.0, 50.0), (at, "2", 3.0, 1.0, 50.0)]
    weather = spark.createDataFrame(
        rows, "ts_hour timestamp_ntz, dt string, temp double, wind_speed double, humidity double"
    )
    assert [r.temp for r in stages.once_per_hour(weather).collect()] == [3.0]
