"""Stored models, forecasts for stations of any history, streamed net flow."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import flow as flow_checks
from checks import forecast as given
from checks.registry import QUERIES
from checks.tables import HORIZON, INITIAL, PERIOD, trips
from stationflow.operators import flow, forecast
from stationflow.streaming.flow import net_flow_stream
from stationflow.streaming.ingest import drain

START = dt.datetime(2022, 1, 1)


def hours(n, station, y):
    return [
        (station, START + dt.timedelta(hours=i), y(i), float(i % 9), 2.0, None if i == 40 else 50.0 + i % 5, float(i % 24))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def series(spark):
    """A long, a short and an unknown history, and one with a single known row."""
    rows = hours(900, "long", lambda i: float(i % 24 - 12)) + hours(30, "short", lambda i: 1.0)
    rows += hours(30, "unknown", lambda i: None) + hours(30, "one", lambda i: 5.0 if i == 3 else None)
    schema = "station_id string, ds timestamp_ntz, y double, temp double, wind_speed double, humidity double, hour double"
    return spark.createDataFrame(rows, schema).cache()


def test_scores_equal_the_fit(spark, sf):
    """Native scoring of coefficient rows against the forecasts of the fit, additive and multiplicative."""
    keys = ["station_id", "fold", "param_id", "ds"]
    rows = given.panel(spark, sf)
    folds = forecast.cv_folds(rows, INITIAL, PERIOD, HORIZON)
    fitted = forecast.fit_predict(rows, folds, given.SCORED_GRID, HORIZON)
    scored = QUERIES["forecast_from_stored_models"](spark, sf)
    both = fitted.alias("a").join(scored.alias("b"), keys)
    off = [F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))) for c in ("yhat", "yhat_lower", "yhat_upper")]
    found = both.agg(F.count(F.lit(1)), *off).first()
    assert found[0] == fitted.count() == scored.count() > 0
    assert max(found[1:]) < 1e-6


def test_models_are_one_row_per_term(spark, series):
    cut = series.select("station_id").distinct().select(
        "station_id", F.lit(0).alias("fold"), F.lit("2022-02-01 00:00:00").cast("timestamp_ntz").alias("cutoff")
    )
    models = forecast.fit_coefficients(series, cut, given.SCORED_GRID).cache()
    terms = forecast.model_terms()
    counts = {(r.station_id, r.param_id): r["count"] for r in models.groupBy("station_id", "param_id").count().collect()}
    assert counts == {(s, p): len(terms) for s in ("long", "short") for p in (1, 2)}
    assert {(r.pos, r.term) for r in models.collect()} == set(enumerate(terms))
    later = series.filter("station_id = 'long'").withColumn("ds", F.col("ds") + F.expr("INTERVAL 60 DAYS"))
    ahead = forecast.score(later, models)
    assert ahead.count() == 2 * 900 and ahead.filter("yhat IS NULL").count() == 2  # the NULL regressor


def test_every_station_has_a_status_and_a_forecast(spark, series):
    folds = forecast.cv_folds(series, 10, 5, 5)
    tested = forecast.fit_predict(series, folds, given.SCORED_GRID, 5)
    best = forecast.select_best(forecast.forecast_metrics(tested, ["station_id", "param_id"]))
    found = forecast.with_status(best, series)
    status = {r.station_id: (r.status, r.param_id is None) for r in found.collect()}
    assert status == {"long": ("tuned", False), "short": ("short", True), "unknown": ("unknown", True), "one": ("unknown", True)}
    held = series.withColumn("ds", F.col("ds") + F.expr("INTERVAL 1 YEAR"))
    model = held.filter("station_id = 'long'").select("station_id", "ds", F.lit(7.0).alias("yhat"))
    rows = forecast.attach_or_fall_back(held, model, forecast.shrunken_means(series))
    assert rows.count() == held.count() and rows.filter("yhat IS NULL").count() == 0
    sources = {(r.station_id, r.source) for r in rows.select("station_id", "source").distinct().collect()}
    assert sources == {("long", "model"), ("short", "mean"), ("unknown", "mean"), ("one", "mean")}


def test_shrunken_means_lean_on_groups(spark, series):
    zoned = series.withColumn("zone", F.when(F.col("station_id") != "long", "z"))
    got = {(r.station_id, r.hour): r.yhat for r in forecast.shrunken_means(zoned, groups=["zone"]).collect()}
    assert len(got) == 4 * 24
    known = [(r.station_id, r.zone, r.hour, r.y) for r in zoned.collect() if r.y is not None]
    total = sum(k[3] for k in known) / len(known)

    def lean(rows, wider):
        return (sum(k[3] for k in rows) + 24 * wider) / (len(rows) + 24)

    for (station, hour), yhat in got.items():
        zone = None if station == "long" else "z"
        of_hour = lean([k for k in known if k[2] == hour], total)
        of_zone = lean([k for k in known if k[1:3] == (zone, hour)], of_hour)
        assert yhat == pytest.approx(lean([k for k in known if k[0] == station and k[2] == hour], of_zone))
    assert forecast.shrunken_means(series.limit(0)).count() == 0
    nothing = forecast.shrunken_means(series.withColumn("y", F.lit(None).cast("double")))
    assert {r.yhat for r in nothing.select("yhat").distinct().collect()} == {0.0}


def stream(spark, tmp_path, drops, schema, delay):
    folder = str(tmp_path / "feed")
    for rows in drops:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    drain(net_flow_stream(source, delay), out, str(tmp_path / "checkpoint"))
    return spark.read.parquet(out)


SCHEMA = "ride_id string, started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string"


def at(hour, minute=0):
    return START + dt.timedelta(hours=hour, minutes=minute)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_stream_counts_late_and_repeated_rides_once(spark, tmp_path, zone):
    first = [("a", at(1, 50), at(2, 10), "x", "y"), (None, at(1, 5), at(1, 20), "x", None), ("b", at(2), at(3), None, "y")]
    # Late, repeated, and again without id; then hours on, so that the rest is final.
    second = [("c", at(1, 10), at(1, 15), "y", "x"), ("a", at(1, 50), at(2, 10), "x", "y"), (None, at(1, 5), at(1, 20), "x", None)]
    third = [("d", at(30), at(30, 5), "x", "y"), ("e", None, at(3, 1), "x", "y")]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = stream(spark, tmp_path, [first, second, third], SCHEMA, "12 hours")
        rows = {(r.station_id, r.ts_hour): (r.departures, r.arrivals, r.net_flow) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == {
        ("x", at(1)): (2, 1, -1),
        ("y", at(1)): (1, 0, -1),
        ("y", at(2)): (0, 1, 1),
        ("y", at(3)): (0, 2, 2),
    }


def test_stream_equals_the_batch(spark, sf):
    got = QUERIES["net_flow_stream"](spark, sf)
    batch = flow.net_flow(trips(spark, sf), zero_fill=False)
    last = trips(spark, sf).agg(F.max("ended_at")).first()[0]
    final = last.replace(microsecond=0) - dt.timedelta(days=flow_checks.STREAM_DELAY_DAYS, hours=1)
    want = batch.filter(F.col("ts_hour") <= F.lit(str(final)).cast("timestamp_ntz"))
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count() > 0
