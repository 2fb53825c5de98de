from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.operators import forecast

T0 = dt.datetime(2022, 1, 1)
SMALL_GRID = {
    "changepoint_prior_scale": [0.05],
    "seasonality_prior_scale": [3],
    "seasonality_mode": ["additive"],
}


def series(spark, days, fn, station="A", noise=0.0):
    rng = np.random.default_rng(7)
    ds = pd.date_range(T0, periods=24 * days, freq="h")
    pdf = pd.DataFrame(
        {
            "station_id": station,
            "ds": ds,
            "temp": rng.normal(10, 4, len(ds)),
            "wind_speed": rng.normal(3, 1, len(ds)),
            "humidity": rng.normal(50, 9, len(ds)),
            "hour": ds.hour.astype(float),
        }
    )
    pdf["y"] = fn(pdf) + rng.normal(0, noise, len(ds))
    schema = (
        "station_id string, ds timestamp_ntz, temp double, wind_speed double, "
        "humidity double, hour double, y double"
    )
    columns = ["station_id", "ds", "temp", "wind_speed", "humidity", "hour", "y"]
    return spark.createDataFrame(pdf[columns], schema)


def daily(pdf):
    return np.sin(2 * np.pi * pdf["hour"] / 24)


def errors(forecasts):
    return forecasts.select(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]


def test_recovers_a_noiseless_series(spark):
    rows = series(spark, 40, lambda p: 2 + 3 * daily(p) + 0.5 * p["temp"] - p["wind_speed"])
    folds = forecast.cv_folds(rows, 20, 10, 5)
    got = forecast.fit_predict(rows, folds, SMALL_GRID, horizon=5)
    assert got.count() == 2 * 5 * 24
    assert errors(got) < 0.15


def test_multiplicative_mode_fits_growing_swings(spark):
    def swings(pdf):
        level = 20 + np.arange(len(pdf)) / 24
        return level * (1 + 0.5 * daily(pdf))

    rows = series(spark, 60, swings)
    grid = {**SMALL_GRID, "seasonality_mode": ["additive", "multiplicative"]}
    folds = forecast.cv_folds(rows, 30, 30, 10)
    tested = forecast.fit_predict(rows, folds, grid, horizon=10)
    mae = {
        r.param_id: r.mae for r in forecast.forecast_metrics(tested, ["station_id", "param_id"]).collect()
    }
    assert mae[2] < mae[1] / 2


def test_interval_covers_about_four_in_five(spark):
    rows = series(spark, 40, daily, noise=1.0)
    tested = forecast.fit_predict(rows, forecast.cv_folds(rows, 20, 5, 5), SMALL_GRID, horizon=5)
    [row] = forecast.forecast_metrics(tested, ["station_id"]).collect()
    assert 0.7 < row.coverage < 0.9


def test_missing_regressors_give_no_forecast_and_do_not_train(spark):
    rows = series(spark, 30, daily).withColumn(
        "temp", F.when(F.hour("ds") != 5, F.col("temp"))
    )
    got = forecast.fit_predict(rows, forecast.cv_folds(rows, 20, 5, 5), SMALL_GRID, horizon=5)
    gaps = got.filter(F.hour("ds") == 5)
    assert gaps.count() > 0 and gaps.filter("yhat IS NOT NULL").count() == 0
    assert got.filter("yhat IS NULL").count() == gaps.count()


def test_stations_are_fitted_apart_and_short_ones_give_nothing(spark):
    a = series(spark, 30, daily)
    b = series(spark, 30, lambda p: 100 + 0 * p["temp"], station="B")
    c = series(spark, 3, daily, station="C")
    rows = a.union(b).union(c)
    folds = forecast.cv_folds(rows, 20, 5, 5)
    assert {r.station_id for r in folds.collect()} == {"A", "B"}
    got = forecast.fit_predict(rows, folds, SMALL_GRID, horizon=5)
    best = forecast.select_best(forecast.forecast_metrics(got, ["station_id", "param_id"]))
    assert {r.station_id for r in best.collect()} == {"A", "B"}
    assert got.filter("station_id = 'B'").select(F.min("yhat")).first()[0] > 95


def test_forecast_after_one_cutoff_runs_to_the_end(spark):
    rows = series(spark, 20, daily)
    cut = spark.createDataFrame(
        [("A", 0, T0 + dt.timedelta(days=18))], "station_id string, fold int, cutoff timestamp_ntz"
    )
    got = forecast.fit_predict(rows, cut, forecast.PARAM_GRID)
    assert got.count() == 8 * (2 * 24 - 1)
    assert got.select("param_id").distinct().count() == 8


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 40), st.integers(1, 15), st.integers(1, 9), st.integers(1, 9))
def test_folds_equal_walking_back_from_the_end(spark, days, initial, period, horizon):
    rows = series(spark, days, daily)
    last = T0 + dt.timedelta(hours=24 * days - 1)
    cut, want = last - dt.timedelta(days=horizon), []
    while cut >= T0 + dt.timedelta(days=initial):
        want.append(cut)
        cut -= dt.timedelta(days=period)
    folds = forecast.cv_folds(rows, initial, period, horizon).orderBy("fold").collect()
    assert [(r.fold, r.cutoff) for r in folds] == list(enumerate(reversed(want)))


@pytest.mark.parametrize("level", [0, 1e8])
def test_mean_backtest_equals_a_loop_over_folds(spark, level):
    rows = series(spark, 25, lambda pdf: daily(pdf) + level, noise=1.0)
    folds = forecast.cv_folds(rows, 10, 4, 6)
    got = forecast.seasonal_mean_backtest(rows, folds, 6).toPandas()
    pdf = rows.toPandas()
    checked = 0
    for f in folds.collect():
        train = pdf[pdf.ds <= f.cutoff]
        test = pdf[(pdf.ds > f.cutoff) & (pdf.ds <= f.cutoff + dt.timedelta(days=6))]
        mean = train.groupby("hour").y.mean()
        spread = 2 * 1.2815515655446004 * train.groupby("hour").y.std(ddof=0)
        mine = got[got.fold == f.fold].sort_values("ds")
        assert list(mine.ds) == list(test.ds)
        assert np.allclose(mine.yhat, test.hour.map(mean))
        assert np.allclose(mine.yhat_upper - mine.yhat_lower, test.hour.map(spread), rtol=1e-5)
        checked += len(mine)
    assert checked == len(got) > 0


def test_errors_with_zeros(spark):
    rows = [("A", 0.0, 0.0, -1.0, 1.0), ("A", 0.0, 1.0, 0.5, 2.0), ("A", 2.0, 1.0, 0.0, 2.0)]
    schema = "s string, y double, yhat double, yhat_lower double, yhat_upper double"
    df = spark.createDataFrame(rows, schema)
    [row] = forecast.forecast_metrics(df, ["s"]).collect()
    assert row.mse == pytest.approx(2 / 3) and row.rmse == pytest.approx(math.sqrt(2 / 3))
    assert row.mae == pytest.approx(2 / 3) and row.mdape == 0.5
    assert row.smape == pytest.approx((0 + 2 + 2 / 3) / 3)
    assert row.coverage == pytest.approx(2 / 3)


def test_grid_order_and_ties(spark):
    sets = forecast.combinations(forecast.PARAM_GRID)
    assert len(sets) == 8 and sets[0] == {
        "param_id": 1,
        "changepoint_prior_scale": 0.001,
        "seasonality_prior_scale": 1,
        "seasonality_mode": "additive",
    }
    grid = forecast.param_grid(spark.createDataFrame([("A",), ("B",)], "station_id string"))
    assert grid.count() == 16
    assert grid.filter("param_id = 8 AND seasonality_mode = 'multiplicative'").count() == 2
    rows = [("A", 3, 1.0), ("A", 2, 1.0), ("A", 1, None), ("B", 5, 9.0)]
    maes = spark.createDataFrame(rows, "station_id string, param_id int, mae double")
    best = forecast.select_best(maes)
    assert {r.station_id: r.param_id for r in best.collect()} == {"A": 2, "B": 5}


@pytest.fixture
def recent(spark):
    levels = [1.0, 4.0, 9.0, 16.0, 25.0]
    rows = [("A", T0 + dt.timedelta(hours=i), 1.0, v) for i, v in enumerate(levels)]
    schema = "station_id string, ts_hour timestamp_ntz, temp double, num_bikes_available double"
    return spark.createDataFrame(rows, schema).withColumns(
        {"wind_speed": F.lit("2.5"), "humidity": F.lit(7)}
    )


@pytest.fixture
def cutoffs(spark):
    schema = "station_id string, cutoff timestamp_ntz"
    return spark.createDataFrame([("A", T0 + dt.timedelta(hours=2))], schema)


FLOWS = (
    "station_id string, ts_hour timestamp_ntz, net_flow int, temp double, "
    "wind_speed double, humidity int"
)


def test_frames_split_at_the_cutoff(spark, recent, cutoffs):
    before = [("A", T0 - dt.timedelta(hours=1), 4, 1.0, 1.0, 1)]
    history = forecast.panel(spark.createDataFrame(before, FLOWS), "net_flow")
    train = forecast.training_frame(history, recent, cutoffs, T0.date()).orderBy("ds").collect()
    assert [r.y for r in train] == [4.0, 0.0, 3.0, 5.0]
    assert train[1].wind_speed == 2.5 and train[1].hour == 0.0
    held = forecast.holdout_frame(recent, cutoffs).orderBy("ds").collect()
    assert [(r.y, r.num_bikes_available) for r in held] == [(0.0, 16.0), (9.0, 25.0)]
    carried = forecast.holdout_frame(recent, cutoffs, carry=True).orderBy("ds").collect()
    assert [r.y for r in carried] == [7.0, 9.0]


def test_empty_history(spark, recent, cutoffs):
    empty = forecast.panel(spark.createDataFrame([], FLOWS), "net_flow")
    assert forecast.training_frame(empty, recent, cutoffs, T0.date()).count() == 3


def test_residual_line(spark):
    rows = [("A", float(x), 2.0 * x + 1) for x in range(10)] + [("B", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "station_id string, yhat double, residual double")
    got = {r.station_id: r for r in forecast.residual_diagnostics(df).collect()}
    assert got["A"].slope == pytest.approx(2) and got["A"].intercept == pytest.approx(1)
    assert got["A"].r2 == pytest.approx(1) and got["A"].q50 == 10.0 and got["A"].n == 10
    assert got["B"].slope is None
