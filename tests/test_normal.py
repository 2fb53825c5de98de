"""Fits from sums of products against the fit of whole series and against numpy."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import forecast as given
from checks.tables import HORIZON, INITIAL, PERIOD
from stationflow.operators import forecast, normal

START = dt.datetime(2022, 1, 1)
SCHEMA = "station_id string, ds timestamp_ntz, y double, temp double, wind_speed double, humidity double, hour double"


@pytest.fixture(scope="module")
def series(spark):
    """Long and short histories, constant regressors, unknown values, no and one known row, no key."""
    def rows(station, n, y):
        return [(station, START + dt.timedelta(hours=i), y(i), None if i == 7 else float(i % 9), 2.0,
                 float("nan") if i == 8 else 50.0 + i % 5, float(i % 24)) for i in range(n)]

    data = rows("long", 900, lambda i: float(i % 24 - 12) + i / 300) + rows("short", 30, lambda i: i % 3 - 1.0)
    data += rows("unknown", 30, lambda i: None) + rows("one", 30, lambda i: 5.0 if i == 3 else None)
    data += rows("flat", 60, lambda i: 0.0) + rows(None, 30, lambda i: 1.0)
    return spark.createDataFrame(data, SCHEMA).cache()


def keyed(df, keys):
    return {tuple(r[c] for c in keys): r.value for r in df.collect()}


@pytest.mark.parametrize("modes", [["additive"], ["multiplicative"], ["additive", "multiplicative"]])
def test_models_equal_those_of_whole_series(spark, series, modes):
    grid = {"changepoint_prior_scale": [0.001, 0.05], "seasonality_prior_scale": [1, 3], "seasonality_mode": modes}
    cuts = [("2022-01-01 12:00:00", 0), ("2022-01-20 00:00:00", 1), ("2022-03-01 00:00:00", 2)]
    folds = spark.createDataFrame([(s, f, c) for s in ("long", "short", "unknown", "one", "flat") for c, f in cuts],
                                  "station_id string, fold int, cutoff string")
    folds = folds.withColumn("cutoff", F.col("cutoff").cast("timestamp_ntz"))
    keys = ["station_id", "fold", "param_id", "pos", "term"]
    want = keyed(forecast.fit_coefficients(series, folds, grid), keys)
    got = keyed(normal.fit_by_sums(series, folds, grid), keys)
    assert set(got) == set(want) and {s for s, *_ in got} == {"long", "short", "flat"}
    for key, value in want.items():
        assert got[key] == pytest.approx(value, rel=1e-6, abs=1e-6), key
    assert normal.fit_by_sums(series.limit(0), folds, grid).count() == 0


def test_forecasts_equal_those_of_whole_series(spark, sf):
    rows = given.panel(spark, sf)
    folds = forecast.cv_folds(rows, INITIAL, PERIOD, HORIZON)
    want = forecast.fit_predict(rows, folds, given.SCORED_GRID, HORIZON)
    models = normal.fit_by_sums(rows, folds, given.SCORED_GRID)
    tests = forecast.cv_test_rows(rows, folds, HORIZON)
    got = forecast.score(tests, models, ["station_id", "fold"], models=["param_id"])
    both = want.alias("a").join(got.alias("b"), ["station_id", "fold", "param_id", "ds"])
    off = [F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))) for c in ("yhat", "yhat_lower", "yhat_upper")]
    n, *off = both.agg(F.count(F.lit(1)), *off).first()
    assert n == want.count() == got.count() > 0 and max(off) < 1e-6


def test_running_sums_equal_numpy(spark, series):
    folds = forecast.cv_folds(series, 10, 5, 5).unionByName(
        # A fold before all rows and one without new rows.
        spark.createDataFrame([("flat", 0, dt.datetime(2021, 1, 1)), ("flat", 1, dt.datetime(2023, 1, 1)),
                               ("flat", 2, dt.datetime(2024, 1, 1))], "station_id string, fold int, cutoff timestamp_ntz"))
    known = series.filter("y IS NOT NULL AND temp IS NOT NULL AND NOT isnan(humidity)")
    columns = ["temp", "hour", "humidity"]
    sums = normal.running_products(known, folds, [*[F.col(c) for c in columns], F.col("y"), F.lit(1.0)])
    lam = [0.0, 1.0, 2.0]
    found = {(r.station_id, r.fold): (r.b, r.sd) for r in normal.solve_ridge(sums, ["station_id", "fold"], {1: lam}).collect()}
    data, cuts = known.collect(), folds.collect()
    assert set(found) == {(c.station_id, c.fold) for c in cuts}
    for c in cuts:
        mine = [r for r in data if r.station_id == c.station_id and r.ds <= c.cutoff]
        if not mine:
            assert np.allclose(found[c.station_id, c.fold][0], 0)
            continue
        x, y = np.array([[r[n] for n in columns] for r in mine]), np.array([r.y for r in mine])
        b = np.linalg.solve(x.T @ x + np.diag(lam), x.T @ y)
        assert np.allclose(found[c.station_id, c.fold][0], b, atol=1e-8)
        assert found[c.station_id, c.fold][1] == pytest.approx(np.std(y - x @ b), abs=1e-7)


def test_wide_and_narrow_designs_have_the_same_sums(spark, monkeypatch):
    """Many small groups in a batch, a NULL key and a key of several columns, on both ways."""
    rows = spark.range(3000).selectExpr(
        "IF(id % 200 = 0, NULL, concat('s', id % 200)) AS a", "CAST(id % 2 AS INT) AS b", "CAST(id AS DOUBLE) AS x")
    columns = [F.lit(1.0), F.col("x"), F.sqrt("x")]

    def found():
        return {(r.a, r.b, r.i): r.sums for r in normal.products(rows, columns, ["a", "b"]).collect()}

    narrow = found()
    monkeypatch.setattr(normal, "WIDTH", 2)
    wide = found()
    assert len(narrow) == 200 * 3 and set(narrow) == set(wide)
    assert all(wide[key] == pytest.approx(narrow[key]) for key in narrow)
    assert normal.products(rows.limit(0), columns, ["a", "b"]).count() == 0


def test_no_series_reaches_a_python_task(spark, sf):
    """What goes to Python has one row per model and column; all Python lies above an aggregate."""
    rows = given.panel(spark, sf)
    folds = forecast.cv_folds(rows, INITIAL, PERIOD, HORIZON)
    sums = normal.running_products(rows, folds, [F.col("temp"), F.col("y"), F.lit(1.0)])
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Python" not in plan and "Pandas" not in plan
    models = folds.count()
    assert sums.count() == 3 * models
