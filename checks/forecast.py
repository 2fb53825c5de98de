"""Frames, folds, errors and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import flow
from stationflow.operators import forecast as ops
from stationflow.operators import normal
from stationflow.plans import stages
from stationflow.sources.tables import store

from .flow import levels, recent
from .registry import query
from .tables import (
    HORIZON,
    HORIZON_HOURS,
    INITIAL,
    PERIOD,
    SPLIT,
    trips,
    using,
    weather,
    weather_once,
)

# One additive and one multiplicative set.
SCORED_GRID = {
    "changepoint_prior_scale": [0.05],
    "seasonality_prior_scale": [1],
    "seasonality_mode": ["additive", "multiplicative"],
}
_MEASURES = ["mse", "rmse", "mae", "mdape", "smape", "coverage"]


def panel(spark, sf):
    """Stored, since folds, training and test rows all start from it."""
    return store(flows(spark, sf), "panel")


def flows(spark, sf):
    counted = flow.net_flow(trips(spark, sf)).join(weather_once(spark, sf), "ts_hour")
    return ops.panel(counted, "net_flow")


def frames(spark, sf):
    """Training rows, holdout rows and cut-offs over stored hourly tables."""
    flows = store(flow.net_flow(trips(spark, sf)), "flow")
    once = store(weather_once(spark, sf), "weather")
    status = store(levels(spark, sf), "levels")
    return stages.frames(flows, once, once, status, SPLIT, HORIZON_HOURS)


def folds(rows):
    return ops.cv_folds(rows, INITIAL, PERIOD, HORIZON)


def backtest(spark, sf):
    rows = panel(spark, sf)
    return ops.seasonal_mean_backtest(rows, folds(rows), HORIZON)


def results(spark, sf):
    """Holdout rows with the station's mean flow at that hour as forecast."""
    train, held, _ = frames(spark, sf)
    means = train.groupBy("station_id", "hour").agg(F.avg("y").alias("yhat"))
    ahead = held.select("station_id", "ds", "hour").join(means, ["station_id", "hour"])
    return store(ops.attach_forecast(held, ahead), "results")


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(using("panel", "SELECT * FROM panel"))
def flow_panel(spark, sf):
    return flows(spark, sf)


@query(using("trips weather", """
    SELECT DISTINCT 5 AS station_id, w.ts_hour AS ds,
           CAST(sum(CASE WHEN start_station_id = 5 THEN -1 WHEN end_station_id = 5 THEN 1 ELSE 0 END)
                OVER (PARTITION BY w.ts_hour) AS DOUBLE) AS y,
           temp, wind_speed, CAST(humidity AS DOUBLE) AS humidity,
           CAST(hour(w.ts_hour) AS DOUBLE) AS hour
    FROM weather w LEFT JOIN trips t ON w.ts_hour = t.ts_hour"""))
def single_station_panel(spark, sf):
    """Panel of one station by the rule that counts a trip in the hour it began."""
    hourly = flow.net_flow_single(weather(spark, sf), trips(spark, sf), 5)
    rows = hourly.withColumn("station_id", F.lit(5))
    return ops.panel(rows, "net_bike_change").distinct()


@query(using("train", "SELECT * FROM train"))
def training_frame(spark, sf):
    return frames(spark, sf)[0]


@query(using("holdout", "SELECT * FROM holdout"))
def holdout_frame(spark, sf):
    return frames(spark, sf)[1]


@query(using("recent cutoffs", """
    SELECT station_id, ts_hour AS ds, y, num_bikes_available FROM (
        SELECT *, coalesce(num_bikes_available - lag(num_bikes_available) OVER (
                      PARTITION BY station_id ORDER BY ts_hour), 0.0) AS y
        FROM recent)
    JOIN cutoffs USING (station_id) WHERE ts_hour > cutoff"""))
def holdout_frame_carried(spark, sf):
    cutoffs = flow.holdout_cutoff(levels(spark, sf), HORIZON_HOURS)
    held = ops.holdout_frame(recent(spark, sf), cutoffs, carry=True)
    return held.select("station_id", "ds", "y", "num_bikes_available")


@query(using("panel", """
    SELECT station_id, param_id, changepoint_prior_scale, seasonality_prior_scale, seasonality_mode
    FROM (SELECT DISTINCT station_id FROM panel), (VALUES
        (1, 0.001::DOUBLE, 1, 'additive'), (2, 0.001, 1, 'multiplicative'),
        (3, 0.001, 3, 'additive'), (4, 0.001, 3, 'multiplicative'),
        (5, 0.05, 1, 'additive'), (6, 0.05, 1, 'multiplicative'),
        (7, 0.05, 3, 'additive'), (8, 0.05, 3, 'multiplicative'))
        AS p(param_id, changepoint_prior_scale, seasonality_prior_scale, seasonality_mode)"""))
def param_grid(spark, sf):
    return ops.param_grid(panel(spark, sf).select("station_id").distinct())


@query(using("folds", "SELECT * FROM folds"))
def cv_folds(spark, sf):
    return folds(panel(spark, sf))


@query(using("tests", "SELECT station_id, ds, y, fold, cutoff FROM tests"))
def cv_test_rows(spark, sf):
    rows = panel(spark, sf)
    tests = ops.cv_test_rows(rows, folds(rows), HORIZON)
    return tests.select("station_id", "ds", "y", "fold", "cutoff")


@query(using("backtest", """
    SELECT station_id, ds, fold, y, round(yhat, 6) AS yhat,
           round(yhat_lower, 5) AS yhat_lower, round(yhat_upper, 5) AS yhat_upper
    FROM backtest"""))
def seasonal_mean_backtest(spark, sf):
    rows = backtest(spark, sf).select(
        "station_id", "ds", "fold", "y", "yhat", "yhat_lower", "yhat_upper"
    )
    return _rounded(_rounded(rows, ["yhat"]), ["yhat_lower", "yhat_upper"], 5)


@query(using("metrics", f"""
    SELECT station_id, fold, {', '.join(f'round({c}, 6) AS {c}' for c in _MEASURES)}
    FROM metrics"""))
def forecast_metrics(spark, sf):
    errors = ops.forecast_metrics(backtest(spark, sf), ["station_id", "fold"])
    return _rounded(errors, _MEASURES)


@query(using("metrics", """
    SELECT station_id, fold AS param_id, round(mae, 6) AS mae FROM metrics
    QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY round(mae, 9), fold) = 1"""))
def select_best(spark, sf):
    """The fold of least error per station, folds standing for parameter sets."""
    errors = ops.forecast_metrics(backtest(spark, sf), ["station_id", "fold"])
    sets = errors.select("station_id", F.col("fold").alias("param_id"), F.round("mae", 9).alias("mae"))
    return _rounded(ops.select_best(sets), ["mae"])


_RESULT = ["station_id", "ds", "y", "num_bikes_available"]


@query(using("results", f"""
    SELECT {', '.join(_RESULT)}, round(yhat, 6) AS yhat, round(residual, 6) AS residual
    FROM results"""))
def residuals(spark, sf):
    rows = results(spark, sf).select(*_RESULT, "yhat", "residual")
    return _rounded(rows, ["yhat", "residual"])


_LINE = ["slope", "intercept", "r2", "q0", "q25", "q50", "q75", "q100"]


@query(using("backtest", f"""
    SELECT station_id, n, {', '.join(f'round({c}, 5) AS {c}' for c in _LINE)} FROM (
        SELECT station_id, count(*) AS n, regr_slope(yhat - y, yhat) AS slope,
               regr_intercept(yhat - y, yhat) AS intercept, regr_r2(yhat - y, yhat) AS r2,
               quantile_cont(yhat - y, 0) AS q0, quantile_cont(yhat - y, 0.25) AS q25,
               quantile_cont(yhat - y, 0.5) AS q50, quantile_cont(yhat - y, 0.75) AS q75,
               quantile_cont(yhat - y, 1) AS q100
        FROM backtest GROUP BY station_id)"""))
def residual_diagnostics(spark, sf):
    rows = backtest(spark, sf).withColumn("residual", F.col("yhat") - F.col("y"))
    return _rounded(ops.residual_diagnostics(rows), _LINE, 5)


@query()
def fit_predict(spark, sf):
    """Backtest of the eight parameter sets for every station."""
    rows = panel(spark, sf)
    return ops.fit_predict(rows, folds(rows), horizon=HORIZON)


@query()
def tuned_parameters(spark, sf):
    """Best parameter set of every station with its backtest errors."""
    rows = panel(spark, sf)
    tested = ops.fit_predict(rows, folds(rows), horizon=HORIZON)
    return ops.select_best(ops.forecast_metrics(tested, ["station_id", "param_id"]))


@query(using("panel", """
    SELECT station_id, hour, round((coalesce(s, 0) + 24 * hour_mean) / (coalesce(n, 0) + 24), 6) AS yhat,
           CAST(coalesce(n, 0) AS BIGINT) AS known_rows
    FROM (SELECT DISTINCT station_id FROM panel) JOIN hours ON true
    LEFT JOIN (SELECT station_id, hour, sum(y) AS s, count(y) AS n FROM short GROUP BY 1, 2) c USING (station_id, hour)""",
    # Station 3 has a day of history, station 4 none.
    short="""SELECT station_id, ds, hour, CASE WHEN station_id <> 4 THEN y END AS y FROM panel
             WHERE station_id <> 3 OR CAST(ds AS DATE) = DATE '2024-01-02'""",
    hours="""SELECT CAST(h AS DOUBLE) AS hour, (coalesce(s, 0) + 24 * m) / (coalesce(n, 0) + 24) AS hour_mean
             FROM range(24) t(h)
             LEFT JOIN (SELECT hour, sum(y) AS s, count(y) AS n FROM short GROUP BY 1) x ON x.hour = h,
                  (SELECT coalesce(avg(y), 0) AS m FROM short)"""))
def shrunken_hour_means(spark, sf):
    """Mean flow by station and hour that leans on wider means where history is short."""
    rows = panel(spark, sf)
    one_day = (F.col("station_id") != 3) | (F.to_date("ds") == F.lit("2024-01-02").cast("date"))
    short = rows.filter(one_day).withColumn("y", F.when(F.col("station_id") != 4, F.col("y")))
    return _rounded(ops.shrunken_means(short), ["yhat"])


@query()
def forecast_from_stored_models(spark, sf):
    """Backtest rows scored from coefficient rows of every station and fold."""
    rows = panel(spark, sf)
    cuts = folds(rows)
    models = store(ops.fit_coefficients(rows, cuts, SCORED_GRID), "models")
    tests = ops.cv_test_rows(rows, cuts, HORIZON).drop("cutoff")
    return ops.score(tests, models.withColumnRenamed("fold", "of_fold"), models=["of_fold", "param_id"]).filter(
        F.col("of_fold") == F.col("fold")
    ).drop("of_fold")


@query(using("panel folds", """
    SELECT station_id, fold, CAST(n AS BIGINT) AS n,
           round((r0 * (d * f - e * e) - b * (r1 * f - e * r2) + c * (r1 * e - d * r2)) / det, 6) AS intercept,
           round((a * (r1 * f - e * r2) - r0 * (b * f - c * e) + c * (b * r2 - r1 * c)) / det, 6) AS of_temp,
           round((a * (d * r2 - r1 * e) - b * (b * r2 - r1 * c) + r0 * (b * e - c * d)) / det, 6) AS of_hour
    FROM solved""",
    # The 3 x 3 system by Cramer's rule, with the penalties 1, 2 and 3 on its diagonal.
    summed="""SELECT p.station_id, fold, count(*) AS n, count(*) + 1.0::DOUBLE AS a, sum(temp) AS b, sum(hour) AS c,
                     sum(temp * temp) + 2 AS d, sum(temp * hour) AS e, sum(hour * hour) + 3 AS f,
                     sum(y) AS r0, sum(temp * y) AS r1, sum(hour * y) AS r2
              FROM panel p JOIN folds g ON p.station_id = g.station_id AND p.ds <= g.cutoff GROUP BY 1, 2""",
    solved="SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM summed"))
def ridge_by_fold(spark, sf):
    """Flow as a line of temperature and hour by station and fold, from running sums of products."""
    rows = panel(spark, sf)
    one = F.lit(1.0)
    columns = [one, F.col("temp"), F.col("hour"), F.col("y"), one]
    sums = store(normal.running_products(rows, folds(rows), columns), "sums")
    counted = sums.filter("i = 4").select("station_id", "fold", F.round(F.col("sums")[4]).cast("bigint").alias("n"))
    lines = normal.solve_ridge(sums, ["station_id", "fold"], {1: [1.0, 2.0, 3.0]})
    terms = [F.col("b")[i].alias(t) for i, t in enumerate(("intercept", "of_temp", "of_hour"))]
    found = lines.select("station_id", "fold", *terms).join(counted, ["station_id", "fold"])
    return _rounded(found, ["intercept", "of_temp", "of_hour"])


@query()
def models_from_sums(spark, sf):
    """Coefficient rows of the eight parameter sets of every station and fold; no task has a series."""
    rows = panel(spark, sf)
    return normal.fit_by_sums(rows, folds(rows))
