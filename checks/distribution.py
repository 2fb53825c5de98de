"""Quantiles and densities of errors, and the level as of each published hour."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import asof, distribution

from .forecast import backtest
from .registry import query
from .serving import published
from .tables import status, using

QUARTILES = (0.25, 0.5, 0.75)
WIDTH, POINTS = 0.5, 41

_LISTED = ", ".join(map(str, QUARTILES))


def _errors(spark, sf):
    return backtest(spark, sf).withColumn("error", F.abs(F.col("y") - F.col("yhat")))


@query(using("backtest", f"""
    SELECT q, n, round(value, 6) AS value FROM (
        SELECT unnest([{_LISTED}]::DOUBLE[]) AS q, count(*) AS n,
               unnest(quantile_cont(abs(y - yhat), [{_LISTED}])) AS value FROM backtest)"""))
def error_quantiles(spark, sf):
    """Quartiles of the error over all stations and folds."""
    rows = distribution.exact_quantiles(_errors(spark, sf), "error", QUARTILES)
    return rows.withColumn("value", F.round("value", 6))


@query(using("backtest", f"""
    SELECT fold, q, n, round(value, 6) AS value FROM (
        SELECT fold, unnest([{_LISTED}]::DOUBLE[]) AS q, count(*) AS n,
               unnest(quantile_cont(abs(y - yhat), [{_LISTED}])) AS value FROM backtest GROUP BY fold)"""))
def error_quantiles_by_fold(spark, sf):
    """Quartiles of the error of each fold over all stations."""
    rows = distribution.exact_quantiles(_errors(spark, sf), "error", QUARTILES, ["fold"])
    return rows.withColumn("value", F.round("value", 6))


@query(using("backtest", f"""
    SELECT s.station_id, CAST(point AS INT) AS point, round(low + point * step, 6) AS at,
           round(sum(b.n * exp(-power((low + point * step - b.c) / h, 2) / 2))
                 / (any_value(s.total) * any_value(h) * sqrt(2 * pi())), 6) AS density
    FROM (SELECT *, lo - 3 * h AS low, (hi - lo + 6 * h) / {POINTS - 1} AS step FROM sizes) s
    JOIN range({POINTS}) g(point) ON true JOIN cells b ON b.station_id = s.station_id
    GROUP BY s.station_id, point, low, step""",
    cells=f"""SELECT station_id, (floor(round(yhat - y, 9) / {WIDTH}) + 0.5) * {WIDTH} AS c, count(*) AS n
              FROM backtest GROUP BY 1, 2""",
    means="SELECT station_id, sum(n * c) / sum(n) AS m FROM cells GROUP BY 1",
    sizes=f"""SELECT station_id, sum(n) AS total, min(c) AS lo, max(c) AS hi,
                     greatest(1.06 * sqrt(sum(n * (c - m) * (c - m)) / sum(n)) * power(sum(n), -0.2), {WIDTH}) AS h
              FROM cells JOIN means USING (station_id) GROUP BY 1"""))
def residual_density(spark, sf):
    """Kernel density of the residuals of every station on a grid."""
    rows = backtest(spark, sf).withColumn("residual", F.round(F.col("yhat") - F.col("y"), 9))
    cells = distribution.histogram(rows, "residual", WIDTH, ["station_id"])
    found = distribution.density(cells, WIDTH, ["station_id"], POINTS)
    return found.withColumns({c: F.round(c, 6) for c in ("at", "density")})


@query(using("published status", """
    SELECT p.station_id, p.ds, p.model_type, s.bikes, s.docks, s.last_reported AS reported_s
    FROM published p ASOF LEFT JOIN reports s ON p.station_id = s.station_id AND p.ds >= s.at""",
    reports="""SELECT station_id, last_reported, make_timestamp(last_reported * 1000000) AS at,
                      max(num_bikes_available) AS bikes, min(num_docks_available) AS docks
               FROM status GROUP BY 1, 2"""))
def status_as_of_hour(spark, sf):
    """Level of the station as of the hour of each published forecast."""
    names = {"bikes": "num_bikes_available", "docks": "num_docks_available"}
    found = asof.status_as_of(published(spark, sf), status(spark, sf), names)
    return found.select("station_id", "ds", "model_type", *names, "reported_s")
