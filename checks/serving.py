"""Model stages, published forecasts and the station screen."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import registry as ops
from stationflow.operators import serving
from stationflow.sources import schemas
from stationflow.sources.tables import empty_table

from .flow import levels
from .forecast import results
from .registry import query
from .tables import AS_OF, station_info, status, trips, using, weather


def _minutes(spark, sf, station):
    length = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")).cast("double")
    return trips(spark, sf).groupBy(F.col(station).alias("station_id")).agg(F.avg(length).alias("mae"))


def stored(spark, sf):
    """Two versions for the stations that have any, the second staged or live."""
    kind = F.col("station_id") % 3

    def version(number, stage, mae):
        return F.struct(
            F.lit(number).alias("version"),
            stage.alias("stage"),
            mae.alias("mae"),
            F.lit(number).alias("param_id"),
        )

    second = F.when(kind == 1, "Staging").otherwise("Production")
    versions = F.array(
        version(1, F.lit("Archived"), F.col("mae")), version(2, second, F.col("mae") / 2)
    )
    known = _minutes(spark, sf, "start_station_id").filter(kind > 0)
    return known.select("station_id", F.inline(versions))


def candidates(spark, sf):
    return _minutes(spark, sf, "end_station_id").select(
        "station_id", (F.col("mae") / 2).alias("mae"), F.lit(3).alias("param_id")
    )


def published(spark, sf):
    both = F.explode(F.array(F.lit("Staging"), F.lit("Production"))).alias("model_type")
    return levels(spark, sf).select(
        "station_id",
        F.col("ts_hour").alias("ds"),
        F.lit(0.0).alias("y"),
        F.lit(1.0).alias("yhat"),
        both,
        F.lit(1.0).alias("model_res"),
        F.lit(2.0).alias("error_mae"),
        "num_bikes_available",
    )


def _round_mae(df, column="mae"):
    return df.withColumn(column, F.round(column, 6))


_STAGED = """
    SELECT c.station_id, c.mae, c.param_id, coalesce(s.last, 0) + 1 AS version,
           CASE WHEN {force} THEN 'Production' WHEN c.mae < coalesce(s.staging_mae, 1234)
                THEN 'Staging' ELSE 'Archived' END AS stage
    FROM candidates c LEFT JOIN (
        SELECT station_id, max(version) AS last,
               max(mae) FILTER (stage = 'Staging') AS staging_mae
        FROM registry GROUP BY 1) s USING (station_id)"""
_PROMOTED = """
    SELECT r.station_id, r.version, CASE WHEN r.stage = s.stage THEN 'Archived' ELSE r.stage END
               AS stage, round(r.mae, 6) AS mae, r.param_id
    FROM registry r LEFT JOIN staged s USING (station_id)
    UNION ALL
    SELECT station_id, version, stage, round(mae, 6), param_id FROM staged"""


@query(using("registry candidates", """
    SELECT station_id, round(mae, 6) AS mae, param_id, version, stage FROM staged""",
    staged=_STAGED.format(force="false")))
def staged_candidates(spark, sf):
    return _round_mae(ops.staged(stored(spark, sf), candidates(spark, sf)))


@query(using("registry candidates", _PROMOTED, staged=_STAGED.format(force="false")))
def promote(spark, sf):
    return _round_mae(ops.promote(stored(spark, sf), candidates(spark, sf)))


@query(using("registry candidates", _PROMOTED, staged=_STAGED.format(force="true")))
def promote_forced(spark, sf):
    return _round_mae(ops.promote(stored(spark, sf), candidates(spark, sf), force=True))


_NEW = """
    SELECT station_id, ds, y, round(yhat) AS yhat, stage AS model_type,
           round(residual, 6) AS model_res, round(mae, 6) AS error_mae, num_bikes_available
    FROM results JOIN staged USING (station_id) WHERE stage <> 'Archived'"""


@query(using("published results registry candidates", """
    SELECT * FROM published p WHERE NOT EXISTS (
        SELECT 1 FROM fresh f WHERE f.station_id = p.station_id AND f.model_type = p.model_type)
    UNION ALL SELECT * FROM fresh""",
    staged=_STAGED.format(force="false"), fresh=_NEW))
def publish_gold(spark, sf):
    stages = ops.staged(stored(spark, sf), candidates(spark, sf))
    gold = ops.publish_gold(published(spark, sf), results(spark, sf), stages)
    return _round_mae(_round_mae(gold, "model_res"), "error_mae")


@query(using("results registry candidates", f"""
    SELECT CAST(station_id AS VARCHAR) AS station_id, * EXCLUDE (station_id) FROM ({_NEW})""",
    staged=_STAGED.format(force="true")))
def publish_gold_first(spark, sf):
    """A forced promotion published into the empty gold table."""
    stages = ops.staged(stored(spark, sf), candidates(spark, sf), force=True)
    text = {"station_id": F.col("station_id").cast("string")}
    gold = ops.publish_gold(
        empty_table(spark, schemas.GOLD),
        results(spark, sf).withColumns(text),
        stages.withColumns(text),
    )
    return _round_mae(_round_mae(gold, "model_res"), "error_mae")


# ---- station screen ---------------------------------------------------------

_LATEST = """
    SELECT station_id, make_timestamp(last_reported * 1000000) AS last_reported,
           num_bikes_available, num_docks_available
    FROM status WHERE make_timestamp(last_reported * 1000000) {until}
    QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY last_reported DESC,
            num_bikes_available DESC, num_docks_available DESC) = 1"""


@query(using("status", _LATEST.format(until=f"<= TIMESTAMP '{AS_OF}'")))
def latest_status(spark, sf):
    return serving.latest_status(status(spark, sf), AS_OF)


@query(using("status", _LATEST.format(until=f"< TIMESTAMP '{AS_OF:%Y-%m-%d %H:00:00}'")))
def latest_status_before_hour(spark, sf):
    return serving.latest_status(status(spark, sf), AS_OF, strict_hour=True)


@query(using("station_info", "SELECT * FROM station_info"))
def station_capacity(spark, sf):
    return serving.station_capacity(station_info(spark, sf))


@query(using("weather", f"""
    SELECT ts_hour, temp, humidity, wind_speed, main FROM weather
    WHERE ts_hour = TIMESTAMP '{AS_OF:%Y-%m-%d %H:00:00}'"""))
def current_weather(spark, sf):
    columns = ["ts_hour", "temp", "humidity", "wind_speed", "main"]
    return serving.current_weather(weather(spark, sf), AS_OF, columns)


def _gold(spark, sf):
    return results(spark, sf).select(
        "station_id",
        "ds",
        F.round("yhat", 3).alias("yhat"),
        F.lit("Staging").alias("model_type"),
        "num_bikes_available",
    )


_GOLD = """
    SELECT station_id, ds, round(yhat, 3) AS yhat, 'Staging' AS model_type, num_bikes_available
    FROM results"""


@query(using("results", """
    SELECT *, num_bikes_available + yhat AS available_bikes FROM gold""", gold=_GOLD))
def forecast_level(spark, sf):
    return serving.forecast_level(_gold(spark, sf))


_CUMULATIVE = """
    SELECT gold.*, round(l.num_bikes_available + sum(yhat) OVER (
               PARTITION BY station_id, model_type ORDER BY ds
               ROWS UNBOUNDED PRECEDING), 6) AS available_bikes
    FROM gold LEFT JOIN latest l USING (station_id)"""


@query(using("results status", _CUMULATIVE, gold=_GOLD,
    latest=_LATEST.format(until=f"<= TIMESTAMP '{AS_OF}'")))
def forecast_level_cumulative(spark, sf):
    known = serving.latest_status(status(spark, sf), AS_OF)
    return _round_mae(serving.forecast_level(_gold(spark, sf), known), "available_bikes")


@query(using("results status station_info", """
    SELECT station_id, ds, capacity, available_bikes,
           CASE WHEN available_bikes >= capacity THEN 'full' WHEN available_bikes <= 0 THEN 'empty'
                WHEN available_bikes IS NOT NULL THEN 'ok' END AS level_state
    FROM ahead LEFT JOIN station_info USING (station_id)""", gold=_GOLD,
    latest=_LATEST.format(until=f"<= TIMESTAMP '{AS_OF}'"), ahead=_CUMULATIVE))
def capacity_breach(spark, sf):
    known = serving.latest_status(status(spark, sf), AS_OF)
    ahead = _round_mae(serving.forecast_level(_gold(spark, sf), known), "available_bikes")
    flagged = serving.capacity_breach(ahead, station_info(spark, sf))
    return flagged.select("station_id", "ds", "capacity", "available_bikes", "level_state")
