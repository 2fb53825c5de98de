"""The domain's tables as Spark and SQL derive them from the given ones.

``events`` stands for trips: an event starts a trip, ``value`` is its length in
minutes, user and ``props.k`` give the two stations. Weather is summed up from
the events of an hour. Its feed has no rows for 03:00 (an hour without weather)
and two for 17:00 (an hour with two reports).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The events run over January 2024.
SPLIT = dt.date(2024, 1, 20)
AS_OF = dt.datetime(2024, 1, 25, 17, 20)
HORIZON_HOURS = 4
INITIAL, PERIOD, HORIZON = 14, 3, 5
YEARS = (2021, 2024)


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.col("event_id").alias("ride_id"),
        F.col("event_type").alias("rideable_type"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))).alias("ended_at"),
        (F.col("user_id") % 20).cast("int").alias("start_station_id"),
        (F.regexp_extract("props", "[0-9]+", 0).cast("int") % 20).alias("end_station_id"),
        F.when(F.col("user_id") % 3 == 0, "casual").otherwise("member").alias("member_casual"),
        F.to_date("ts").alias("date"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts_hour"),
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    main = (
        F.when(F.hour("ts_hour") == 5, "Tornado")
        .when(F.col("kind") == 0, "Clear")
        .when(F.col("kind") == 1, "Rain")
        .when(F.col("kind") == 2, "Clouds")
        .when(F.col("kind") == 3, "Snow")
        .otherwise("Haze")
    )
    hourly = (
        load(spark, sf, "events")
        .filter(F.hour("ts") != 3)
        .groupBy(hour.alias("ts_hour"))
        .agg(
            F.max("value").alias("temp"),
            F.min("value").alias("wind_speed"),
            F.count(F.lit(1)).cast("int").alias("humidity"),
            (F.min("event_id") % 5).alias("kind"),
        )
    )
    reports = F.when(
        F.hour("ts_hour") == 17, F.array(main, F.lit("Mist"))
    ).otherwise(F.array(main))
    return hourly.select(
        "ts_hour",
        "temp",
        "wind_speed",
        "humidity",
        (F.col("temp") - F.col("wind_speed")).alias("feels_like"),
        F.explode(reports).alias("main"),
    )


def live_weather(spark: SparkSession, sf: str) -> DataFrame:
    """The live feed: epoch seconds, a nested column and a column name with a dot."""
    return weather(spark, sf).select(
        F.unix_timestamp("ts_hour").alias("dt"),
        F.date_format("ts_hour", "yyyy-MM-dd HH:mm:ss").alias("time"),
        "temp",
        "feels_like",
        "humidity",
        "wind_speed",
        (F.col("humidity") % 100).alias("clouds"),
        (F.col("humidity") + 1000).alias("pressure"),
        F.array(F.struct(F.col("main").alias("main"))).alias("weather"),
        (F.col("temp") / 4).alias("rain.1h"),
    )


def weather_once(spark: SparkSession, sf: str) -> DataFrame:
    """One row per hour, without the category."""
    from stationflow.operators.quality import keep_first

    columns = ["temp", "wind_speed", "humidity"]
    return keep_first(weather(spark, sf).select("ts_hour", *columns), ["ts_hour"], columns)


def status(spark: SparkSession, sf: str) -> DataFrame:
    level = F.floor("value").cast("int") % 40
    return load(spark, sf, "events").select(
        (F.col("user_id") % 20).cast("int").alias("station_id"),
        F.unix_timestamp("ts").alias("last_reported"),
        level.alias("num_bikes_available"),
        (40 - level).alias("num_docks_available"),
        (level % 7).alias("num_ebikes_available"),
        (level % 3).alias("num_bikes_disabled"),
        (level % 5).alias("num_docks_disabled"),
    )


def station_info(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        (F.col("user_id") % 20).cast("int").alias("station_id"), F.lit(20).alias("capacity")
    ).distinct()


_SQL = {
    "trips": """
        SELECT event_id AS ride_id, event_type AS rideable_type, ts AS started_at,
               ts + to_minutes(CAST(floor(value) AS BIGINT)) AS ended_at,
               CAST(user_id % 20 AS INT) AS start_station_id,
               CAST(regexp_extract(props, '[0-9]+') AS INT) % 20 AS end_station_id,
               CASE WHEN user_id % 3 = 0 THEN 'casual' ELSE 'member' END AS member_casual,
               CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS ts_hour
        FROM events""",
    "weather": """
        SELECT ts_hour, temp, wind_speed, humidity, temp - wind_speed AS feels_like,
               unnest(CASE WHEN hour(ts_hour) = 17 THEN [main, 'Mist'] ELSE [main] END) AS main
        FROM (
            SELECT ts_hour, temp, wind_speed, humidity,
                   CASE WHEN hour(ts_hour) = 5 THEN 'Tornado' WHEN kind = 0 THEN 'Clear'
                        WHEN kind = 1 THEN 'Rain' WHEN kind = 2 THEN 'Clouds'
                        WHEN kind = 3 THEN 'Snow' ELSE 'Haze' END AS main
            FROM (
                SELECT date_trunc('hour', ts) AS ts_hour, max(value) AS temp,
                       min(value) AS wind_speed, CAST(count(*) AS INT) AS humidity,
                       min(event_id) % 5 AS kind
                FROM events GROUP BY 1)
            WHERE hour(ts_hour) <> 3)""",
    "status": """
        SELECT CAST(user_id % 20 AS INT) AS station_id,
               CAST(epoch_ms(date_trunc('second', ts)) // 1000 AS BIGINT) AS last_reported,
               CAST(floor(value) AS INT) % 40 AS num_bikes_available,
               40 - CAST(floor(value) AS INT) % 40 AS num_docks_available,
               CAST(floor(value) AS INT) % 40 % 7 AS num_ebikes_available,
               CAST(floor(value) AS INT) % 40 % 3 AS num_bikes_disabled,
               CAST(floor(value) AS INT) % 40 % 5 AS num_docks_disabled
        FROM events""",
    "station_info": """
        SELECT DISTINCT CAST(user_id % 20 AS INT) AS station_id, 20 AS capacity FROM events""",
    # Trips and weather joined row by row.
    "rides": """
        SELECT t.*, strftime(t.ts_hour, '%H:00:00') AS time, w.main, w.temp, w.feels_like
        FROM trips t LEFT JOIN weather w USING (ts_hour)""",
    "by_day": """
        SELECT date, main, count(ride_id) AS ride_count FROM rides GROUP BY date, main""",
    "weather_once": """
        SELECT DISTINCT ts_hour, temp, wind_speed, humidity FROM weather""",
    # Net flow of every station, with and without the hours of no traffic.
    "legs": """
        SELECT start_station_id AS station_id, date_trunc('hour', started_at) AS ts_hour,
               -1 AS change FROM trips
        UNION ALL
        SELECT end_station_id, date_trunc('hour', ended_at), 1 FROM trips""",
    "busy": """
        SELECT station_id, ts_hour, count(*) FILTER (change < 0) AS departures,
               count(*) FILTER (change > 0) AS arrivals, CAST(sum(change) AS BIGINT) AS net_flow
        FROM legs GROUP BY station_id, ts_hour""",
    "all_hours": """
        SELECT station_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts_hour
        FROM (SELECT DISTINCT station_id FROM busy),
             (SELECT min(ts_hour) AS lo, max(ts_hour) AS hi FROM busy)""",
    "flow": """
        SELECT station_id, ts_hour, coalesce(departures, 0) AS departures,
               coalesce(arrivals, 0) AS arrivals, coalesce(net_flow, 0) AS net_flow
        FROM all_hours LEFT JOIN busy USING (station_id, ts_hour)""",
    "panel": """
        SELECT station_id, ts_hour AS ds, CAST(net_flow AS DOUBLE) AS y, temp, wind_speed,
               CAST(humidity AS DOUBLE) AS humidity, CAST(hour(ts_hour) AS DOUBLE) AS hour
        FROM flow JOIN weather_once USING (ts_hour)""",
    "levels": """
        SELECT station_id, date_trunc('hour', make_timestamp(last_reported * 1000000)) AS ts_hour,
               round(avg(num_bikes_available)) AS num_bikes_available
        FROM status GROUP BY 1, 2""",
    "cutoffs": f"""
        SELECT station_id, ts_hour AS cutoff FROM (
            SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY ts_hour DESC) AS n
            FROM levels)
        WHERE n = {HORIZON_HOURS + 2}""",
    "recent": f"""
        SELECT s.station_id, w.ts_hour, temp, wind_speed, humidity, num_bikes_available
        FROM (SELECT station_id, max(ts_hour) AS last FROM levels GROUP BY 1) s
        JOIN weather_once w ON w.ts_hour >= TIMESTAMP '{SPLIT} 00:00:00' AND w.ts_hour <= s.last
        LEFT JOIN levels l ON l.station_id = s.station_id AND l.ts_hour = w.ts_hour""",
    "train": f"""
        SELECT station_id, ds, y, temp, wind_speed, humidity, hour
        FROM panel WHERE CAST(ds AS DATE) < DATE '{SPLIT}'
        UNION ALL
        SELECT station_id, ts_hour, coalesce(num_bikes_available - lag(num_bikes_available) OVER (
                   PARTITION BY station_id ORDER BY ts_hour), 0.0),
               temp, wind_speed, CAST(humidity AS DOUBLE), CAST(hour(ts_hour) AS DOUBLE)
        FROM recent JOIN cutoffs USING (station_id) WHERE ts_hour <= cutoff""",
    "holdout": """
        SELECT station_id, ts_hour AS ds,
               coalesce(num_bikes_available - lag(num_bikes_available) OVER (
                   PARTITION BY station_id ORDER BY ts_hour), 0.0) AS y,
               temp, wind_speed, CAST(humidity AS DOUBLE) AS humidity,
               CAST(hour(ts_hour) AS DOUBLE) AS hour, num_bikes_available
        FROM recent JOIN cutoffs USING (station_id) WHERE ts_hour > cutoff""",
    "folds": f"""
        SELECT station_id, CAST(i AS INT) AS fold,
               last - to_seconds(CAST((n - i) * {PERIOD * 86400} AS BIGINT)) AS cutoff
        FROM (
            SELECT station_id, last, n, unnest(generate_series(0, n)) AS i
            FROM (
                SELECT station_id, max(ds) - INTERVAL {HORIZON} DAY AS last,
                       CAST(floor((epoch(max(ds)) - epoch(min(ds)) - {(HORIZON + INITIAL) * 86400})
                            / {PERIOD * 86400}) AS BIGINT) AS n
                FROM panel GROUP BY station_id)
            WHERE n >= 0)""",
    "tests": f"""
        SELECT p.*, f.fold, f.cutoff FROM panel p JOIN folds f
          ON p.station_id = f.station_id AND p.ds > f.cutoff
         AND p.ds <= f.cutoff + INTERVAL {HORIZON} DAY""",
    # Mean by station and hour of day over the rows before the cut-off.
    "backtest": """
        SELECT t.*, m.yhat, m.yhat - 1.2815515655446004 * m.sd AS yhat_lower,
               m.yhat + 1.2815515655446004 * m.sd AS yhat_upper
        FROM tests t JOIN (
            SELECT p.station_id, p.hour, f.fold, avg(p.y) AS yhat, stddev_pop(p.y) AS sd
            FROM panel p JOIN folds f ON p.station_id = f.station_id AND p.ds <= f.cutoff
            GROUP BY 1, 2, 3) m
          ON t.station_id = m.station_id AND t.hour = m.hour AND t.fold = m.fold""",
    "metrics": """
        SELECT station_id, fold, avg((y - yhat) ** 2) AS mse, sqrt(avg((y - yhat) ** 2)) AS rmse,
               avg(abs(y - yhat)) AS mae,
               quantile_cont(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END, 0.5) AS mdape,
               avg(CASE WHEN abs(y) + abs(yhat) = 0 THEN 0
                        ELSE 2 * abs(y - yhat) / (abs(y) + abs(yhat)) END) AS smape,
               avg(CASE WHEN y >= yhat_lower AND y <= yhat_upper THEN 1.0 ELSE 0.0 END) AS coverage
        FROM backtest GROUP BY station_id, fold""",
    # The mean by station and hour as forecast of the holdout rows.
    "results": """
        SELECT h.*, m.yhat, m.yhat - h.y AS residual
        FROM holdout h JOIN (
            SELECT station_id, hour, avg(y) AS yhat FROM train GROUP BY 1, 2) m
        USING (station_id, hour)""",
    # Stored versions per station: every third station has none, a staged or a live model.
    "registry": """
        SELECT start_station_id AS station_id, 1 AS version, 'Archived' AS stage,
               avg(epoch(ended_at) - epoch(started_at)) AS mae, 1 AS param_id
        FROM trips WHERE start_station_id % 3 > 0 GROUP BY 1
        UNION ALL
        SELECT start_station_id, 2, CASE WHEN start_station_id % 3 = 1 THEN 'Staging'
               ELSE 'Production' END, avg(epoch(ended_at) - epoch(started_at)) / 2, 2
        FROM trips WHERE start_station_id % 3 > 0 GROUP BY 1""",
    "candidates": """
        SELECT end_station_id AS station_id, avg(epoch(ended_at) - epoch(started_at)) / 2 AS mae,
               3 AS param_id
        FROM trips GROUP BY 1""",
    # Forecasts published before: the first status level of each hour under both stages.
    "published": """
        SELECT station_id, ts_hour AS ds, 0.0::DOUBLE AS y, 1.0::DOUBLE AS yhat, model_type,
               1.0::DOUBLE AS model_res, 2.0::DOUBLE AS error_mae, num_bikes_available
        FROM levels, (VALUES ('Staging'), ('Production')) AS s(model_type)""",
}

_NEEDS = {
    "rides": ["trips", "weather"],
    "by_day": ["rides"],
    "weather_once": ["weather"],
    "legs": ["trips"],
    "busy": ["legs"],
    "all_hours": ["busy"],
    "flow": ["all_hours"],
    "panel": ["flow", "weather_once"],
    "levels": ["status"],
    "cutoffs": ["levels"],
    "recent": ["levels", "weather_once"],
    "train": ["panel", "recent", "cutoffs"],
    "holdout": ["recent", "cutoffs"],
    "folds": ["panel"],
    "tests": ["folds"],
    "backtest": ["tests"],
    "metrics": ["backtest"],
    "results": ["holdout", "train"],
    "registry": ["trips"],
    "candidates": ["trips"],
    "published": ["levels"],
}


def using(names: str, body: str, **extra: str) -> str:
    """``body`` after a WITH of the named tables, what they need, and ``extra`` tables."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    tables = [f"{n} AS ({_SQL[n]})" for n in order]
    tables += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(tables)} {body}"
