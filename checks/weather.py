"""Rides and weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import weather as ops
from stationflow.sources.tables import store

from .registry import query
from .tables import trips, using, weather

_JOINED = ["ride_id", "start_station_id", "ts_hour", "main", "temp", "feels_like"]


def _hourly(spark, sf, k=()):
    return ops.rides_weather(trips(spark, sf), weather(spark, sf), k)


def _by_day(spark, sf, k=()):
    return ops.rides_by_weather_day(_hourly(spark, sf, k), k)


@query(using("rides", f"SELECT {', '.join(_JOINED)} FROM rides"))
def trips_with_weather(spark, sf):
    hours = store(weather(spark, sf), "weather")
    return ops.trips_with_weather(trips(spark, sf), hours).select(*_JOINED)


@query(using("rides", f"SELECT {', '.join(_JOINED)} FROM rides"))
def trips_with_weather_salted(spark, sf):
    """The same join on the way taken when weather is too large to broadcast."""
    hours = store(weather(spark, sf), "weather")
    return ops.trips_with_weather(trips(spark, sf), hours, max_rows=0).select(*_JOINED)


_UNDATED = "CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('hour', ts) END"


@query(using("weather", f"""
    SELECT e.event_id, e.ts_hour, w.main FROM e
    LEFT JOIN (SELECT nullif(ts_hour, TIMESTAMP '2024-01-02 06:00:00') AS ts_hour, main
               FROM weather) w
      ON e.ts_hour IS NOT DISTINCT FROM w.ts_hour""",
    e=f"SELECT event_id, {_UNDATED} AS ts_hour FROM events"))
def trips_with_weather_null_safe(spark, sf):
    """Trips of unknown hour meet weather of unknown hour."""
    known = F.col("rideable_type") != "error"
    rows = trips(spark, sf).select(
        F.col("ride_id").alias("event_id"), F.when(known, F.col("ts_hour")).alias("ts_hour")
    )
    lost = F.lit("2024-01-02 06:00:00").cast("timestamp_ntz")
    hours = weather(spark, sf).select(F.nullif("ts_hour", lost).alias("ts_hour"), "main")
    return ops.trips_with_weather(rows, hours, null_safe=True)


@query(using("rides", """
    SELECT date, main, time, round(avg(temp), 6) AS avg_temp, count(ride_id) AS ride_count
    FROM rides GROUP BY date, main, time"""))
def rides_temp_hourly(spark, sf):
    return ops.rides_temp_hourly(_hourly(spark, sf)).withColumn("avg_temp", F.round("avg_temp", 6))


@query(using("by_day", "SELECT * FROM by_day"))
def rides_by_weather_day(spark, sf):
    return _by_day(spark, sf)


@query(using("rides", """
    SELECT start_station_id, date, main, count(ride_id) AS ride_count
    FROM rides GROUP BY 1, 2, 3"""))
def rides_by_weather_day_and_station(spark, sf):
    return _by_day(spark, sf, ["start_station_id"])


@query(using("rides", """
    SELECT main, count(ride_id) AS ride_count, count(*) AS trip_rows FROM rides GROUP BY main"""))
def rides_by_weather(spark, sf):
    return ops.rides_by_weather(_hourly(spark, sf))


@query(using("by_day", """
    SELECT date, CAST(sum(ride_count) AS BIGINT) AS total_rides FROM by_day GROUP BY date"""))
def daily_totals(spark, sf):
    return ops.daily_totals(_by_day(spark, sf))


@query(using("rides", """
    SELECT round(feels_like) AS feels_like, count(ride_id) AS ride_count
    FROM rides GROUP BY 1"""))
def rides_by_feels_like(spark, sf):
    return ops.rides_by_feels_like(_hourly(spark, sf))


@query(using("rides", """
    SELECT ts_hour, count(*) AS trips, count(ride_id) AS rides FROM rides
    WHERE main IS NULL GROUP BY 1"""))
def unmatched_weather(spark, sf):
    return ops.unmatched_weather(_hourly(spark, sf)).select("ts_hour", "trips", "rides")


_SHARES = """
    SELECT *, (percent_rides - prev_percent_rides) / prev_percent_rides * 100 AS percent_change
    FROM (
        SELECT *, lag(percent_rides) OVER (PARTITION BY {k} main ORDER BY date)
                   AS prev_percent_rides
        FROM (
            SELECT *, CAST(sum(ride_count) OVER (PARTITION BY {k} date) AS BIGINT) AS total_rides,
                   ride_count / sum(ride_count) OVER (PARTITION BY {k} date) * 100
                       AS percent_rides
            FROM {source}))"""
_ROUNDED = ["percent_rides", "prev_percent_rides", "percent_change"]


@query(using("by_day", f"""
    SELECT date, main, ride_count, total_rides,
           {', '.join(f'round({c}, 6) AS {c}' for c in _ROUNDED)}
    FROM shares""", shares=_SHARES.format(k="", source="by_day")))
def weather_share(spark, sf):
    shares = ops.weather_share(_by_day(spark, sf))
    return shares.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(using("rides", """
    SELECT main, prev_main, round(avg(percent_change), 5) AS avg_percent_change
    FROM (SELECT *, lag(main) OVER (PARTITION BY start_station_id ORDER BY date, main NULLS FIRST)
                     AS prev_main FROM shares)
    WHERE main <> prev_main GROUP BY 1, 2""",
    days="""SELECT start_station_id, date, main, count(ride_id) AS ride_count
            FROM rides GROUP BY 1, 2, 3""",
    shares=_SHARES.format(k="start_station_id,", source="days")))
def weather_transition(spark, sf):
    k = ["start_station_id"]
    change = ops.weather_transition(ops.weather_share(_by_day(spark, sf, k), k), k[0])
    return change.withColumn("avg_percent_change", F.round("avg_percent_change", 5))


@query(using("by_day", """
    SELECT main, prev_main, round(avg(percent_change), 5) AS avg_percent_change
    FROM (SELECT *, lag(main) OVER (ORDER BY date NULLS FIRST, main NULLS FIRST) AS prev_main FROM shares)
    WHERE main <> prev_main GROUP BY 1, 2""", shares=_SHARES.format(k="", source="by_day")))
def weather_transition_city(spark, sf):
    """The same over the whole city: one order of all rows."""
    change = ops.weather_transition(ops.weather_share(_by_day(spark, sf)), None)
    return change.withColumn("avg_percent_change", F.round("avg_percent_change", 5))


_GOOD = "main IN ('Clear', 'Clouds')"
_BAD = "main IN ('Rain', 'Snow', 'Thunderstorm', 'Mist', 'Smoke', 'Drizzle', 'Haze', 'Fog')"
_GOOD_BAD = f"""
    SELECT date,
           CAST(sum(ride_count) FILTER ({_GOOD}) AS BIGINT) AS good_weather_rides,
           CAST(sum(ride_count) FILTER ({_BAD}) AS BIGINT) AS bad_weather_rides
    FROM by_day WHERE {_GOOD} OR {_BAD} GROUP BY date"""


@query(using("by_day", _GOOD_BAD))
def good_bad_trend(spark, sf):
    return ops.good_bad_trend(_by_day(spark, sf))


@query(using("by_day", _GOOD_BAD))
def good_bad_outer_join(spark, sf):
    """The same trend as two aggregates joined on date."""
    by_day = _by_day(spark, sf)

    def rides(kinds, name):
        rows = by_day.filter(F.col("main").isin(kinds))
        return rows.groupBy("date").agg(F.sum("ride_count").alias(name))

    return ops.merge_trends(
        rides(ops.GOOD_WEATHER, "good_weather_rides"), rides(ops.BAD_WEATHER, "bad_weather_rides")
    )
