"""Net flow and status levels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions.timeparts import epoch_wall_clock, hour_start
from stationflow.operators import bridge
from stationflow.operators import flow as ops
from stationflow.sources.tables import scratch_dir, store
from stationflow.streaming import flow as streaming
from stationflow.streaming.ingest import drain

from .registry import query
from .tables import HORIZON_HOURS, SPLIT, status, trips, using, weather, weather_once

_LEVELS = [
    "num_ebikes_available",
    "num_docks_available",
    "num_docks_disabled",
    "num_bikes_disabled",
    "num_bikes_available",
]


def levels(spark, sf):
    return ops.status_hourly(status(spark, sf), ["num_bikes_available"])


def recent(spark, sf):
    start = dt.datetime.combine(SPLIT, dt.time())
    return ops.weather_with_status(weather_once(spark, sf), levels(spark, sf), start)


@query(using("flow", "SELECT * FROM flow"))
def net_flow(spark, sf):
    return ops.net_flow(trips(spark, sf))


@query(using("busy", "SELECT * FROM busy"))
def net_flow_busy_hours(spark, sf):
    return ops.net_flow(trips(spark, sf), zero_fill=False)


@query(using("busy", """
    SELECT station_id, h AS ts_hour, coalesce(departures, 0) AS departures,
           coalesce(arrivals, 0) AS arrivals, coalesce(net_flow, 0) AS net_flow
    FROM hours LEFT JOIN busy ON hours.station_id_ = busy.station_id AND hours.h = busy.ts_hour""",
    hours="""SELECT station_id AS station_id_, station_id, unnest(generate_series(
                 TIMESTAMP '2024-01-08 00:00:00', TIMESTAMP '2024-01-14 23:00:00',
                 INTERVAL 1 HOUR)) AS h
             FROM (SELECT DISTINCT station_id FROM busy)"""
    ).replace("SELECT station_id, h AS", "SELECT station_id_ AS station_id, h AS"))
def net_flow_week(spark, sf):
    first, last = dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 14, 23)
    return ops.net_flow(trips(spark, sf), first=first, last=last)


@query(using("trips weather", """
    SELECT DISTINCT w.ts_hour, temp, wind_speed, humidity, feels_like, main,
           CAST(w.ts_hour AS DATE) AS date, CAST(hour(w.ts_hour) AS INT) AS hour,
           CAST(sum(CASE WHEN start_station_id = 5 THEN -1 WHEN end_station_id = 5 THEN 1
                         ELSE 0 END) OVER (PARTITION BY w.ts_hour) AS BIGINT) AS net_bike_change
    FROM weather w LEFT JOIN trips t ON w.ts_hour = t.ts_hour"""))
def net_flow_single(spark, sf):
    return ops.net_flow_single(weather(spark, sf), trips(spark, sf), 5)


@query(using("trips weather", """
    SELECT w.ts_hour, w.main, w.temp, t.ride_id, t.start_station_id
    FROM weather w LEFT JOIN trips t ON w.ts_hour = t.ts_hour"""))
def weather_with_trips(spark, sf):
    joined = ops.weather_with_trips(store(weather(spark, sf), "weather"), trips(spark, sf))
    return joined.select("ts_hour", "main", "temp", "ride_id", "start_station_id")


@query(using("status", f"""
    SELECT station_id, ts_hour, CAST(ts_hour AS DATE) AS date,
           strftime(ts_hour, '%H:00:00') AS time,
           {', '.join(f'round(avg({c})) AS {c}' for c in _LEVELS)}
    FROM (SELECT *, date_trunc('hour', make_timestamp(last_reported * 1000000)) AS ts_hour
          FROM status)
    GROUP BY 1, 2"""))
def status_hourly(spark, sf):
    return ops.status_hourly(status(spark, sf), _LEVELS)


@query(using("recent", "SELECT * FROM recent"))
def weather_with_status(spark, sf):
    return recent(spark, sf)


@query(using("cutoffs", "SELECT * FROM cutoffs"))
def holdout_cutoff(spark, sf):
    return ops.holdout_cutoff(levels(spark, sf), HORIZON_HOURS)


@query(using("recent", """
    SELECT station_id, ts_hour, num_bikes_available,
           coalesce(num_bikes_available - lag(num_bikes_available) OVER (
               PARTITION BY station_id ORDER BY ts_hour), 0.0) AS y
    FROM recent"""))
def level_to_flow(spark, sf):
    rows = recent(spark, sf).select("station_id", "ts_hour", "num_bikes_available")
    return ops.level_to_flow(rows, ts="ts_hour")


# The feed of the streamed rides: a file for four days; every tenth ride comes a file late, every
# seventh comes again in the next file.
DROP_DAYS, STREAM_DELAY_DAYS = 4, 9


def drop_rides(spark, sf):
    """Folder of the feed. Files are written one after the other, as the stream takes them by age."""
    rides = trips(spark, sf).select(
        "ride_id", "started_at", "ended_at", "start_station_id", "end_station_id"
    )
    days = F.date_diff(F.to_date("started_at"), F.lit("2024-01-01").cast("date"))
    first = F.floor(days / DROP_DAYS).cast("int") + F.when(F.col("ride_id") % 10 == 0, 1).otherwise(0)
    again = F.when(F.col("ride_id") % 7 == 0, F.array(first, first + 1)).otherwise(F.array(first))
    rides = store(rides.withColumn("drop", F.explode(again)), "rides")
    folder = scratch_dir(spark, "feed")
    for n in range(rides.agg(F.max("drop")).first()[0] + 1):
        some = rides.filter(F.col("drop") == n).drop("drop").coalesce(1)
        some.write.mode("append").parquet(folder)
    return folder, rides.drop("drop").schema


@query(using("busy", f"""
    SELECT * FROM busy WHERE ts_hour + INTERVAL 1 HOUR <= (
        SELECT max(greatest(date_trunc('second', started_at), date_trunc('second', ended_at)))
        FROM trips) - INTERVAL {STREAM_DELAY_DAYS} DAY"""))
def net_flow_stream(spark, sf):
    """Net flow of a drained stream with late and repeated rides: the hours that are final."""
    folder, schema = drop_rides(spark, sf)
    rides = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = scratch_dir(spark, "flow-stream")
    drain(streaming.net_flow_stream(rides, f"{STREAM_DELAY_DAYS} days"), out, f"{out}-checkpoint")
    return spark.read.parquet(out)


_MOVED = "2024-01-15 00:00:00"


def _moving_id(station: str, hour: str):
    """From the middle of the month a station has the id another had before."""
    moved = F.col(hour) >= F.lit(_MOVED).cast("timestamp_ntz")
    return F.when(moved, (F.col(station) + 7) % 20).otherwise(F.col(station)).alias("id")


@query(using("trips status", """
    SELECT station, ts_hour, departures, level FROM
        (SELECT station, ts_hour, count(*) AS departures FROM sighted t JOIN periods p
            ON t.id = p.id AND (valid_from IS NULL OR ts_hour >= valid_from) AND (valid_to IS NULL OR ts_hour < valid_to)
         GROUP BY 1, 2) JOIN
        (SELECT station, ts_hour, round(avg(num_bikes_available), 6) AS level FROM reported t JOIN periods p
            ON t.id = p.id AND (valid_from IS NULL OR ts_hour >= valid_from) AND (valid_to IS NULL OR ts_hour < valid_to)
         GROUP BY 1, 2) USING (station, ts_hour)""",
    sighted=f"""SELECT ts_hour, 'S' || start_station_id AS named,
                       CASE WHEN ts_hour >= TIMESTAMP '{_MOVED}' THEN (start_station_id + 7) % 20
                            ELSE start_station_id END AS id FROM trips""",
    reported=f"""SELECT ts_hour, num_bikes_available,
                        CASE WHEN ts_hour >= TIMESTAMP '{_MOVED}' THEN (station_id + 7) % 20 ELSE station_id END AS id
                 FROM (SELECT *, date_trunc('hour', make_timestamp(last_reported * 1000000)) AS ts_hour FROM status)""",
    said="""SELECT id, ts_hour, named FROM (SELECT id, ts_hour, named, count(*) AS n FROM sighted GROUP BY 1, 2, 3)
            QUALIFY row_number() OVER (PARTITION BY id, ts_hour ORDER BY n DESC, named) = 1""",
    changes="""SELECT * FROM (SELECT *, lag(named) OVER (PARTITION BY id ORDER BY ts_hour) AS before FROM said)
               WHERE before IS DISTINCT FROM named""",
    periods="""SELECT id, named AS station, CASE WHEN before IS NOT NULL THEN ts_hour END AS valid_from,
                      lead(ts_hour) OVER (PARTITION BY id ORDER BY ts_hour) AS valid_to FROM changes"""))
def departures_with_levels_by_station(spark, sf):
    """Departures and status levels of a station meet although its id changed and others use it again."""
    rides = trips(spark, sf)
    named = F.concat(F.lit("S"), F.col("start_station_id").cast("string")).alias("named")
    rides = rides.select("ts_hour", named, _moving_id("start_station_id", "ts_hour"))
    hour = hour_start(epoch_wall_clock("last_reported", "UTC")).alias("ts_hour")
    reports = status(spark, sf).select("station_id", hour, "num_bikes_available")
    reports = reports.select("ts_hour", "num_bikes_available", _moving_id("station_id", "ts_hour"))
    periods = store(bridge.station_periods(rides, "id", "named"), "periods")
    left = bridge.attach_station(rides, periods, "id").groupBy("station", "ts_hour")
    found = bridge.attach_station(reports, periods, "id").groupBy("station", "ts_hour")
    level = F.round(F.avg("num_bikes_available"), 6).alias("level")
    return left.agg(F.count(F.lit(1)).alias("departures")).join(found.agg(level), ["station", "ts_hour"])
