"""Ingest, stored tables and the cleaning stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.plans import incremental, stages
from stationflow.sources import schemas, tables

from .registry import query
from .tables import live_weather as given_live
from .tables import trips, using, weather


def trips_text(spark, sf):
    """Trips as the feed delivers them: thirteen text columns."""
    rows = trips(spark, sf).withColumns(
        {
            "start_station_name": F.concat(F.lit("S"), F.col("start_station_id").cast("string")),
            "end_station_name": F.concat(F.lit("S"), F.col("end_station_id").cast("string")),
        }
    )
    return rows.select(
        *[
            (F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c)
            for c in schemas.TRIPS.names
        ]
    )


def weather_text(spark, sf):
    """Weather as the feed delivers it: 23 text columns, most of them empty here."""
    rows = weather(spark, sf).withColumn("dt", F.unix_timestamp("ts_hour"))
    return rows.select(
        *[
            (F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c)
            for c in schemas.WEATHER.names
        ]
    )


def _drop_csv(spark, df, purpose):
    path = tables.scratch_dir(spark, purpose)
    df.write.option("header", True).csv(path)
    return path


def raw_trips(spark, sf):
    root = tables.scratch_dir(spark, "lake")
    return stages.ingest_trips(spark, _drop_csv(spark, trips_text(spark, sf), "drop"), root)


_TYPED = ["ride_id", "started_at", "ended_at", "start_station_id", "date", "ts_hour"]
_TYPED_SQL = """
    SELECT CAST(ride_id AS VARCHAR) AS ride_id, started_at, ended_at,
           CAST(start_station_id AS VARCHAR) AS start_station_id, date, ts_hour FROM trips"""


@query(using("trips", _TYPED_SQL))
def stream_trips_csv(spark, sf):
    """CSV drop, drained into a table by a checkpointed stream, then typed."""
    return stages.typed_trips(raw_trips(spark, sf)).select(*_TYPED)


@query(using("trips", _TYPED_SQL))
def stream_twice(spark, sf):
    """A second drain of the same folder adds nothing."""
    root = tables.scratch_dir(spark, "lake")
    source = _drop_csv(spark, trips_text(spark, sf), "drop")
    stages.ingest_trips(spark, source, root)
    return stages.typed_trips(stages.ingest_trips(spark, source, root)).select(*_TYPED)


@query(using("flow", """
    SELECT CAST(station_id AS VARCHAR) AS station_id, ts_hour, CAST(departures AS BIGINT) AS departures,
           CAST(arrivals AS BIGINT) AS arrivals, CAST(net_flow AS BIGINT) AS net_flow FROM flow"""))
def net_flow_after_two_drops(spark, sf):
    """Flow of the monthly tables: trips arrive in two drops, and only months with new rows are rebuilt."""
    root, drop = tables.scratch_dir(spark, "lake"), tables.scratch_dir(spark, "drop")
    rows = trips_text(spark, sf)
    late = F.col("rideable_type") == "purchase"
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").option("header", True).csv(drop)
        stages.ingest_trips(spark, drop, root)
        incremental.rebuild(spark, root)
    return incremental.current_flow(spark, root)


_WEATHER = ["ts_hour", "temp", "feels_like", "humidity", "main", "wind_speed"]


@query(using("weather", f"""
    SELECT ts_hour, temp, feels_like, CAST(humidity AS DOUBLE) AS humidity, main, wind_speed
    FROM weather"""))
def stream_weather_csv(spark, sf):
    """Weather drop through stream, cleaning, silver selection and typing."""
    root = tables.scratch_dir(spark, "lake")
    raw = stages.ingest_weather(spark, _drop_csv(spark, weather_text(spark, sf), "drop"), root)
    silver = stages.silver_weather(stages.clean_weather(raw))
    return stages.typed_weather(silver).select(*_WEATHER)


@query(using("weather", """
    SELECT ts_hour, CAST(ts_hour AS DATE) AS date, strftime(ts_hour, '%H:00:00') AS time, temp,
           CAST(humidity AS DOUBLE) AS humidity, CAST(humidity + 1000 AS DOUBLE) AS pressure,
           wind_speed, CAST(humidity % 100 AS DOUBLE) AS clouds, temp / 4 AS rain_1h
    FROM weather"""))
def live_weather(spark, sf):
    return stages.typed_live_weather(given_live(spark, sf)).select(
        "ts_hour", "date", *schemas.LIVE_WEATHER, "rain_1h"
    )


@query(using("trips", """
    SELECT CAST(ride_id AS VARCHAR) AS ride_id, rideable_type, member_casual,
           'S' || start_station_id AS start_station_name, date,
           strftime(ts_hour, '%H:00:00') AS time
    FROM trips WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""))
def silver_trips(spark, sf):
    """Trips cleaned within two dates and reduced to the silver columns."""
    import datetime as dt

    clean = stages.clean_trips(trips_text(spark, sf), dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    return stages.silver_trips(clean).select(
        "ride_id", "rideable_type", "member_casual", "start_station_name", "date", "time"
    )


@query(using("trips", """
    SELECT CAST(ride_id AS VARCHAR) AS ride_id, strftime(ts_hour, '%H:00:00') AS time,
           CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month
    FROM trips WHERE start_station_id = 5 OR end_station_id = 5"""))
def station_trips(spark, sf):
    rows = stages.station_trips(trips_text(spark, sf), "S5")
    return rows.select("ride_id", "time", "year", "month")


@query("SELECT event_type, count(*) AS n, max(value) AS top FROM events GROUP BY 1")
def table_round_trip(spark, sf):
    """Trips written partitioned, overwritten with another schema, and read back."""
    root = tables.scratch_dir(spark, "lake")
    events = spark.read.parquet(f"{sf}/events.parquet")
    tables.write_table(events.select("event_id", "event_type"), root, "bronze", "events")
    tables.write_table(
        events.select("event_type", "value"), root, "bronze", "events", partition_by=["event_type"]
    )
    back = tables.read_table(spark, root, "bronze", "events")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))


@query("""
    SELECT event_id, CAST(user_id AS INT) AS user_id, event_type, value FROM events""")
def csv_inferred(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    path = _drop_csv(spark, events.select("event_id", "user_id", "event_type", "value"), "drop")
    rows = tables.read_csv_inferred(spark, path)
    return rows.withColumn("event_id", F.col("event_id").cast("bigint"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def database_table(spark, sf):
    """A table saved in a database that is created and made current."""
    before = spark.catalog.currentDatabase()
    where = tables.scratch_dir(spark, "database")
    tables.use_database(spark, "stationflow_check", where)
    try:
        events = spark.read.parquet(f"{sf}/events.parquet")
        events.select("event_type").write.mode("overwrite").option("path", f"{where}/events").saveAsTable(
            "events"
        )
    finally:
        spark.sql(f"USE {before}")
    return spark.sql(
        "SELECT event_type, count(*) AS n FROM stationflow_check.events GROUP BY event_type"
    )
