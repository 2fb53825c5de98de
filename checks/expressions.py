"""Scalar expressions and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stationflow.functions import numbers, timeparts
from stationflow.operators import flow

from .registry import query
from .tables import AS_OF, YEARS, load, status, trips, using


@query("""
    SELECT event_id, date_trunc('hour', ts) AS ts_hour, CAST(ts AS DATE) AS date,
           strftime(ts, '%H:00:00') AS time FROM events""")
def hour_bucket(spark, sf):
    rows = load(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"))
    return timeparts.hour_bucket(rows, "ts").drop("ts")


@query(using("status", """
    SELECT station_id, last_reported, make_timestamp(last_reported * 1000000) AS ts,
           CAST(make_timestamp(last_reported * 1000000) AS DATE) AS date,
           strftime(make_timestamp(last_reported * 1000000), '%H:%M:%S') AS time,
           CAST(year(make_timestamp(last_reported * 1000000)) AS INT) AS year,
           CAST(month(make_timestamp(last_reported * 1000000)) AS INT) AS month
    FROM status"""))
def epoch_parts(spark, sf):
    rows = status(spark, sf).select("station_id", "last_reported")
    return timeparts.epoch_parts(rows, "last_reported")


@query(using("status", """
    SELECT station_id, last_reported,
           strftime(make_timestamp(last_reported * 1000000) - INTERVAL 5 HOUR,
                    '%Y-%m-%d %H:%M:%S') AS local_text
    FROM status"""))
def epoch_text(spark, sf):
    text = timeparts.epoch_text("last_reported", "America/New_York")
    return status(spark, sf).select("station_id", "last_reported", text.alias("local_text"))


@query(using("trips", f"""
    SELECT ride_id, CAST(year(started_at) AS INT) AS year,
           CAST(month(started_at) AS INT) AS month, CAST(hour(started_at) AS INT) AS hour,
           CAST(started_at AS DATE) AS day, strftime(started_at, '%Y-%m') AS year_month,
           dayname(started_at) AS day_name,
           strftime(started_at, '%Y-%m-%d %H:00:00') AS hour_text,
           strftime(started_at, '%H') AS hour_of_time,
           isodow(date) >= 6 AND year(date) BETWEEN {YEARS[0]} AND {YEARS[1]} AS is_dayoff,
           isodow(date) >= 6 AS is_dayoff_default
    FROM trips"""))
def date_parts(spark, sf):
    return trips(spark, sf).select(
        "ride_id",
        F.year("started_at").alias("year"),
        F.month("started_at").alias("month"),
        F.hour("started_at").alias("hour"),
        F.to_date("started_at").alias("day"),
        timeparts.year_month("started_at").alias("year_month"),
        timeparts.day_name("started_at").alias("day_name"),
        timeparts.hour_text("date", F.hour("started_at")).alias("hour_text"),
        timeparts.hour_of_time(F.date_format("started_at", "HH:mm:ss")).alias("hour_of_time"),
        timeparts.is_dayoff("date", *YEARS).alias("is_dayoff"),
        timeparts.is_dayoff("date").alias("is_dayoff_default"),
    )


@query("""
    SELECT isodow(l_shipdate) >= 6 OR CAST(l_shipdate AS DATE) IN
               (DATE '1995-12-25', DATE '1996-01-01') AS is_dayoff,
           count(*) AS n
    FROM lineitem GROUP BY 1""")
def dayoff_with_holidays(spark, sf):
    holidays = [dt.date(1995, 12, 25), dt.date(1996, 1, 1)]
    off = timeparts.is_dayoff(F.to_date("l_shipdate"), 1990, 2010, holidays)
    return load(spark, sf, "lineitem").groupBy(off.alias("is_dayoff")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
    SELECT event_id, round(value) AS whole, round(value, 1) AS tenth,
           TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END
                    AS DOUBLE) AS number,
           round((value - user_id) / nullif(user_id, 0) * 100, 6) AS change
    FROM events""")
def typed_numbers(spark, sf):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return load(spark, sf, "events").select(
        "event_id",
        F.round("value", 0).alias("whole"),
        F.round("value", 1).alias("tenth"),
        numbers.to_number(text).alias("number"),
        F.round(numbers.pct_change(F.col("value"), F.col("user_id")), 6).alias("change"),
    )


@query(using("trips", "SELECT ride_id, started_at, start_station_id FROM trips WHERE start_station_id = 5"))
def start_station_trips(spark, sf):
    rows = trips(spark, sf).filter(F.col("start_station_id") == 5)
    return rows.select("ride_id", "started_at", "start_station_id")


@query(using("trips", """
    SELECT ride_id, started_at, start_station_id, end_station_id,
           CASE WHEN start_station_id = 5 THEN -1 WHEN end_station_id = 5 THEN 1 ELSE 0 END
               AS change
    FROM trips WHERE start_station_id = 5 OR end_station_id = 5"""))
def endpoint_trips(spark, sf):
    change = F.when(F.col("start_station_id") == 5, -1).when(F.col("end_station_id") == 5, 1)
    return (
        trips(spark, sf)
        .filter(flow.touches_station(5, "start_station_id", "end_station_id"))
        .select(
            "ride_id",
            "started_at",
            "start_station_id",
            "end_station_id",
            change.otherwise(0).alias("change"),
        )
    )


@query(using("status", "SELECT * FROM status WHERE station_id = 5"))
def station_status_rows(spark, sf):
    return status(spark, sf).filter(F.col("station_id") == 5)


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1995-12-01' AND TIMESTAMP '1995-12-31'""")
def december_rows(spark, sf):
    first, last = F.lit("1995-12-01"), F.lit("1995-12-31")
    return (
        load(spark, sf, "orders")
        .filter(F.col("o_orderdate").between(*[d.cast("timestamp_ntz") for d in (first, last)]))
        .select("o_orderkey", "o_orderdate")
    )


@query(using("trips", f"""
    SELECT ride_id, 'Staging' AS model_type, 12.5::DOUBLE AS error_mae FROM trips
    WHERE started_at < TIMESTAMP '{AS_OF:%Y-%m-%d %H:00:00}'"""))
def tagged_until_hour(spark, sf):
    """Trips before the current hour at a fixed offset, tagged as a published row is."""
    now = AS_OF.replace(tzinfo=dt.timezone.utc)
    hour = timeparts.as_of_hour(now, offset_hours=0)
    return (
        trips(spark, sf)
        .filter(F.col("started_at") < timeparts.wall_clock_literal(hour))
        .select("ride_id", F.lit("Staging").alias("model_type"), F.lit(12.5).alias("error_mae"))
    )
