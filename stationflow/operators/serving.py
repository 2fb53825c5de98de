"""Current state and forecast levels of the stations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import epoch_wall_clock, wall_clock_literal


def latest_status(
    status: DataFrame,
    as_of: dt.datetime,
    k: Sequence[str] = ("station_id",),
    levels: Sequence[str] = ("num_bikes_available", "num_docks_available"),
    zone: str = "UTC",
    strict_hour: bool = False,
) -> DataFrame:
    """Last status reported not after ``as_of``.

    ``as_of`` is wall-clock time in ``zone``; it becomes epoch seconds, so the scan
    can skip later reports. ``strict_hour`` takes only reports from before its hour.
    Of reports of the same second, the one of the highest first level is taken, then of
    the highest second level; a missing level, or one beyond 32 bits, is lowest. The latest row is kept by an
    aggregate, so each task sends one row per key.
    """
    if strict_hour:
        as_of = as_of.replace(minute=0, second=0, microsecond=0)
    until = F.lit(int(as_of.replace(tzinfo=ZoneInfo(zone)).timestamp()))
    seconds = F.col("last_reported")
    if status.schema["last_reported"].dataType == T.StringType():
        seconds = seconds.try_cast("bigint")
    known = status.filter(seconds < until if strict_hour else seconds <= until)
    # One number to order by keeps this a hash aggregate: seconds, then ten digits a level.
    order = F.greatest(seconds, F.lit(-(10**16))).cast("decimal(18,0)")
    for c in levels[:2]:
        level = F.coalesce(F.col(c).try_cast("int").cast("bigint") + 2**31, F.lit(0))
        order = (order * F.lit(10**10)).cast("decimal(38,0)") + level
        order = order.cast("decimal(38,0)")
    return known.groupBy(*k).agg(
        epoch_wall_clock(F.max(seconds), zone).alias("last_reported"),
        *[F.max_by(c, order).alias(c) for c in levels],
    )


def station_capacity(info: DataFrame, stations: Sequence | None = None) -> DataFrame:
    rows = info if stations is None else info.filter(F.col("station_id").isin(list(stations)))
    return rows.select("station_id", "capacity")


def current_weather(
    weather: DataFrame, as_of: dt.datetime, columns: Sequence[str], ts: str = "ts_hour"
) -> DataFrame:
    """Weather rows of the hour of ``as_of``."""
    hour = as_of.replace(minute=0, second=0, microsecond=0)
    return weather.filter(F.col(ts) == wall_clock_literal(hour)).select(*columns)


def forecast_level(
    gold: DataFrame,
    last_level: DataFrame | None = None,
    k: Sequence[str] = ("station_id",),
    series: Sequence[str] = ("model_type",),
) -> DataFrame:
    """Adds ``available_bikes``, the forecast level.

    Without ``last_level`` it is the level of the row plus its forecast flow. With
    it (keys, num_bikes_available) it is the last known level plus the running sum
    of the forecast.
    """
    if last_level is None:
        return gold.withColumn("available_bikes", F.col("num_bikes_available") + F.col("yhat"))
    known = last_level.select(*k, F.col("num_bikes_available").cast("double").alias("_known"))
    so_far = (
        W.partitionBy(*k, *series).orderBy("ds").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        gold.join(known, list(k), "left")
        .withColumn("available_bikes", F.col("_known") + F.sum("yhat").over(so_far))
        .drop("_known")
    )


def capacity_breach(
    levels: DataFrame, info: DataFrame, k: Sequence[str] = ("station_id",)
) -> DataFrame:
    """Adds the station's capacity and ``level_state``: full, empty or ok."""
    level = F.col("available_bikes")
    state = (
        F.when(level >= F.col("capacity"), F.lit("full"))
        .when(level <= 0, F.lit("empty"))
        .when(level.isNotNull() & F.col("capacity").isNotNull(), F.lit("ok"))
    )
    return levels.join(info.select(*k, "capacity"), list(k), "left").withColumn(
        "level_state", state
    )
