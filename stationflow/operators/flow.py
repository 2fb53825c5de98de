"""Net flow of bikes per hour, from trips and from status levels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.timeparts import epoch_wall_clock, hour_label, hour_start, wall_clock_literal
from ..sources.schemas import STATUS_LEVELS
from .joins import BROADCAST_ROWS, join_small

HOUR = "INTERVAL 1 HOUR"


def touches_station(station: str | int, start: str, end: str) -> Column:
    """Trips that start or end at the station."""
    return (F.col(start) == F.lit(station)) | (F.col(end) == F.lit(station))


def weather_with_trips(
    weather: DataFrame, trips: DataFrame, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Every weather row with the trips of its hour; hours without trips are kept.

    Trips are the large side, so weather goes to them as the small side, and the
    weather rows whose hour has no trip are added from the distinct trip hours.
    """
    trips = trips.drop(*[c for c in trips.columns if c != "ts_hour" and c in weather.columns])
    salt_on = [c for c in ("ride_id", "started_at") if c in trips.columns]
    matched = join_small(
        trips, weather, ["ts_hour"], "inner", max_rows=max_rows, salt_on=salt_on
    )
    idle = weather.join(trips.select("ts_hour").distinct(), "ts_hour", "left_anti")
    return matched.unionByName(idle, allowMissingColumns=True)


def station_flow(trips: DataFrame, station: str | int, start: str, end: str) -> DataFrame:
    """Flow of one station per hour of departure: -1 if a trip starts there, else +1 if it ends there.

    A round trip counts -1 and an arrival belongs to the hour its trip began.
    """
    effect = F.when(F.col(start) == F.lit(station), -1).otherwise(1)
    return (
        trips.filter(touches_station(station, start, end))
        .groupBy("ts_hour")
        .agg(F.sum(effect).cast("bigint").alias("flow"))
    )


def net_flow_single(
    weather: DataFrame,
    trips: DataFrame,
    station: str | int,
    start: str = "start_station_id",
    end: str = "end_station_id",
) -> DataFrame:
    """Hourly flow of one station for every weather row.

    Equals joining each weather row with its trips and summing over the hour: an
    hour with several weather rows counts its trips once per row. Trips are
    reduced to hours before the join, so nothing fans out.
    """
    hourly = station_flow(trips, station, start, end)
    per_hour = W.partitionBy("ts_hour")
    return (
        weather.join(hourly, "ts_hour", "left")
        .withColumn("net_bike_change", F.sum(F.coalesce("flow", F.lit(0))).over(per_hour))
        .drop("flow")
        .withColumns({"date": F.to_date("ts_hour"), "hour": F.hour("ts_hour")})
        .dropDuplicates()
    )


def station_legs(
    trips: DataFrame,
    start: str = "start_station_id",
    end: str = "end_station_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Two rows per trip: a departure in its hour and an arrival in its hour, with the columns ``keep``."""
    departure = F.struct(
        F.col(start).alias("station_id"),
        hour_start("started_at").alias("ts_hour"),
        F.lit(-1).alias("change"),
    )
    arrival = F.struct(
        F.col(end).alias("station_id"),
        hour_start("ended_at").alias("ts_hour"),
        F.lit(1).alias("change"),
    )
    return trips.select(*keep, F.inline(F.array(departure, arrival))).dropna(
        subset=["station_id", "ts_hour"]
    )


def net_flow(
    trips: DataFrame,
    start: str = "start_station_id",
    end: str = "end_station_id",
    zero_fill: bool = True,
    first: dt.datetime | None = None,
    last: dt.datetime | None = None,
) -> DataFrame:
    """Departures, arrivals and net flow of every station in every hour.

    The sum is taken per task before the shuffle, so a busy station does not
    make a large task. With ``zero_fill`` each station of any trip has every hour from
    ``first`` to ``last``, idle or not; by default the first and last hour of all trips.
    """
    change = F.col("change")
    legs = station_legs(trips, start, end)
    inside = F.lit(True)
    if first is not None:
        inside = inside & (F.col("ts_hour") >= wall_clock_literal(first))
    if last is not None:
        inside = inside & (F.col("ts_hour") <= wall_clock_literal(last))
    if first is None and last is None:
        pass
    elif zero_fill:
        # A leg outside counts nothing at a bound: its station is known, all the same.
        bound = wall_clock_literal(last if first is None else first)
        legs = legs.select(
            "station_id",
            F.when(inside, F.col("ts_hour")).otherwise(bound).alias("ts_hour"),
            F.when(inside, change).otherwise(F.lit(0)).alias("change"),
        )
    else:
        legs = legs.filter(inside)
    hourly = legs.groupBy("station_id", "ts_hour").agg(
        F.count_if(change < 0).alias("departures"),
        F.count_if(change > 0).alias("arrivals"),
        F.sum(change).alias("net_flow"),
    )
    if not zero_fill:
        return hourly
    return fill_hours(hourly, ["departures", "arrivals", "net_flow"], first, last)


def fill_hours(
    hourly: DataFrame,
    measures: Sequence[str],
    first: dt.datetime | None = None,
    last: dt.datetime | None = None,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """Adds the missing hours of each key with zero measures.

    Each row is followed by the hours up to the next one, so the gaps need
    neither a table of all hours nor a join. The default bounds are read from the
    data as one row.
    """
    # The totals go unused, but with them the subquery needs the same aggregate as
    # the rows do, and Spark runs it once for both instead of reading the trips twice.
    bounds = hourly.agg(
        F.struct(
            F.min("ts_hour").alias("first"),
            F.max("ts_hour").alias("last"),
            *[F.sum(m).alias(m) for m in measures],
        ).alias("b")
    ).scalar()
    low = bounds.getField("first") if first is None else wall_clock_literal(first)
    high = bounds.getField("last") if last is None else wall_clock_literal(last)
    by_time = W.partitionBy(*k).orderBy("ts_hour")
    hour = F.expr(HOUR)
    since = F.when(F.lag("ts_hour").over(by_time).isNull(), low).otherwise(F.col("ts_hour"))
    until = F.coalesce(F.lead("ts_hour").over(by_time) - hour, high)
    spread = hourly.withColumns({"_since": since, "_until": until}).withColumn(
        "_hour", F.explode(F.sequence("_since", "_until", hour))
    )
    own = F.col("_hour") == F.col("ts_hour")
    return spread.select(
        *k,
        F.col("_hour").alias("ts_hour"),
        *[F.when(own, F.col(m)).otherwise(F.lit(0)).alias(m) for m in measures],
    )


def status_hourly(
    status: DataFrame,
    levels: Sequence[str] = STATUS_LEVELS,
    k: Sequence[str] = ("station_id",),
    reported: str = "last_reported",
    zone: str = "UTC",
) -> DataFrame:
    """Mean of each level per hour, rounded to whole numbers."""
    hour = hour_start(epoch_wall_clock(reported, zone))
    return (
        status.groupBy(*k, hour.alias("ts_hour"))
        .agg(*[F.round(F.avg(c)).alias(c) for c in levels])
        .withColumns({"date": F.to_date("ts_hour"), "time": hour_label("ts_hour")})
    )


def weather_with_status(
    weather: DataFrame,
    hourly: DataFrame,
    start: dt.datetime | None = None,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """Weather rows of each station from ``start`` to its last status hour, with the status.

    ``start`` defaults to the station's first status hour. A weather hour without
    status has NULL levels.
    """
    k = list(k)
    first = F.min("ts_hour") if start is None else wall_clock_literal(start)
    hours = (
        hourly.groupBy(*k)
        .agg(first.alias("_from"), F.max("ts_hour").alias("_to"))
        .filter("_from <= _to")
        .select(*k, F.explode(F.sequence("_from", "_to", F.expr(HOUR))).alias("ts_hour"))
    )
    levels = hourly.drop("date", "time")
    return hours.join(weather, "ts_hour").join(levels, [*k, "ts_hour"], "left")


def holdout_cutoff(
    hourly: DataFrame, horizon: int, k: Sequence[str] = ("station_id",), ts: str = "ts_hour"
) -> DataFrame:
    """(keys, cutoff): the timestamp ``horizon + 2`` from the end of each key."""
    from_end = W.partitionBy(*k).orderBy(F.desc(ts))
    return (
        hourly.select(*k, ts)
        .withColumn("_n", F.row_number().over(from_end))
        .filter(F.col("_n") == horizon + 2)
        .select(*k, F.col(ts).alias("cutoff"))
    )


def level_to_flow(
    df: DataFrame,
    k: Sequence[str] = ("station_id",),
    ts: str = "ds",
    level: str = "num_bikes_available",
    out: str = "y",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Change of the level since the row before, 0 on the first row and beside a NULL.

    ``ties`` orders rows of the same time, as when an hour has two weather rows.
    """
    by_time = W.partitionBy(*k).orderBy(ts, *ties)
    change = F.col(level) - F.lag(level).over(by_time)
    return df.withColumn(out, F.coalesce(change.cast("double"), F.lit(0.0)))
