"""Net flow per hour as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import epoch_wall_clock, wall_clock


def _instant(column: str) -> Column:
    """Wall-clock time as the instant that UTC has it at; event times cannot be without a zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_seconds(F.timestamp_diff("SECOND", origin, wall_clock(column)))


def net_flow_stream(
    rides: DataFrame,
    delay: str = "1 day",
    start: str = "start_station_id",
    end: str = "end_station_id",
) -> DataFrame:
    """Departures, arrivals and net flow of every station and hour of a stream of rides.

    An hour is final, and appended once, when the watermark has passed its end: the latest
    time seen less ``delay``. Rides may come in any order within ``delay``, and a ride that comes
    again within it counts once. A ride without id is known by its stations and times.
    Idle hours have no row; :func:`stationflow.operators.flow.fill_hours` adds them to the
    appended table. State holds the open hours and the ids of the last ``delay`` only.
    """
    ids = F.col("ride_id").cast("string")
    same = F.coalesce(
        F.concat(F.lit("id:"), ids), F.to_json(F.struct(start, "started_at", end, "ended_at"))
    )
    legs = [(start, "started_at", -1), (end, "ended_at", 1)]
    rows = [
        F.struct(F.col(s).alias("station_id"), _instant(t).alias("at"), F.lit(c).alias("change"))
        for s, t, c in legs
    ]
    legs = rides.select(same.alias("ride"), F.inline(F.array(*rows)))
    once = (
        legs.dropna(subset=["station_id", "at"])
        .withWatermark("at", delay)
        .dropDuplicatesWithinWatermark(["ride", "change"])
    )
    change = F.col("change")
    hourly = once.groupBy("station_id", F.window("at", "1 hour").alias("hour")).agg(
        F.count_if(change < 0).alias("departures"),
        F.count_if(change > 0).alias("arrivals"),
        F.sum(change).alias("net_flow"),
    )
    hour = epoch_wall_clock(F.unix_seconds("hour.start")).alias("ts_hour")
    return hourly.select("station_id", hour, "departures", "arrivals", "net_flow")
