"""Which station an id means at a time: feeds name stations by ids that change and are used again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import fits_broadcast


def station_periods(seen: DataFrame, id: str, name: str, at: str = "ts_hour") -> DataFrame:
    """``id, station, valid_from, valid_to``: the station each id stands for, from the rows that have both.

    An id means the station most of its rows of a time name, of equally many the lowest, and keeps it
    until a time that names another; ``valid_to`` is not included. The first period has no
    beginning and the last no end (NULL). Rows are counted by id, station and time before
    anything is ordered, so with hours for times a window is bounded by the calendar. Rows
    without id, station or time tell nothing.
    """
    named = seen.select(F.col(id).alias("id"), F.col(name).alias("station"), F.col(at).alias("_at")).dropna()
    counted = named.groupBy("id", "_at", "station").agg(F.count(F.lit(1)).alias("_n"))
    said = counted.groupBy("id", "_at").agg(F.min_by("station", F.struct(-F.col("_n"), "station")).alias("station"))
    by_time = W.partitionBy("id").orderBy("_at")
    before = F.lag("station").over(by_time)
    changes = said.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.col("station")))
    return changes.select(
        "id",
        "station",
        F.when(F.col("_before").isNotNull(), F.col("_at")).alias("valid_from"),
        F.lead("_at").over(by_time).alias("valid_to"),
    )


def attach_station(
    rows: DataFrame, periods: DataFrame, id: str, at: str = "ts_hour", name: str = "station"
) -> DataFrame:
    """Every row with the station its id means at its time, in the column ``name``; NULL for an unknown id.

    The periods of an id do not overlap, so a row meets one at most. Rows without a time have
    no station. Periods are broadcast after a count; beyond that ids are shuffled, and
    adaptive execution splits a busy one.
    """
    periods = periods.select(
        F.col("id").alias("_id"), F.col("station").alias(name), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")
    )
    if fits_broadcast(periods):
        periods = F.broadcast(periods)
    time = F.col(at)
    inside = time.isNotNull() & F.coalesce(time >= F.col("_from"), F.lit(True)) & F.coalesce(time < F.col("_to"), F.lit(True))
    return rows.join(periods, (F.col(id) == F.col("_id")) & inside, "left").drop("_id", "_from", "_to")
