"""Trip trends over time and category.

``k`` holds optional grouping keys, for example ``["start_station_id"]``, so one
job answers for every station.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pct_change
from ..functions.timeparts import day_name, is_dayoff, year_month


def monthly_trips(
    df: DataFrame, ts: str = "started_at", k: Sequence[str] = (), padded: bool = True
) -> DataFrame:
    keys = [*k, "year", "month"]
    counts = df.groupBy(
        *k, F.year(ts).alias("year"), F.month(ts).alias("month")
    ).agg(F.count(F.lit(1)).alias("trips"))
    label = year_month(F.make_date("year", "month", F.lit(1)), padded)
    return counts.withColumn("year_month", label).orderBy(*keys)


def daily_trips(df: DataFrame, ts: str = "started_at", k: Sequence[str] = ()) -> DataFrame:
    return (
        df.groupBy(*k, F.to_date(ts).alias("start_date"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(*k, "start_date")
    )


def hourly_profile(df: DataFrame, ts: str = "started_at", k: Sequence[str] = ()) -> DataFrame:
    return (
        df.groupBy(*k, F.hour(ts).alias("hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(*k, "hour")
    )


def value_counts(df: DataFrame, col: str, dropna: bool = False) -> DataFrame:
    """Rows per value, most frequent first; NULL is a value unless ``dropna``."""
    rows = df.filter(F.col(col).isNotNull()) if dropna else df
    return (
        rows.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), col)
    )


def n_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of distinct values per column, NULL being one."""
    counts = [
        (F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0)))
        .cast("bigint")
        .alias(c)
        for c in cols
    ]
    return df.agg(*counts)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def cross_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def _count_columns(b: str, values: Sequence[str]) -> list[Column]:
    """One count per value, NULL where there is none; one shuffle, where pivot takes two."""
    return [F.nullif(F.count_if(F.col(b) == F.lit(v)), F.lit(0)).alias(v) for v in values]


def _counts_and_rest(b: str, values: Sequence[str], rest: str | None) -> list[Column]:
    if rest is None:
        return _count_columns(b, values)
    listed = F.coalesce(F.col(b).isin(list(values)), F.lit(False))
    return [*_count_columns(b, values), F.nullif(F.count_if(~listed), F.lit(0)).alias(rest)]


def crosstab(
    df: DataFrame, a: str, b: str, values: Sequence[str], rest: str | None = "rest"
) -> DataFrame:
    """One row per ``a``, one count column per listed value of ``b``.

    ``rest`` names the column that counts NULL and all other values; ``None`` leaves
    it out, for values known to be all there are.
    """
    return df.groupBy(a).agg(*_counts_and_rest(b, values, rest))


def dow_by_member(
    df: DataFrame,
    ts: str = "started_at",
    member: str = "member_casual",
    values: Sequence[str] = ("member", "casual"),
    rest: str | None = "rest",
) -> DataFrame:
    """Trips per day of the week, one column per member type, Sunday first.

    ``rest`` is that of :func:`crosstab`.

    Days are named after the aggregate, seven times rather than once per trip.
    """
    sunday = F.lit("1970-01-04").cast("date")
    return (
        df.groupBy(F.dayofweek(ts).alias("dow"))
        .agg(*_counts_and_rest(member, values, rest))
        .withColumn("day", day_name(F.date_add(sunday, F.col("dow") - 1)))
        .orderBy("dow")
    )


def daily_by_dayoff(
    df: DataFrame,
    date: str = "date",
    k: Sequence[str] = (),
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Trips per day with the day-off flag.

    The flag depends on the date alone, so it is set after the aggregate.
    """
    return (
        df.groupBy(*k, date)
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("is_dayoff", is_dayoff(date, first_year, last_year))
        .orderBy(*k, date)
    )


def dayoff_effect(daily: DataFrame, k: Sequence[str] = ()) -> DataFrame:
    """Mean daily trips on days off and other days, and the change in percent."""
    means = daily.groupBy(*k).agg(
        F.avg(F.when(F.col("is_dayoff"), F.col("trips"))).alias("avg_dayoff"),
        F.avg(F.when(~F.col("is_dayoff"), F.col("trips"))).alias("avg_other"),
    )
    return means.withColumn("pct_change", pct_change(F.col("avg_dayoff"), F.col("avg_other")))


def dayoff_means(daily: DataFrame) -> DataFrame:
    """Days and mean daily trips per kind of day, in SQL; leaves no view behind."""
    return daily.sparkSession.sql(
        """
        WITH kinds AS (
            SELECT CASE WHEN is_dayoff THEN 'day off' ELSE 'other' END AS kind, trips
            FROM {daily}
        )
        SELECT kind, count(*) AS days, avg(trips) AS avg_trips FROM kinds GROUP BY kind
        """,
        daily=daily,
    )


def top_k(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values; ties go to the lower value."""
    return value_counts(df, key).limit(n)
