"""Trends, counts and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationflow.operators import quality, trends

from .registry import query
from .tables import YEARS, load, trips, using


@query("""
    SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
           count(*) AS trips, strftime(l_shipdate, '%Y-%m') AS year_month
    FROM lineitem GROUP BY ALL""")
def monthly_trips(spark, sf):
    return trends.monthly_trips(load(spark, sf, "lineitem"), "l_shipdate")


@query("""
    SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
           count(*) AS trips, concat(year(o_orderdate), '-', month(o_orderdate)) AS year_month
    FROM orders GROUP BY ALL""")
def monthly_trips_unpadded(spark, sf):
    return trends.monthly_trips(load(spark, sf, "orders"), "o_orderdate", padded=False)


@query(using("trips", """
    SELECT start_station_id, CAST(year(started_at) AS INT) AS year,
           CAST(month(started_at) AS INT) AS month, count(*) AS trips,
           strftime(started_at, '%Y-%m') AS year_month
    FROM trips GROUP BY ALL"""))
def monthly_trips_by_station(spark, sf):
    return trends.monthly_trips(trips(spark, sf), k=["start_station_id"])


@query("""
    SELECT CAST(o_orderdate AS DATE) AS start_date, count(*) AS trips FROM orders GROUP BY 1""")
def daily_trips(spark, sf):
    return trends.daily_trips(load(spark, sf, "orders"), "o_orderdate")


@query(using("trips", """
    SELECT CAST(hour(started_at) AS INT) AS hour, count(*) AS trips FROM trips GROUP BY 1"""))
def hourly_profile(spark, sf):
    return trends.hourly_profile(trips(spark, sf))


@query(using("trips", """
    SELECT rideable_type, count(*) AS count FROM trips GROUP BY 1"""))
def value_counts(spark, sf):
    return trends.value_counts(trips(spark, sf), "rideable_type")


@query(using("trips", """
    SELECT nullif(rideable_type, 'view') AS rideable_type, count(*) AS count
    FROM trips WHERE rideable_type <> 'view' GROUP BY 1"""))
def value_counts_dropna(spark, sf):
    rows = trips(spark, sf).withColumn(
        "rideable_type", F.nullif("rideable_type", F.lit("view"))
    )
    return trends.value_counts(rows, "rideable_type", dropna=True)


@query("SELECT l_suppkey AS end_station_id, count(*) AS count FROM lineitem GROUP BY 1")
def end_station_counts(spark, sf):
    rows = load(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "end_station_id")
    return trends.value_counts(rows, "end_station_id")


@query("""
    SELECT l_suppkey AS end_station_id, count(*) AS count FROM lineitem
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def top_end_stations(spark, sf):
    rows = load(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "end_station_id")
    return trends.top_k(rows, "end_station_id", 20)


@query("""
    SELECT (SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)) AS l_suppkey,
           (SELECT count(*) FROM (SELECT DISTINCT nullif(l_returnflag, 'A') FROM lineitem))
               AS l_returnflag,
           (SELECT count(*) FROM (SELECT DISTINCT l_linestatus FROM lineitem)) AS l_linestatus""")
def n_distinct(spark, sf):
    rows = load(spark, sf, "lineitem").withColumn(
        "l_returnflag", F.nullif("l_returnflag", F.lit("A"))
    )
    return trends.n_distinct(rows, ["l_suppkey", "l_returnflag", "l_linestatus"])


@query(using("weather", "SELECT DISTINCT main FROM weather"))
def distinct_values(spark, sf):
    from .tables import weather

    return trends.distinct_values(weather(spark, sf), "main")


@query("""
    SELECT l_linestatus, l_returnflag, count(*) AS count FROM lineitem GROUP BY 1, 2""")
def cross_counts(spark, sf):
    return trends.cross_counts(load(spark, sf, "lineitem"), "l_linestatus", "l_returnflag")


@query("""
    SELECT o_orderpriority,
           nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS "F",
           nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS "O",
           nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS "P"
    FROM orders GROUP BY 1""")
def crosstab(spark, sf):
    return trends.crosstab(
        load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"], rest=None
    )


@query("""
    SELECT o_orderpriority, nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS "F",
           nullif(count(*) FILTER (o_orderstatus IS DISTINCT FROM 'F'), 0) AS rest
    FROM orders GROUP BY 1""")
def crosstab_rest(spark, sf):
    return trends.crosstab(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F"])


@query(using("trips", """
    SELECT CAST(dayofweek(started_at) + 1 AS INT) AS dow, dayname(started_at) AS day,
           nullif(count(*) FILTER (member_casual = 'member'), 0) AS member,
           nullif(count(*) FILTER (member_casual = 'casual'), 0) AS casual
    FROM trips GROUP BY 1, 2"""))
def dow_by_member(spark, sf):
    return trends.dow_by_member(trips(spark, sf), rest=None)


_DAYOFF = f"isodow(date) >= 6 AND year(date) BETWEEN {YEARS[0]} AND {YEARS[1]}"


@query(using("trips", f"""
    SELECT date, count(*) AS trips, {_DAYOFF} AS is_dayoff FROM trips GROUP BY date"""))
def daily_by_dayoff(spark, sf):
    return trends.daily_by_dayoff(trips(spark, sf), first_year=YEARS[0], last_year=YEARS[1])


@query(using("trips", f"""
    SELECT start_station_id, date, count(*) AS trips FROM trips
    WHERE {_DAYOFF} GROUP BY 1, 2"""))
def dayoff_trips_by_station(spark, sf):
    daily = trends.daily_by_dayoff(
        trips(spark, sf), k=["start_station_id"], first_year=YEARS[0], last_year=YEARS[1]
    )
    return daily.filter(F.col("is_dayoff")).drop("is_dayoff")


@query(using("trips", """
    SELECT round(off, 6) AS avg_dayoff, round(other, 6) AS avg_other,
           round((off - other) / other * 100, 6) AS pct_change
    FROM (SELECT avg(n) FILTER (d) AS off, avg(n) FILTER (NOT d) AS other FROM daily)""",
    daily=f"SELECT date, {_DAYOFF} AS d, count(*) AS n FROM trips GROUP BY date"))
def dayoff_effect(spark, sf):
    daily = trends.daily_by_dayoff(trips(spark, sf), first_year=YEARS[0], last_year=YEARS[1])
    effect = trends.dayoff_effect(daily)
    return effect.select(*[F.round(c, 6).alias(c) for c in effect.columns])


@query(using("trips", """
    SELECT CASE WHEN d THEN 'day off' ELSE 'other' END AS kind, count(*) AS days,
           round(avg(n), 6) AS avg_trips
    FROM daily GROUP BY 1""",
    daily="SELECT date, coalesce(isodow(date) >= 6, false) AS d, count(*) AS n FROM trips GROUP BY date"))
def dayoff_default(spark, sf):
    """Days off of all years, asked in SQL over a common table expression."""
    means = trends.dayoff_means(trends.daily_by_dayoff(trips(spark, sf)))
    return means.withColumn("avg_trips", F.round("avg_trips", 6))


@query(using("trips", """
    SELECT start_station_id, round(off, 6) AS avg_dayoff, round(other, 6) AS avg_other,
           round((off - other) / other * 100, 6) AS pct_change
    FROM (SELECT start_station_id, avg(n) FILTER (d) AS off, avg(n) FILTER (NOT d) AS other
          FROM daily GROUP BY 1)""",
    daily=f"""SELECT start_station_id, date, {_DAYOFF} AS d, count(*) AS n
              FROM trips GROUP BY start_station_id, date"""))
def dayoff_effect_by_station(spark, sf):
    k = ["start_station_id"]
    daily = trends.daily_by_dayoff(trips(spark, sf), k=k, first_year=YEARS[0], last_year=YEARS[1])
    effect = trends.dayoff_effect(daily, k)
    return effect.select(*k, *[F.round(c, 6).alias(c) for c in effect.columns if c not in k])


@query(using("trips", """
    SELECT ride_id, rideable_type, started_at, ended_at FROM trips
    ORDER BY started_at, ride_id LIMIT 5"""))
def preview(spark, sf):
    rows = trips(spark, sf).select("ride_id", "rideable_type", "started_at", "ended_at")
    return rows.orderBy("started_at", "ride_id").limit(5)


# ---- quality ----------------------------------------------------------------


def _gappy(spark, sf):
    """Events with NULLs put in, and the priciest ones twice."""
    rows = load(spark, sf, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.nullif(F.col("user_id") % 5, F.lit(3)).alias("zone"),
        F.when(F.hour("ts") < 4, F.to_date("ts")).alias("day"),
        "value",
    )
    return rows.unionByName(rows.filter("value > 20"))


_GAPPY = """
    SELECT event_id, nullif(event_type, 'view') AS event_type,
           nullif(user_id % 5, 3) AS zone,
           CASE WHEN hour(ts) < 4 THEN CAST(ts AS DATE) END AS day, value
    FROM events"""
_GAPPY_ALL = "SELECT * FROM once UNION ALL SELECT * FROM once WHERE value > 20"


def _mode(column: str, nulls: bool = False) -> str:
    where = "" if nulls else f"WHERE {column} IS NOT NULL"
    return (
        f"(SELECT {column} FROM gappy {where} GROUP BY {column}"
        f" ORDER BY count(*) DESC, {column} NULLS FIRST LIMIT 1)"
    )


@query(using("", f"""
    SELECT event_id, coalesce(event_type, {_mode('event_type')}) AS event_type,
           coalesce(zone, {_mode('zone')}) AS zone, coalesce(day, {_mode('day')}) AS day, value
    FROM gappy""", once=_GAPPY, gappy=_GAPPY_ALL))
def impute_mode(spark, sf):
    return quality.impute_mode(_gappy(spark, sf), ["event_type", "zone", "day"])


@query(using("", f"""
    SELECT event_id, coalesce(event_type, {_mode('event_type', True)}) AS event_type,
           coalesce(zone, {_mode('zone', True)}) AS zone,
           coalesce(day, {_mode('day', True)}) AS day, value
    FROM gappy""", once=_GAPPY, gappy=_GAPPY_ALL))
def impute_mode_all_columns(spark, sf):
    return quality.impute_mode(_gappy(spark, sf), "*", null_competes=True)


@query(using("", """
    SELECT 'event_id' AS column, count(*) FILTER (event_id IS NULL) AS n_null FROM gappy
    UNION ALL SELECT 'event_type', count(*) FILTER (event_type IS NULL) FROM gappy
    UNION ALL SELECT 'zone', count(*) FILTER (zone IS NULL) FROM gappy
    UNION ALL SELECT 'day', count(*) FILTER (day IS NULL) FROM gappy
    UNION ALL SELECT 'value', count(*) FILTER (value IS NULL) FROM gappy""",
    once=_GAPPY, gappy=_GAPPY_ALL))
def null_profile(spark, sf):
    return quality.null_profile(_gappy(spark, sf))


@query(using("", """
    SELECT *, count(*) AS count FROM gappy GROUP BY ALL HAVING count(*) > 1""",
    once=_GAPPY, gappy=_GAPPY_ALL))
def duplicate_groups(spark, sf):
    return quality.duplicate_groups(_gappy(spark, sf))


@query(using("", "SELECT DISTINCT * FROM gappy", once=_GAPPY, gappy=_GAPPY_ALL))
def drop_duplicates(spark, sf):
    return quality.drop_duplicates(_gappy(spark, sf))


@query(using("", "SELECT DISTINCT * FROM gappy", once=_GAPPY, gappy=_GAPPY_ALL))
def drop_copies(spark, sf):
    return quality.drop_copies(_gappy(spark, sf))


@query(using("trips", """
    SELECT ride_id, ts_hour, row_number() OVER (
               PARTITION BY ts_hour ORDER BY started_at, ride_id) > 1 AS is_repeat
    FROM trips"""))
def mark_repeats(spark, sf):
    rows = trips(spark, sf).select("ride_id", "ts_hour", "started_at")
    return quality.mark_repeats(rows, ["ts_hour"], ["started_at", "ride_id"]).drop("started_at")


@query(using("trips", """
    SELECT ride_id, ts_hour, started_at, member_casual FROM trips
    QUALIFY row_number() OVER (PARTITION BY ts_hour ORDER BY started_at, ride_id) = 1"""))
def keep_first(spark, sf):
    rows = trips(spark, sf).select("ride_id", "ts_hour", "started_at", "member_casual")
    return quality.keep_first(rows, ["ts_hour"], ["started_at", "ride_id"])


@query("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark, sf):
    return quality.shape(load(spark, sf, "lineitem"))
