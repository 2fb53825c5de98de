from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stationflow.functions import numbers, timeparts


def one(df):
    return df.first().asDict()


def test_malformed_text_becomes_null(spark):
    df = spark.createDataFrame([("2022-03-05 10:59:59", "1.5"), ("soon", "n/a")], "t string, n string")
    rows = timeparts.hour_bucket(df, "t").withColumn("n", numbers.to_number("n")).collect()
    assert rows[0].ts_hour == dt.datetime(2022, 3, 5, 10) and rows[0].time == "10:00:00"
    assert rows[0].date == dt.date(2022, 3, 5) and rows[0].n == 1.5
    assert rows[1].ts_hour is rows[1].date is rows[1].time is rows[1].n is None


def test_dayoff_years_nulls_and_holidays(spark):
    days = [
        (dt.date(2020, 1, 4), False),  # Saturday before the range
        (dt.date(2022, 1, 1), True),  # Saturday
        (dt.date(2022, 1, 2), True),  # Sunday
        (dt.date(2022, 1, 3), False),  # Monday
        (None, False),
    ]
    df = spark.createDataFrame(days, "d date, want boolean")
    for row in df.withColumn("got", timeparts.is_dayoff("d", 2021, 2023)).collect():
        assert row.got == row.want
    every_year = df.filter(timeparts.is_dayoff("d")).orderBy("d").collect()
    assert [r.d.year for r in every_year] == [2020, 2022, 2022]
    monday = timeparts.is_dayoff("d", holidays=[dt.date(2022, 1, 3)])
    assert df.filter(monday & (F.col("d") == "2022-01-03")).count() == 1


def test_epoch_in_a_zone_with_daylight_saving(spark):
    df = spark.createDataFrame([("1647154800",), ("1647158400",), ("bad",)], "dt string")
    rows = timeparts.epoch_parts(df, "dt", "America/New_York").collect()
    # Clocks go from 01:59 to 03:00 on 13 March 2022.
    assert [r.time for r in rows] == ["03:00:00", "04:00:00", None]
    assert rows[0].date == dt.date(2022, 3, 13) and rows[0].year == 2022 and rows[0].month == 3


def test_labels(spark):
    df = spark.createDataFrame([(dt.date(2021, 9, 1), 7)], "d date, h int")
    row = one(
        df.select(
            timeparts.year_month("d").alias("padded"),
            timeparts.year_month("d", padded=False).alias("plain"),
            timeparts.day_name("d").alias("day"),
            timeparts.hour_text("d", "h").alias("text"),
            timeparts.hour_of_time(F.lit("07:30:00")).alias("hour"),
        )
    )
    assert row == {
        "padded": "2021-09",
        "plain": "2021-9",
        "day": "Wednesday",
        "text": "2021-09-01 07:00:00",
        "hour": "07",
    }


def test_rounding_goes_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.49,)], "x double")
    assert [r.r for r in df.select(F.round("x").alias("r")).collect()] == [3.0, -3.0, 0.0]


def test_percentage_change_of_zero_is_null(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 0.0), (None, 2.0)], "a double, b double")
    got = df.select(numbers.pct_change(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in got] == [50.0, None, None]


def test_as_of_hour_drops_minutes_and_zone():
    now = dt.datetime(2023, 5, 1, 2, 45, 10, tzinfo=dt.timezone.utc)
    assert timeparts.as_of_hour(now) == dt.datetime(2023, 4, 30, 22)
    assert timeparts.as_of_hour().minute == 0


def test_days_of_the_week_are_named_and_unknown_days_kept(spark):
    from stationflow.operators.trends import dow_by_member

    rows = [(dt.datetime(2022, 1, 2, 5), "member"), (dt.datetime(2022, 1, 8), "casual"), (None, "member")]
    df = spark.createDataFrame(rows, "started_at timestamp_ntz, member_casual string")
    got = [(r.day, r.member, r.casual) for r in dow_by_member(df).collect()]
    assert got == [(None, 1, None), ("Sunday", 1, None), ("Saturday", None, 1)]


def test_crosstab_counts_unlisted_and_null_values(spark):
    from stationflow.operators.trends import crosstab

    rows = [("a", "member"), ("a", "guest"), ("a", None), ("b", "member")]
    df = spark.createDataFrame(rows, "k string, v string")
    got = sorted(tuple(r) for r in crosstab(df, "k", "v", ["member"]).collect())
    assert got == [("a", 1, 2), ("b", 1, None)]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_hours_do_not_depend_on_the_session_zone(spark, zone):
    # The session zone of New York skips 02:00 on 13 March 2022.
    df = spark.createDataFrame([("2022-03-13 02:30:00", "1647138600")], "t string, dt string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = timeparts.hour_bucket(df, "t").withColumns(
            {
                "text": timeparts.epoch_text("dt"),
                "ym": timeparts.year_month("ts_hour"),
                "hour": F.col("ts_hour").cast("string"),
            }
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.hour == "2022-03-13 02:00:00" and row.time == "02:00:00"
    assert row.text == "2022-03-13 02:30:00" and row.ym == "2022-03"
