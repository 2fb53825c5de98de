from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationflow.operators import flow

T0 = dt.datetime(2022, 1, 1)
SCHEMA = (
    "ride_id int, started_at timestamp_ntz, ended_at timestamp_ntz, "
    "start_station_id string, end_station_id string, ts_hour timestamp_ntz"
)


def trip(i, start, minutes, a, b):
    began = T0 + dt.timedelta(minutes=start)
    return (i, began, began + dt.timedelta(minutes=minutes), a, b, began.replace(minute=0))


def flows(df):
    return {(r.station_id, r.ts_hour): r.net_flow for r in df.collect() if r.net_flow}


def test_trip_across_the_hour_and_round_trips(spark):
    df = spark.createDataFrame(
        [
            trip(1, 650, 20, "A", "B"),  # 10:50 to 11:10
            trip(2, 605, 10, "C", "C"),  # within one hour
            trip(3, 650, 20, "D", "D"),  # across two hours
            trip(4, 605, 10, "A", None),
        ],
        SCHEMA,
    )
    ten, eleven = T0.replace(hour=10), T0.replace(hour=11)
    got = flow.net_flow(df, zero_fill=False)
    assert flows(got) == {
        ("A", ten): -2,
        ("B", eleven): 1,
        ("D", ten): -1,
        ("D", eleven): 1,
    }
    assert got.filter("station_id = 'C' AND net_flow = 0 AND departures = 1 AND arrivals = 1").count() == 1


def test_one_station_rule(spark):
    trips = spark.createDataFrame(
        [
            trip(1, 605, 10, "A", "A"),  # -1: the start decides
            trip(2, 650, 20, "B", "A"),  # +1 in the hour it began
            trip(3, 660, 5, "A", "B"),
            trip(4, 660, 5, "B", "C"),
        ],
        SCHEMA,
    )
    hours = [T0.replace(hour=h) for h in (9, 10, 11, 11)]
    weather = spark.createDataFrame(
        [(h, i, "x") for i, h in enumerate(hours)], "ts_hour timestamp_ntz, temp int, main string"
    )
    got = flow.net_flow_single(weather, trips, "A").orderBy("temp").collect()
    # Two weather rows at 11:00 count the trip twice, on both rows.
    assert [(r.hour, r.net_bike_change) for r in got] == [(9, 0), (10, 0), (11, -2), (11, -2)]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.integers(0, 60 * 48), st.integers(0, 200), st.sampled_from("ABC"), st.sampled_from("ABC")
        ),
        min_size=1,
        max_size=30,
    )
)
def test_net_flow_equals_counting_by_hand(spark, sample):
    rows = [trip(i, *t) for i, t in enumerate(sample)]
    want = Counter()
    for _, began, ended, a, b, _ in rows:
        want[a, began.replace(minute=0)] -= 1
        want[b, ended.replace(minute=0)] += 1
    got = flow.net_flow(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.station_id, r.ts_hour): r.net_flow for r in got if r.net_flow} == {
        k: v for k, v in want.items() if v
    }
    # Every station has every hour between the first and the last, once; all flow cancels.
    hours = [h for _, h in want]
    n = int((max(hours) - min(hours)).total_seconds() // 3600) + 1
    stations = {s for s, _ in want}
    assert len(got) == n * len(stations) == len({(r.station_id, r.ts_hour) for r in got})
    assert sum(r.net_flow for r in got) == 0


def test_net_flow_reads_trips_once(spark, tmp_path):
    spark.createDataFrame([trip(1, 605, 10, "A", "B")], SCHEMA).write.parquet(str(tmp_path / "t"))
    df = flow.net_flow(spark.read.parquet(str(tmp_path / "t")))
    df.collect()
    # The bounds of the hours come from the aggregate the rows need anyway.
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_idle_hours_survive_the_trip_join(spark):
    trips = spark.createDataFrame([trip(1, 605, 10, "A", "B"), trip(2, 606, 1, "A", "B")], SCHEMA)
    weather = spark.createDataFrame(
        [(T0.replace(hour=h), m) for h, m in ((9, "w"), (10, "x"), (10, "y"))],
        "ts_hour timestamp_ntz, main string",
    )
    for limit in (100, 0):
        got = flow.weather_with_trips(weather, trips, max_rows=limit)
        assert sorted(((r.main, r.ride_id) for r in got.collect()), key=str) == [
            ("w", None), ("x", 1), ("x", 2), ("y", 1), ("y", 2),
        ]


def level_rows(spark, levels):
    rows = [("A", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(levels)]
    return spark.createDataFrame(rows, "station_id string, ds timestamp_ntz, num_bikes_available double")


def test_difference_is_zero_on_the_first_row_and_beside_null(spark):
    got = flow.level_to_flow(level_rows(spark, [5.0, 7.0, None, 9.0, 8.0])).orderBy("ds").collect()
    assert [r.y for r in got] == [0.0, 2.0, 0.0, 0.0, -1.0]


def test_cutoff_is_horizon_plus_two_from_the_end(spark):
    rows = level_rows(spark, [1.0] * 10)
    [row] = flow.holdout_cutoff(rows, 4, ts="ds").collect()
    assert row.cutoff == T0 + dt.timedelta(hours=4)
    assert flow.holdout_cutoff(rows, 9, ts="ds").count() == 0


def test_status_hourly_means_are_rounded(spark):
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = [("A", base + 10, 2), ("A", base + 3000, 3), ("A", base + 3600, 9), ("A", base + 7200, None)]
    status = spark.createDataFrame(rows, "station_id string, last_reported long, n int")
    got = flow.status_hourly(status, ["n"]).orderBy("ts_hour").collect()
    assert [(r.time, r.n) for r in got] == [("00:00:00", 3.0), ("01:00:00", 9.0), ("02:00:00", None)]


@pytest.mark.parametrize("start, hours", [(None, [1, 2, 3]), (T0, [0, 1, 2, 3])])
def test_weather_hours_of_each_station(spark, start, hours):
    weather = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=h), float(h)) for h in range(6)], "ts_hour timestamp_ntz, temp double"
    )
    levels = spark.createDataFrame(
        [("A", T0 + dt.timedelta(hours=h), 1.0) for h in (1, 3)],
        "station_id string, ts_hour timestamp_ntz, num_bikes_available double",
    )
    got = flow.weather_with_status(weather, levels, start).orderBy("ts_hour").collect()
    assert [int(r.temp) for r in got] == hours
    idle = [int(r.temp) for r in got if r.num_bikes_available is None]
    assert idle == [h for h in hours if h not in (1, 3)]


def test_idle_stations_have_every_hour_of_the_window(spark):
    rows = [
        (dt.datetime(2022, 1, 1, 5), dt.datetime(2022, 1, 1, 6), "a", "b"),
        (dt.datetime(2022, 2, 1, 5), dt.datetime(2022, 2, 1, 5), "c", "a"),
    ]
    trips = spark.createDataFrame(
        rows,
        "started_at timestamp_ntz, ended_at timestamp_ntz, start_station_id string, end_station_id string",
    )
    first, last = dt.datetime(2022, 1, 1, 4), dt.datetime(2022, 1, 1, 6)
    got = flow.net_flow(trips, first=first, last=last).collect()
    by_station = {}
    for r in sorted(got, key=lambda r: r.ts_hour):
        by_station.setdefault(r.station_id, []).append((r.departures, r.arrivals, r.net_flow))
    idle = (0, 0, 0)
    assert by_station == {
        "a": [idle, (1, 0, -1), idle],
        "b": [idle, idle, (0, 1, 1)],
        "c": [idle, idle, idle],
    }
    only_late = flow.net_flow(trips, last=last)
    assert {r.station_id for r in only_late.collect()} == {"a", "b", "c"}
    assert flow.net_flow(trips, zero_fill=False, first=first, last=last).count() == 2
