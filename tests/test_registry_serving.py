from __future__ import annotations

import datetime as dt

import pytest

from stationflow.operators import registry, serving
from stationflow.sources import schemas
from stationflow.sources.tables import empty_table

T0 = dt.datetime(2023, 4, 1, 10)
PLACED = "station_id string, stage string, mae double"
STATUS = "station_id string, last_reported long, num_bikes_available int, num_docks_available int"


def reg(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.REGISTRY)


def candidate(spark, mae, station="A"):
    return spark.createDataFrame([(station, mae, 4)], "station_id string, mae double, param_id int")


def stages(df):
    return {(r.station_id, r.version): r.stage for r in df.collect()}


def test_first_model_must_beat_the_default(spark):
    none = empty_table(spark, schemas.REGISTRY)
    assert stages(registry.promote(none, candidate(spark, 5.0))) == {("A", 1): "Staging"}
    assert stages(registry.promote(none, candidate(spark, 1234.0))) == {("A", 1): "Archived"}
    assert stages(registry.promote(none, candidate(spark, 9e9), force=True)) == {("A", 1): "Production"}


def test_better_and_worse_than_staging(spark):
    old = reg(
        spark,
        ("A", 1, "Production", 1.0, 1),
        ("A", 2, "Staging", 3.0, 2),
        ("B", 7, "Staging", 0.1, 1),
    )
    better = registry.promote(old, candidate(spark, 2.0))
    assert stages(better) == {
        ("A", 1): "Production", ("A", 2): "Archived", ("A", 3): "Staging", ("B", 7): "Staging",
    }
    worse = registry.promote(old, candidate(spark, 3.0))
    assert stages(worse) == {
        ("A", 1): "Production", ("A", 2): "Staging", ("A", 3): "Archived", ("B", 7): "Staging",
    }
    forced = registry.promote(old, candidate(spark, 9.0), force=True)
    assert stages(forced) == {
        ("A", 1): "Archived", ("A", 2): "Staging", ("A", 3): "Production", ("B", 7): "Staging",
    }


def gold(spark, *rows):
    full = [(s, T0, 1.0, 2.0, kind, 1.0, 9.0, level) for s, kind, level in rows]
    return spark.createDataFrame(full, schemas.GOLD)


def results(spark, yhat=2.6):
    return spark.createDataFrame(
        [("A", T0, 1.0, yhat, yhat - 1.0, 5.0)],
        "station_id string, ds timestamp_ntz, y double, yhat double, residual double, "
        "num_bikes_available double",
    )


@pytest.mark.parametrize(
    "stage, left",
    [
        ("Staging", [("A", "Production", 1.0), ("A", "Staging", 5.0), ("B", "Staging", 3.0)]),
        ("Production", [("A", "Production", 5.0), ("A", "Staging", 2.0), ("B", "Staging", 3.0)]),
        ("Archived", [("A", "Production", 1.0), ("A", "Staging", 2.0), ("B", "Staging", 3.0)]),
    ],
)
def test_publishing_replaces_one_stage_of_one_station(spark, stage, left):
    old = gold(spark, ("A", "Production", 1.0), ("A", "Staging", 2.0), ("B", "Staging", 3.0))
    placed = spark.createDataFrame([("A", stage, 0.5)], PLACED)
    new = registry.publish_gold(old, results(spark), placed)
    assert new.columns == schemas.GOLD.names
    rows = sorted((r.station_id, r.model_type, r.num_bikes_available) for r in new.collect())
    assert rows == left
    fresh = [r for r in new.collect() if r.num_bikes_available == 5.0]
    assert all(r.yhat == 3.0 and r.error_mae == 0.5 and r.model_res == pytest.approx(1.6) for r in fresh)


def test_publishing_into_an_empty_table(spark):
    placed = spark.createDataFrame([("A", "Staging", 0.5)], PLACED)
    gold = empty_table(spark, schemas.GOLD)
    assert registry.publish_gold(gold, results(spark), placed).count() == 1


@pytest.fixture
def status(spark):
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = [
        ("A", base - 60, 1, 9),
        ("A", base + 600, 2, 8),
        ("A", base + 601, 3, 7),
        ("B", base + 600, None, 5),
        ("C", base + 3600, 4, 4),
    ]
    return spark.createDataFrame(rows, STATUS)


def test_latest_status_at_before_and_after(status):
    as_of = T0 + dt.timedelta(seconds=600)
    got = {r.station_id: r for r in serving.latest_status(status, as_of).collect()}
    assert (got["A"].num_bikes_available, got["A"].num_docks_available) == (2, 8)
    assert got["A"].last_reported == as_of
    assert (got["B"].num_bikes_available, got["B"].num_docks_available) == (None, 5)
    assert "C" not in got
    strict = serving.latest_status(status, as_of, strict_hour=True).collect()
    assert {r.station_id: r.num_bikes_available for r in strict} == {"A": 1}


def test_latest_status_in_another_zone_and_from_text(status):
    as_of = dt.datetime(2023, 4, 1, 6, 10)  # New York is four hours behind
    text = status.withColumn("last_reported", status.last_reported.cast("string"))
    for df in (status, text):
        got = serving.latest_status(df, as_of, zone="America/New_York").collect()
        assert {r.station_id: r.last_reported for r in got} == {"A": as_of, "B": as_of}


def test_same_second_reports_give_one_whole_row(spark):
    rows = [("A", 100, i, 40 - i) for i in range(20)]
    df = spark.createDataFrame(rows, STATUS).repartition(7)
    seen = {tuple(serving.latest_status(df, T0).first()) for _ in range(3)}
    [row] = seen
    assert row[2:] == (19, 21)


def test_second_level_and_missing_levels_break_ties(spark):
    rows = [("A", 100, 9, 1), ("A", 100, 9, 7), ("A", 100, None, 50), ("A", -(2**63), 99, 99)]
    rows += [("B", 100, None, None), ("B", 100, None, 3)]
    got = {tuple(r) for r in serving.latest_status(spark.createDataFrame(rows, STATUS), T0).collect()}
    assert {(r[0], *r[2:]) for r in got} == {("A", 9, 7), ("B", None, 3)}


def test_levels_and_capacity(spark):
    hours = [T0 + dt.timedelta(hours=i) for i in range(3)]
    rows = [("A", hours[i], y, "Staging", 10.0 + i) for i, y in enumerate([3.0, -5.0, 9.0])]
    rows += [("B", T0, None, "Staging", 1.0), ("Z", T0, 1.0, "Staging", 1.0)]
    df = spark.createDataFrame(
        rows, "station_id string, ds timestamp_ntz, yhat double, model_type string, num_bikes_available double"
    )
    info = spark.createDataFrame([("A", 13), ("B", 5)], "station_id string, capacity int")
    plain = serving.capacity_breach(serving.forecast_level(df), info)
    shown = plain.orderBy("station_id", "ds").collect()
    assert [(r.station_id, r.available_bikes, r.level_state) for r in shown] == [
        ("A", 13.0, "full"), ("A", 6.0, "ok"), ("A", 21.0, "full"), ("B", None, None), ("Z", 2.0, None),
    ]
    known = spark.createDataFrame([("A", 2)], "station_id string, num_bikes_available int")
    running = serving.capacity_breach(serving.forecast_level(df, known), info).filter("station_id = 'A'")
    got = [(r.available_bikes, r.level_state) for r in running.orderBy("ds").collect()]
    assert got == [(5.0, "ok"), (0.0, "empty"), (9.0, "ok")]
    assert serving.station_capacity(info, ["B"]).collect()[0].capacity == 5


def test_current_weather(spark):
    rows = [(T0, 1.0), (T0 + dt.timedelta(hours=1), 2.0)]
    df = spark.createDataFrame(rows, "ts_hour timestamp_ntz, temp double")
    [row] = serving.current_weather(df, T0 + dt.timedelta(minutes=59), ["temp"]).collect()
    assert row.temp == 1.0
