"""Ids that change hands."""

from __future__ import annotations

import datetime as dt

import pytest

from stationflow.operators import bridge, joins


def at(hour):
    return dt.datetime(2022, 1, 1) + dt.timedelta(hours=hour)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_ids_follow_their_station(spark, monkeypatch, limit):
    """Station A moves from id 1 to id 2, which B had; both ways of the join."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(bridge, "fits_broadcast", lambda df: joins.fits_broadcast(df, limit))
    seen = [("1", "A", 0), ("1", "A", 3), ("2", "B", 1), ("2", "A", 5), ("2", "A", 9), ("3", "C", 2),
            # Two names in one hour: the one of more rows; of equally many the lowest.
            ("1", "X", 3), ("1", "A", 3), ("3", "D", 2),
            (None, "A", 1), ("4", None, 1)]
    seen = spark.createDataFrame([(i, n, at(h)) for i, n, h in seen], "id string, name string, ts_hour timestamp_ntz")
    periods = bridge.station_periods(seen, "id", "name")
    assert {tuple(r) for r in periods.collect()} == {
        ("1", "A", None, None), ("2", "B", None, at(5)), ("2", "A", at(5), None), ("3", "C", None, None)}
    # The column names of the periods may be in use already.
    rows = [("1", -5), ("1", 50), ("2", 0), ("2", 4), ("2", 5), ("2", 50), ("9", 1), (None, 1), ("2", None)]
    rows = spark.createDataFrame(
        [(i, None if h is None else at(h), "mine") for i, h in rows], "id string, ts_hour timestamp_ntz, valid_from string")
    got = bridge.attach_station(rows, periods, "id")
    assert got.columns == ["id", "ts_hour", "valid_from", "station"]
    assert {(r.id, r.ts_hour, r.station) for r in got.collect()} == {
        ("1", at(-5), "A"), ("1", at(50), "A"), ("2", at(0), "B"), ("2", at(4), "B"), ("2", at(5), "A"),
        ("2", at(50), "A"), ("9", at(1), None), (None, at(1), None), ("2", None, None)}
    assert bridge.attach_station(rows, periods.limit(0), "id").count() == rows.count()
