"""Drops by drops against a rebuild of everything."""

from __future__ import annotations

import pytest

from stationflow.operators import flow
from stationflow.plans import incremental, stages
from stationflow.sources import schemas

COLUMNS = schemas.TRIPS.fieldNames()


def trip(i, start, end=None, bike="classic", member="member", a="x", b="y"):
    given = {"ride_id": str(i), "started_at": start, "ended_at": end or start, "rideable_type": bike,
             "member_casual": member, "start_station_id": a, "end_station_id": b}
    return tuple(given.get(c) for c in COLUMNS)


JANUARY = [trip(i, f"2022-01-0{1 + i % 9} 10:00:00") for i in range(6)] + [trip(90, "2022-01-31 23:50:00", "2022-02-01 00:10:00")]
FEBRUARY = [trip(i, f"2022-02-0{1 + i % 9} 11:00:00", bike="electric") for i in range(10, 15)] + [trip(20, "2022-02-03 00:00:00", bike=None)]
DROPS = {
    "first": (JANUARY + FEBRUARY + [trip(30, "soon")], {"2022-01", "2022-02", None}),
    "nothing new": ([], set()),
    # A new month and a copy of an old row.
    "march, and a copy in january": ([trip(40, "2022-03-01 09:00:00"), JANUARY[0]], {"2022-01", "2022-03"}),
    # Electric becomes the most frequent kind: February's gap is filled anew, January has none.
    "another filler": ([trip(i, "2022-04-01 09:00:00", bike="electric") for i in range(50, 60)], {"2022-02", "2022-04"}),
    "unreadable again": ([trip(31, None)], {None}),
}


def test_each_drop_rebuilds_what_it_touches_and_equals_a_full_rebuild(spark, tmp_path):
    drop, root = str(tmp_path / "drop"), str(tmp_path / "lake")
    assert incremental.current(spark, root, "trips_by_month").count() == 0
    for name, (rows, touched) in DROPS.items():
        if rows:
            spark.createDataFrame(rows, schemas.TRIPS).coalesce(1).write.mode("append").option("header", True).csv(drop)
        raw = stages.ingest_trips(spark, drop, root)
        assert set(incremental.rebuild(spark, root)) == touched, name
        want = stages.silver_trips(stages.clean_trips(raw))
        got = incremental.current(spark, root, "trips_by_month").select(want.columns)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0, name
        for fill in (True, False):
            flows = incremental.current_flow(spark, root, fill)
            full = flow.net_flow(stages.typed_trips(want), zero_fill=fill)
            assert flows.count() == full.count() > 0, name
            assert flows.select(full.columns).exceptAll(full).count() == 0, name


def test_an_unfinished_run_is_not_read_and_is_done_again(spark, tmp_path, monkeypatch):
    drop, root = str(tmp_path / "drop"), str(tmp_path / "lake")

    def put(rows):
        spark.createDataFrame(rows, schemas.TRIPS).coalesce(1).write.mode("append").option("header", True).csv(drop)
        stages.ingest_trips(spark, drop, root)

    put(JANUARY)
    incremental.rebuild(spark, root)
    put(FEBRUARY)
    write = incremental._write

    def lost(rows, root, name, run):
        if name == "flow_by_month":
            raise OSError("lost")
        write(rows, root, name, run)

    monkeypatch.setattr(incremental, "_write", lost)
    with pytest.raises(OSError):
        incremental.rebuild(spark, root)
    assert incremental.current(spark, root, "trips_by_month").count() == len(JANUARY)
    monkeypatch.setattr(incremental, "_write", write)
    assert incremental.rebuild(spark, root) == ["2022-02"]
    assert incremental.current(spark, root, "trips_by_month").count() == len(JANUARY + FEBRUARY)
    # Months of an earlier run are read where that run wrote them.
    assert {r.start_month: r.built_by for r in incremental.published(spark, root)} == {"2022-01": 1, "2022-02": 2}
