from __future__ import annotations

import csv
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stationflow.plans import stages
from stationflow.sources import schemas, tables
from stationflow.streaming.ingest import append_available, drain, stream_csv

TRIP = {
    "ride_id": "r1",
    "rideable_type": "classic",
    "started_at": "2022-01-31 23:50:00",
    "ended_at": "2022-02-01 00:10:00",
    "start_station_name": "A",
    "start_station_id": "1",
    "end_station_name": "B",
    "end_station_id": "2",
    "member_casual": "member",
}


def drop(folder, name, names, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", newline="") as f:
        out = csv.DictWriter(f, names)
        out.writeheader()
        out.writerows(rows)


def trips(*changes):
    return [{**TRIP, **c} for c in changes]


def test_stream_equals_batch_and_reruns_add_nothing(spark, tmp_path):
    source, root = tmp_path / "drop", str(tmp_path / "lake")
    later = {"ride_id": "r2", "started_at": "2022-02-01 07:00:00"}
    drop(source, "1.csv", schemas.TRIPS.names, trips({}, later))
    assert stages.ingest_trips(spark, str(source), root).count() == 2
    drop(source, "2.csv", schemas.TRIPS.names, trips({"ride_id": "r3", "member_casual": ""}))
    stored = stages.ingest_trips(spark, str(source), root)
    batch = spark.read.schema(schemas.TRIPS).csv(str(source), header=True)
    assert stored.count() == 3
    assert stored.drop("start_month").exceptAll(batch).count() == 0
    assert stages.ingest_trips(spark, str(source), root, files_per_batch=1).count() == 3
    # Identifiers stay text, as do partition values.
    assert dict(stored.dtypes)["start_month"] == dict(stored.dtypes)["ride_id"] == "string"
    months = {r.start_month for r in stored.select("start_month").distinct().collect()}
    assert months == {"2022-01", "2022-02"}


def test_bounded_batches_take_every_file(spark, tmp_path):
    source = tmp_path / "drop"
    for i in range(5):
        drop(source, f"{i}.csv", schemas.TRIPS.names, trips({"ride_id": f"r{i}"}))
    df = stream_csv(spark, str(source), schemas.TRIPS, files_per_batch=2)
    query = append_available(df, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.awaitTermination()
    assert query.lastProgress is not None
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_empty_and_missing_categories_share_a_partition(spark, tmp_path):
    source = tmp_path / "drop"
    row = dict.fromkeys(schemas.WEATHER.names, "")
    drop(source, "1.csv", schemas.WEATHER.names, [{**row, "dt": "0"}, {**row, "dt": "1", "main": "Fog"}])
    df = stream_csv(spark, str(source), schemas.WEATHER)
    drain(df, str(tmp_path / "out"), str(tmp_path / "ckpt"), ["main"])
    back = spark.read.schema(schemas.WEATHER).parquet(str(tmp_path / "out"))
    assert {r.main for r in back.collect()} == {None, "Fog"}


@pytest.fixture
def raw(spark):
    rows = trips(
        {},
        {},
        {"ride_id": "r2", "started_at": "2022-02-02 10:00:00", "member_casual": None},
        {"ride_id": "r3", "started_at": "2022-03-01 10:00:00", "start_station_name": "C"},
        {"ride_id": "r4", "started_at": "never", "rideable_type": None},
        {"ride_id": None, "started_at": "2022-02-02 11:00:00", "end_station_name": "C"},
    )
    rows = [tuple(r.get(n) for n in schemas.TRIPS.names) for r in rows]
    return spark.createDataFrame(rows, schemas.TRIPS)


def test_cleaning_fills_categories_only(raw):
    got = {r.ride_id: r for r in stages.clean_trips(raw).collect()}
    assert len(got) == 5  # one exact duplicate gone
    assert got["r2"].member_casual == "member" and got["r4"].rideable_type == "classic"
    assert None in got and got["r4"].date is None
    assert got["r1"].time == "23:00:00" and got["r1"].month == 1 and got["r1"].year == 2022
    # Filling every column also invents identifiers.
    assert None not in {r.ride_id for r in stages.clean_trips(raw, impute="*").collect()}


def test_dates_are_inclusive(raw):
    got = stages.clean_trips(raw, dt.date(2022, 1, 31), dt.date(2022, 2, 2))
    assert {r.ride_id for r in got.collect()} == {"r1", "r2", None}
    one = stages.clean_trips(raw, start_stations=["C"])
    assert {r.ride_id for r in one.collect()} == {"r3"}


def test_months_outside_the_dates_are_not_read(raw, spark, tmp_path):
    raw.withColumn("start_month", F.substring("started_at", 1, 7)).write.partitionBy(
        "start_month"
    ).parquet(str(tmp_path / "t"))
    stored = spark.read.schema(raw.schema.add("start_month", "string")).parquet(str(tmp_path / "t"))
    clean = stages.clean_trips(stored, dt.date(2022, 2, 1), dt.date(2022, 2, 28))
    assert {r.ride_id for r in clean.collect()} == {"r2", None}
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert any("start_month" in f for f in re.findall(r"PartitionFilters: \[(.*?)\]", plan))


def test_station_trips_match_either_end(raw):
    assert {r.ride_id for r in stages.station_trips(raw, "C").collect()} == {"r3", None}


def test_a_table_may_be_overwritten_with_another_schema(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(spark.range(3), root, "bronze", "t")
    tables.write_table(spark.range(2).selectExpr("id AS other"), root, "bronze", "t")
    assert tables.read_table(spark, root, "bronze", "t").columns == ["other"]
    with pytest.raises(ValueError):
        tables.table_path(root, "copper", "t")


def test_empty_table_csv_and_listing(spark, tmp_path):
    assert tables.empty_table(spark, schemas.GOLD).schema == schemas.GOLD
    drop(tmp_path / "csv", "a.csv", ["id", "when"], [{"id": 1, "when": "2022-01-01 00:00:00"}])
    df = tables.read_csv_inferred(spark, str(tmp_path / "csv"))
    assert dict(df.dtypes) == {"id": "int", "when": "timestamp"}
    [row] = tables.input_files(spark, str(tmp_path / "csv")).collect()
    assert row.path.endswith("a.csv") and row.size > 0


def test_database(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    tables.use_database(spark, "rides_db", str(tmp_path / "db"))
    tables.use_database(spark, "rides_db", str(tmp_path / "db"))
    assert spark.catalog.currentDatabase() == "rides_db"
    spark.sql(f"USE {before}")


def test_scratch_folder_needs_a_shared_place_on_a_cluster(spark):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        tables.scratch_dir(Session(), "x")
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/c/"})
    assert tables.scratch_dir(Session(), "x").startswith("hdfs://x/c/x-")
