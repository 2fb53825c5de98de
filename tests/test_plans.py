"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from checks.registry import QUERIES
from stationflow.operators import serving

FITTED = {
    "fit_predict", "tuned_parameters", "forecast_from_stored_models", "ridge_by_fold", "models_from_sums",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_single_task_window(spark, sf, name):
    plan = plan_of(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in FITTED:
        assert not re.search(r"Python|Pandas|Arrow", plan)
    assert not windows_in_one_task(plan)


def windows_in_one_task(plan):
    lines = plan.splitlines()
    return [
        line
        for i, line in enumerate(lines)
        if re.search(r"\bWindow \[", line)
        and any("Exchange SinglePartition" in below for below in lines[i + 1 : i + 3])
    ]


def test_a_window_without_keys_would_be_seen(spark):
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    df = spark.range(9).withColumn("n", F.row_number().over(W.orderBy("id")))
    assert windows_in_one_task(plan_of(df))


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("monthly_trips", {"l_shipdate"}),
        ("top_end_stations", {"l_suppkey"}),
        ("hourly_profile", {"ts"}),
        ("table_shape", set()),
    ],
)
def test_only_the_needed_columns_are_read(spark, sf, name, columns):
    for line in scans(plan_of(QUERIES[name](spark, sf))):
        schema = re.search(r"ReadSchema: struct<(.*?)>", line).group(1)
        assert {c.split(":")[0] for c in schema.split(",") if c} == columns


def test_filters_reach_the_scan(spark, sf):
    [line] = scans(plan_of(QUERIES["december_rows"](spark, sf)))
    pushed = line[line.index("PushedFilters") :]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThanOrEqual(o_orde" in pushed


def test_status_time_and_station_reach_the_scan(spark, tmp_path):
    spark.range(9).selectExpr(
        "cast(id as string) AS station_id", "id AS last_reported",
        "1 AS num_bikes_available", "1 AS num_docks_available",
    ).write.parquet(str(tmp_path / "s"))
    status = spark.read.parquet(str(tmp_path / "s")).filter("station_id = '3'")
    latest = serving.latest_status(status, dt.datetime(1970, 1, 1, 0, 0, 5))
    [line] = scans(plan_of(latest))[-1:]
    pushed = line[line.index("PushedFilters") :]
    assert "IsNotNull(last_reported)" in pushed and "IsNotNull(station_id)" in pushed
    assert [r.station_id for r in latest.collect()] == ["3"]


def test_top_k_does_not_sort_everything(spark, sf):
    plan = plan_of(QUERIES["top_end_stations"](spark, sf))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_one_shuffle_where_one_is_enough(spark, sf):
    for name in ("net_flow_busy_hours", "status_hourly", "latest_status", "crosstab", "cross_counts"):
        plan = plan_of(QUERIES[name](spark, sf))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, name
