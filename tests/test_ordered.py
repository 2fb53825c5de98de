"""Order over all rows in ranges against a window in one task."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationflow.operators.ordered import positions, previous

from .test_plans import plan_of, windows_in_one_task


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(5_000).select(
        (F.col("id") % 7).alias("g"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 7919 % 5_003).alias("at"),
        F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("v"),
        "id",
    )
    # A third of all rows in one group, in many ranges.
    return df.withColumn("g", F.when(F.col("id") < 1_700, F.lit(0)).otherwise(F.col("g"))).repartition(9)


def spread(spark):
    """Keeps small ranges apart, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")


@pytest.fixture(autouse=True)
def many_ranges(spark):
    spread(spark)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_previous_equals_lag(spark, rows):
    order = [F.asc_nulls_first("at"), F.asc("id")]
    found = previous(rows, order, {"last": "v", "last_id": "id"})
    over = W.orderBy(*order)
    want = rows.withColumns({"last": F.lag("v").over(over), "last_id": F.lag("id").over(over)})
    # A NULL in the row before stays NULL, at the ends of ranges too.
    assert found.exceptAll(want).count() == 0 and found.count() == want.count()
    assert not windows_in_one_task(plan_of(found))


def test_previous_of_no_rows(spark, rows):
    assert previous(rows.limit(0), [F.asc("id")], {"last": "v"}).count() == 0


def test_positions_equal_row_numbers(spark, rows):
    order = [F.asc_nulls_first("at"), F.asc("id")]
    found = positions(rows, ["g"], order, "pos", "n")
    want = rows.withColumns(
        {
            "pos": F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("long") - 1,
            "n": F.count(F.lit(1)).over(W.partitionBy("g")),
        }
    )
    assert found.select(want.columns).exceptAll(want).count() == 0 and found.count() == 5_000


def test_entry_without_the_text_operators(tmp_path):
    """The rest imports and keeps its queries when those files are gone."""
    repo = Path(__file__).resolve().parents[1]
    for name in ("stationflow", "checks"):
        shutil.copytree(repo / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    for with_pipeline in (False, True):
        if with_pipeline and (repo / "corpus_pipeline.py").exists():
            shutil.copy(repo / "corpus_pipeline.py", tmp_path)
        code = "import __spark_entry__ as e; q = e.queries(); print('net_flow' in q, any(k.startswith('op') for k in q), 'pipeline' in q)"
        env = {"PATH": "/usr/bin:/bin"}
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
        assert out.stdout.split() == ["True", "False", "False"]
