from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationflow.operators import quality


@pytest.fixture
def gaps(spark):
    rows = [
        # mostly NULL, tie of a and b, all NULL, typed columns
        (1, None, "b", None, 2, dt.date(2022, 1, 2)),
        (2, None, "a", None, 2, dt.date(2022, 1, 1)),
        (3, None, "b", None, None, None),
        (4, "x", "a", None, 1, dt.date(2022, 1, 1)),
        (5, None, None, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "id int, sparse string, tie string, empty string, n int, d date"
    )


def test_mode_ignores_null_and_breaks_ties_low(gaps):
    filled = quality.impute_mode(gaps, ["sparse", "tie", "empty", "n", "d"]).orderBy("id").collect()
    assert [r.sparse for r in filled] == ["x"] * 5
    assert [r.tie for r in filled] == ["b", "a", "b", "a", "a"]
    assert [r.empty for r in filled] == [None] * 5
    assert [r.n for r in filled] == [2, 2, 2, 1, 2]
    assert filled[4].d == dt.date(2022, 1, 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc") | st.none(), st.integers(0, 2) | st.none()),
        min_size=1,
        max_size=25,
    ),
    st.booleans(),
)
def test_modes_equal_counting_by_hand(spark, rows, null_competes):
    got = quality.column_modes(
        spark.createDataFrame(rows, "s string, n int"), ["s", "n"], null_competes
    ).first()
    for i, name in enumerate(("s", "n")):
        counts = Counter(r[i] for r in rows if null_competes or r[i] is not None)
        want = None
        if counts:
            most = max(counts.values())
            tied = [v for v, c in counts.items() if c == most]
            want = None if None in tied else min(tied)
        assert got[name] == want


def test_null_may_win_when_it_competes(gaps):
    filled = quality.impute_mode(gaps, "*", null_competes=True).orderBy("id").collect()
    assert [r.sparse for r in filled] == [None, None, None, "x", None]
    # NULL and 2 occur twice each; NULL is the lower.
    assert [r.n for r in filled] == [2, 2, None, 1, None]
    assert filled[4].tie == "a"


def test_impute_keeps_schema_and_reads_no_python(gaps):
    filled = quality.impute_mode(gaps, ["tie", "n"])
    assert filled.dtypes == gaps.dtypes
    assert "Python" not in filled._jdf.queryExecution().executedPlan().toString()


def test_null_profile_and_shape(gaps):
    nulls = {r.column: r.n_null for r in quality.null_profile(gaps).collect()}
    assert nulls == {"id": 0, "sparse": 4, "tie": 1, "empty": 5, "n": 2, "d": 2}
    assert quality.shape(gaps).first().asDict() == {"n_rows": 5, "n_columns": 6}


@pytest.fixture
def repeats(spark):
    rows = [
        ("2022-01-01", "10:00:00", 1, "p"),
        ("2022-01-01", "10:00:00", 1, "p"),
        ("2022-01-01", "11:00:00", 2, "p"),
        ("2022-01-01", "11:00:00", 1, "q"),
        (None, "11:00:00", 3, "r"),
        (None, "11:00:00", 4, "s"),
    ]
    return spark.createDataFrame(rows, "date string, time string, n int, v string")


def test_duplicates(repeats):
    groups = quality.duplicate_groups(repeats).collect()
    assert [(r.time, r["count"]) for r in groups] == [("10:00:00", 2)]
    by_key = quality.duplicate_groups(repeats, ["date", "time"]).collect()
    assert sorted(r["count"] for r in by_key) == [2, 2, 2]
    assert quality.drop_duplicates(repeats).count() == 5


@pytest.mark.parametrize("limit", [100, 0])
def test_copies_are_the_duplicates(spark, repeats, limit):
    assert sorted(map(str, quality.drop_copies(repeats, limit).collect())) == sorted(
        map(str, quality.drop_duplicates(repeats).collect())
    )
    # Equal to a comparison, though not bit by bit; and NULLs in different places.
    rows = [(0.0, None, "a"), (-0.0, None, "a"), (0.0, "a", None), (float("nan"), "x", "y")] * 2
    df = spark.createDataFrame(rows, "x double, a string, b string")
    assert quality.drop_copies(df, limit).count() == 3


def test_unique_rows_are_not_shuffled_whole(spark, repeats):
    plan = quality.drop_copies(repeats)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_keep_first_and_marks_agree(repeats):
    rows = repeats.distinct()
    first = quality.keep_first(rows, ["date", "time"], ["n"])
    marked = quality.mark_repeats(rows, ["date", "time"], ["n"])
    assert first.columns == rows.columns
    left = sorted(map(tuple, first.collect()), key=str)
    right = sorted(map(tuple, marked.filter(~F.col("is_repeat")).select(*rows.columns).collect()), key=str)
    assert left == right and len(left) == 3
    assert {r.v for r in first.collect()} == {"p", "q", "r"}
