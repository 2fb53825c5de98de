from __future__ import annotations

import bisect
import datetime as dt
import random

import numpy as np
import pytest

from stationflow.operators import asof, distribution


@pytest.mark.parametrize("buckets", [2, 1024])
def test_exact_quantiles_equal_numpy(spark, buckets):
    rng = random.Random(3)
    many = [rng.choice([0.1, -1e-9, 1e300, rng.gauss(0, 1)]) for _ in range(400)]
    cases = {"a": many, "b": [2.5], "c": [5e-324, 0.0], "d": [-1.7e308, 1.7e308, 1.0], None: [1.0] * 9 + [2.0]}
    rows = [(k, v) for k, vs in cases.items() for v in vs]
    rows += [("a", None), ("b", float("nan")), ("c", float("inf")), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    found = distribution.exact_quantiles(df, "v", [0.0, 0.3, 0.5, 1.0], ["k"], 8 if buckets == 2 else buckets)
    got = {(r.k, r.q): (r.n, r.value) for r in found.collect()}
    assert set(got) == {(k, q) for k in cases for q in (0.0, 0.3, 0.5, 1.0)}
    for (k, q), (n, value) in got.items():
        assert n == len(cases[k])
        if k != "d":
            assert value == pytest.approx(float(np.quantile(cases[k], q)), rel=1e-12, abs=5e-324)
    assert got["d", 0.0][1] == -1.7e308 and got["d", 0.5][1] == 1.0 and got["d", 1.0][1] == 1.7e308
    assert distribution.exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_density_sums_to_one_and_merges(spark):
    rows = spark.createDataFrame([(1, float(i % 7) - 3) for i in range(50)] + [(2, 4.0), (2, None)], "k long, r double")
    cells = distribution.histogram(rows, "r", 0.5, ["k"])
    twice = cells.unionByName(cells)
    for table in (cells, twice):
        found = distribution.density(table, 0.5, ["k"], 201).collect()
        for key in (1, 2):
            at = [(r.at, r.density) for r in found if r.k == key]
            assert sum(d for _, d in at) * (at[1][0] - at[0][0]) == pytest.approx(1, abs=0.01)


@pytest.mark.parametrize("bucket", [60, 86_400])
def test_status_as_of_equals_a_search(spark, bucket):
    rng = random.Random(5)
    reports = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(0, 7200, 7)]), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    start = dt.datetime(1970, 1, 1)
    asks = [(s, start + dt.timedelta(seconds=t) if t is not None else None, "x") for s in (1, 2, 3, None) for t in (0, 59, 60, 700, 3600, 9000, None)]
    asks += asks[:3]
    rows = spark.createDataFrame(asks, "station_id long, ds timestamp_ntz, bikes0 string")
    status = spark.createDataFrame(reports, "station_id long, last_reported long, n long")
    got = asof.status_as_of(rows, status, {"bikes": "n"}, bucket_seconds=bucket).collect()

    def want(station, ds):
        if station is None or ds is None:
            return (None, None)
        known = sorted((t, n is not None, n or 0) for s, t, n in reports if s == station and t is not None)
        i = bisect.bisect_right(known, ((ds - start).total_seconds(), True, 99))
        return (known[i - 1][2] if known[i - 1][1] else None, known[i - 1][0]) if i else (None, None)

    expected = sorted([(s, d, x, *want(s, d)) for s, d, x in asks], key=str)
    assert sorted([tuple(r) for r in got], key=str) == expected
