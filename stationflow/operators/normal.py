"""Ridge fits from sums of products.

Design columns are expressions and their normal equations are aggregates, combined
before the shuffle. A Python task sees the sums of one model, never its rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import store
from .forecast import BANDS, CHANGE_RANGE, CHANGEPOINTS, DAY, PARAM_GRID, REGRESSORS, combinations, model_terms

# Designs up to this width are summed in generated code, wider ones by batches of rows.
WIDTH = 16


def products(rows: DataFrame, columns: Sequence[Column], by: Sequence[str]) -> DataFrame:
    """Sums of the products of all pairs of ``columns``: keys, ``i`` and the array ``sums`` over the other column.

    One row per group and column, whatever the number of rows. Columns must not be NULL.
    Beyond ``WIDTH`` columns the products of a batch are one matrix product per group in
    it, and Spark adds those up; a batch is a part of the rows of a task, never a group.
    """
    by, q = list(by), len(columns)
    each = rows.select(*by, F.array(*columns).alias("_x"))
    if q <= WIDTH:
        each = each.select(*by, "_x", F.posexplode("_x").alias("i", "_v"))
        sums = [F.sum(F.col("_v") * F.col("_x")[j]) for j in range(q)]
        return each.groupBy(*by, "i").agg(F.array(*sums).alias("sums"))
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in each.select(*by).schema]
    partial = each.mapInArrow(_partial_products(by, q), ", ".join([*keys, "i int", "sums array<double>"]))
    cells = partial.select(*by, "i", F.posexplode("sums").alias("_j", "_v"))
    summed = cells.groupBy(*by, "i", "_j").agg(F.sum("_v").alias("_s"))
    line = F.array_sort(F.collect_list(F.struct("_j", "_s")))
    return summed.groupBy(*by, "i").agg(F.transform(line, lambda c: c["_s"]).alias("sums"))


def _partial_products(by, q):
    def add(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, q)
            keys = batch.select(by)
            group = keys.to_pandas().groupby(by, dropna=False, sort=False).ngroup().to_numpy()
            order = np.argsort(group, kind="stable")
            _, starts = np.unique(group[order], return_index=True)
            first, parts = order[starts], np.split(order, starts[1:])
            # A few groups at a time, so that a batch of many small ones stays small.
            for at in range(0, len(parts), 64):
                sums = [x[mine].T @ x[mine] for mine in parts[at : at + 64]]
                values = pa.array(np.concatenate(sums).ravel())
                lines = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, q, dtype=np.int32), values)
                place = pa.array(np.tile(np.arange(q, dtype=np.int32), len(sums)))
                named = keys.take(pa.array(np.repeat(first[at : at + 64], q)))
                yield pa.RecordBatch.from_arrays([*named.columns, place, lines], names=[*by, "i", "sums"])

    return add


def running_products(
    rows: DataFrame, folds: DataFrame, columns: Sequence[Column], k: Sequence[str] = ("station_id",)
) -> DataFrame:
    """:func:`products` of the rows up to each fold's cut-off, for columns that are the same in all folds.

    A row is counted once, under the first fold that has it; sums run over the folds.
    """
    k, q = list(k), len(columns)
    cuts = folds.groupBy(*k).agg(F.array_sort(F.collect_list("cutoff")).alias("_cuts"))
    step = F.size(F.filter("_cuts", lambda c: c < F.col("ds"))).alias("fold")
    steps = products(rows.join(cuts, k).select("*", step), columns, [*k, "fold"])
    # Folds are numbered by cut-off; one without rows of its own has those before it.
    places = folds.select(*k, "fold", F.explode(F.sequence(F.lit(0), F.lit(q - 1))).alias("i"))
    so_far = W.partitionBy(*k, "i").orderBy("fold")
    sums = [F.coalesce(F.sum(F.col("sums")[j]).over(so_far), F.lit(0.0)) for j in range(q)]
    return places.join(steps, [*k, "fold", "i"], "left").select(*k, "fold", "i", F.array(*sums).alias("sums"))


def solve_ridge(
    sums: DataFrame, by: Sequence[str], penalties: Mapping[int, Sequence[float]], name: str = "set_id"
) -> DataFrame:
    """Coefficients ``b`` of each penalty set and the deviation of its residuals, from :func:`products`.

    The columns are the terms, the target and a constant one. A set with fewer penalties
    than terms is fitted on the first terms alone. A group has one row per column.
    """
    by = list(by)
    fit = _solver(by, {s: list(map(float, p)) for s, p in penalties.items()}, name)
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in sums.select(*by).schema]
    out = ", ".join([*keys, f"{name} int", "b array<double>", "sd double"])
    return sums.groupBy(*by).applyInPandas(fit, out)


def _solver(by, penalties, name):
    # Built as a closure so that workers need not have this package installed.
    def fit(key, pdf):
        import numpy as np
        import pandas as pd

        m = np.stack(pdf.sort_values("i")["sums"].to_numpy()).astype(float)
        target, one = len(m) - 2, len(m) - 1
        n, found = m[one, one], []
        for s, penalty in penalties.items():
            p = len(penalty)
            a, rhs = m[:p, :p] + np.diag(penalty), m[:p, target]
            try:
                b = np.linalg.solve(a, rhs)
            except np.linalg.LinAlgError:
                b = np.linalg.lstsq(a, rhs, rcond=None)[0]
            w = np.zeros(len(m))
            w[:p], w[target] = -b, 1.0
            var = w @ m @ w / n - (m[one] @ w / n) ** 2 if n else 0.0
            found.append((*key, s, b, max(var, 0.0) ** 0.5))
        return pd.DataFrame(found, columns=[*by, name, "b", "sd"])

    return fit


def fit_by_sums(
    series: DataFrame,
    folds: DataFrame,
    grid: Mapping[str, Sequence] = PARAM_GRID,
    k: Sequence[str] = ("station_id",),
    regressors: Sequence[str] = REGRESSORS,
) -> DataFrame:
    """The rows of :func:`forecast.fit_coefficients`, without a series in a task.

    Trend and scales of a fold follow from its own rows, so a row meets each fold that trains on
    it. Additive sets take one pass of sums, multiplicative ones a second over the
    products of the fitted trend, once per trend penalty. Rows with an unknown value train
    nothing; a NULL key, and a fold with fewer than two rows, have no model.
    """
    k, regressors = list(k), list(regressors)
    by, sets = [*k, "fold"], combinations(grid)
    known = F.lit(True)
    for c in ("y", *regressors):
        known = known & (F.abs(F.col(c).cast("double")) < F.lit(math.inf))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    day = F.timestamp_diff("SECOND", start, F.col("ds")) / F.lit(float(DAY))
    cuts = folds.select(*[F.col(c).alias(c) for c in k], F.col("fold").cast("int").alias("fold"), "cutoff")
    rows = series.filter(known).select(
        *k, "ds", day.alias("_day"), *[F.col(c).cast("double").alias(c) for c in ("y", *regressors)]
    )
    seen = rows.join(cuts, k).filter(F.col("ds") <= F.col("cutoff")).drop("ds", "cutoff")
    settings = seen.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_day").alias("_from"),
        F.greatest(F.max("_day") - F.min("_day"), F.lit(1e-9)).alias("_span"),
        F.greatest(F.max(F.abs("y")), F.lit(1e-9)).alias("_scale"),
        *[F.avg(r).alias(f"_mean_{i}") for i, r in enumerate(regressors)],
        *[F.stddev_pop(r).alias(f"_sd_{i}") for i, r in enumerate(regressors)],
    )
    # Read by both passes and for the stored rows: one row per key and fold.
    settings = store(settings.filter("_n >= 2"), "settings")
    rows = seen.join(settings, by).withColumn("_u", (F.col("_day") - F.col("_from")) / F.col("_span"))
    trend, rest = _trend(), [*_waves(), *[_standard(i, r) for i, r in enumerate(regressors)]]
    target, one = F.col("y") / F.col("_scale"), F.lit(1.0)
    slopes = {v: i for i, v in enumerate(dict.fromkeys(s["changepoint_prior_scale"] for s in sets))}
    of_trend = {i: [0.04, 0.04, *[v**-2.0] * CHANGEPOINTS] for v, i in slopes.items()}

    def of_rest(s):
        return [*[s["seasonality_prior_scale"] ** -2.0] * (len(rest) - len(regressors)), *[0.01] * len(regressors)]

    first = store(products(rows, [*trend, *rest, target, one], by), "sums")
    m, parts = len(trend), []
    additive = {
        s["param_id"]: [*of_trend[slopes[s["changepoint_prior_scale"]]], *of_rest(s)]
        for s in sets if s["seasonality_mode"] == "additive"
    }
    if additive:
        whole = solve_ridge(first, by, additive, "param_id")
        parts.append(whole.select(
            *by, "param_id", F.lit(0.0).alias("_times"), F.slice("b", 1, m).alias("_a"),
            F.slice("b", m + 1, len(rest)).alias("_b"), "sd",
        ))
    times = [s for s in sets if s["seasonality_mode"] != "additive"]
    if times:
        used = {slopes[s["changepoint_prior_scale"]] for s in times}
        # y = g (1 + z b) is linear in b once the trend g is known.
        fitted = solve_ridge(first, by, {i: p for i, p in of_trend.items() if i in used}, "_trend")
        fitted = store(fitted.select(*by, "_trend", F.col("b").alias("_a")), "trends")
        g = sum((F.col("_a")[i] * x for i, x in enumerate(trend)), F.lit(0.0))
        along = rows.join(fitted, by).withColumn("_g", g)
        scaled = [F.col("_g") * z for z in rest]
        second = products(along, [*scaled, target - F.col("_g"), one], [*by, "_trend"])
        solved = solve_ridge(second, [*by, "_trend"], {s["param_id"]: of_rest(s) for s in times}, "param_id")
        mine = F.create_map(*[F.lit(v) for s in times for v in (s["param_id"], slopes[s["changepoint_prior_scale"]])])
        solved = solved.filter(mine[F.col("param_id")] == F.col("_trend")).join(fitted, [*by, "_trend"])
        parts.append(solved.select(*by, "param_id", F.lit(1.0).alias("_times"), "_a", F.col("b").alias("_b"), "sd"))
    models = parts[0]
    for part in parts[1:]:
        models = models.unionByName(part)
    return _stored(models.join(settings, by), by, regressors)


def _trend() -> list[Column]:
    u = F.col("_u")
    knots = [CHANGE_RANGE * i / CHANGEPOINTS for i in range(1, CHANGEPOINTS + 1)]
    return [F.lit(1.0), u, *[F.greatest(u - c, F.lit(0.0)) for c in knots]]


def _waves() -> list[Column]:
    """Zero where the history is too short for the season; the penalty then makes the coefficient zero."""
    return [
        F.when(F.col("_span") >= least, wave(F.col("_day") * (2 * math.pi * n / days))).otherwise(0.0)
        for days, most, least in BANDS
        for wave in (F.sin, F.cos)
        for n in range(1, most + 1)
    ]


def _standard(i: int, r: str) -> Column:
    off = F.col(r) - F.col(f"_mean_{i}")
    return F.when(F.col(f"_sd_{i}") > 0, off / F.col(f"_sd_{i}")).otherwise(0.0)


def _stored(models: DataFrame, by: Sequence[str], regressors: Sequence[str]) -> DataFrame:
    """One row per term, regressors on their own scale."""
    terms = model_terms(regressors)
    waves = sum(2 * most for _, most, _ in BANDS)
    of = [
        F.when(F.col(f"_sd_{i}") > 0, F.col("_b")[waves + i] / F.col(f"_sd_{i}")).otherwise(0.0)
        for i in range(len(regressors))
    ]
    offset = sum((-x * F.col(f"_mean_{i}") for i, x in enumerate(of)), F.lit(0.0))
    spread = F.col("_scale") * F.col("sd")
    values = F.concat(
        F.array("_from", "_span", "_scale", spread, "_times", offset),
        "_a", F.slice("_b", 1, waves), F.array(*of),
    )
    names = F.array(*[F.lit(t) for t in terms])
    rows = models.select(*by, "param_id", names.alias("_names"), F.posexplode(values).alias("pos", "value"))
    return rows.select(*by, "param_id", "pos", F.get("_names", "pos").alias("term"), "value")
