"""Training frames, backtests and per-station forecasts.

Series, folds and parameter sets are rows. Everything but the small dense solve
is DataFrame expressions; the solve runs once per station on the executors.
"""

from __future__ import annotations

import datetime as dt
import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .flow import level_to_flow

DAY = 86_400

# The regressors and the tuning grid.
REGRESSORS = ("temp", "wind_speed", "humidity", "hour")
PARAM_GRID = {
    "changepoint_prior_scale": [0.001, 0.05],
    "seasonality_prior_scale": [1, 3],
    "seasonality_mode": ["additive", "multiplicative"],
}
# Rolling-origin backtest in days.
INITIAL_DAYS, PERIOD_DAYS, HORIZON_DAYS = 200, 60, 120


# ---- frames -----------------------------------------------------------------


def panel(df: DataFrame, y: str, ts: str = "ts_hour", k: Sequence[str] = ("station_id",)) -> DataFrame:
    """Keys, ``ds``, ``y`` and the regressors, all measures DOUBLE."""
    return df.select(
        *k,
        F.col(ts).alias("ds"),
        F.col(y).cast("double").alias("y"),
        *[F.col(r).try_cast("double").alias(r) for r in ("temp", "wind_speed", "humidity")],
        F.hour(ts).cast("double").alias("hour"),
    )


def training_frame(
    history: DataFrame,
    recent: DataFrame,
    cutoffs: DataFrame,
    split: dt.date,
    k: Sequence[str] = ("station_id",),
    ties: Sequence[str] = ("temp",),
) -> DataFrame:
    """Flow counted from trips before ``split``, flow from status levels since.

    ``history`` is a :func:`panel`; ``recent`` has ``ts_hour``, the regressors and
    ``num_bikes_available``. Recent rows end at the key's cut-off.
    """
    split_at = F.lit(split.isoformat()).cast("date")
    learned = (
        recent.filter(F.to_date("ts_hour") >= split_at)
        .join(cutoffs, list(k))
        .filter(F.col("ts_hour") <= F.col("cutoff"))
    )
    flow = level_to_flow(learned, k, "ts_hour", ties=ties)
    return history.filter(F.to_date("ds") < split_at).unionByName(
        panel(flow, "y", k=k), allowMissingColumns=True
    )


def holdout_frame(
    recent: DataFrame,
    cutoffs: DataFrame,
    k: Sequence[str] = ("station_id",),
    ties: Sequence[str] = ("temp",),
    carry: bool = False,
) -> DataFrame:
    """Rows after the cut-off up to the last status hour, with the actual level.

    The first row has flow 0 unless ``carry`` takes the difference before the split.
    """
    rows = recent.join(cutoffs, list(k))
    held = F.col("ts_hour") > F.col("cutoff")
    if carry:
        rows = level_to_flow(rows, k, "ts_hour", ties=ties).filter(held)
    else:
        rows = level_to_flow(rows.filter(held), k, "ts_hour", ties=ties)
    return rows.select(
        *k,
        F.col("ts_hour").alias("ds"),
        "y",
        *[F.col(r).try_cast("double").alias(r) for r in ("temp", "wind_speed", "humidity")],
        F.hour("ts_hour").cast("double").alias("hour"),
        F.col("num_bikes_available").cast("double").alias("num_bikes_available"),
    )


# ---- grid and folds ---------------------------------------------------------


def combinations(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid's values, numbered from 1 in ``param_id``."""
    sets = itertools.product(*grid.values())
    return [{"param_id": i, **dict(zip(grid, s))} for i, s in enumerate(sets, 1)]


def param_grid(series: DataFrame, grid: Mapping[str, Sequence] = PARAM_GRID) -> DataFrame:
    """One row per series and parameter set."""
    sets = F.array(
        *[F.struct(*[F.lit(v).alias(n) for n, v in s.items()]) for s in combinations(grid)]
    )
    return series.select(*series.columns, F.inline(sets))


def cv_folds(
    series: DataFrame,
    initial: int = INITIAL_DAYS,
    period: int = PERIOD_DAYS,
    horizon: int = HORIZON_DAYS,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """(keys, fold, cutoff): cut-offs every ``period`` days back from the last one that
    leaves a full horizon, down to the first that leaves ``initial`` days of history.

    Lengths are days. A key too short for one fold has no row.
    """
    bounds = series.groupBy(*k).agg(F.min("ds").alias("_min"), F.max("ds").alias("_max"))
    first = F.col("_min") + _days(initial)
    last = F.col("_max") - _days(horizon)
    n = F.floor(F.timestamp_diff("SECOND", first, last) / F.lit(period * DAY)).cast("int")
    back = F.sequence(F.col("_n"), F.lit(0), F.lit(-1))
    return (
        bounds.withColumns({"_last": last, "_n": n})
        .filter(F.col("_last") >= first)
        .select(*k, "_last", F.posexplode(back).alias("fold", "_back"))
        .select(
            *k,
            "fold",
            F.timestamp_add("SECOND", F.col("_back") * F.lit(-period * DAY), F.col("_last")).alias(
                "cutoff"
            ),
        )
    )


def cv_test_rows(
    series: DataFrame,
    folds: DataFrame,
    horizon: int = HORIZON_DAYS,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """Rows with each fold that tests them: ``cutoff < ds <= cutoff + horizon``."""
    rows = series.join(folds, list(k))
    return rows.filter(
        (F.col("ds") > F.col("cutoff")) & (F.col("ds") <= F.col("cutoff") + _days(horizon))
    )


def seasonal_mean_backtest(
    series: DataFrame,
    folds: DataFrame,
    horizon: int = HORIZON_DAYS,
    k: Sequence[str] = ("station_id",),
    z: float = 1.2815515655446004,
) -> DataFrame:
    """Backtest of the plainest model: mean flow by key and hour of day before the cut-off.

    The yardstick for :func:`fit_predict`. A row is counted once, under the first
    fold that trains on it, and running sums over the folds give every fold its
    training mean, so training rows are not copied per fold. The interval is
    ``yhat ± z`` standard deviations.
    """
    k = list(k)
    cuts = folds.groupBy(*k).agg(F.array_sort(F.collect_list("cutoff")).alias("_cuts"))
    # Folds are numbered by cut-off, so the first one that sees a row is the
    # number of cut-offs before it.
    first_fold = F.size(F.filter("_cuts", lambda c: c < F.col("ds")))
    y = F.col("y")
    seen = (
        series.join(cuts, k)
        .select(*k, "hour", first_fold.alias("fold"), y)
        .groupBy(*k, "hour", "fold")
        .agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.avg("y").alias("m"), F.var_pop("y").alias("v"))
    )
    # Spread about a value near all of them, so that squares of a high level do not cancel.
    off = F.col("m") - F.min("m").over(W.partitionBy(*k, "hour"))
    seen = seen.withColumn("so", F.col("n") * off)
    seen = seen.withColumn("ss", F.col("n") * (F.col("v") + off * off)).drop("m", "v")
    hours = seen.select(*k, "hour").distinct().join(folds.select(*k, "fold"), k)
    so_far = W.partitionBy(*k, "hour").orderBy("fold")
    means = (
        hours.join(seen, [*k, "hour", "fold"], "left")
        .withColumns({c: F.sum(c).over(so_far) for c in ("n", "s", "so", "ss")})
        .withColumn("yhat", F.try_divide("s", F.col("n").cast("double")))
        .withColumn(
            "_sd",
            F.sqrt(
                F.greatest(
                    F.try_divide("ss", F.col("n").cast("double"))
                    - F.pow(F.try_divide("so", F.col("n").cast("double")), F.lit(2)),
                    F.lit(0.0),
                )
            ),
        )
        .select(
            *k,
            "hour",
            "fold",
            "yhat",
            (F.col("yhat") - F.lit(z) * F.col("_sd")).alias("yhat_lower"),
            (F.col("yhat") + F.lit(z) * F.col("_sd")).alias("yhat_upper"),
        )
    )
    tests = cv_test_rows(series, folds, horizon, k)
    return tests.join(means, [*k, "hour", "fold"])


# ---- model ------------------------------------------------------------------


def fit_predict(
    series: DataFrame,
    folds: DataFrame,
    grid: Mapping[str, Sequence] = PARAM_GRID,
    horizon: int | None = None,
    k: Sequence[str] = ("station_id",),
    regressors: Sequence[str] = REGRESSORS,
    interval_z: float = 1.2815515655446004,
) -> DataFrame:
    """Forecast of every fold and parameter set of every series.

    Trend with changepoints, daily, weekly and yearly seasonality and linear
    regressors (Taylor and Letham, "Forecasting at Scale", 2018), fitted as a
    ridge regression with penalty ``1 / scale^2``. Rows up to a fold's cut-off
    train; later ones, within ``horizon`` days if given, are predicted.

    A series is hourly, so a group is bounded by the calendar, not by the number
    of trips, and reaches its task once whatever the number of folds and sets.
    """
    k = list(k)
    fit = _series_fitter(combinations(grid), list(regressors), horizon, interval_z, k)
    keys = [f"{f.name} {f.dataType.simpleString()}" for f in series.select(*k).schema]
    out = ", ".join(
        keys
        + ["fold int", "param_id int", "ds timestamp_ntz", "y double", "yhat double"]
        + ["yhat_lower double", "yhat_upper double"]
    )
    rows = series.select(*k, "ds", F.col("y").cast("double").alias("y"), *regressors)
    # Renamed keys: folds are usually derived from the series itself.
    cuts = folds.select(
        *[F.col(c).alias(c) for c in k], F.col("fold").cast("int").alias("fold"), "cutoff"
    )
    return rows.groupBy(*k).cogroup(cuts.groupBy(*k)).applyInPandas(fit, out)


def fit_coefficients(
    series: DataFrame,
    folds: DataFrame,
    grid: Mapping[str, Sequence] = PARAM_GRID,
    k: Sequence[str] = ("station_id",),
    regressors: Sequence[str] = REGRESSORS,
) -> DataFrame:
    """The models of :func:`fit_predict` as rows: keys, fold, ``param_id``, ``pos``, ``term``, ``value``.

    A model has one row per term of :func:`model_terms`; a season too long for the
    history has zeros. :func:`score` needs nothing else to forecast any hour.
    """
    k = list(k)
    fit = _series_fitter(combinations(grid), list(regressors), None, 1.0, k, model_terms(regressors))
    keys = [f"{f.name} {f.dataType.simpleString()}" for f in series.select(*k).schema]
    out = ", ".join(keys + ["fold int", "param_id int", "pos int", "term string", "value double"])
    rows = series.select(*k, "ds", F.col("y").cast("double").alias("y"), *regressors)
    cuts = folds.select(
        *[F.col(c).alias(c) for c in k], F.col("fold").cast("int").alias("fold"), "cutoff"
    )
    return rows.groupBy(*k).cogroup(cuts.groupBy(*k)).applyInPandas(fit, out)


# Seasons: days, waves and the days of history they need.
BANDS = ((1.0, 4, 2), (7.0, 3, 14), (365.25, 10, 730))
# Changepoints over the first 80 % of the history.
CHANGEPOINTS, CHANGE_RANGE = 25, 0.8
_SETTINGS = ("origin", "span", "scale", "spread", "multiplicative", "offset")


def model_terms(regressors: Sequence[str] = REGRESSORS) -> list[str]:
    """Names of a stored model's values in their order."""
    trend = ["trend", "slope", *[f"change {i}" for i in range(1, CHANGEPOINTS + 1)]]
    waves = [
        f"{kind} {n} of {days:g} days"
        for days, most, _ in BANDS
        for kind in ("sin", "cos")
        for n in range(1, most + 1)
    ]
    return [*_SETTINGS, *trend, *waves, *[f"of {r}" for r in regressors]]


def score(
    rows: DataFrame,
    coefficients: DataFrame,
    k: Sequence[str] = ("station_id",),
    regressors: Sequence[str] = REGRESSORS,
    interval_z: float = 1.2815515655446004,
    models: Sequence[str] = ("fold", "param_id"),
) -> DataFrame:
    """Rows (keys, ``ds``, regressors) with the forecast of each stored model of their key.

    A model is one array per key, and the forecast the product of its values with terms of the
    row's time and regressors. Rows of keys without a model are left out; a NULL regressor
    gives a NULL forecast.
    """
    terms = model_terms(regressors)
    values = F.array_sort(F.collect_list(F.struct("pos", "value")))
    stored = coefficients.groupBy(*k, *models).agg(
        F.transform(values, lambda v: v["value"]).alias("_w")
    )
    at = {t: F.col("_w")[i] for i, t in enumerate(terms)}
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    day = F.timestamp_diff("SECOND", origin, F.col("ds")) / F.lit(float(DAY))
    u = (F.col("_day") - at["origin"]) / at["span"]
    trend = at["trend"] + at["slope"] * F.col("_u")
    for i in range(1, CHANGEPOINTS + 1):
        trend += at[f"change {i}"] * F.greatest(F.col("_u") - CHANGE_RANGE * i / CHANGEPOINTS, F.lit(0.0))
    rest = at["offset"]
    for days, most, _ in BANDS:
        for n in range(1, most + 1):
            angle = F.col("_day") * (2 * math.pi * n / days)
            for kind, wave in (("sin", F.sin(angle)), ("cos", F.cos(angle))):
                rest += at[f"{kind} {n} of {days:g} days"] * wave
    for r in regressors:
        rest += at[f"of {r}"] * F.col(r)
    g, z = F.col("_g"), F.col("_z")
    yhat = at["scale"] * F.when(at["multiplicative"] > 0, g * (1 + z)).otherwise(g + z)
    spread = F.lit(interval_z) * at["spread"]
    return (
        rows.join(stored, list(k))
        .withColumn("_day", day)
        .withColumn("_u", u)
        .withColumns({"_g": trend, "_z": rest})
        .withColumn("yhat", yhat)
        .withColumns({"yhat_lower": F.col("yhat") - spread, "yhat_upper": F.col("yhat") + spread})
        .drop("_w", "_day", "_u", "_g", "_z")
    )


def _series_fitter(sets, regressors, horizon, z, k, terms=None):
    # Built as a closure so that workers need not have this package installed.
    bands, changes, change_range = BANDS, CHANGEPOINTS, CHANGE_RANGE

    def fit(key, pdf, cuts):
        import numpy as np
        import pandas as pd

        columns = [*k, "fold", "param_id", "ds", "y", "yhat", "yhat_lower", "yhat_upper"]
        if terms:
            columns = [*k, "fold", "param_id", "pos", "term", "value"]
        pdf = pdf.sort_values("ds", kind="stable")
        day = pdf["ds"].to_numpy("datetime64[s]").astype("int64") / 86400.0
        y_all = pdf["y"].to_numpy(float)
        x_all = pdf[regressors].to_numpy(float)
        known = np.isfinite(y_all) & np.isfinite(x_all).all(axis=1)

        def waves(t, length, order):
            angle = 2 * np.pi * np.outer(t, np.arange(1, order + 1)) / length
            return np.hstack([np.sin(angle), np.cos(angle)])

        def solve(gram, rhs, penalty):
            return np.linalg.solve(gram + np.diag(penalty), rhs)

        parts = []
        for fold, cutoff in zip(cuts["fold"], cuts["cutoff"].to_numpy("datetime64[s]")):
            cut = cutoff.astype("int64") / 86400.0
            train = known & (day <= cut)
            test = day > cut
            if horizon is not None:
                test &= day <= cut + horizon
            if train.sum() < 2 or not (terms or test.any()):
                continue
            t, y = day[train], y_all[train]
            span = max(t[-1] - t[0], 1e-9)
            scale = max(np.abs(y).max(), 1e-9)
            mean, sd = x_all[train].mean(axis=0), x_all[train].std(axis=0)
            sd[sd == 0] = np.inf
            knots = np.linspace(0, change_range, changes + 1)[1:]

            def trend(d):
                u = (d - t[0]) / span
                hinges = np.maximum(u[:, None] - knots, 0)
                return np.hstack([np.ones((len(u), 1)), u[:, None], hinges])

            def season(d):
                used = [waves(d, p, n) for p, n, least in bands if span >= least]
                return np.hstack(used) if used else np.zeros((len(d), 0))

            g_x, s_x = trend(t), season(t)
            z_x = np.hstack([s_x, (x_all[train] - mean) / sd])
            g_new = trend(day[test])
            z_new = np.hstack([season(day[test]), (x_all[test] - mean) / sd])
            x, x_new, target = np.hstack([g_x, z_x]), np.hstack([g_new, z_new]), y / scale
            # One product over the history serves every parameter set.
            gram, rhs, m = x.T @ x, x.T @ target, g_x.shape[1]
            for p in sets:
                slope = np.r_[0.04, 0.04, np.full(changes, p["changepoint_prior_scale"] ** -2.0)]
                other = np.r_[
                    np.full(s_x.shape[1], p["seasonality_prior_scale"] ** -2.0),
                    np.full(len(regressors), 0.01),
                ]
                if p["seasonality_mode"] == "additive":
                    b = solve(gram, rhs, np.r_[slope, other])
                    fitted, ahead = x @ b, x_new @ b
                    a, b = b[:m], b[m:]
                else:
                    # y = g (1 + z b) is linear in b once the trend g is known.
                    a = solve(gram[:m, :m], rhs[:m], slope)
                    g, g_ahead = g_x @ a, g_new @ a
                    gz = g[:, None] * z_x
                    b = solve(gz.T @ gz, gz.T @ (target - g), other)
                    fitted, ahead = g * (1 + z_x @ b), g_ahead * (1 + z_new @ b)
                spread = z * scale * np.std(target - fitted)
                if terms:
                    # Seasons that were not used are zero; regressors are not centred any more.
                    waves_used = iter(b[: s_x.shape[1]])
                    season_b = [
                        next(waves_used) if span >= least else 0.0
                        for _, n, least in bands
                        for _ in range(2 * n)
                    ]
                    of = b[s_x.shape[1] :] / sd
                    settings = [t[0], span, scale, spread, p["seasonality_mode"] != "additive", -of @ mean]
                    values = np.r_[np.array(settings, float), a, season_b, of]
                    part = pd.DataFrame({"pos": np.arange(len(terms)), "term": terms, "value": values})
                    parts.append(part.assign(fold=int(fold), param_id=p["param_id"]))
                    continue
                yhat = scale * ahead
                part = pd.DataFrame(
                    {
                        "fold": int(fold),
                        "param_id": p["param_id"],
                        "ds": pdf["ds"].to_numpy()[test],
                        "y": y_all[test],
                        "yhat": yhat,
                        "yhat_lower": yhat - spread,
                        "yhat_upper": yhat + spread,
                    }
                )
                parts.append(part)
        if not parts:
            return pd.DataFrame()
        out = pd.concat(parts, ignore_index=True)
        for name, value in zip(k, key):
            out[name] = value
        return out[columns]

    return fit


# ---- evaluation -------------------------------------------------------------


def forecast_metrics(forecasts: DataFrame, k: Sequence[str]) -> DataFrame:
    """mse, rmse, mae, mdape, smape and coverage per key over the whole horizon.

    Rows with ``y = 0`` have no percentage error and are left out of ``mdape``;
    a row with ``y = yhat = 0`` has a symmetric error of 0. ``k`` should include the
    series: the exact median holds one key's values, which the calendar then bounds.
    """
    y, yhat = F.col("y"), F.col("yhat")
    error = y - yhat
    size = F.abs(y) + F.abs(yhat)
    inside = (y >= F.col("yhat_lower")) & (y <= F.col("yhat_upper"))
    return forecasts.groupBy(*k).agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.median(F.abs(F.try_divide(error, y))).alias("mdape"),
        F.avg(
            F.when(size == 0, F.lit(0.0)).otherwise(F.try_divide(F.lit(2.0) * F.abs(error), size))
        ).alias("smape"),
        F.avg(inside.cast("double")).alias("coverage"),
    )


def select_best(metrics: DataFrame, k: Sequence[str] = ("station_id",)) -> DataFrame:
    """The row of lowest mae per key; equal maes go to the lower ``param_id``."""
    rest = [c for c in metrics.columns if c not in k]
    best = F.min_by(F.struct(*rest), F.struct("mae", "param_id")).alias("_best")
    return metrics.filter(F.col("mae").isNotNull()).groupBy(*k).agg(best).select(*k, "_best.*")


def with_status(best: DataFrame, series: DataFrame, k: Sequence[str] = ("station_id",)) -> DataFrame:
    """A row for every key of ``series``: its best set, or NULLs where it has none, with ``status``.

    ``tuned``; ``short`` if the history holds no fold; ``unknown`` under two known rows.
    """
    known = series.groupBy(*k).agg(F.count("y").alias("_known"))
    status = (
        F.when(F.col("param_id").isNotNull(), "tuned")
        .when(F.col("_known") >= 2, "short")
        .otherwise("unknown")
    )
    return known.join(best, list(k), "left").withColumn("status", status).drop("_known")


def shrunken_means(
    series: DataFrame,
    k: Sequence[str] = ("station_id",),
    groups: Sequence[str] = (),
    strength: float = 24.0,
) -> DataFrame:
    """Mean flow of every key and hour of day, for keys of any history, also none.

    The mean of key and hour leans on that of the key's group and hour, which leans on that of
    the hour, which leans on that of all rows: ``strength`` rows of the wider mean are
    added to each. Columns of ``groups`` follow from the key. Rows are counted once, by
    key and hour; the wider sums are made of these. A table without any known row gives 0.
    """
    k, groups = list(k), list(groups)
    cell = series.groupBy(*k, *groups, "hour").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    # Every key has all hours, so a key without rows at an hour gets the wider mean.
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)).cast("array<double>")).alias("hour")
    keys = series.select(*k, *groups).distinct().select(*k, *groups, hours)
    found = keys.join(cell.select(*[F.col(c).alias(f"_{c}") for c in (*k, *groups, "hour")], "s", "n"),
                      _same((*k, *groups, "hour")), "left").select(*k, *groups, "hour", _zero("s"), _zero("n"))
    total = cell.agg(F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.0)).alias("m")).scalar()
    wider = total
    for level in (["hour"], *([[*groups, "hour"]] if groups else []), [*k, *groups, "hour"]):
        finest = len(level) > 1 + len(groups)
        sums = ("s", "n") if finest else ("_s", "_n")
        if not finest:
            means = cell.groupBy(*level).agg(F.sum("s").alias("_s"), F.sum("n").alias("_n"))
            means = means.select(*[F.col(c).alias(f"_{c}") for c in level], "_s", "_n")
            found = found.join(means, _same(level), "left").withColumns({c: _zero(c) for c in sums})
            found = found.drop(*[f"_{c}" for c in level])
        mean = (F.col(sums[0]) + strength * wider) / (F.col(sums[1]) + strength)
        found = found.withColumn("yhat", mean).drop("_s", "_n")
        wider = F.col("yhat")
    return found.select(*k, "hour", "yhat", F.col("n").alias("known_rows"))


def _same(columns: Sequence[str]) -> Column:
    """Columns equal those with an underscore before, NULL being a value."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


def _zero(c: str) -> Column:
    return F.coalesce(c, F.lit(0)).alias(c)


def attach_or_fall_back(
    holdout: DataFrame, forecast: DataFrame, means: DataFrame, k: Sequence[str] = ("station_id",)
) -> DataFrame:
    """Every holdout row with its model's forecast, or else the shrunken mean; ``source`` says which."""
    forecast = forecast.groupBy(*k, "ds").agg(F.min("yhat").alias("_model"))
    joined = holdout.join(forecast, [*k, "ds"], "left").join(
        means.select(*k, "hour", F.col("yhat").alias("_mean")), [*k, "hour"], "left"
    )
    source = F.when(F.col("_model").isNotNull(), "model").when(F.col("_mean").isNotNull(), "mean")
    return (
        joined.withColumns({"yhat": F.coalesce("_model", "_mean"), "source": source})
        .withColumn("residual", F.col("yhat") - F.col("y"))
        .drop("_model", "_mean")
    )


def attach_forecast(
    holdout: DataFrame, forecast: DataFrame, k: Sequence[str] = ("station_id",)
) -> DataFrame:
    """Holdout rows with ``yhat`` of the same key and time, and the residual.

    Of several forecasts of one key and time the lowest counts, on every run.
    """
    forecast = forecast.groupBy(*k, "ds").agg(F.min("yhat").alias("yhat"))
    joined = holdout.join(forecast, [*k, "ds"])
    return joined.withColumn("residual", F.col("yhat") - F.col("y"))


def residual_diagnostics(results: DataFrame, k: Sequence[str] = ("station_id",)) -> DataFrame:
    """Line of the residual on ``yhat`` and quartiles of the residual, per key."""
    r, x = F.col("residual"), F.col("yhat")
    quantiles = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    return results.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(r, x).alias("slope"),
        F.regr_intercept(r, x).alias("intercept"),
        F.regr_r2(r, x).alias("r2"),
        *[F.percentile(r, F.lit(q)).alias(n) for n, q in quantiles.items()],
    )


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))
