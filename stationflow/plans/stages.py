"""The stages from CSV drop to published forecast, as functions with plain arguments.

Stages hand over through tables only, so each can be rerun by itself. A stage
that rebuilds a table from itself reads one ``run`` and writes another.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import to_number
from ..functions.timeparts import (
    epoch_parts,
    epoch_wall_clock,
    hour_bucket,
    hour_label,
    hour_start,
    wall_clock,
    year_month,
)
from ..operators import flow, forecast, normal, quality, registry, serving
from ..sources import schemas
from ..sources.tables import (
    checkpoint_path,
    empty_table,
    read_table,
    store,
    table_path,
    write_table,
)
from ..streaming.ingest import drain, stream_csv

# Columns that may be filled by their most frequent value without inventing
# identifiers, times or places.
CATEGORICAL_TRIPS = ("rideable_type", "member_casual")
CATEGORICAL_WEATHER = ("main", "description", "icon")


def ingest_trips(
    spark: SparkSession, source: str, root: str, files_per_batch: int | None = None
) -> DataFrame:
    """Takes new trip files into ``bronze/trips_raw``, partitioned by start month.

    The month is that of the parsed time, however it is written; unreadable times share
    the partition of NULL.
    """
    raw = stream_csv(spark, source, schemas.TRIPS, files_per_batch).withColumn(
        "start_month", year_month(wall_clock("started_at"))
    )
    drain(
        raw,
        table_path(root, "bronze", "trips_raw"),
        checkpoint_path(root, "bronze", "trips_raw"),
        ["start_month"],
    )
    return read_table(spark, root, "bronze", "trips_raw", schema=raw.schema)


def ingest_weather(
    spark: SparkSession, source: str, root: str, files_per_batch: int | None = None
) -> DataFrame:
    """Takes new weather files into ``bronze/weather_raw``, partitioned by category."""
    raw = stream_csv(spark, source, schemas.WEATHER, files_per_batch)
    drain(
        raw,
        table_path(root, "bronze", "weather_raw"),
        checkpoint_path(root, "bronze", "weather_raw"),
        ["main"],
    )
    return read_table(spark, root, "bronze", "weather_raw", schema=raw.schema)


def clean_trips(
    raw: DataFrame,
    start_date: dt.date | None = None,
    end_date: dt.date | None = None,
    start_stations: Sequence[str] | None = None,
    impute: Sequence[str] | str = CATEGORICAL_TRIPS,
) -> DataFrame:
    """Trips with hour, date parts and categories filled, without exact duplicates.

    Dates are inclusive and bound ``started_at``. Months outside are pruned when
    the table has ``start_month``.
    """
    trips = raw
    if start_stations is not None:
        trips = trips.filter(F.col("start_station_name").isin(list(start_stations)))
    started = F.to_date(wall_clock("started_at"))
    for bound, late in ((start_date, False), (end_date, True)):
        if bound is None:
            continue
        day, month = F.lit(bound.isoformat()).cast("date"), F.lit(bound.isoformat()[:7])
        trips = trips.filter(started <= day if late else started >= day)
        if "start_month" in trips.columns:
            here = F.col("start_month")
            trips = trips.filter(here <= month if late else here >= month)
    trips = trips.drop("start_month")
    # Hour and date parts follow from the row, so they are added last where they can be.
    early = impute == "*" or "started_at" in impute
    trips = with_hour(trips) if early else trips
    filled = trips.columns if impute == "*" else list(impute)
    # Stored, as the search for copies and the result both read the filled rows.
    modes = store(quality.column_modes(trips, filled), "modes")
    trips = quality.drop_copies(quality.impute_mode(trips, filled, modes=modes))
    return trips if early else with_hour(trips)


def with_hour(trips: DataFrame) -> DataFrame:
    """Adds hour, date, time, year and month of the start."""
    return hour_bucket(trips).withColumns({"year": F.year("date"), "month": F.month("date")})


def clean_weather(
    raw: DataFrame, zone: str = "UTC", impute: Sequence[str] | str = CATEGORICAL_WEATHER
) -> DataFrame:
    """Weather with date parts, categories filled, without exact duplicates."""
    weather = epoch_parts(raw, "dt", zone).drop("ts")
    return quality.drop_duplicates(quality.impute_mode(weather, impute))


def station_trips(
    raw: DataFrame,
    station: str,
    start: str = "start_station_name",
    end: str = "end_station_name",
) -> DataFrame:
    """Trips that start or end at one station, with hour and date parts."""
    return with_hour(raw.filter(flow.touches_station(station, start, end)))


def silver_trips(trips: DataFrame) -> DataFrame:
    return trips.select(*schemas.SILVER_TRIPS)


def silver_weather(weather: DataFrame) -> DataFrame:
    return weather.select(*schemas.SILVER_WEATHER)


def typed_trips(silver: DataFrame) -> DataFrame:
    """Silver trips with typed times and ``ts_hour``; unreadable times are NULL."""
    times = {c: wall_clock(c) for c in ("started_at", "ended_at")}
    return hour_bucket(silver.withColumns(times))


def typed_weather(silver: DataFrame) -> DataFrame:
    """Silver weather with typed numbers and ``ts_hour``."""
    numbers = {c: to_number(c) for c in schemas.SILVER_NUMBERS if c in silver.columns}
    hour = F.concat_ws(" ", F.col("date").cast("string"), F.col("time"))
    return hour_bucket(silver.withColumns(numbers).withColumn("_at", hour), "_at").drop("_at")


def typed_live_weather(live: DataFrame, zone: str = "UTC") -> DataFrame:
    """The live feed with typed numbers and the hour of its report.

    The nested ``weather`` column is not used; ``rain.1h`` is renamed to ``rain_1h``.
    """
    flat = live.drop("weather").withColumnsRenamed({"rain.1h": "rain_1h"})
    numbers = {
        c: to_number(c)
        for c in (*schemas.SILVER_NUMBERS, *schemas.LIVE_WEATHER)
        if c in flat.columns and c != "time"
    }
    hour = {"ts_hour": hour_start(epoch_wall_clock("dt", zone))}
    return flat.withColumns(numbers).withColumns(hour).withColumns(
        {"date": F.to_date("ts_hour"), "time": hour_label("ts_hour")}
    )


def prepare(
    spark: SparkSession,
    trips_csv: str,
    weather_csv: str,
    root: str,
    start_date: dt.date | None = None,
    end_date: dt.date | None = None,
    start_stations: Sequence[str] | None = None,
) -> None:
    """Ingest, clean and silver tables."""
    raw = ingest_trips(spark, trips_csv, root)
    trips = write_table(
        clean_trips(raw, start_date, end_date, start_stations), root, "bronze", "trips"
    )
    write_table(silver_trips(trips), root, "silver", "trips")
    weather = write_table(
        clean_weather(ingest_weather(spark, weather_csv, root)), root, "bronze", "weather"
    )
    write_table(silver_weather(weather), root, "silver", "weather")


def create_gold(spark: SparkSession, root: str, run: str = "0") -> None:
    """Empty forecast, registry and model tables as the first run."""
    for name, schema in schemas.MODELS.items():
        write_table(empty_table(spark, schema), root, "gold", name, run)
    write_table(empty_table(spark, schemas.GOLD), root, "gold", "model_information", run)
    write_table(empty_table(spark, schemas.REGISTRY), root, "gold", "model_registry", run)


def hourly_tables(
    spark: SparkSession,
    root: str,
    status: DataFrame,
    live_weather: DataFrame,
    run: str,
    zone: str = "UTC",
) -> None:
    """Stores what modelling needs of the raw tables: flow, weather and levels per hour.

    Trips and status are read once here. Everything later works on these tables,
    whose size depends on stations and hours only. Weather is reduced to one row
    per hour, so no flow is counted twice.
    """
    trips = typed_trips(read_table(spark, root, "silver", "trips"))
    write_table(flow.net_flow(trips), root, "silver", "flow_hourly", run)
    past = typed_weather(read_table(spark, root, "silver", "weather"))
    write_table(once_per_hour(past), root, "silver", "weather_hourly", run)
    live = once_per_hour(typed_live_weather(live_weather, zone))
    write_table(live, root, "silver", "live_weather_hourly", run)
    levels = flow.status_hourly(status, zone=zone)
    write_table(levels, root, "silver", "status_hourly", run)


def once_per_hour(weather: DataFrame) -> DataFrame:
    """Temperature, wind and humidity, one row per hour: the most complete report, of
    those the latest (``dt``, where there is one), of those the coldest."""
    measures = ["temp", "wind_speed", "humidity"]
    missing = sum(F.col(c).isNull().cast("int") for c in measures)
    age = -F.col("dt").try_cast("bigint") if "dt" in weather.columns else F.lit(0)
    rows = weather.select("ts_hour", *measures, missing.alias("_missing"), age.alias("_age"))
    order = ["_missing", "_age", *measures]
    return quality.keep_first(rows, ["ts_hour"], order).drop("_missing", "_age")


def frames(
    flows: DataFrame,
    weather: DataFrame,
    live_weather: DataFrame,
    levels: DataFrame,
    split: dt.date,
    hours_to_forecast: int = 4,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, holdout rows and cut-offs of every station, from the hourly tables.

    Until ``split`` flow is counted from trips beside past weather, from then on it
    is the change of the status levels beside the live feed.
    """
    history = forecast.panel(flows.join(weather, "ts_hour"), "net_flow")
    cutoffs = flow.holdout_cutoff(levels, hours_to_forecast)
    start = dt.datetime.combine(split, dt.time())
    recent = flow.weather_with_status(live_weather, levels, start)
    train = forecast.training_frame(history, recent, cutoffs, split)
    return train, forecast.holdout_frame(recent, cutoffs), cutoffs


def tune(
    train: DataFrame,
    grid: Mapping[str, Sequence] = forecast.PARAM_GRID,
    initial: int = forecast.INITIAL_DAYS,
    period: int = forecast.PERIOD_DAYS,
    horizon: int = forecast.HORIZON_DAYS,
) -> DataFrame:
    """Best parameter set of each station with its backtest errors; NULLs and a status where it has none."""
    folds = forecast.cv_folds(train, initial, period, horizon)
    models = normal.fit_by_sums(train, folds, grid)
    tests = forecast.cv_test_rows(train, folds, horizon)
    tested = forecast.score(tests, models, ["station_id", "fold"], models=["param_id"])
    errors = forecast.forecast_metrics(tested, ["station_id", "param_id"])
    return forecast.with_status(forecast.select_best(errors), train)


def predict(
    train: DataFrame, holdout: DataFrame, coefficients: DataFrame
) -> DataFrame:
    """Holdout rows with the forecast of the station's stored model, and the residual.

    A station without a model has the shrunken mean of its hour; ``source`` says so.
    """
    ahead = forecast.score(holdout, coefficients, models=["param_id"])
    return forecast.attach_or_fall_back(holdout, ahead, forecast.shrunken_means(train))


def fit_best(
    train: DataFrame,
    cutoffs: DataFrame,
    best: DataFrame,
    grid: Mapping[str, Sequence] = forecast.PARAM_GRID,
) -> DataFrame:
    """Coefficients of each station's best set, fitted on all rows up to its cut-off."""
    fitted = normal.fit_by_sums(train, cutoffs.withColumn("fold", F.lit(0)), grid)
    chosen = best.filter("param_id IS NOT NULL").select("station_id", "param_id")
    return fitted.join(chosen, ["station_id", "param_id"]).drop("fold")


def forecast_ahead(
    spark: SparkSession, root: str, run: str, hours: DataFrame, stage: str = "Staging"
) -> DataFrame:
    """Forecast of any hours (station_id, ds, regressors) from the stored models of a stage; nothing is fitted."""
    read = lambda name: read_table(spark, root, "gold", name, run)
    live = read("model_registry").filter(F.col("stage") == stage).select("station_id", "version")
    stored = read("model_coefficients").join(live, ["station_id", "version"])
    return forecast.score(hours, stored, models=["version"])


def train_and_publish(
    spark: SparkSession,
    root: str,
    status: DataFrame,
    live_weather: DataFrame,
    split: dt.date,
    previous_run: str,
    run: str,
    hours_to_forecast: int = 4,
    promote_model: bool = False,
    grid: Mapping[str, Sequence] = forecast.PARAM_GRID,
    initial: int = forecast.INITIAL_DAYS,
    period: int = forecast.PERIOD_DAYS,
    horizon: int = forecast.HORIZON_DAYS,
    zone: str = "UTC",
) -> DataFrame:
    """From silver tables and status to the next run of registry and forecasts.

    The frames and the tuning result are stored, which keeps the later plans short
    and lets a lost executor recompute from them.
    """
    if run == previous_run:
        raise ValueError("a run cannot overwrite the run it reads")
    hourly_tables(spark, root, status, live_weather, run, zone)
    names = ("flow_hourly", "weather_hourly", "live_weather_hourly", "status_hourly")
    hourly = [read_table(spark, root, "silver", name, run) for name in names]
    train, holdout, cutoffs = frames(*hourly, split, hours_to_forecast)
    train = write_table(train, root, "gold", "training_frame", run)
    holdout = write_table(holdout, root, "gold", "holdout_frame", run)
    cutoffs = write_table(cutoffs, root, "gold", "cutoffs", run)
    best = write_table(tune(train, grid, initial, period, horizon), root, "gold", "tuning", run)
    # Read twice: for the forecast and, with their version, as the stored models.
    fitted = store(fit_best(train, cutoffs, best, grid), "fitted")
    results = write_table(predict(train, holdout, fitted), root, "gold", "results", run)
    old = read_table(spark, root, "gold", "model_registry", previous_run, schemas.REGISTRY)
    candidates = best.filter("param_id IS NOT NULL").select("station_id", "mae", "param_id")
    stages = registry.staged(old, candidates, promote_model)
    for (name, schema), rows in zip(
        schemas.MODELS.items(), registry.stored_models(stages, fitted, grid)
    ):
        earlier = read_table(spark, root, "gold", name, previous_run, schema)
        write_table(earlier.unionByName(rows), root, "gold", name, run)
    write_table(
        registry.promote(old, candidates, promote_model), root, "gold", "model_registry", run
    )
    gold = read_table(spark, root, "gold", "model_information", previous_run, schemas.GOLD)
    return write_table(
        registry.publish_gold(gold, results, stages), root, "gold", "model_information", run
    )


def station_view(
    gold: DataFrame,
    status: DataFrame,
    live_weather: DataFrame,
    info: DataFrame,
    as_of: dt.datetime,
    zone: str = "UTC",
) -> dict[str, DataFrame]:
    """What the station screen shows: weather, latest status, forecast levels, capacity state."""
    weather = typed_live_weather(live_weather, zone)
    shown = [c for c in schemas.LIVE_WEATHER if c in weather.columns]
    return {
        "weather": serving.current_weather(weather, as_of, shown),
        "status": serving.latest_status(status, as_of, zone=zone),
        "capacity": serving.station_capacity(info),
        "forecast": serving.capacity_breach(serving.forecast_level(gold), info),
    }
