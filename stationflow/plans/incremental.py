"""Silver trips and hourly flow kept up to date by month.

A run rebuilds the months whose raw rows or fillers changed, into a folder of its own, and
then publishes one small file that names the run of every month. Readers follow the newest such
file, so they see a whole run or the one before; an unfinished run is never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import flow, quality
from ..sources.schemas import SILVER_TRIPS, TRIPS
from ..sources.tables import read_table, store, table_path
from .stages import CATEGORICAL_TRIPS, typed_trips, with_hour

MONTH = "start_month"
_RAW = StructType([*TRIPS.fields, StructField(MONTH, StringType())])
_SCHEMAS = {
    "trips_by_month": ", ".join(f"{c} {'date' if c == 'date' else 'string'}" for c in SILVER_TRIPS),
    "flow_by_month": "station_id string, ts_hour timestamp_ntz, departures bigint, arrivals bigint",
}


def month_profile(raw: DataFrame, fill: Sequence[str]) -> DataFrame:
    """Rows of each month (``field`` NULL) and how often each value of the ``fill`` columns occurs in it.

    One scan and one shuffle of counts. NULL values count too: they are what a new filler changes.
    """
    empty = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"))
    each = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fill]
    cells = raw.select(MONTH, F.inline(F.array(empty, *each)))
    return cells.groupBy(MONTH, "field", "value").agg(F.count(F.lit(1)).alias("n"))


def fillers(profile: DataFrame) -> DataFrame:
    """Most frequent known value of each column over all months; ties go to the lowest."""
    totals = profile.filter("field IS NOT NULL AND value IS NOT NULL").groupBy("field", "value")
    totals = totals.agg(F.sum("n").alias("n"))
    return totals.groupBy("field").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("filler"))


def months(profile: DataFrame, chosen: DataFrame) -> DataFrame:
    """What a month's result depends on: its number of raw rows, and the fillers of those columns it has NULLs in."""
    gaps = profile.filter("field IS NOT NULL AND value IS NULL").join(chosen, "field", "left")
    gap = F.struct("field", "filler")
    filled = gaps.groupBy(F.col(MONTH).alias("_month")).agg(F.to_json(F.array_sort(F.collect_list(gap))).alias("fills"))
    rows = profile.filter("field IS NULL").select(MONTH, F.col("n").alias("n_raw"))
    return rows.join(filled, F.col(MONTH).eqNullSafe(F.col("_month")), "left").drop("_month")


def published(spark: SparkSession, root: str) -> list:
    """Month, run that built it, raw rows and fillers of the newest published run: one row per calendar month."""
    schema = f"{MONTH} string, built_by bigint, n_raw bigint, fills string, run bigint"
    try:
        every = spark.read.schema(schema).parquet(table_path(root, "silver", "published"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return every.join(every.agg(F.max("run").alias("run")), "run").collect()


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published rows of a monthly table with their ``start_month``; only the folders named are read."""
    built: dict[int, list] = {}
    for r in published(spark, root):
        built.setdefault(r.built_by, []).append(r[MONTH])
    schema = f"{_SCHEMAS[name]}, run bigint, {MONTH} string"
    if not built:
        return spark.createDataFrame([], schema).drop("run")
    wanted = F.lit(False)
    for run, of_run in built.items():
        wanted = wanted | ((F.col("run") == run) & _in(MONTH, of_run))
    return spark.read.schema(schema).parquet(table_path(root, "silver", name)).filter(wanted).drop("run")


def current_flow(spark: SparkSession, root: str, zero_fill: bool = True) -> DataFrame:
    """Net flow of every station and hour, summed over the months whose trips have a leg in the hour."""
    measures = [F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals")]
    hourly = current(spark, root, "flow_by_month").groupBy("station_id", "ts_hour").agg(*measures)
    hourly = hourly.withColumn("net_flow", F.col("arrivals") - F.col("departures"))
    return flow.fill_hours(hourly, ["departures", "arrivals", "net_flow"]) if zero_fill else hourly


def rebuild(spark: SparkSession, root: str, fill: Sequence[str] = CATEGORICAL_TRIPS) -> list[str | None]:
    """Brings the monthly tables up to ``bronze/trips_raw``; returns the months rebuilt.

    Raw rows are only appended, so a month with as many as before has no new ones. A month also
    counts as touched if a column it has NULLs in got another most frequent value. The
    result equals a rebuild of everything: equal trips start in one month, so copies are
    found within it, and hours are kept as counts of each month's trips, which add up. A run that was
    lost before its end is done again. ``fill`` must not hold ``started_at``; one writer at a time.
    """
    raw = read_table(spark, root, "bronze", "trips_raw", schema=_RAW)
    profile = store(month_profile(raw, fill), "profile")
    chosen = store(fillers(profile), "fillers")
    before = published(spark, root)
    known = {r[MONTH]: r for r in before}
    now = months(profile, chosen).collect()

    def changed(r) -> bool:
        old = known.get(r[MONTH])
        return old is None or (old.n_raw, old.fills) != (r.n_raw, r.fills)

    touched = [r[MONTH] for r in now if changed(r)]
    if not touched:
        return []
    run = max((r.run for r in before), default=0) + 1
    modes = chosen.agg(*[F.max(F.when(F.col("field") == c, F.col("filler"))).alias(c) for c in fill])
    rows = quality.impute_mode(raw.filter(_in(MONTH, touched)), fill, modes=modes)
    clean = with_hour(quality.drop_copies(rows)).select(*SILVER_TRIPS, MONTH)
    _write(clean, root, "trips_by_month", run)
    written = spark.read.schema(f"{_SCHEMAS['trips_by_month']}, {MONTH} string").parquet(
        f"{table_path(root, 'silver', 'trips_by_month')}/run={run}"
    )
    legs = flow.station_legs(typed_trips(written), keep=[MONTH])
    hourly = legs.groupBy(MONTH, "station_id", "ts_hour").agg(
        F.count_if(F.col("change") < 0).alias("departures"), F.count_if(F.col("change") > 0).alias("arrivals")
    )
    _write(hourly, root, "flow_by_month", run)
    pointer = [(r[MONTH], run if r[MONTH] in touched else known[r[MONTH]].built_by, r.n_raw, r.fills) for r in now]
    pointer = spark.createDataFrame(pointer, f"{MONTH} string, built_by bigint, n_raw bigint, fills string")
    # One file: it is there as a whole or not at all.
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{table_path(root, 'silver', 'published')}/run={run}")
    return touched


def _in(column: str, values: Sequence[str | None]) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def _write(rows: DataFrame, root: str, name: str, run: int) -> None:
    path = f"{table_path(root, 'silver', name)}/run={run}"
    rows.write.mode("overwrite").partitionBy(MONTH).parquet(path)
