"""The last report at or before the time of each row, without one task for a whole station."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_SECONDS = 86_400


def epoch_seconds(wall_clock: Column, zone: str = "UTC") -> Column:
    """Epoch seconds of a wall-clock time in ``zone``; not dependent on the session zone."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall_clock.cast("timestamp_ntz"))
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), utc)


def status_as_of(
    rows: DataFrame,
    status: DataFrame,
    levels: Mapping[str, str],
    k: Sequence[str] = ("station_id",),
    ts: str = "ds",
    zone: str = "UTC",
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Every row with ``new: column`` of ``levels`` from the last report not after its ``ts``, and ``reported_s``.

    Rows and reports are united and cut into buckets of time. Inside a bucket the last
    report is carried on by a window; the last report of earlier buckets comes
    from one aggregated row per key and bucket, whose number the calendar bounds. So a
    busy station spreads over its days.

    Of reports of one second the one of the highest levels counts, in the order of ``levels``;
    a missing one is lowest. Rows before the first report, with a NULL key or time, get
    NULLs; reports without key or time are passed over. Repeated rows are all kept.
    """
    k, sources = list(k), list(levels.values())
    report = F.struct(
        F.col("last_reported").try_cast("bigint").alias("t"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(sources)]
    )
    reports = status.select(*k, report.alias("_r"))
    present = F.col("_r.t").isNotNull()
    for c in k:
        present = present & F.col(c).isNotNull()
    reports = reports.filter(present).select(*k, F.col("_r.t").alias("_t"), "_r", F.lit(False).alias("_asks"))
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    asks = rows.select(*k, epoch_seconds(F.col(ts), zone).alias("_t"), own, F.lit(True).alias("_asks"))
    askable = F.col("_t").isNotNull()
    for c in k:
        askable = askable & F.col(c).isNotNull()
    united = asks.filter(askable).unionByName(reports, allowMissingColumns=True)
    united = united.withColumn("_b", F.floor(F.col("_t") / bucket_seconds))
    # Structs compare by time, then by level; NULL is lowest.
    lasts = reports.withColumn("_b", F.floor(F.col("_t") / bucket_seconds)).groupBy(*k, "_b").agg(F.max("_r").alias("_last"))
    asked = asks.filter(askable).select(*k, F.floor(F.col("_t") / bucket_seconds).alias("_b")).distinct()
    earlier = W.partitionBy(*k).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    days = asked.join(lasts, [*k, "_b"], "full").withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
    days = days.select(*k, "_b", "_before")
    inside = W.partitionBy(*k, "_b").orderBy("_t", "_asks", "_r").rowsBetween(W.unboundedPreceding, 0)
    seen = united.withColumn("_here", F.last("_r", ignorenulls=True).over(inside)).filter("_asks")
    known = seen.join(days, [*k, "_b"], "left").select("_row", F.coalesce("_here", "_before").alias("_r"))
    rest = asks.filter(F.coalesce(~askable, F.lit(True))).select("_row").withColumn("_r", F.lit(None).cast(known.schema["_r"].dataType))
    new = [F.col(f"_r.v{i}").alias(n) for i, n in enumerate(levels)]
    return known.unionByName(rest).select("_row.*", *new, F.col("_r.t").alias("reported_s"))
