"""What several text operators need: row keys, stored tables, row numbers, joined spans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.operators.joins import fits_broadcast
from stationflow.sources.tables import store

# Words between ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20

__all__ = ["SPACED", "UPPER", "bound_batches", "fold", "keyed", "numbered", "only_keys", "span_list", "store"]


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, or one row, unless the session has its own limit.

    Spark's default of 64 MB is held several times over for each task: by the JVM
    and by Python, as input and as output. Both keep for later what they once took,
    so the largest batch counts even when it is gone.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def fold(word: Column) -> Column:
    """A-Z lower-cased, other letters as they are.

    Most words are their own ``lower``, which is a byte loop; only the rest pay
    for a translation by code point.
    """
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, UPPER.lower()))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and the key ``(k1, k2)`` that thin tables carry instead of the text.

    Rows with equal id and text share a key, and so every decision that depends
    on the text alone. A NULL text is empty; a NULL id is its own value.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit(1)).alias("k1"),
        F.xxhash64(text).alias("k2"),
    )


def only_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose ``on`` is among the keys, or with ``left_anti`` is not; ``keys`` is a stored table.

    A table of few keys is broadcast, so that no text moves; beyond the limit of
    ``fits_broadcast`` both sides are shuffled. The rows are the same either way.
    """
    keys = keys.select(*on)
    return rows.join(F.broadcast(keys) if fits_broadcast(keys) else keys, list(on), how)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Adds the row number from 0 in the given order, without one task for all rows.

    Rows are sorted in ranges; only the row count of each range is summed up
    in a single task.
    """
    rows = store(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_p", F.shiftright("_m", 33))
    ranges = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_s"))
    number = (F.col("_s") + F.col("_m").bitwiseAND((1 << 33) - 1)).cast("long")
    return rows.join(starts, "_p").withColumn(name, number).drop("_m", "_p", "_s")


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, of an array of (start, kind, end) in that order."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))
