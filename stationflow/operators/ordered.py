"""Row numbers and predecessors in a total order, without one task for all rows.

Rows are sorted in ranges and stored. Only one row per range and group goes through
a window that the ranges share; a row keeps its place ``_at`` and its range ``_range``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import store


def sorted_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows stored in the given order, with ``_at`` ascending and the ``_range`` it lies in."""
    rows = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    return store(rows, "ordered").withColumn("_range", F.shiftright("_at", 33))


def positions(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str, total: str
) -> DataFrame:
    """Adds the row's number from 0 within ``by`` and the number of rows of its group.

    The columns of ``by`` hold no NULL. A group of any size spreads over the ranges;
    what is joined back has one row per range and group.
    """
    by = list(by)
    rows = sorted_ranges(df, [*[F.asc(c) for c in by], *order])
    heads = rows.groupBy("_range", *by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    group = W.partitionBy(*by)
    earlier = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    heads = heads.select(
        "_range",
        *by,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(group).alias(total),
    )
    joined = rows.join(heads, ["_range", *by])
    return joined.withColumn(name, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def previous(df: DataFrame, order: Sequence[Column], columns: Mapping[str, str]) -> DataFrame:
    """Adds, for each ``new: column``, the column's value in the row before, over all rows.

    Equals ``lag`` over an unpartitioned window. Each range is windowed by itself and its
    first row takes the last row of the nearest range before.
    """
    rows = sorted_ranges(df, order)
    here = W.partitionBy("_range").orderBy("_at")
    ends = rows.groupBy("_range").agg(F.max_by(F.struct(*columns.values()), "_at").alias("row"))
    # All ends as one array, one element per range, so each finds the one before it.
    ends = ends.agg(F.array_sort(F.collect_list(F.struct("_range", "row"))).alias("e"))
    last = lambda x, i: F.struct(x["_range"].alias("_range"), F.get("e", i - 1)["row"].alias("_carried"))
    carried = ends.select(F.inline(F.transform("e", last)))
    first = F.row_number().over(here) == 1
    inside = rows.withColumns({n: F.lag(c).over(here) for n, c in columns.items()} | {"_head": first})
    return (
        inside.join(carried, "_range")
        .withColumns({n: F.when(F.col("_head"), F.col("_carried").getField(c)).otherwise(F.col(n)) for n, c in columns.items()})
        .drop("_range", "_at", "_head", "_carried")
    )
