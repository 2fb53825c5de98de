"""How values are distributed: exact quantiles by refined histograms, mergeable cells, kernel density."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import store
from .joins import join_small

BUCKETS = 1024
_INF = float("inf")


def exact_quantiles(
    df: DataFrame, column: str, qs: Sequence[float], k: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """``k, q, n, value``: exact quantiles per key, or over all rows, interpolated between neighbours.

    No task holds a key's values. Each step counts the values of the open interval of a
    rank in ``buckets`` cells and goes on with the cell that has the rank, from its least
    to its greatest value, until these are one. Counts are combined before the shuffle, so a
    key with most of the rows is no large task.

    NULL, NaN and infinite values are left out; a key without others has no row; a
    NULL key is a key. No rows give no rows.
    """
    keys = list(k) or ["_all"]
    v = F.col(column).cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < _INF)
    named = [F.col(c) for c in k] or [F.lit(0).alias("_all")]
    rows = store(df.filter(finite).select(*named, v.alias("_v")), "values")
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
    )
    wanted = F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor(F.lit(q) * (F.col("n") - 1)), F.ceil(F.lit(q) * (F.col("n") - 1))) for q in qs
    ])))
    ranks = sizes.select("*", F.explode(wanted).alias("rank"), F.lit(0).cast("bigint").alias("below"))
    ranks = store(ranks, "ranks")
    width = F.col("hi") - F.col("lo")
    part = F.when(width < _INF, (F.col("_v") - F.col("lo")) / width).otherwise(
        (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    )
    bucket = F.least(F.floor(part * buckets), F.lit(buckets - 1)).alias("bucket")
    state = [*keys, "n", "rank", "below"]
    upto = F.sum("c").over(W.partitionBy(*keys, "rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    while not (still := ranks.filter("lo < hi")).isEmpty():
        inside = join_small(rows, still, keys, "inner", null_safe=True, salt_on=["_v"])
        cells = inside.filter("_v BETWEEN lo AND hi").groupBy(*state, bucket).agg(
            F.count(F.lit(1)).alias("c"), F.min("_v").alias("lo"), F.max("_v").alias("hi")
        )
        reached = cells.withColumn("upto", F.col("below") + upto).filter("upto > rank")
        cell = F.min_by(F.struct("lo", "hi", (F.col("upto") - F.col("c")).alias("below")), "bucket")
        found = reached.groupBy(*keys, "n", "rank").agg(cell.alias("e")).select(*keys, "n", "rank", "e.*")
        ranks = store(ranks.filter("lo = hi").unionByName(found), "ranks")
    # A key has at most two ranks for each quantile.
    known = ranks.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_set(F.struct("rank", "lo"))).alias("m"))
    spread = known.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"))
    place = F.col("q") * (F.col("n") - 1)
    low, high = F.element_at("m", F.floor(place)), F.element_at("m", F.ceil(place))
    return spread.select(*k, "q", "n", (low + (high - low) * (place - F.floor(place))).alias("value"))


def histogram(df: DataFrame, column: str, width: float, k: Sequence[str] = ()) -> DataFrame:
    """``k, cell, n``: rows by cell of ``width``; cell 0 starts at 0.

    Histograms of several runs merge by adding ``n``. Values that are no finite number are left out.
    """
    v = F.col(column).cast("double")
    rows = df.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < _INF))
    return rows.groupBy(*k, F.floor(v / width).alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def density(cells: DataFrame, width: float, k: Sequence[str], points: int = 41) -> DataFrame:
    """``k, point, at, density``: Gaussian kernel density of a ``histogram`` on a grid per key.

    The bandwidth follows from spread and number of rows, 1.06 times deviation by the fifth
    root, and is no less than a cell. The grid reaches three bandwidths beyond the cells. A
    key's cells, not its rows, meet its grid.
    """
    at = F.struct(((F.col("cell") + 0.5) * width).alias("c"), F.col("n").cast("double").alias("n"))
    merged = cells.groupBy(*k, "cell").agg(F.sum("n").alias("n"))
    rows = merged.groupBy(*k).agg(F.array_sort(F.collect_list(at)).alias("b"))

    def total(of):
        return F.aggregate("b", F.lit(0.0), lambda a, x: a + of(x))

    rows = rows.withColumn("_n", total(lambda x: x["n"]))
    rows = rows.withColumn("_mean", total(lambda x: x["n"] * x["c"]) / F.col("_n"))
    spread = total(lambda x: x["n"] * (x["c"] - F.col("_mean")) * (x["c"] - F.col("_mean")))
    rows = rows.withColumn("_sd", F.sqrt(spread / F.col("_n")))
    rows = rows.withColumn("_h", F.greatest(1.06 * F.col("_sd") * F.pow("_n", F.lit(-0.2)), F.lit(float(width))))
    low = F.element_at("b", 1)["c"] - 3 * F.col("_h")
    high = F.element_at("b", -1)["c"] + 3 * F.col("_h")
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    rows = rows.withColumns({"_low": low, "_step": (high - low) / (points - 1)}).select("*", grid)
    rows = rows.withColumn("at", F.col("_low") + F.col("point") * F.col("_step"))
    z = lambda x: (F.col("at") - x["c"]) / F.col("_h")
    kernel = total(lambda x: x["n"] * F.exp(-z(x) * z(x) / 2))
    return rows.select(*k, "point", "at", (kernel / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"))
