"""Cleaning and profiling, each as one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import store
from .joins import BROADCAST_ROWS, fits_broadcast, join_small


def column_modes(
    df: DataFrame, cols: Sequence[str], null_competes: bool = False
) -> DataFrame:
    """One row with the most frequent value of each column; ties go to the lowest.

    Every column is counted in the same scan through grouping sets. Values are
    counted before anything is compared, so no task holds a column's values.
    """
    cols = list(cols)
    counts = df.select(*cols).groupingSets(
        [[F.col(c)] for c in cols], *[F.col(c) for c in cols]
    ).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))

    def mode_of(i: int, name: str) -> Column:
        # grouping_id has one bit per column, 0 for the one grouped by.
        own = F.col("_set") == F.lit((2 ** len(cols) - 1) ^ (1 << (len(cols) - 1 - i)))
        if not null_competes:
            own = own & F.col(name).isNotNull()
        rank = F.when(own, F.struct(-F.col("_n"), F.col(name)))
        return F.min_by(F.col(name), rank).alias(name)

    return counts.agg(*[mode_of(i, c) for i, c in enumerate(cols)])


def impute_mode(
    df: DataFrame,
    cols: Sequence[str] | str,
    null_competes: bool = False,
    modes: DataFrame | None = None,
) -> DataFrame:
    """Replaces NULL by the column's most frequent value.

    ``cols="*"`` fills every column, identifiers included. With ``null_competes``
    a column that is mostly NULL keeps its NULLs. ``modes`` takes a stored
    :func:`column_modes`, for a result that several queries read.
    """
    cols = df.columns if cols == "*" else list(cols)
    modes = column_modes(df, cols, null_competes) if modes is None else modes
    row = modes.select(F.struct(*cols).alias("modes")).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), row.getField(c)) for c in cols})


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_null) for every column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column", "n_null")


def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Groups of equal rows that occur more than once, with their count."""
    return df.groupBy(*(cols or df.columns)).count().filter("count > 1")


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_copies(df: DataFrame, max_repeated: int = BROADCAST_ROWS) -> DataFrame:
    """:func:`drop_duplicates` for tables whose rows are mostly unique.

    Only a hash of each row is shuffled to find those that may occur twice. Rows
    whose hash occurs once pass where they are; the others are compared in full.
    With more than ``max_repeated`` such hashes the plain way is the cheaper one.
    """
    # Adding 0 makes -0.0 hash as the 0.0 it equals.
    whole = [
        F.col(c) + F.lit(0.0).cast(kind) if kind in ("float", "double") else F.col(c)
        for c, kind in df.dtypes
    ]
    row = F.xxhash64(*whole).alias("_row")
    counts = df.select(row).groupBy("_row").count()
    repeated = store(counts.filter("count > 1").select("_row"), "repeated")
    if not fits_broadcast(repeated, max_repeated):
        return drop_duplicates(df)
    rows, repeated = df.select("*", row), F.broadcast(repeated)
    once = rows.join(repeated, "_row", "left_anti").drop("_row")
    several = rows.join(repeated, "_row", "left_semi").drop("_row")
    return once.unionByName(drop_duplicates(several))


def mark_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``is_repeat``: false on the first row of each key in ``order``, else true.

    ``order`` must tell the rows of a key apart. The first rows are found by an
    aggregate, stored, and joined back, so no task sorts a hot key.
    """
    keys, order = list(keys), list(order)
    first = store(df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first")), "first")
    marked = join_small(df, first, keys, "left", null_safe=True)
    return marked.withColumn("is_repeat", F.struct(*order) > F.col("_first")).drop("_first")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in ``order``.

    An aggregate rather than a window: each task reduces its rows to one per key
    before the shuffle, so a hot key costs no more than any other.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )
