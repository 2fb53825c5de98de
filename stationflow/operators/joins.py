"""Joins of a large table with a side that is usually small.

The small side is broadcast only after its size is checked. Beyond the limit the
join is salted, so a hot key on the large side is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hourly rows of some 22 years; tens of megabytes even with every weather column.
BROADCAST_ROWS = 200_000
SALTS = 64


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    salt_on: Sequence[str] = (),
) -> DataFrame:
    """Left or inner join; every matching pair is kept on either way.

    ``null_safe`` lets NULL keys meet NULL keys. ``salt_on`` names columns that tell
    most rows of a hot key apart; by default all of them are hashed.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    on = list(on)
    if fits_broadcast(small, max_rows):
        return _join(large, F.broadcast(small), on, how, null_safe)
    # A row hashes to one salt, the same on every run, so a recomputed task agrees
    # with the rest. The other side is present under every salt.
    row = F.xxhash64(*(salt_on or large.columns))
    salted = large.withColumn("_salt", F.pmod(row, F.lit(salts)))
    copies = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    )
    return _join(salted, copies, [*on, "_salt"], how, null_safe).drop("_salt")


def _join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool
) -> DataFrame:
    if not null_safe:
        return left.join(right, on, how)
    keyed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    )
    return left.join(keyed, match, how).drop(*[f"_r_{c}" for c in on])
