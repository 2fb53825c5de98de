"""Mixing sources to target weights by nested hash thresholds, without sorting documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.llm.shared import SPACED, numbered, store
from stationflow.operators.joins import join_small

HASH_DIGITS = 12  # hex digits of a row's hash
LEVEL_BITS = 12  # bits that one histogram resolves


def row_hash(row_id: Column, text: Column) -> Column:
    """The hash that orders rows, of id and text; a NULL counts as empty."""
    empty = F.lit("")
    label = F.concat(F.coalesce(row_id.cast("string"), empty), F.lit(":"), F.coalesce(text, empty))
    return F.conv(F.substring(F.md5(label), 1, HASH_DIGITS), 16, 10).cast("long")


def measures(row_id: Column, text: Column) -> dict[str, Column]:
    """``size`` in words and the hash ``h`` of a row."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SPACED)).cast("long")
    return {"size": words, "h": row_hash(row_id, text)}


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Thin rows: ``doc_id``, ``source``, ``size`` in words and the hash ``h`` that orders them.

    The hash covers id and text, so reruns agree and rows are alike only if both are.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        *[c.alias(n) for n, c in measures(F.col(id_col), F.col(text_col)).items()],
    )


def source_targets(
    thin: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """One row per source: ``sid``, ``source_size`` and ``target``.

    Weights repeat over the sources by code point, NULL last. A target stops at
    ``most`` times the size; what is above is shared again by weight, until none
    is above. Each round reads one row of sums.
    """
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "sid")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = store(
        ranked.withColumn(
            "weight", F.element_at(cycle, (F.col("sid") % len(weights) + 1).cast("int"))
        ).withColumn("cap", most * F.col("source_size")),
        "sources",
    )
    level = 0.0
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        total, capped, open_weight = ranked.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if not open_weight:
            break
        following = (share * total - capped) / open_weight
        if following <= level:
            break
        level = following
    target = F.when(full, F.col("cap")).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "sid", "source_size", target.alias("target"))


def source_plan(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The thin rows of ``sized`` and, per source, ``source, source_size, target, whole, stop``.

    ``whole`` copies of every document of the source are taken, and one more of
    those whose hash is below ``stop``; NULL takes none more.
    """
    thin = store(sized(docs, id_col, source_col, text_col), "sized")
    targets = store(source_targets(thin, weights, share, most), "targets")
    rows = (
        thin.alias("r")
        .join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
        .select("doc_id", "r.source", "size", "h", "sid", "source_size", "target")
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    whole = F.coalesce(whole, F.lit(0)).cast("long")
    edge = targets.select(
        "sid",
        whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(0).cast("long").alias("below"),
        F.lit(0).cast("long").alias("inside"),
    )
    bits = HASH_DIGITS * 4
    for shift in range(bits - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = rows.withColumn("prefix", F.shiftright("h", shift + LEVEL_BITS)).join(
            edge.filter("budget > 0"), ["sid", "prefix"]
        )
        buckets = inside.groupBy(
            "sid", "whole", "budget", "below", F.shiftright("h", shift).alias("bucket")
        ).agg(F.sum("size").alias("words"))
        upto = F.col("below") + F.sum("words").over(
            Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        )
        reached = buckets.withColumn("upto", upto).filter("upto >= budget")
        first = F.min(F.struct("bucket", "upto", "words", "whole", "budget"))
        edge = store(
            reached.groupBy("sid")
            .agg(first.alias("e"))
            .select(
                "sid",
                "e.whole",
                "e.budget",
                F.col("e.bucket").alias("prefix"),
                (F.col("e.upto") - F.col("e.words")).alias("below"),
                F.col("e.words").alias("inside"),
            ),
            "edge",
        )
    nearer = (F.col("below") + F.col("inside") - F.col("budget")) < (F.col("budget") - F.col("below"))
    stop = edge.select("sid", (F.col("prefix") + nearer.cast("long")).alias("stop"))
    plan = targets.join(stop, "sid", "left")
    return thin, store(plan.select("source", "source_size", "target", whole.alias("whole"), "stop"), "plan")


def copies() -> Column:
    """How many copies the mix takes of a row with ``h`` and its source's ``whole`` and ``stop``."""
    return F.col("whole") + F.coalesce((F.col("h") < F.col("stop")).cast("long"), F.lit(0))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """How many copies of each document the mix takes.

    Returns ``doc_id, source, h, size, source_size, target, copies, taken``, one row per input row.
    A whole number of copies of the source comes first; what is left of the
    target goes to the documents of the lowest hash. The threshold is found by
    histograms: words by source and hash bucket, then again only inside the
    bucket where the budget ends, until that bucket is a single hash; it is taken
    if that comes nearer to the target.

    A NULL text has no words; a NULL source is a source, the last one; NULL ids
    are allowed. Rows equal in id and text are taken alike. No rows give no rows.
    """
    thin, plan = source_plan(docs, weights, share, most, id_col, source_col, text_col)
    return (
        join_small(thin, plan, ["source"], "inner", null_safe=True)
        .withColumn("copies", copies())
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select("doc_id", "source", "h", "size", "source_size", "target", "copies", "taken")
    )
