"""Model stages as a table, and the published forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .forecast import combinations

# Fixed value: the error a first model has to beat.
NO_MODEL_ERROR = 1234.0


def stage_for(mae: Column, staging_mae: Column, force: bool) -> Column:
    """``Production`` if forced, ``Staging`` if better than the staged model, else ``Archived``."""
    if force:
        return F.lit("Production")
    better = mae < F.coalesce(staging_mae, F.lit(NO_MODEL_ERROR))
    return F.when(better, F.lit("Staging")).otherwise(F.lit("Archived"))


def staged(
    registry: DataFrame,
    candidates: DataFrame,
    force: bool = False,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """Candidates with the stage they reach and their new version number."""
    standing = registry.groupBy(*k).agg(
        F.max("version").alias("_last"),
        F.max_by("mae", F.when(F.col("stage") == "Staging", F.col("version"))).alias("_staging_mae"),
    )
    return (
        candidates.join(standing, list(k), "left")
        .withColumn("stage", stage_for(F.col("mae"), F.col("_staging_mae"), force))
        .withColumn("version", (F.coalesce("_last", F.lit(0)) + 1).cast("int"))
        .drop("_last", "_staging_mae")
    )


def promote(
    registry: DataFrame,
    candidates: DataFrame,
    force: bool = False,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """The registry after each candidate (keys, mae, param_id) has been placed.

    A version that held the stage the candidate takes becomes ``Archived``.
    """
    new = staged(registry, candidates, force, k)
    taken = new.select(*k, F.col("stage").alias("_taken"))
    kept = (
        registry.join(taken, list(k), "left")
        .withColumn(
            "stage",
            F.when(F.col("stage") == F.col("_taken"), F.lit("Archived")).otherwise(F.col("stage")),
        )
        .drop("_taken")
    )
    return kept.unionByName(new.select(*registry.columns))


def publish_gold(
    existing: DataFrame,
    results: DataFrame,
    stages: DataFrame,
    k: Sequence[str] = ("station_id",),
) -> DataFrame:
    """The published table after the results of a promotion.

    ``results`` has the forecast with its residual, ``stages`` the stage and mae of
    each key's candidate. New rows replace those of the same key and stage; rows of
    the other stage stay; an archived candidate changes nothing.
    """
    k = list(k)
    placed = stages.filter(F.col("stage") != "Archived").select(
        *k, F.col("stage").alias("model_type"), F.col("mae").alias("error_mae")
    )
    rows = results.join(placed, k).withColumns(
        {"model_res": F.col("residual"), "yhat": F.round("yhat")}
    )
    columns = existing.columns
    replaced = rows.select(*k, "model_type").distinct()
    return existing.join(replaced, [*k, "model_type"], "left_anti").select(
        *columns
    ).unionByName(rows.select(*columns))


def stored_models(
    stages: DataFrame,
    coefficients: DataFrame,
    grid: Mapping[str, Sequence],
    k: Sequence[str] = ("station_id",),
) -> tuple[DataFrame, DataFrame]:
    """Coefficients (keys, version, pos, term, value) and parameters (keys, version, name, value).

    ``stages`` has the version of each key's candidate, ``coefficients`` its fitted terms.
    Parameters are text, as a grid's values differ in kind.
    """
    k = list(k)
    versions = stages.select(*k, "version", "param_id")
    terms = coefficients.join(versions, [*k, "param_id"]).select(*k, "version", "pos", "term", "value")
    sets = F.array(
        *[
            F.array(*[F.struct(F.lit(n).alias("name"), F.lit(str(v)).alias("value")) for n, v in s.items()])
            for s in combinations(grid)
        ]
    )
    chosen = F.inline(F.get(sets, F.col("param_id") - 1))
    return terms, versions.select(*k, "version", chosen)
