"""From raw documents to a training mix: five stages, each stored before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import decontam, jaccard, mixing, pii, toxicity
from stationflow.llm.queries import held_out, table
from stationflow.llm.shared import only_keys, store
from stationflow.operators.joins import join_small

TOXIC = 0.7
# No SQL: it would have to fit the toxicity model.
ORACLE_SQL = None


MIX = ("size", "source_size", "target", "copies", "taken")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _with_keys(docs: DataFrame) -> DataFrame:
    """Each document as one column ``d`` and the row keys that the operators return, so that no name clashes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
        F.xxhash64(F.col("doc_id").cast("string"), F.lit(1)).alias("k1"),
        F.xxhash64(text).alias("k2"),
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labelled ones, without the held-out third, does not reject.

    NULL, empty and very long texts are scored as ``toxicity.score`` says; repeated rows are
    decided alike. Columns stay as they are, one named like the score too. No rows give no rows.
    """
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(3))
    score = _free(docs, "score")
    scored = toxicity.score(docs, weights, out=score).filter(F.col(score) < TOXIC)
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest id.

    Of rows equal in id and text one stays; NULL and empty texts all stay, repeated ones
    too. A NULL id stays only if its class has no other. Texts of any length are compared
    whole. Columns stay as they are. No rows give no rows.
    """
    key = ["k1", "k2"]
    found = jaccard.classes(docs, n=5, percent=80).filter("size > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", *key)).alias("r")
    kept = found.groupBy("root").agg(first).select("r.k1", "r.k2", F.lit(True).alias("stays"))
    rows = found.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).join(kept, key, "left")
    # Only documents that go, or are there more than once, need to be looked at.
    judged = store(rows.filter("n > 1 OR stays IS NULL").select(*key, "stays"), "judged")
    left = only_keys(_with_keys(docs), judged.filter("stays IS NULL"), key, "left_anti")
    repeated = judged.filter("stays")
    once = only_keys(left, repeated, key).dropDuplicates(key)
    return only_keys(left, repeated, key, "left_anti").unionByName(once).select("d.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of a benchmark item.

    NULL and empty texts stay; repeated rows are decided alike; texts of any length are
    searched whole. Columns stay as they are. No rows give no rows.
    """
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"))
    hit = store(found.filter("n_hit > 0").select("k1", "k2").distinct(), "contaminated")
    return only_keys(_with_keys(docs), hit, ["k1", "k2"], "left_anti").select("d.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, ``n_chars`` counted again.

    A NULL text stays NULL. Other columns stay as they are, one named like the spans too.
    """
    masked = pii.scan(docs, mask=True, out=_free(docs, "pii"))
    masked = masked.withColumn("n_chars", F.length("text").cast("long"))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents with the number of copies that it takes, and the words that they give.

    Whether a document is taken follows from its hash and its source's threshold, so only
    thresholds are joined and no text moves. Columns named like the ``MIX`` ones are
    replaced by these. NULLs, empty texts and repeated rows count as in ``mixing.mix``.
    """
    _, plan = mixing.source_plan(docs)
    plan = plan.withColumnRenamed("source", "s")
    kept = [c for c in docs.columns if c.lower() not in MIX]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("d"),
        F.col("source").cast("string").alias("s"),
        *[c.alias(n) for n, c in mixing.measures(F.col("doc_id"), F.col("text")).items()],
    )
    joined = join_small(rows, plan, ["s"], "inner", null_safe=True, salt_on=["h"])
    joined = joined.withColumn("copies", mixing.copies()).filter("copies > 0")
    return joined.withColumn("taken", F.col("size") * F.col("copies")).select("d.*", *MIX)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
