"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stationflow.llm import flat
from stationflow.llm.shared import bound_batches, store

BITS = 20  # hashed features; feature 0 is the bias
TRAIN_ROWS = 16_000  # bound of the labelled sample that the model is fitted on
EPOCHS = 4
ALPHA, BETA, L1, L2 = 4.0, 1.0, 12.0, 1.0
TOXIC_WEIGHT = 3.0  # a missed toxic text counts as so many clean ones


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, pairs of neighbours and pairs with a word between, and the text of each."""
    h, first = flat.words(data, offsets, flat.ALNUM)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    found, of = [h], [text]
    for gap in (1, 2):
        same = text[gap:] == text[:-gap]
        pairs = flat.mix(h[:-gap] * flat.U(3) + flat.mix(h[gap:] + flat.U(gap)))
        found.append(pairs[same])
        of.append(text[:-gap][same])
    ids = (np.concatenate(found) >> flat.U(64 - BITS)).astype(np.int32)
    return np.maximum(ids, 1), np.concatenate(of)


def fit(examples: pa.Table) -> pa.Table:
    """Weights that are not zero, of one pass after another over the examples in hash order.

    The features are read where Arrow has them; all of them are in memory once.
    """
    y = examples["y"].to_numpy()
    features_of = [np.frombuffer(f.as_buffer(), np.int32) for f in examples["f"]]
    rows = [(features_of[k], y[k]) for k in np.lexsort((y, examples["order"].to_numpy())).tolist()]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(i):
        step = (BETA + np.sqrt(n[i])) / ALPHA + L2
        w = -(z[i] - np.sign(z[i]) * L1) / step
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for i, y in rows:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y) * (TOXIC_WEIGHT if y else 1)
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    seen = np.flatnonzero(n)
    w = weights(seen)
    return pa.table({"i": seen[w != 0].astype(np.int32), "w": w[w != 0]})


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """The weights ``i, w`` of a model fitted on labelled documents where ``usable``.

    At most ``rows`` examples, those of the lowest hash of the id, are used; the
    weights are at most 2^BITS rows. Rows without a label or id are not used.
    """
    bound_batches(docs.sparkSession)
    order = F.xxhash64(F.col("id").cast("string"), F.lit(8))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    marked = marked.filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.withColumn("_use", usable).select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), "_use"
    )
    known = texts.filter("_use").select("id").distinct().join(marked, "id")
    sample = store(known.withColumn("order", order).orderBy("order").limit(rows), "labelled")
    picked = texts.filter("_use").join(sample, "id").select("t", "y", "order")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, data, offsets in flat.chunks(b.column(0)):
                ids, of = features(data, offsets)
                key = np.unique((of.astype(np.int64) << BITS) | ids)
                cuts = np.searchsorted(key, np.arange(high - low + 1) << BITS)
                ids = (key & ((1 << BITS) - 1)).astype(np.int32)
                packed = [
                    np.concatenate(([0], ids[cuts[k] : cuts[k + 1]])).astype(np.int32).tobytes()
                    for k in range(high - low)
                ]
                part = b.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(packed, pa.binary()), part.column(1), part.column(2)],
                    ["f", "y", "order"],
                )

    examples = picked.mapInArrow(extract, "f binary, y int, order long")
    return store(examples.groupBy().applyInArrow(fit, "i int, w double"), "weights")


def score(
    docs: DataFrame, weights: DataFrame, text_col: str = "text", out: str = "score"
) -> DataFrame:
    """All rows and columns, and ``out``: the model's probability of toxicity.

    Weights are broadcast; their number is bounded by the hash space. A NULL or
    empty text gets the score of the bias; without weights the score is 0.5. An
    input column named like ``out`` is replaced. Repeated rows score alike.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    model = weights.collect()
    sparse = spark.sparkContext.broadcast(
        (np.array([r.i for r in model], np.int32), np.array([r.w for r in model], float))
    )
    docs = docs.drop(out)
    at = docs.columns.index(text_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(1 << BITS)
        dense[sparse.value[0]] = sparse.value[1]
        for b in batches:
            logits = np.full(b.num_rows, dense[0])
            for low, high, data, offsets in flat.chunks(b.column(at)):
                ids, of = features(data, offsets)
                hit = np.flatnonzero(dense[ids])
                key = np.unique((of[hit].astype(np.int64) << BITS) | ids[hit])
                w = dense[key & ((1 << BITS) - 1)]
                logits[low:high] += np.bincount(key >> BITS, w, high - low)
            p = 1 / (1 + np.exp(-np.clip(logits, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(p)], [*b.schema.names, out]
            )

    return docs.mapInArrow(apply, StructType([*docs.schema, StructField(out, DoubleType())]))
