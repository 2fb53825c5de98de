"""LM scoring: the probability of a text over all segmentations into subword pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import store

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAVY = 1 << 17  # words of at least this share of all tokens are broadcast, so no more of them exist
LONGEST = 64  # bytes of a broadcast word
FLUSH = 300_000  # distinct words that a counting task holds
PRIOR = 1000.0  # pieces' worth of counts that the vocabulary's own scores weigh
END = "</s>"
MARK = "▁"


class Pieces:
    """Log probabilities of the vocabulary's pieces, and all beginnings of pieces."""

    def __init__(self, names: list[str], logs: np.ndarray):
        self.log = dict(zip(names, logs.tolist()))
        self.starts = {n[:i] for n in names for i in range(1, len(n) + 1)}

    def byte(self, char: str) -> float:
        return sum(self.log[f"<0x{b:02X}>"] for b in char.encode())

    def word(self, word: str) -> float:
        """Log of the summed probability of all segmentations: forward recursion in log space."""
        text = MARK + word
        n = len(text)
        ends: list[list[float]] = [[] for _ in range(n + 1)]
        ends[0].append(0.0)
        log, starts = self.log, self.starts
        for i in range(n):
            terms = ends[i]
            if len(terms) == 1:
                here = terms[0]
            else:
                most = max(terms)
                here = most + math.log(sum([math.exp(t - most) for t in terms]))
            ends[i] = ()
            one = True
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in starts:
                    break
                if part in log:
                    ends[j].append(here + log[part])
                    one = one and j > i + 1
            if one:  # a character outside the vocabulary goes by its bytes
                ends[i + 1].append(here + self.byte(text[i]))
        most = max(ends[n])
        return most + math.log(sum(math.exp(t - most) for t in ends[n]))


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def hash_of(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def word_counts(rows: DataFrame) -> DataFrame:
    """``w, c, a``: each word's tokens in texts to learn from and in all, of ``text, learn``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt: Counter[bytes] = Counter()
        rest: Counter[bytes] = Counter()

        def flush():
            words = list(learnt.keys() | rest.keys())
            c = np.array([learnt[w] for w in words], np.int64)
            a = c + np.array([rest[w] for w in words], np.int64)
            learnt.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(a, pa.int64())],
                ["w", "c", "a"],
            )

        for b in batches:
            texts = b.column(0).cast(pa.binary())
            for text, learn in zip(texts, b.column(1)):
                (learnt if learn.as_py() else rest).update(tokens(text.as_py()))
                if len(learnt) + len(rest) > FLUSH:
                    yield flush()
        if learnt or rest:
            yield flush()

    counted = rows.select("text", "learn").mapInArrow(count, "w binary, c long, a long")
    return counted.groupBy("w").agg(F.sum("c").alias("c"), F.sum("a").alias("a"))


def piece_counts(words: DataFrame, model: bytes) -> DataFrame:
    """``i, n``: how often each piece occurs, at the vocabulary's own segmentation of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = sentencepiece.SentencePieceProcessor(model_proto=model)
        total = np.zeros(cut.get_piece_size(), np.int64)
        for b in batches:
            found = [x.decode("utf-8", "replace") for x in b.column(0).to_pylist()]
            for ids, n in zip(cut.encode(found, num_threads=1), b.column(1).to_pylist()):
                for i in ids:
                    total[i] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["i", "n"])

    learnt = words.filter("c > 0").select("w", "c").mapInArrow(count, "i long, n long")
    return learnt.groupBy("i").agg(F.sum("n").alias("n"))


def learn_pieces(words: DataFrame, texts: int, vocabulary: str) -> Pieces:
    """Piece probabilities: the vocabulary's scores as a prior, and counts in the learnt words.

    The vocabulary's scores are ranks, taken by Zipf's law. Its pieces, no more
    than it has, are all that reaches the driver.
    """
    with open(vocabulary, "rb") as f:
        model = f.read()
    cut = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = cut.get_piece_size()
    names = [cut.id_to_piece(i) for i in range(size)]
    # Bytes and other pieces without a rank of their own come after all ranked ones.
    rank = np.array([-cut.get_score(i) if cut.get_score(i) < 0 else size for i in range(size)])
    weight = 1 / (rank + 2.7)
    usable = np.array([not (cut.is_control(i) or cut.is_unknown(i)) for i in range(size)])
    end = cut.eos_id()
    usable[end] = True
    weight = np.where(usable, weight, 0.0)
    counts = np.zeros(size)
    for row in piece_counts(words, model).collect():
        counts[row.i] = row.n if usable[row.i] else 0
    counts[end] = texts
    p = (counts + PRIOR * weight / weight.sum()) / (counts.sum() + PRIOR)
    # The end is no part of a word.
    kept = [i for i in range(size) if usable[i] and i != end]
    pieces = Pieces([names[i] for i in kept], np.log(p[kept]))
    pieces.log_end = math.log(p[end])
    return pieces


def score(
    docs: DataFrame,
    learn: Column,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Log10 probabilities of all texts, learning from those where ``learn`` holds.

    Returns ``doc_id, learn, n_tokens, n_known, train_tokens, base_score, score``. Tokens
    are words and one end. The base is a word model with half a count added; the
    score sums over all segmentations of the words into pieces.

    A word's probability does not depend on the text, so it is computed once for
    each distinct word. Words of at least 1/``HEAVY`` of all tokens, no more than
    ``HEAVY``, are broadcast; the others are joined by hash, so no word is hot.

    NULL and empty texts have the end only; without anything to learn from the
    base has no words and the pieces keep the vocabulary's own weights. Repeated
    rows count as often as they are there; no rows give no rows; other columns
    are not read.
    """
    spark = docs.sparkSession
    rows = docs.withColumn("_learn", F.coalesce(learn, F.lit(False))).select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col("_learn").alias("learn"),
    )
    words = store(word_counts(rows), "words")
    texts = rows.filter("learn").count()
    c_sum, a_sum, distinct = words.agg(F.sum("c"), F.sum("a"), F.sum((F.col("c") > 0).cast("long"))).first()
    train = (c_sum or 0) + texts
    spread = train + 0.5 * ((distinct or 0) + (1 if texts else 0) + 1)
    pieces = learn_pieces(words, texts, vocabulary)
    log_end = pieces.log_end / math.log(10)
    shared = spark.sparkContext.broadcast(pieces)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            found = b.column(0).to_pylist()
            lp = [model.word(w.decode("utf-8", "replace")) / math.log(10) for w in found]
            h = [hash_of(w) for w in found]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(h, pa.int64()), pa.array(lp, pa.float64())], ["w", "c", "a", "h", "lp"]
            )

    # Words are dealt anew: their cost differs from their size on disk.
    dealt = words.repartition(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), "w")
    weighed = store(dealt.mapInArrow(weigh, "w binary, c long, a long, h long, lp double"), "weighed")
    often = weighed.filter((F.col("a") >= max(1, (a_sum or 0) / HEAVY)) & (F.length("w") <= LONGEST))
    frequent = spark.sparkContext.broadcast(
        {bytes(r.w): (math.log10((r.c + 0.5) / spread), r.lp, r.c > 0) for r in often.collect()}
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for b in batches:
            heads, rare, count, ends = [], [], [], [0]
            for text in b.column(1).cast(pa.binary()):
                n = n_known = 0
                base = total = 0.0
                for w, times in Counter(tokens(text.as_py())).items():
                    n += times
                    if w in known:
                        one, lp, seen = known[w]
                        base += times * one
                        total += times * lp
                        n_known += times if seen else 0
                    else:
                        rare.append(hash_of(w))
                        count.append(times)
                heads.append((n, n_known, base, total))
                ends.append(len(rare))
            n, n_known, base, total = zip(*heads) if heads else ((), (), (), ())
            lists = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()),
                    pa.array(base, pa.float64()), pa.array(total, pa.float64()),
                    pa.ListArray.from_arrays(lists, pa.array(rare, pa.int64())),
                    pa.ListArray.from_arrays(lists, pa.array(count, pa.int32())),
                ],
                ["doc_id", "learn", "n", "known", "base", "total", "rare", "times"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, learn boolean, n long, known long, base double, total double, "
        "rare array<long>, times array<int>"
    )
    looked = rows.select("doc_id", "text", "learn").mapInArrow(look_up, schema)
    looked = store(looked.withColumn("rid", F.monotonically_increasing_id()), "looked-up")
    rare = looked.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    rare = rare.select("rid", F.col("r.rare").alias("h"), F.col("r.times").alias("times"))
    each = F.log10((F.col("c") + 0.5) / spread)
    sums = (
        rare.join(weighed.select("h", "c", "lp"), "h")
        .groupBy("rid")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * each).alias("rare_base"),
            F.sum(F.col("times") * F.col("lp")).alias("rare_total"),
        )
    )
    end_base = math.log10((texts + 0.5) / spread)
    zero = F.lit(0.0)
    return looked.drop("rare", "times").join(sums, "rid", "left").select(
        "doc_id",
        "learn",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + (1 if texts else 0)).cast("long").alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero) + end_base).alias("base_score"),
        (F.col("total") + F.coalesce("rare_total", zero) + log_end).alias("score"),
    )
