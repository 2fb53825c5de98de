"""Document fingerprints: SimHash over word shingles, and search within a Hamming radius."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.llm.shared import SPACED, keyed, store

BITS = 64
LANE = (1 << 32) + 1  # two 32-bit counters in one long
MAX_RANGES = 1024


def term_hashes(words: Column, shingle: int) -> Column:
    """A hash of each run of ``shingle`` words; a shorter text is one run, an empty one none.

    ``words`` must be a column, not an expression: it is read once for each run.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - shingle + 1, F.lit(1)))
    runs = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, shingle)))
    return F.when(F.size(words) > 0, runs)


def votes(h: Column, weight: Column) -> list[Column]:
    """Sums of the weights of terms with each bit set, two bits to a sum."""
    return [
        F.sum(F.shiftrightunsigned(h, j).bitwiseAND(LANE) * weight).alias(f"s{j}")
        for j in range(BITS // 2)
    ]


def fingerprint(total: Column) -> Column:
    """The sign of every bit's vote, from the sums of ``votes`` and the sum of all weights."""
    bits = F.lit(0).cast("long")
    for i in range(BITS):
        s = F.coalesce(F.col(f"s{i % 32}"), F.lit(0).cast("long"))  # no term, no vote
        count = F.shiftrightunsigned(s, 32) if i >= 32 else s.bitwiseAND((1 << 32) - 1)
        bits = bits.bitwiseOR(F.shiftleft((2 * count > total).cast("long"), i))
    return bits


def hashed(rows: DataFrame, texts: dict[str, Column], keys: list[str], shingle: int) -> DataFrame:
    """One fingerprint column per text; ``keys`` must tell rows apart.

    A term votes once for each time it occurs. Terms are summed where the text
    is; with the partitioning column among the keys nothing is shuffled.
    """
    sides = F.explode(F.array(*[
        F.struct(F.lit(n).alias("n"), F.regexp_extract_all(t, F.lit(SPACED), F.lit(0)).alias("w"))
        for n, t in texts.items()
    ]))
    terms = (
        rows.select(*keys, sides.alias("side"))
        .select(*keys, "side.n", "side.w")
        .select(*keys, "n", F.explode_outer(term_hashes(F.col("w"), shingle)).alias("h"))
    )
    sums = terms.groupBy(*keys, "n").agg(F.count("h").alias("total"), *votes(F.col("h"), F.lit(1)))
    each = sums.select(*keys, "n", fingerprint(F.col("total")).alias("f"))
    return each.groupBy(*keys).agg(*[F.max(F.when(F.col("n") == n, F.col("f"))).alias(n) for n in texts])


def hexed(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def with_next(docs: DataFrame) -> DataFrame:
    """Adds the next row's text and key in descending ``doc_id``; after the last comes the first.

    Rows are cut into ranges of ids and each range into a group, so that no task
    orders everything; the first row of a range is also shown to the range
    before it. Equal ids are ordered by the key of their text, NULL ids come last.
    """
    spark = docs.sparkSession
    n = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = F.col("doc_id").cast("double")
    bounds = docs.agg(F.percentile_approx(number, [i / n for i in range(1, n)], 10 * n)).first()[0]
    cuts = F.array(*[F.lit(b) for b in sorted(set(bounds or []))]).cast("array<double>")
    place = F.coalesce(F.size(F.filter(cuts, lambda c: c <= number)), F.lit(-1))
    rows = docs.withColumn("range", F.when(number.isNull(), -1).otherwise(place))
    # No more than a row for each range.
    heads = rows.groupBy("range").agg(F.max(F.struct("doc_id", "k2")).alias("head"))
    down = Window.orderBy(F.desc("range"))
    shown = F.coalesce(F.lag("range").over(down), F.min("range").over(Window.partitionBy()))
    heads = store(heads.select(shown.alias("to"), "head.doc_id", "head.k2"), "heads")
    guests = (
        rows.alias("r")
        .join(heads.alias("h"), F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.k2") == F.col("h.k2")))
        .select("r.doc_id", "r.text", "r.k2", F.col("h.to").alias("range"), F.lit(True).alias("guest"))
    )
    both = rows.select("doc_id", "text", "k2", "range", F.lit(False).alias("guest")).unionByName(guests)
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("k2"))
    after = F.lead(F.struct("text", "k2")).over(order)
    return (
        both.withColumn("after", after)
        .filter("NOT guest")
        .select("doc_id", "text", "k2", "range", F.col("after.text").alias("next_text"), F.col("after.k2").alias("next_k2"))
    )


def neighbours(found: DataFrame, queries: DataFrame, radius: int, blocks: int = 6) -> DataFrame:
    """``f, found, differ, copies``: each ``f`` of ``queries`` with those of ``found (f, copies)`` within ``radius`` bits.

    Two fingerprints within the radius agree on at least ``blocks - radius`` whole
    blocks, so they meet in the table of those blocks. A pair counts in the first
    table that it shares, so it counts once. Both sides hold distinct fingerprints.
    """
    size = -(-BITS // blocks)
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        m = sum(1 << i for i in range(BITS) if i // size in chosen)
        masks.append(m - (1 << 64) if m >> 63 else m)
    tables = lambda f: F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col(f).bitwiseAND(m).alias("key")) for t, m in enumerate(masks)
    ]))
    left = queries.select(F.col("f").alias("q"), tables("f").alias("z")).select("q", "z.t", "z.key")
    right = found.select("f", "copies", tables("f").alias("z")).select("f", "copies", "z.t", "z.key")
    differ = F.col("q").bitwiseXOR(F.col("f"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(m) == 0, t) for t, m in enumerate(masks)])
    return (
        left.join(right, ["t", "key"])
        .filter((F.bit_count(differ) <= radius) & (first == F.col("t")))
        .select(F.col("q").alias("f"), F.col("f").alias("found"), F.bit_count(differ).alias("differ"), "copies")
    )


def asked(every: int) -> Column:
    """Whether a row's neighbours are asked for."""
    return F.col("doc_id") % every == 0


def near_prints(
    docs: DataFrame, shingle: int = 5, radius: int = 3, every: int = 100,
    id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Links ``f, found, differ, copies`` of the rows that ``fingerprints`` asks for, and members ``f, doc_id`` of all.

    The rows near a row are the members of ``found`` for its ``f``, itself among
    them. Links are of fingerprints, so that a group of copies has one row in each.
    """
    rows = keyed(docs, id_col, text_col).select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    members = store(hashed(rows, {"f": F.col("text")}, ["row", "doc_id"], shingle).select("f", "doc_id"), "members")
    found = members.groupBy("f").agg(F.count(F.lit(1)).alias("copies"))
    return neighbours(found, members.filter(asked(every)).select("f").distinct(), radius), members


def fingerprints(
    docs: DataFrame, shingle: int = 5, radius: int = 3, every: int = 100,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """SimHash of each text and of its edited text, and how alike they are.

    The edited text has its second half (the smaller one) replaced by the start
    of the next document's text, in descending id. ``n_near`` counts the other
    rows within ``radius`` bits, for rows whose id is divisible by ``every``;
    ``near_prints`` tells which. It is exact for the radius, which edited copies
    mostly exceed: the README has the recall measured for similar sets of shingles.

    Returns ``doc_id, n_chars, edited_sha256, f, edited_f, next_f, n_near``. NULL texts
    are empty; a text without words has fingerprint 0; equal texts have equal
    fingerprints; repeated rows keep their rows and are each other's next; a
    single row is its own next; no rows give no rows; other columns are not read.
    """
    rows = with_next(keyed(docs, id_col, text_col).select("doc_id", "text", "k2"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(
        "range", "doc_id", "k2", "next_k2", n.cast("long").alias("n_chars"), "text", edited.alias("edited"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range", "row", "doc_id", "k2", "next_k2", "n_chars", "edited_sha256"]
    both = store(hashed(rows, {"f": F.col("text"), "edited_f": F.col("edited")}, keys, shingle), "simhash")
    of_text = both.groupBy(F.col("k2").alias("next_k2")).agg(F.max("f").alias("next_f"))
    distinct = both.groupBy("f").agg(F.count(F.lit(1)).alias("copies"))
    near = neighbours(distinct, both.filter(asked(every)).select("f").distinct(), radius)
    near = near.groupBy("f").agg(F.sum("copies").alias("n_near"))
    return (
        both.join(of_text, "next_k2")
        .join(near, "f", "left")
        .select(
            "doc_id", "n_chars", "edited_sha256", "f", "edited_f", "next_f",
            F.when(asked(every), F.col("n_near") - 1).alias("n_near"),
        )
    )
