"""Benchmark decontamination by a distributed positional inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import fold, keyed, numbered, only_keys, store

# Letters outside ASCII, digits and a-z; A-Z as long as words are not lower-cased yet.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, not lower-cased."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def folded(text: Column) -> Column:
    """Words of a text, A-Z lower-cased: at once in an ASCII text, else word by word."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, words(F.lower(text))).otherwise(F.transform(words(text), fold))


def windows(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(wid, phrase, terms)`` and the items that have them ``(wid, item_id)``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item_id"), F.transform(words(text), fold).alias("w")
    ).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0)))
    spread = items.select("item_id", "w", F.explode(starts).alias("i")).select(
        "item_id", F.slice("w", F.col("i") + 1, n).alias("terms")
    )
    spread = store(spread.withColumn("phrase", F.array_join("terms", " ")), "windows")
    distinct = spread.groupBy("phrase").agg(F.first("terms").alias("terms"))
    ids = store(distinct.withColumn("wid", F.monotonically_increasing_id()), "window-ids")
    items_of = spread.join(ids.select("phrase", "wid"), "phrase").select("wid", "item_id")
    return ids, store(items_of.distinct(), "window-items")


def tokens(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``k1, k2, pos, term`` of every occurrence of the given terms, with the terms' other columns."""
    spread = rows.select("k1", "k2", F.posexplode("w").alias("pos", "term"))
    return spread.join(terms, "term")


def least_shared(near_share: float, terms: Column) -> Column:
    """How many of a window's distinct terms a proximity match has."""
    return F.greatest(F.ceil(near_share * F.size(F.array_distinct(terms))), F.lit(1)).cast("int")


def term_numbers(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``term, tid``: the windows' terms numbered by rarity in the documents; absent ones come first."""
    vocabulary = store(ids.select(F.explode("terms").alias("term")).distinct(), "terms")
    counts = rows.select(F.explode("w").alias("term")).join(vocabulary, "term").groupBy("term").count()
    counted = vocabulary.join(counts, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("count"))
    return numbered(counted, [F.col("count"), F.col("term")], "tid").select("term", "tid")


def pivot_pairs(ids: DataFrame, numbers: DataFrame, near_share: float, slop: int) -> DataFrame:
    """``a, b, wid, span, oa, ob``: pairs of a window's rarest terms, one of which is in each of its matches.

    A match may miss ``d - least_shared`` of the ``d`` distinct terms, so it has two of
    any two terms more than that; a window that needs a single term pairs it with itself.
    ``oa`` and ``ob`` are the terms' first offsets.
    """
    sizes = ids.select(
        "wid", (F.size("terms") + 2 * slop).alias("span"), least_shared(near_share, F.col("terms")).alias("need"),
        F.posexplode("terms").alias("off", "term"),
    )
    ranked = (
        sizes.groupBy("wid", "span", "need", "term")
        .agg(F.min("off").alias("off"))
        .join(numbers, "term")
        .groupBy("wid", "span", "need")
        .agg(F.array_sort(F.collect_list(F.struct("tid", "off"))).alias("t"))
    )
    rarest = F.slice("t", 1, F.size("t") - F.col("need") + F.least(F.lit(2), F.col("need")))
    sides = ranked.withColumn("t", rarest).withColumn("x", F.explode("t")).withColumn("y", F.explode("t"))
    paired = F.when(F.col("need") > 1, F.col("x.tid") < F.col("y.tid")).otherwise(F.col("x.tid") == F.col("y.tid"))
    return sides.filter(paired).select(
        F.col("x.tid").alias("a"), F.col("y.tid").alias("b"), "wid", "span",
        F.col("x.off").alias("oa"), F.col("y.off").alias("ob"),
    )


def close_pairs(postings: DataFrame, reach: int) -> DataFrame:
    """``k1, k2, a, b, pa, pb``: two postings of a text at most ``reach`` words apart, and each with itself.

    Postings of a text are one sorted array of position and term; zipped with
    itself shifted by 1 to ``reach`` places, it has every pair in one row.
    """
    place = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("tid"))
    lists = postings.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(place)).alias("t"))
    names = [f"t{i}" for i in range(reach + 1)]
    shifted = [F.slice("t", i + 1, F.size("t")) for i in range(reach + 1)]
    sides = lists.select("k1", "k2", F.inline(F.arrays_zip(*shifted)).alias(*names))
    t, u = F.col("t0"), F.col("u")
    pos = lambda c: F.shiftright(c, 32)
    tid = lambda c: c.bitwiseAND((1 << 32) - 1)
    pairs = sides.select("k1", "k2", "t0", F.explode(F.array(*names)).alias("u")).filter(
        (pos(u) - pos(t) <= reach) & ((tid(t) != tid(u)) | (t == u))
    )
    ahead = tid(t) <= tid(u)
    return pairs.select(
        "k1", "k2", F.least(tid(t), tid(u)).alias("a"), F.greatest(tid(t), tid(u)).alias("b"),
        F.when(ahead, pos(t)).otherwise(pos(u)).cast("int").alias("pa"),
        F.when(ahead, pos(u)).otherwise(pos(t)).cast("int").alias("pb"),
    )


def candidates(rows: DataFrame, ids: DataFrame, n: int, slop: int, near_share: float) -> DataFrame:
    """``k1, k2, wid, starts, runs``: where a window may start as a phrase, and pairs of places of its terms.

    A phrase has the two terms of a pair as far apart as the window has.
    """
    numbers = store(term_numbers(rows, ids), "term-numbers")
    pairs = store(pivot_pairs(ids, numbers, near_share, slop), "pivot-pairs")
    pivots = numbers.join(pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct(), "tid")
    near = close_pairs(tokens(rows, store(pivots, "pivots")), n + 2 * slop - 1)
    # Most pairs are of no window: their numbers alone are a smaller table to ask.
    near = near.join(store(pairs.select("a", "b").distinct(), "pair-keys"), ["a", "b"], "left_semi")
    start = F.col("pa") - F.col("oa")
    aligned = (F.col("pb") - F.col("ob") == start) & (start >= 0)
    return (
        near.join(pairs, ["a", "b"])
        .filter(F.abs(F.col("pa") - F.col("pb")) < F.col("span"))
        .groupBy("k1", "k2", "wid")
        .agg(
            F.collect_set(F.when(aligned, start)).alias("starts"),
            F.collect_set(F.struct(F.least("pa", "pb").alias("lo"), F.greatest("pa", "pb").alias("hi"))).alias("runs"),
        )
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    slop: int = 2,
    near_share: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Benchmark windows of ``n`` words in each document, as phrases and by proximity.

    The index stores positions of the windows' rarest terms over all documents.
    Pairs of them that stand close are looked up among the windows' pairs, which
    leaves few candidates; a phrase match has all words in order, a proximity match
    ``near_share`` of the distinct ones, in any order, in a run of the window's
    length and ``slop`` words on either side. Words that are in no document only
    count as missing.

    Texts are split once and their words stored; counts, postings and the check of
    candidates read these.

    Returns ``doc_id, k1, k2, n_words, n_hit, n_near, exact, items, near_items``: words
    inside a phrase match, windows matched only by proximity, the array of matched
    windows' starts and lengths, the array of item ids, sorted as strings, and that
    of the items whose windows match only by proximity.

    NULL or empty texts have no words and no match; items without words have no
    windows; an item shorter than ``n`` is one window. Equal rows get equal
    results. Empty tables give no match. Other columns are not read.
    """
    rows = keyed(docs, id_col, text_col).select("doc_id", "k1", "k2", folded(F.col("text")).alias("w"))
    rows = store(rows, "words")
    ids, items_of = windows(benchmark, n, item_col, item_text_col)
    starts = store(candidates(rows, ids, n, slop, near_share), "candidates")
    hot = store(starts.select("k1", "k2").distinct(), "candidate-texts")
    found = starts.join(ids, "wid").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("starts", "runs", "wid", "phrase", "terms")).alias("c")
    )
    w = F.col("w")

    def exact(c: Column) -> Column:
        size = F.size(c["terms"])
        return F.filter(
            c["starts"], lambda i: F.array_join(F.slice(w, i + 1, size), " ") == c["phrase"]
        )

    def close(c: Column) -> Column:
        span, need = F.size(c["terms"]) + 2 * slop, least_shared(near_share, c["terms"])
        enough = lambda run: F.size(F.array_intersect(c["terms"], run)) >= need

        def around(r: Column) -> Column:
            """The words of all runs that have both places."""
            low = F.greatest(r["hi"] - span + 1, F.lit(0))
            return F.slice(w, low + 1, r["lo"] + span - low)

        def any_run(a: Column) -> Column:
            last = F.greatest(F.size(a) - span, F.lit(0))
            return F.exists(F.sequence(F.lit(0), last), lambda i: enough(F.slice(a, i + 1, span)))

        return F.exists(
            F.transform(c["runs"], around), lambda a: enough(a) & any_run(a)
        )

    # Only texts with candidates move; the others need the number of words.
    joined = only_keys(rows.select("k1", "k2", "w"), hot, ["k1", "k2"]).join(found, ["k1", "k2"])
    judged = lambda c: F.struct(
        c["wid"].alias("wid"), F.size(c["terms"]).alias("len"), exact(c).alias("at"), c.alias("c")
    )
    places = lambda e: F.transform(
        e["at"], lambda i: F.struct(i.alias("start"), e["len"].alias("len"))
    )
    whole = lambda e: F.size(e["at"]) > 0
    only_near = lambda e: (F.size(e["at"]) == 0) & close(e["c"])
    wid = lambda e: e["wid"]
    checked = joined.withColumn("e", F.transform("c", judged)).select(
        "k1",
        "k2",
        F.flatten(F.transform("e", places)).alias("exact"),
        F.transform(F.filter("e", whole), wid).alias("wids"),
        F.transform(F.filter("e", only_near), wid).alias("near"),
    )
    checked = store(checked.dropDuplicates(["k1", "k2"]), "checked")
    of = lambda name: F.transform(
        name, lambda i: F.struct(i.alias("wid"), F.lit(name).alias("how"))
    )
    empty = F.array().cast("array<struct<wid:bigint,how:string>>")
    hits = F.concat(F.coalesce(of("wids"), empty), F.coalesce(of("near"), empty))
    names = lambda how: F.array_sort(
        F.collect_set(F.when(F.col("how") == how, F.col("item_id")))
    )
    item_list = (
        checked.select("k1", "k2", F.inline(hits))
        .distinct()
        .join(items_of, "wid")
        .groupBy("k1", "k2")
        .agg(names("wids").alias("items"), names("near").alias("near_items"))
    )
    covered = F.array_distinct(
        F.flatten(
            F.transform("exact", lambda m: F.sequence(m["start"], m["start"] + m["len"] - 1))
        )
    )
    none = F.array().cast("array<string>")
    thin = rows.select("doc_id", "k1", "k2", F.size("w").cast("long").alias("n_words"))
    results = checked.join(item_list, ["k1", "k2"], "left")
    return thin.join(results, ["k1", "k2"], "left").select(
        "doc_id",
        "k1",
        "k2",
        "n_words",
        F.when(F.col("exact").isNull(), 0).otherwise(F.size(covered)).cast("long").alias("n_hit"),
        F.when(F.col("near").isNull(), 0).otherwise(F.size("near")).cast("long").alias("n_near"),
        "exact",
        F.coalesce("items", none).alias("items"),
        F.coalesce("near_items", none).alias("near_items"),
    )
