"""Secret scans: certain patterns, and weak parts of credentials that occur together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.llm.shared import store

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# kind: (pattern, class of part, group that is measured, its least length, reported alone)
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
WEAK_ID = (
    r"((?i:client_?id|access_?key_?id|account_?id|user_?name|user|login))"
    + _VALUE
    + r"([A-Za-z0-9+/_.@-]{4,})"
)
# A whole run; one without a digit or without a small letter is dropped afterwards.
WEAK_SECRET = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"(?i:https?|ftp|amqps?|redis|mongodb|postgres(?:ql)?|mysql|jdbc:[a-z]+)://[^\s\"'<>]+"
KINDS = {
    "assign": (ASSIGN, "secret", 2, 6, True),
    "access": (ACCESS, "id", 0, 20, True),
    "hex": (HEX, "secret", 0, 24, True),
    "weak_id": (WEAK_ID, "id", 0, 0, False),
    "weak_secret": (WEAK_SECRET, "secret", 0, 1, False),
    "endpoint": (ENDPOINT, "endpoint", 0, 0, False),
}
# What must be near a weak part for it to be reported.
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}


def _measured(value: Column, kind: str) -> Column:
    """Length of a match's measured part; 0 for a run that is not mixed."""
    if kind != "weak_secret":
        return F.length(value)
    mixed = value.rlike("[0-9]") & value.rlike("[a-z]")
    return F.when(mixed, F.length(value)).otherwise(0)


def _found(text: Column, kind: str) -> Column:
    """Matches of a kind with the lengths of the text between them; NULL without a match."""
    pattern, _, group, _, _ = KINDS[kind]
    match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.struct(
        F.lit(kind).alias("kind"),
        F.arrays_zip(
            F.transform(match, F.length).alias("n"),
            F.transform(value, lambda v: _measured(v, kind)).alias("v"),
            F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        ).alias("m"),
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), found)


def parts(rows: DataFrame) -> DataFrame:
    """``rid, kind, start, end`` of every match, weak ones too, in code points.

    A match starts after all matches and gaps before it, which one running sum
    over the matches of a row and kind gives.
    """
    by_place = Window.partitionBy("rid", "kind").orderBy("i")
    end = F.sum(F.col("z.gap") + F.col("z.n")).over(by_place)
    least = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[3])])
    return (
        rows.select("rid", F.explode("found").alias("f"))
        .select("rid", "f.kind", F.posexplode("f.m").alias("i", "z"))
        .filter("z.n IS NOT NULL")
        .select("rid", "kind", "z.n", "z.v", end.alias("end"))
        .filter(F.col("v") >= least[F.col("kind")])
        .select("rid", "kind", (F.col("end") - F.col("n")).alias("start"), "end")
    )


def linked(spans: DataFrame, scope: int) -> DataFrame:
    """Certain spans, and weak ones that have their complementary parts within ``scope``.

    An interval join that needs only existence: in the order of positions, the
    furthest end of a class's parts that start at or before a weak part's end
    plus the scope says whether one of them reaches back into its scope. A weak
    part inside a certain span is dropped, as it is reported already.
    """
    sort_of = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[1])])
    sure = F.col("kind").isin([k for k, v in KINDS.items() if v[4]])
    upto = Window.partitionBy("rid").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("sort", sort_of[F.col("kind")]).withColumn("sure", sure)
    covered = F.max(F.when(F.col("sure"), F.col("end"))).over(upto)
    spans = spans.withColumn("inside", F.coalesce(~F.col("sure") & (covered >= F.col("end")), F.lit(False)))
    spans = spans.filter("NOT inside")
    # Each part stands at its start; each weak part asks at the end of its scope.
    event = F.struct(F.col("start").alias("at"), F.lit(False).alias("asks"))
    asks = F.struct((F.col("end") + scope).alias("at"), F.lit(True).alias("asks"))
    events = F.explode(F.when(F.col("sure"), F.array(event)).otherwise(F.array(event, asks)))
    sweep = spans.withColumn("e", events).select("*", "e.at", "e.asks")
    before = Window.partitionBy("rid").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    for sort in NEEDS:
        reach = F.max(F.when(~F.col("asks") & (F.col("sort") == sort), F.col("end"))).over(before)
        sweep = sweep.withColumn(f"near_{sort}", F.coalesce(reach >= F.col("start") - scope, F.lit(False)))
    fits = F.lit(False)
    for sort, needs in NEEDS.items():
        ok = F.col("sort") == sort
        for need in needs:
            ok = ok & F.col(f"near_{need}")
        fits = fits | ok
    return sweep.filter((F.col("sure") & ~F.col("asks")) | (F.col("asks") & fits)).select(
        "rid", "kind", "start", "end", "sure"
    )


def scan(
    docs: DataFrame, scope: int = 200, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Secrets of each document: ``doc_id, spans`` with ``spans`` an array of (start, kind, end, sure).

    Assignments, access identifiers and long hexadecimal strings are certain and
    always reported. Other identifiers, long mixed strings and endpoints are
    weak: an identifier needs a secret, a secret an identifier, an endpoint both,
    within ``scope`` code points in the same document.

    Spans are sorted by start, then kind as listed in ``KINDS``. NULL and empty
    texts have none; repeated rows each keep their own row; no rows give no rows;
    other columns are not read. Positions count code points, the end is exclusive.
    """
    text = F.coalesce(F.col("_t"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_t"))
    found = F.filter(F.array(*[_found(text, k) for k in KINDS]), lambda f: f.isNotNull())
    rows = store(
        rows.select("doc_id", F.monotonically_increasing_id().alias("rid"), found.alias("found")),
        "secrets",
    )
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    one = F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end", "sure")
    spans = (
        linked(parts(rows.filter(F.size("found") > 0)), scope)
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(one)).alias("spans"))
    )
    return rows.select("doc_id", "rid").join(spans, "rid", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
    )
