"""Packs documents' token ids into sequences of a fixed length, best fit, in bulk steps.

Documents are tokenized where they are read; only sizes and places move on. Documents are
range-sorted by size and numbered within it, once. A step takes the documents of one octave
of sizes, largest first:

* the open gaps are range-sorted and numbered within their size,
* a successor sweep over the sizes matches documents to the smallest gaps that hold them;
  all of one size are alike, so the sweep needs the number of documents and gaps of each
  size only, at most ``capacity`` numbers each, whatever the data,
* which document meets which gap of the size is decided by rank,
* the gaps are updated by task, each from the sweep's rank intervals, and stored.

Documents that found no gap are larger than every gap left. Sequences are opened for them,
as many as their sum needs at least, and the step repeats. The places are joined at the
end: a document's size and rank name its step, gap size and gap rank.
"""

from __future__ import annotations

import base64
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.llm.shared import bound_batches, store
from stationflow.operators.ordered import positions

CAPACITY = 2048
# Units whose ids a task remembers, the first ones it meets, and the longest one it does.
CACHE, LONGEST = 400_000, 64
# Characters of a text that are split at a time.
SLICE = 1 << 20


# ---- tokens -----------------------------------------------------------------


class Encoder:
    """Ids of whole texts by a byte-level BPE file of ``tokenizers``.

    Its pre-tokenizer always starts a new token at a blank between two characters that
    are no white space. So a text is cut there, and ids of the units are looked up. Units of
    plain letters, digits and punctuation are encoded by the same vocabulary's ranks,
    which is faster and gives the same ids; all others by ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.known: dict[str, bytes] = {}
        # Printable ASCII, line feed, Latin letters; "<|" may begin a special token.
        self.plain = re.compile("(?!.*<\\|)[\n!-~À-ÖØ-öø-ɏ]+", re.S).fullmatch
        self.cut = re.compile(r"(?<=\S) (?=\S)")
        self.held = re.compile(r"\s\s|^ | $").search
        self.ranks = None
        if ranks_file:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            pattern = public_tokenizers.PATTERN
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def unit(self, unit: str, lead: str = " ") -> bytes:
        """Ids of one unit after its blank, as little-endian 32-bit numbers."""
        if self.ranks is not None and self.plain(unit):
            ids = self.ranks.encode_ordinary(lead + unit)
        else:
            ids = self.tokenizer.encode(lead + unit, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def look_up(self, unit: str) -> bytes:
        ids = self.unit(unit)
        if len(unit) <= LONGEST and len(self.known) < CACHE:
            self.known[unit] = ids
        return ids

    def units(self, text: str) -> list[str]:
        """The text cut at safe blanks; a blank beside other white space stays in its unit."""
        if not self.held(text):
            return text.split(" ")
        units: list[str] = []
        for unit in text.split(" "):
            held = not unit or unit[0].isspace() or not units or not units[-1] or units[-1][-1].isspace()
            if held and units:
                units[-1] = f"{units[-1]} {unit}"
            else:
                units.append(unit)
        return units

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; long ones a slice at a time, so only ids are held for all of it."""
        out, at = [], 0
        while at < len(text):
            end = min(at + SLICE, len(text))
            if end < len(text):
                cut = self.cut.search(text, end)
                end = cut.start() if cut else len(text)
            out.append(self._slice(text[at:end], first=at == 0))
            at = end + 1 if end < len(text) else end
        return b"".join(out)

    def _slice(self, text: str, first: bool) -> bytes:
        known = self.known.get
        units = self.units(text)
        head = [self.unit(units[0], "")] if first else []
        rest = units[1:] if first else units
        return b"".join(head + [known(u) or self.look_up(u) for u in rest])


def piece_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: what is left over first, then whole sequences."""
    whole, rest = divmod(total, capacity)
    return ([rest] if rest else []) + [capacity] * whole


def pieces(
    docs: DataFrame,
    tokenizer_file: str,
    ranks_file: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A NULL or empty text is its end id alone. Texts are encoded whole. Repeated rows and
    NULL ids have pieces of their own; other columns are not looked at.
    """
    import pyarrow as pa

    bound_batches(docs.sparkSession)
    ids = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id {ids}, piece int, start long, length long, ids_crc32 long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = None, int(end_id).to_bytes(4, "little")
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_file, ranks_file)
            of, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = encoder.encode(text.as_py() or "") + end
                at = 0
                for k, n in enumerate(piece_lengths(len(data) // 4, capacity)):
                    of.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * at : 4 * (at + n)]))
                    at += n
            columns = [pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), *columns],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(encode, schema)


# ---- packing ----------------------------------------------------------------


@dataclass(frozen=True)
class Match:
    """Documents of ``size`` from rank ``first`` on, ``each`` to a gap of size ``gap`` from rank ``low`` to ``high``."""

    size: int
    first: int
    last: int
    gap: int
    low: int
    high: int
    each: int
    offset: int


def sweep(
    sizes: dict[int, int], taken: dict[int, int], gaps: dict[int, int], capacity: int
) -> tuple[list[Match], list[tuple[int, int, int, int]]]:
    """Best fit of documents, largest first, over counts of documents and gaps by size.

    ``taken`` has the rank of the next document of each size and moves on. Gaps that
    start alike are told apart by their rank. Returns the matches and, for each interval of
    gaps that changed, (gap, low, high, left).
    """
    runs: dict[int, list[tuple[int, int, int]]] = {g: [(g, 0, n)] for g, n in gaps.items() if n}
    order = sorted(runs)
    matches = []

    def put(left: int, run: tuple[int, int, int]) -> None:
        if run[1] == run[2]:
            return
        if left not in runs:
            insort(order, left)
            runs[left] = []
        runs[left].append(run)

    for size in sorted(sizes, reverse=True):
        n = sizes[size]
        while n:
            at = bisect_left(order, size)
            if at == len(order):
                break
            left = order[at]
            gap, low, high = runs[left].pop()
            if not runs[left]:
                del runs[left], order[at]
            each = min(left // size, n)
            used = min(high - low, n // each)
            first = taken.get(size, 0)
            matches.append(
                Match(size, first, first + used * each, gap, low, low + used, each, capacity - left)
            )
            taken[size] = first + used * each
            n -= used * each
            put(left - each * size, (gap, low, low + used))
            put(left, (gap, low + used, high))
        sizes[size] = n
    changed = [
        (gap, low, high, left) for left, some in runs.items() for gap, low, high in some if left != gap
    ]
    return matches, changed


_MATCH = T.StructType(
    [T.StructField("step", T.IntegerType())]
    + [T.StructField(f, T.LongType()) for f in Match.__dataclass_fields__]
)


def _update(ranked: DataFrame, changed: list[tuple[int, int, int, int]]) -> DataFrame:
    """Open gaps after a sweep; at most some intervals for each size are broadcast."""
    rows = ranked.sparkSession.createDataFrame(changed, "gap long, low long, high long, rest long")
    inside = (F.col("r") >= F.col("low")) & (F.col("r") < F.col("high"))
    rows = F.broadcast(rows.withColumnRenamed("gap", "of"))
    joined = ranked.join(rows, (F.col("gap") == F.col("of")) & inside, "left")
    left = F.coalesce("rest", "gap")
    return joined.select("bin", left.alias("gap")).filter("gap > 0")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    A row of full length is a sequence by itself. The rows are stored first; hot sizes
    spread over many tasks, as ranks come from a range sort. Ties of size are interchangeable.
    """
    spark = rows.sparkSession
    columns = rows.columns
    rows = store(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = rows.filter(F.col("length") == capacity).select(
        *columns, (F.col("_row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    thin = rows.filter(F.col("length") < capacity).select("_row", F.col("length").alias("size"))
    docs = store(positions(thin, ["size"], [F.asc("_row")], "r", "n"), "sizes")
    # One number for each size below the capacity.
    counts = {r["size"]: r["n"] for r in docs.groupBy("size").agg(F.max("n").alias("n")).collect()}
    matches, used = _steps(spark, counts, capacity)
    if not matches:
        return whole
    plan = spark.createDataFrame(matches, _MATCH).withColumnRenamed("size", "of")
    inside = (F.col("r") >= F.col("first")) & (F.col("r") < F.col("last"))
    placed = docs.join(F.broadcast(plan), (F.col("size") == F.col("of")) & inside)
    nth = F.col("r") - F.col("first")
    placed = placed.select(
        "_row",
        "step",
        "gap",
        (F.col("low") + F.floor(nth / F.col("each"))).alias("r"),
        (F.col("offset") + nth % F.col("each") * F.col("size")).alias("offset"),
    )
    placed = placed.join(used, ["step", "gap", "r"]).select(
        "_row", (F.col("bin") * 2 + 1).alias("sequence_id"), "offset"
    )
    packed = rows.filter(F.col("length") < capacity).join(placed, "_row")
    return whole.unionByName(packed.select(*columns, "sequence_id", "offset"))


def _steps(spark: SparkSession, counts: dict[int, int], capacity: int) -> tuple[list[tuple], DataFrame | None]:
    """Matches of all steps, and each step's gaps (step, gap, r, bin) as they were before it."""
    open_gaps = spark.createDataFrame([], "bin long, gap long")
    gaps: dict[int, int] = {}
    taken: dict[int, int] = {}
    matches: list[tuple] = []
    used: DataFrame | None = None
    bins = step = 0
    top = capacity
    while top:
        # Sizes of one octave; the rest of it is tried again after sequences were opened.
        some = {s: n - taken.get(s, 0) for s, n in counts.items() if top // 2 < s <= top}
        some = {s: n for s, n in some.items() if n}
        if not some:
            top //= 2
            continue
        largest = max(gaps, default=0)
        unfit = {s: n for s, n in some.items() if s > largest}
        if unfit:
            alone = sum(n for s, n in unfit.items() if 2 * s > capacity)
            fresh = max(alone, -(-sum(s * n for s, n in unfit.items()) // capacity))
            new = spark.range(bins, bins + fresh).select(F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap"))
            open_gaps, bins = open_gaps.unionByName(new), bins + fresh
        ranked = store(positions(open_gaps, ["gap"], [F.asc("bin")], "r", "n"), "gaps")
        # One number for each size of gap, so bounded by the capacity.
        gaps = {r["gap"]: r["n"] for r in ranked.groupBy("gap").agg(F.max("n").alias("n")).collect()}
        found, changed = sweep(some, taken, gaps, capacity)
        matches += [(step, *m.__dict__.values()) for m in found]
        here = ranked.select(F.lit(step).alias("step"), "gap", "r", "bin")
        used = here if used is None else used.unionByName(here)
        open_gaps = _update(ranked, changed)
        gaps = _left(gaps, changed)
        step += 1
    return matches, used


def _left(gaps: dict[int, int], changed: list[tuple[int, int, int, int]]) -> dict[int, int]:
    """Number of gaps of each size after a sweep."""
    after = dict(gaps)
    for gap, low, high, left in changed:
        after[gap] -= high - low
        after[left] = after.get(left, 0) + high - low
    return {g: n for g, n in after.items() if g and n}
