"""Removal of long repeated strings by two-stage suffix sorting.

A string of ``WINDOW`` bytes belongs to one place-independent group: the one of the
smallest hash among its ``GRAM``-byte grams (the rightmost of equal ones). So the
bytes around a gram that occurs once need no sorting, and equal strings always
meet in the task of their gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import flat
from stationflow.llm.shared import keyed, store

WINDOW = 200
GRAM = 32
PER_GRAM = WINDOW - GRAM + 1
BLOCK = 256 << 10  # bytes that are sorted at a time, at least one group
LARGE = 20_000  # distinct surroundings of a gram from which its group is cut
CUT = 8  # strings of neighbouring places in a piece of a large group


def surroundings(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with the same smallest gram: first byte, windows, gram's offset, two hashes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none, none, none, none, none
    p, down = flat.prefix_sums(data)
    gram = flat.mix((p[GRAM:] - p[:-GRAM]) * down[: n - GRAM + 1])
    last = flat.U((1 << 32) - 1)
    key = (gram & ~last) | (last - np.arange(len(gram), dtype=flat.U))
    step = 1
    while 2 * step <= PER_GRAM:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    if step < PER_GRAM:
        key = np.minimum(key[: step - PER_GRAM], key[PER_GRAM - step :])
    at = (last - (key & last)).astype(np.int64)
    # No window crosses the end of a text.
    edge = np.zeros(n + 1, np.int64)
    inner = offsets[1:-1]
    np.add.at(edge, np.maximum(inner - WINDOW + 1, 0), 1)
    np.add.at(edge, inner, -1)
    place = np.flatnonzero(np.cumsum(edge)[: len(at)] == 0)
    if not len(place):
        return none, none, none, none, none
    new = np.ones(len(place), bool)
    new[1:] = (at[place[1:]] != at[place[:-1]]) | (place[1:] != place[:-1] + 1)
    heads = np.flatnonzero(new)
    start, count = place[heads], np.diff(np.append(heads, len(place)))
    end = start + count + WINDOW - 1
    whole = flat.mix((p[end] - p[start]) * down[start] + count.astype(flat.U))
    return start, count, at[start] - start, gram[at[start]].view(np.int64), whole.view(np.int64)


def places(rows: DataFrame) -> DataFrame:
    """``k1, k2, h, c, at``: every run of windows by its gram ``h`` and content ``c``.

    ``at`` packs the first byte, the gram's offset and the number of windows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, data, offsets in flat.chunks(b.column(2)):
                start, count, gram, h, c = surroundings(data, offsets)
                row = np.searchsorted(offsets, start, "right") - 1
                at = ((start - offsets[row]) << 16) | (gram << 8) | count
                keys = [b.column(i).slice(low, high - low).take(pa.array(row)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(h), pa.array(c), pa.array(at)], ["k1", "k2", "h", "c", "at"]
                )

    schema = "k1 long, k2 long, h long, c long, at long"
    return rows.select("k1", "k2", "text").mapInArrow(find, schema)


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``t``, ordered by their first ``depth`` values; ``t`` ends with 0.

    Only suffixes smaller than their successors are sorted. The others follow by
    scanning the buckets of first values in order: each suffix puts the one before
    it, if that is larger, at the end of its bucket's open part.
    """
    n = len(t)
    # The sign of the next change says whether a suffix is smaller than its successor.
    change = np.flatnonzero(t[1:] != t[:-1])
    following = np.searchsorted(change, np.arange(n))
    rises = np.ones(n, bool)
    known = following < len(change)
    rises[known] = t[change[following[known]] + 1] > t[change[following[known]]]
    small = np.flatnonzero(rises)
    padded = np.concatenate((t, np.zeros(depth, t.dtype)))
    strings = np.lib.stride_tricks.sliding_window_view(padded, depth)[small]
    strings = np.ascontiguousarray(strings.astype(">u2")).view(f"S{2 * depth}")[:, 0]
    small = small[np.argsort(strings, kind="stable")]
    cuts = np.searchsorted(t[small], np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(258)]
    out = []
    for value in range(257):
        front = np.concatenate(waiting[value]) if waiting[value] else small[:0]
        own = []
        while len(front):
            own.append(front)
            before = front[front > 0] - 1
            front = before[t[before] == value]
        bucket = np.concatenate([*own, small[cuts[value] : cuts[value + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[t[before] > value]
        firsts = t[before]
        order = np.argsort(firsts, kind="stable")
        before, firsts = before[order], firsts[order]
        for first, part in zip(*_grouped(firsts, before)):
            waiting[first].append(part)
    return np.concatenate(out)


def _grouped(keys: np.ndarray, values: np.ndarray):
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return keys[np.concatenate(([0], cuts))] if len(keys) else keys, np.split(values, cuts) if len(keys) else []


def repeated(texts: list[bytes]) -> list[np.ndarray]:
    """For each text, which of its windows also start elsewhere in one of the texts."""
    sizes = np.array([len(x) for x in texts])
    # A text ends with 0, and bytes count from 1.
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    t = np.zeros(starts[-1], np.uint16)
    filled = np.ones(len(t), bool)
    filled[starts[1:] - 1] = False
    t[filled] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
    order = suffix_order(t, WINDOW)
    left = np.repeat(starts[1:] - 1, sizes + 1) - np.arange(len(t))
    order = order[left[order] >= WINDOW]
    # Adjacent common prefixes, four values at a time, as far as they go.
    wide = np.concatenate((t, np.zeros(4, np.uint16)))
    wide = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(wide, 4)).view(np.uint64)[:, 0]
    pair = np.arange(len(order) - 1)
    for k in range(0, WINDOW, 4):
        pair = pair[wide[order[pair] + k] == wide[order[pair + 1] + k]]
    seen = np.zeros(len(t), bool)
    seen[order[pair]] = seen[order[pair + 1]] = True
    return [seen[a : a + max(n - WINDOW + 1, 0)] for a, n in zip(starts, sizes)]


def contents(texts: DataFrame) -> DataFrame:
    """``g, k1, k2, start, once, piece`` from rows with their ``needs``: the bytes to be compared.

    A piece of a large group holds strings that have their gram at nearly the
    same offset, and is named by the bytes that all of them share.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).cast(pa.binary()).to_pylist()
            out = []
            for k1, k2, text, needs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw, b.column(3).to_pylist()):
                for need in needs:
                    start, gram, count = need["at"] >> 16, need["at"] >> 8 & 255, need["at"] & 255
                    if not need["large"]:
                        out.append((need["h"], k1, k2, start, need["once"], text[start : start + count + WINDOW - 1]))
                        continue
                    # Windows by the distance to their gram, in steps of CUT.
                    for low in range(gram // CUT * CUT, gram - count - CUT, -CUT):
                        first, last = max(gram - low - CUT + 1, 0), min(gram - low, count - 1)
                        if first > last:
                            continue
                        # What every string of this step has, also those not in this text.
                        shared = text[start + gram - low : start + gram - low - CUT + 1 + WINDOW]
                        name = hash_bytes(shared, low) ^ need["h"]
                        out.append((name, k1, k2, start + first, need["once"], text[start + first : start + last + WINDOW]))
            names = ["g", "k1", "k2", "start", "once", "piece"]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "g long, k1 long, k2 long, start long, once boolean, piece binary"
    return texts.mapInArrow(cut, schema)


def hash_bytes(piece: bytes, salt: int) -> int:
    data = np.frombuffer(piece, np.uint8)
    p, _ = flat.prefix_sums(data)
    return int(flat.mix(p[-1:] + flat.U(salt * 2 + 1)).view(np.int64)[0])


def compared(pieces: DataFrame) -> DataFrame:
    """``k1, k2, low, high``: ranges of window starts that occur elsewhere, of pieces that occur once.

    Pieces come ordered by group; some groups at a time are sorted together.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush():
            out = []
            seen = repeated([x[5] for x in held])
            for (_, k1, k2, start, once, _), hit in zip(held, seen):
                if once and hit.any():
                    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    out += [(k1, k2, start + int(a), start + int(z)) for a, z in edges.reshape(-1, 2)]
            held.clear()
            columns = list(zip(*out)) or [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "low", "high"]
            )

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if size >= BLOCK and held[-1][0] != row[0]:
                    yield flush()
                    size = 0
                held.append(row)
                size += len(row[5])
        if held:
            yield flush()

    return pieces.mapInArrow(sort, "k1 long, k2 long, low long, high long")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed runs of bytes and the bytes that stay.

    Every byte inside a string of ``WINDOW`` bytes that also starts elsewhere, in
    any text, is removed; all are judged on the input.

    Runs of windows are counted by gram and content. A content that occurs twice
    is repeated as a whole. A content that occurs once is compared with the
    others of its gram by suffix sorting. Grams that occur once are never sent.

    NULL and empty texts and texts shorter than ``WINDOW`` keep everything.
    Repeated rows repeat each other. Texts of any length work; no rows give no
    rows; other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    found = store(places(rows), "places")
    by_content = found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"))
    by_gram = by_content.groupBy("h").agg(
        F.count(F.lit(1)).alias("contents"), F.sum((F.col("n") == 1).cast("int")).alias("single")
    )
    mixed = by_gram.filter("contents > 1 AND single > 0").select("h", (F.col("contents") > LARGE).alias("large"))
    marked = by_content.join(mixed, "h", "left").filter("n > 1 OR large IS NOT NULL")
    needed = store(found.join(marked, ["h", "c"]), "needed")
    # One place for each content that must be compared.
    one = needed.filter("large IS NOT NULL").groupBy("h", "c").agg(
        F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("at").alias("at"),
        F.first("n").alias("n"), F.first("large").alias("large"),
    )
    need = F.struct("h", "at", "large", (F.col("n") == 1).alias("once"))
    wanted = one.groupBy("k1", "k2").agg(F.collect_list(need).alias("needs"))
    # A text of repeated rows is sent once for each; their contents are not single. Their
    # ranges are alike and make one set, so the array is no longer than one row needs.
    texts = rows.join(wanted, ["k1", "k2"]).select("k1", "k2", "text", "needs")
    pieces = contents(texts).repartition("g").sortWithinPartitions("g")
    start = F.shiftright("at", 16)
    whole = needed.filter("n > 1").select(
        "k1", "k2", start.alias("low"), (start + F.col("at").bitwiseAND(255)).alias("high")
    )
    ranges = compared(pieces).unionByName(whole).groupBy("k1", "k2")
    ranges = ranges.agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    joined = rows.join(ranges, ["k1", "k2"], "left").select("doc_id", "text", "ranges")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            kept, spans = [], []
            for text, found in zip(texts, b.column(2).to_pylist()):
                if not found:
                    kept.append(text)
                    spans.append([])
                    continue
                cover = np.zeros(len(text) + 1, np.int64)
                np.add.at(cover, [r["low"] for r in found], 1)
                np.add.at(cover, [r["high"] + WINDOW - 1 for r in found], -1)
                gone = np.cumsum(cover)[:-1] > 0
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                spans.append([{"start": int(a), "end": int(z)} for a, z in edges.reshape(-1, 2)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return joined.mapInArrow(remove, schema)
