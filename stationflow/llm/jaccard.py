"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm import flat
from stationflow.llm.components import components
from stationflow.llm.shared import bound_batches, keyed, store
from stationflow.operators.joins import fits_broadcast

LIMIT = 512  # texts that one task compares with each other
DEPTH = 4  # Voronoi levels before a region is cut into blocks
PIVOTS = 16  # of a region at a level
COPIES = 4  # times that windows may hold a text before its region counts as dense
NARROWED = 16 * LIMIT  # texts of a region that the bound on distances is tried for
SKETCH = 1 << 18  # bound of the common shingles that are put last
COUNT_EVERY = 2 << 20  # shingles that a task counts at a time for the sketch
SLACK = 1e-9
BITS = 64, 1 << 16  # least and most bits of a sketch, whose differences bound the distance of two sets


def _shingles(texts: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Distinct shingle hashes of some rows at a time, and the row of each, sorted by row."""
    for low, high, data, offsets in flat.chunks(texts):
        hashes, at = flat.runs(*flat.words(data, offsets), n)
        row = np.repeat(np.arange(high - low), np.diff(at))
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        yield low, high, hashes[new], row[new]


def _least(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that any set similar to one of this size shares with it."""
    return -(-percent * size // 100)


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Binary logarithm of a sketch's bits, which are once to twice the set's shingles within ``BITS``."""
    least, most = (int(np.log2(b)) for b in BITS)
    return np.clip(np.floor(np.log2(np.maximum(size, 1))) + 1, least, most).astype(np.int64)


def sketches(h: np.ndarray, row: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For each row the parities of its shingles' numbers by hash class.

    Two sketches differ in no more bits than the sets have shingles that are not
    in both; halves added up bit by bit are the sketch of half the classes.
    """
    bits = sketch_bits(size)
    base = np.concatenate(([0], np.cumsum(1 << bits)))
    at = (flat.mix(h + flat.U(7)) & ((1 << bits[row]) - 1).astype(flat.U)).astype(np.int64)
    odd = np.bincount(base[row] + at, minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8 : z // 8] for a, z in zip(base.tolist(), base[1:].tolist())]


def common_shingles(rows: DataFrame, n: int) -> DataFrame:
    """``h, c``: shingles that are frequent somewhere, with a rough count.

    They only order the shingles, so a rough count does. Their number is bounded
    by ``SKETCH``: no more can have that share of all counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []

        def flush():
            h = np.concatenate(kept)
            kept.clear()
            h.sort()
            at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            c = np.diff(at, append=len(h))
            often = c > 2
            arrays = [pa.array(h[at[often]].view(np.int64)), pa.array(c[often])]
            return pa.RecordBatch.from_arrays(arrays, ["h", "c"])

        for b in batches:
            for *_, hashes, _row in _shingles(b.column(0), n):
                kept.append(hashes)
                if sum(map(len, kept)) > COUNT_EVERY:
                    yield flush()
        if kept:
            yield flush()

    counted = rows.select("text").mapInArrow(count, "h long, c long").groupBy("h")
    counted = store(counted.agg(F.sum("c").alias("c")), "shingle-counts")
    total = counted.agg(F.sum("c")).first()[0] or 0
    return counted.filter(F.col("c") >= max(16, total // SKETCH))


def prefixes(rows: DataFrame, common: DataFrame, n: int, percent: int) -> DataFrame:
    """``k1, k2, size, s, hs, sketch``: size and hash of each row's set, its rarest shingles, its sketch.

    Similar sets share one of their ``size - least + 1`` first shingles in any
    order that is the same for all; common ones come last.
    """
    found = common.collect()  # at most SKETCH
    order = np.argsort([r.h for r in found])
    known = np.array([found[i].h for i in order], np.int64).view(flat.U)
    counts = np.array([found[i].c for i in order], flat.U)
    # Sorted as unsigned values in the tasks.
    order = np.argsort(known)
    shared = rows.sparkSession.sparkContext.broadcast((known[order], counts[order]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for b in batches:
            for low, high, h, row in _shingles(b.column(2), n):
                key = flat.mix(h) >> flat.U(1)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    often = np.flatnonzero(known[at] == h)
                    rank = np.minimum(counts[at[often]], flat.U((1 << 22) - 1)) << flat.U(40)
                    key[often] = flat.U(1 << 63) | rank | (key[often] >> flat.U(24))
                size = np.bincount(row, minlength=high - low)
                ends = np.concatenate(([0], np.cumsum(size)))
                sums = np.concatenate((np.zeros(1, flat.U), np.cumsum(flat.mix(h ^ flat.U(0x5DEECE66D)))))
                s = flat.mix(sums[ends[1:]] - sums[ends[:-1]] + size.astype(flat.U)).view(np.int64)
                order = np.lexsort((key, row))
                place = np.arange(len(h)) - ends[row]
                first = place < (size - _least(size, percent) + 1)[row]
                picked = h[order][first].view(np.int64)
                lengths = np.bincount(row[first], minlength=high - low)
                starts = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                part = b.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(size, pa.int32()), pa.array(s),
                        pa.ListArray.from_arrays(starts, pa.array(picked)),
                        pa.array(sketches(h, row, size), pa.binary()),
                    ],
                    ["k1", "k2", "size", "s", "hs", "sketch"],
                )

    schema = "k1 long, k2 long, size int, s long, hs array<long>, sketch binary"
    return rows.select("k1", "k2", "text").mapInArrow(cut, schema)


def sets(rows: DataFrame, n: int) -> DataFrame:
    """``region, s, set`` with the whole set's sorted hashes as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high, h, row in _shingles(b.column(2), n):
                ends = np.searchsorted(row, np.arange(high - low + 1))
                packed = [h[ends[i] : ends[i + 1]].tobytes() for i in range(high - low)]
                part = b.slice(low, high - low)
                columns = [part.column(0), part.column(1), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["region", "s", "set"])

    return rows.select("region", "s", "text").mapInArrow(pack, "region long, s long, set binary")


def shared_counts(packed: pd.Series, others: pd.Series | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the intersections and unions of the sets with each other, or with the others."""
    rows = [np.frombuffer(x, flat.U) for x in packed]
    n = len(rows)
    rows += [] if others is None else [np.frombuffer(x, flat.U) for x in others]
    size = np.array([len(r) for r in rows])
    h, row = np.concatenate(rows), np.repeat(np.arange(len(rows)), size)
    _, column, often = np.unique(h, return_inverse=True, return_counts=True)
    keep = often[column] > 1
    number = np.cumsum(often > 1) - 1
    column, row = number[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    left = slice(0, n)
    right = left if others is None else slice(n, len(rows))
    both = np.zeros((n, right.stop - right.start), np.float64)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        m = np.zeros((len(rows), width), np.float32)
        m[row[a:b], column[a:b] - low] = 1
        both += m[left] @ m[right].T
    both = np.rint(both).astype(np.int64)
    return both, size[left][:, None] + size[right][None, :] - both


def spanning(s: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each component's first member to its others; loops are left out."""
    open_, u, v = np.ones(len(s), bool), [], []
    for i in range(len(s)):
        if not open_[i]:
            continue
        open_[i] = False
        front = [i]
        while front:
            near = np.flatnonzero(linked[front].any(axis=0) & open_)
            open_[near] = False
            u += [s[i]] * len(near)
            v += list(s[near])
            front = list(near)
    return np.array(u, np.int64), np.array(v, np.int64)


def _join(percent: int):
    """Links inside a region; of two rows linked to the same pivot, or of one side, none is needed."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("s")
        both, union = shared_counts(rows["set"])
        linked = 100 * both >= percent * union
        side, core = rows.side.to_numpy(), rows.core.to_numpy()
        skip = core[:, None] & core[None, :]
        crossed = side.max() != side.min()
        if crossed:
            skip |= side[:, None] == side[None, :]
        linked &= ~skip
        u, v = spanning(rows.s.to_numpy(), linked)
        return pd.DataFrame({"u": u, "v": v})

    return join


def folded(packed: bytes, bits: int) -> np.ndarray:
    """The sketch of so many bits that a longer one has in it."""
    words = np.frombuffer(packed, np.uint64)
    while len(words) > 1 << bits - 6:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def within(size: np.ndarray, packed: list[bytes], percent: int) -> np.ndarray:
    """Which sets, ascending by size, the bound on distances lets be linked.

    Only sets of similar size are compared, by sketches as long as the smaller one's.
    """
    n, bits = len(size), sketch_bits(size)
    last = np.searchsorted(size, 100 * size // percent, "right")
    near = np.zeros((n, n), bool)
    for b in np.unique(bits).tolist():
        own = np.flatnonzero(bits == b)
        low, high = own[0], last[own[-1]]
        words = np.stack([folded(x, b) for x in packed[low:high]], axis=1)
        for i in own.tolist():
            if last[i] > i + 1:
                other = slice(i + 1, last[i])
                differ = words[:, i + 1 - low : last[i] - low] ^ words[:, i - low : i - low + 1]
                apart = np.bitwise_count(differ).sum(axis=0, dtype=np.int64)
                near[i, other] = apart * (100 + percent) <= (size[other] + size[i]) * (100 - percent)
    return near | near.T


def _near(percent: int):
    """Edges that connect the rows of a region that may be linked, by the bound on distances."""

    def near(rows: pa.Table) -> pa.Table:
        size = rows["size"].to_numpy().astype(np.int64)
        order = np.argsort(size, kind="stable")
        s, packed = rows["s"].to_numpy()[order], rows["sketch"].take(pa.array(order)).to_pylist()
        linked = within(size[order], packed, percent)
        some = np.flatnonzero(linked.any(axis=0))
        u, v = spanning(s[some], linked[np.ix_(some, some)])
        region = np.full(len(u), rows["region"][0].as_py(), np.int64)
        return pa.table({"region": region, "u": u, "v": v})

    return near


def narrowed(elected: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """``region, u, v``: edges between the rows that can have a link in their region, before any set is fetched.

    Rows that may be linked in a region are connected by its edges. A region that
    one task can compare is one group; a larger one is cut into blocks, each pair
    of which is a group of these short rows. In regions of more than ``NARROWED``
    texts all are connected.
    """
    counts = store(elected.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "elected-sizes")
    sized = elected.join(counts, "region")
    few = sized.filter(F.col("n") <= NARROWED)
    blocks = F.when(F.col("n") <= LIMIT, 1).otherwise(F.ceil(F.col("n") / (LIMIT // 2))).cast("int")
    own = F.pmod(F.xxhash64("s", F.lit(-3)), blocks).cast("int")
    paired = few.select("region", "s", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o"))
    paired = paired.select("region", "s", F.least("own", "o").alias("a"), F.greatest("own", "o").alias("b"))
    of_class = found.groupBy("s").agg(F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    # The rows are short and their comparison is not, so there are as many tasks as partitions.
    parts = int(elected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = paired.join(of_class, "s").repartition(parts, "region", "a", "b").groupBy("region", "a", "b")
    edges = edges.applyInArrow(_near(percent), "region long, u long, v long")
    whole = sized.filter((F.col("n") > NARROWED) & (F.col("s") != F.col("region")))
    return edges.unionByName(whole.select("region", F.col("region").alias("u"), F.col("s").alias("v")))


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``region, s, text`` of the representatives ``region, s, k1, k2, n``, a stored table; ``n`` rows are equal."""
    # Few representatives are broadcast, so that no other text moves.
    broadcast = fits_broadcast(wanted)

    def texts(some: DataFrame) -> DataFrame:
        some = some.drop("n")
        return rows.select("k1", "k2", "text").join(F.broadcast(some) if broadcast else some, ["k1", "k2"])

    repeated = wanted.filter("n > 1")
    once = texts(wanted.filter("n = 1")).select("region", "s", "text")
    if repeated.isEmpty():
        return once
    return once.unionByName(texts(repeated).dropDuplicates(["s"]).select("region", "s", "text"))


def _assign(percent: int):
    """Distances of a block's rows to all pivots of the region: nearest one and windows."""
    reach = 1 - percent / 100

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        pivots = rows[rows.is_pivot].drop_duplicates("s")
        own = rows[~rows.is_pivot].drop_duplicates("s")
        both, union = shared_counts(own["set"], pivots["set"])
        far = 1 - both / np.maximum(union, 1)
        near = far.min(axis=1)
        inside = far <= near[:, None] + 2 * reach + SLACK
        linked = 100 * both >= percent * union
        i, j = np.nonzero(inside)
        return pd.DataFrame(
            {"region": [rows.region.iloc[0]] * len(i), "c": pivots.s.to_numpy()[j],
             "s": own.s.to_numpy()[i], "core": linked[i, j]}
        )

    return assign


def _place(large: DataFrame, percent: int, depth: int) -> DataFrame:
    """``region, c, s, core``: the pivots ``c`` whose Voronoi region or window holds a text."""
    blocks = F.ceil(F.col("n") / LIMIT).cast("int")
    block = F.pmod(F.xxhash64("s", F.lit(-1)), blocks).cast("int")
    # By hash; a region is left without a pivot by a chance of e^-8, and is dense then.
    part = F.least(F.lit(float(PIVOTS)), F.greatest(F.lit(8.0), 2 * F.col("n") / LIMIT)) / F.col("n")
    chance = F.pmod(F.xxhash64("s", F.lit(depth)), F.lit(1 << 30)) / (1 << 30)
    own = large.select("region", "s", "set", block.alias("block"), F.lit(False).alias("is_pivot"))
    pivots = large.filter(chance < part).select(
        "region", "s", "set", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.lit(True).alias("is_pivot"),
    )
    with_pivot = pivots.select("region").distinct()
    placed = own.join(with_pivot, "region").unionByName(pivots).groupBy("region", "block")
    return store(
        placed.applyInPandas(_assign(percent), "region long, c long, s long, core boolean"), "placed"
    )


def _block_links(dense: DataFrame, percent: int) -> DataFrame:
    """Links of the texts ``region, s, set, core, n`` by pairs of blocks, a task for each pair.

    Core texts fill the first blocks; two of them need not meet.
    """
    half = LIMIT // 2
    cores = dense.groupBy("region").agg(F.sum(F.col("core").cast("int")).alias("nc"))
    dense = dense.join(cores, "region")
    of_core = F.ceil(F.col("nc") / half).cast("int")
    of_rest = F.ceil((F.col("n") - F.col("nc")) / half).cast("int")
    at = F.pmod(F.xxhash64("s", F.lit(-2)), F.when(F.col("core"), of_core).otherwise(of_rest))
    side = F.when(F.col("core"), at).otherwise(of_core + at).cast("int")
    others = F.sequence(F.when(F.col("core"), of_core).otherwise(F.lit(0)), of_core + of_rest - 1)
    paired = dense.filter("nc < n").select(
        "region", "s", "set", "core", side.alias("side"), F.explode(others).alias("o")
    )
    pair = paired.select(
        "region", "s", "set", "core", "side",
        F.least("side", "o").alias("a"), F.greatest("side", "o").alias("b"),
    )
    return pair.groupBy("region", "a", "b").applyInPandas(_join(percent), "u long, v long")


def region_links(regions: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """Spanning links ``u, v`` of all regions ``region, s, core``; ``packed (s, set)`` has the sets.

    A region of up to ``LIMIT`` texts is compared in one task. A larger one gets
    up to ``PIVOTS`` pivots of its own, by hash: every text goes to its nearest
    pivot, and to those not further than that by twice the largest distance of a
    link, so both ends of a link meet in the region of either's nearest pivot.
    Texts linked to their pivot (``core``) are not compared with each other.

    Where texts are so close that windows hold them more than ``COPIES`` times, or
    a region is still too large after ``DEPTH`` levels, no pivot tells them apart:
    core texts of the pivot that has most of them are linked through it, and the
    others are compared in blocks.
    """
    links = []
    for depth in range(DEPTH + 1):
        regions = store(regions, "regions")
        counts = store(regions.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region-sizes")
        sized = regions.join(counts, "region").join(packed, "s")
        small = sized.filter(F.col("n").between(2, LIMIT)).withColumn("side", F.lit(0))
        links.append(small.groupBy("region").applyInPandas(_join(percent), "u long, v long"))
        if counts.filter(F.col("n") > LIMIT).isEmpty():
            break
        large = sized.filter(F.col("n") > LIMIT)
        if depth == DEPTH:
            links.append(_block_links(large, percent))
            break
        placed = _place(large, percent, depth)
        held = placed.groupBy("region").agg(F.count(F.lit(1)).alias("m"))
        spread = counts.filter(F.col("n") > LIMIT).join(held, "region", "left")
        dense = F.coalesce(F.col("m") > COPIES * F.col("n"), F.lit(True))
        spread = store(spread.select("region", dense.alias("dense")), "spread")
        links.append(
            placed.filter("core AND c <> s").select(F.col("c").alias("u"), F.col("s").alias("v"))
        )
        regions = placed.join(spread.filter("NOT dense"), "region").select(
            F.xxhash64("region", "c").alias("region"), "s", "core"
        )
        best = (
            placed.filter("core").groupBy("region", "c").agg(F.count(F.lit(1)).alias("m"))
            .groupBy("region").agg(F.max(F.struct("m", "c"))["c"].alias("c"))
        )
        hub = placed.filter("core").join(best, ["region", "c"]).select("region", "s", F.lit(True).alias("hub"))
        tight = large.join(spread.filter("dense").select("region"), "region")
        tight = tight.join(hub, ["region", "s"], "left").withColumn("core", F.coalesce("hub", F.lit(False)))
        links.append(_block_links(tight, percent))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def classes(
    docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Near-duplicate classes: ``doc_id, k1, k2, size, root, component_id``, one row per input row.

    A text's set holds its distinct runs of ``n`` words, A-Z lower-cased; a text
    of fewer words is one run. Two texts link if the intersection has at least
    ``percent`` per cent of the union. ``component_id`` is the smallest id that
    links reach; ``root`` names the component, also without ids.

    Equal sets are one class and are compared once. Every class elects pivots
    through its rarest shingles (the smallest class that has one of them is its
    pivot), so that linked classes have a pivot in common; a pivot and the
    classes that elected it are a region. A bound on distances leaves the pairs of
    a region that may link. Up to ``LIMIT`` classes that such pairs connect, in
    whatever regions, are compared at once, so that their sets move once; more
    are joined by their regions (``region_links``).
    Sets are told apart by 64-bit hashes of shingles and of sets.

    NULL or empty texts have no set, link with nothing and keep their own id.
    NULL ids are not considered for the smallest id. Repeated rows are copies. No
    rows give no rows; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    found = store(prefixes(rows, common_shingles(rows, n), n, percent), "prefixes")
    heads = found.filter("size > 0").select("s", F.explode("hs").alias("h"))
    # The smallest class that has a shingle is a pivot for all others that have it.
    lists = heads.groupBy("h").agg(F.min("s").alias("region"), F.max("s").alias("last"))
    lists = lists.filter("region <> last").select("h", "region")
    elected = store(heads.join(lists, "h").select("region", "s").distinct(), "elected")
    near = store(narrowed(elected, found.select("s", "size", "sketch"), percent), "near")
    connected = store(components(near.select("u", "v")), "near-classes")
    sizes = connected.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    connected = connected.join(sizes, "root").select(F.col("root").alias("region"), F.col("node").alias("s"), "m")
    thin = found.groupBy("s", "k1", "k2").agg(F.count(F.lit(1)).alias("n")).join(connected, "s")
    first = F.min(F.struct("k1", "k2", "n")).alias("r")
    of_class = store(
        thin.groupBy("s", "region", "m").agg(first).select("region", "s", "r.k1", "r.k2", "r.n", "m"), "one-each"
    )
    few = of_class.filter(F.col("m") <= LIMIT).drop("m")
    compared = sets(texts_of(rows, few), n).withColumns({"side": F.lit(0), "core": F.lit(False)})
    links = compared.groupBy("region").applyInPandas(_join(percent), "u long, v long")
    many = of_class.filter(F.col("m") > LIMIT).drop("m")
    if not many.isEmpty():
        packed = store(sets(texts_of(rows, many), n).select("s", "set"), "sets")
        regions = near.select("region", F.explode(F.array("u", "v")).alias("s")).distinct()
        regions = regions.join(many.select("s"), "s").withColumn("core", F.lit(False))
        links = links.unionByName(region_links(regions, packed, percent))
    roots = components(store(links, "links"))
    thin = rows.select("doc_id", "k1", "k2").alias("d")
    grouped = found.select("k1", "k2", "size", "s").distinct()
    thin = thin.join(grouped, ["k1", "k2"]).join(
        roots.withColumnRenamed("node", "s"), "s", "left"
    ).withColumn("root", F.coalesce("root", "s"))
    thin = store(thin.select("doc_id", "k1", "k2", "size", "root"), "class-rows")
    smallest = thin.filter("size > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return thin.join(smallest, "root", "left").select(
        "doc_id", "k1", "k2", "size", "root",
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
