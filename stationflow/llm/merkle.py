"""A Merkle manifest of a dataset, and proofs of many rows at once (octopus multiproof).

Rows become leaves of one tree per group; the trees' tops become the leaves of one more
tree, whose top is the root. Leaves are numbered by a range sort, so a group of any size
spreads over many tasks, and a node above is hashed from at most ``BLOCK`` nodes at a time.

Proofs are made for chunks of ``CHUNK`` neighbouring leaves. A chunk lists the coordinates
of the nodes that its proofs need and that its own leaves do not give, fetches each once,
derives the nodes that its proofs share, and writes out the proof of each leaf. Texts are
hashed where they are read and never move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.shared import store
from stationflow.operators.ordered import positions

# Children of a node, as a power of two.
BITS = 3
ARITY = 1 << BITS
# Levels hashed in one group, so a group has up to ARITY ** TIER nodes.
TIER = 4
BLOCK = ARITY**TIER
# Leaves proved together: as few as share most of their path.
CHUNK = 3_000
# Chunks that fetch the same copy of a node.
SPREAD = 1_000
# The "level" under which a tree's way to the root is stored.
WAY = 64
TOP = ""


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, pos, n, doc_id, leaf, claimed), ``nodes`` (tree, level, idx, n, hash)."""

    leaves: DataFrame
    nodes: DataFrame


def digest(fields: Sequence[Column]) -> Column:
    """Hash of fields in order: ``-`` for NULL, else the UTF-8 length, ``:`` and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaf_rows(
    docs: DataFrame,
    fields: Sequence[str],
    id_col: str = "doc_id",
    by: str = "lang",
    claimed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``doc_id``, ``tree``, ``leaf`` and ``claimed``: the leaf with some fields replaced.

    A NULL group is a tree of its own, before all others. Other columns are not looked at.
    """
    group = F.coalesce(F.concat(F.lit("1"), F.col(by).cast("string")), F.lit("0"))
    leaf = digest([F.col(c) for c in fields])
    other = leaf
    if claimed:
        other = digest([claimed.get(c, F.col(c)) for c in fields])
    return docs.select(
        F.col(id_col).alias("doc_id"), group.alias("tree"), leaf.alias("leaf"), other.alias("claimed")
    )


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``; 0 for a lone leaf."""
    bits = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)
    return F.floor((bits + F.lit(BITS - 1)) / BITS).cast("int")


def _level(nodes: Column) -> Column:
    """The nodes above an array of nodes, the last one of what is left."""
    starts = F.sequence(F.lit(1), F.size(nodes), F.lit(ARITY))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(nodes, i, ARITY), ""), 256))


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """The next ``TIER`` levels over nodes (tree, idx, n, hash) of one level."""
    per_block = TIER * BITS
    blocks = nodes.groupBy("tree", "n", F.shiftright("idx", per_block).alias("b")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "hash"))), lambda s: s["hash"]).alias("l0")
    )
    for k in range(1, TIER + 1):
        blocks = blocks.withColumn(f"l{k}", _level(F.col(f"l{k - 1}")))
    levels = F.array(
        *[
            F.struct(
                F.lit(level + k).alias("level"),
                F.shiftleft("b", per_block - BITS * k).alias("first"),
                F.col(f"l{k}").alias("hashes"),
            )
            for k in range(1, TIER + 1)
        ]
    )
    rows = blocks.select("tree", "n", F.inline(levels)).filter(F.col("level") <= _height(F.col("n")))
    rows = rows.select("tree", "n", "level", "first", F.posexplode("hashes").alias("i", "hash"))
    return rows.select("tree", "level", (F.col("first") + F.col("i")).alias("idx"), "n", "hash")


def _grow(leaves: DataFrame) -> DataFrame:
    """All nodes of all trees, the leaves at level 0."""
    zero = leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "n", F.col("leaf").alias("hash"))
    nodes, level, below = zero, 0, zero
    most = leaves.agg(F.max("n")).first()[0] or 1
    while (most - 1) >> (BITS * level):
        tier = store(_above(below.drop("level"), level), "nodes")
        nodes, level = nodes.unionByName(tier), level + TIER
        below = tier.filter(F.col("level") == level)
    return nodes


def _tops(nodes: DataFrame) -> DataFrame:
    """The highest node of each tree."""
    return nodes.filter(F.col("level") == _height(F.col("n"))).select("tree", "n", F.col("hash").alias("top"))


def build(rows: DataFrame) -> Manifest:
    """The manifest of :func:`leaf_rows`, leaves ascending by id.

    NULL ids come first, rows of one id by their leaf; equal rows are leaves each.
    An empty table has neither nodes nor root.
    """
    order = [F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("claimed")]
    leaves = store(positions(rows, ["tree"], order, "pos", "n"), "leaves")
    nodes = _grow(leaves)
    tops = store(_tops(nodes), "tops")
    upper = tops.select(F.lit(TOP).alias("tree"), F.col("tree").alias("doc_id"), F.col("top").alias("leaf"))
    upper = upper.withColumn("claimed", F.col("leaf"))
    upper = store(positions(upper, ["tree"], [F.asc("doc_id")], "pos", "n"), "uppers")
    upper_nodes = _grow(upper)
    root = _tops(upper_nodes).select(F.col("tree").alias("_one"), F.col("top").alias("root"))
    ways = _fold(Manifest(upper, upper_nodes), "doc_id string, way string", _way)
    # A way is one row per tree, and the root one row in all.
    ways = ways.withColumn("_one", F.lit(TOP)).join(F.broadcast(root), "_one")
    ways = ways.withColumnRenamed("doc_id", "tree").join(tops, "tree")
    ways = ways.select(
        "tree",
        F.lit(WAY).alias("level"),
        F.lit(0).cast("long").alias("idx"),
        "n",
        F.concat_ws("\n", "root", "top", "way").alias("hash"),
    )
    return Manifest(leaves, nodes.unionByName(store(ways, "ways")))


def _copies(level: Column, n: Column) -> Column:
    """Copies of a node, so that at most some ``SPREAD`` chunks fetch the same one.

    A node serves the chunks below its parent, a tree's way all chunks of the tree.
    """
    chunks = F.floor((n - 1) / CHUNK) + 1
    under = F.floor(F.pow(F.lit(float(ARITY)), F.least(level, F.lit(20)) + 1) / CHUNK) + 2
    fan = F.least(chunks, F.when(level == WAY, chunks).otherwise(under))
    return (F.floor(fan / SPREAD) + 1).cast("long")


def missing(own: Column, n: Column) -> Column:
    """Coordinates (level, idx) that proofs of the leaves ``own`` need and ``own`` does not give.

    The leaves may be any of the tree. Going up, the members of each touched run that
    are not known yet are missing, and the runs' parents are known from then on.
    """
    shift = lambda x, k: F.call_function("shiftright", x, k)
    struct = "struct<own:array<bigint>,need:array<struct<level:int,idx:bigint>>>"
    start = F.struct(own.alias("own"), F.array().cast("array<struct<level:int,idx:bigint>>").alias("need"))

    def step(s: Column, level: Column) -> Column:
        last = shift(n - 1, level * BITS)
        parents = F.array_distinct(F.transform(s["own"], lambda i: F.shiftright(i, BITS)))
        first = lambda p: F.shiftleft(p, BITS)
        run = lambda p: F.sequence(first(p), F.least(first(p) + (ARITY - 1), last))
        absent = F.array_except(F.flatten(F.transform(parents, run)), s["own"])
        need = F.transform(absent, lambda i: F.struct(level.alias("level"), i.alias("idx")))
        return F.struct(parents.alias("own"), F.concat(s["need"], need).alias("need")).cast(struct)

    height = _height(n)
    levels = F.when(height > 0, F.sequence(F.lit(0), height - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(levels, start.cast(struct), step)["need"]


def fetched(manifest: Manifest, ways: bool = True) -> DataFrame:
    """The nodes (tree, chunk, level, idx, hash) that each chunk lacks, each once per chunk."""
    chunk = F.floor(F.col("pos") / CHUNK).alias("chunk")
    chunks = manifest.leaves.groupBy("tree", "n", chunk).agg(F.collect_list("pos").alias("own"))
    need = missing(F.col("own"), F.col("n"))
    if ways:
        way = F.array(F.struct(F.lit(WAY).alias("level"), F.lit(0).cast("long").alias("idx")))
        need = F.concat(need, way.cast("array<struct<level:int,idx:bigint>>"))
    wanted = chunks.select("tree", "n", "chunk", F.inline(need))
    copies = _copies(F.col("level"), F.col("n"))
    # Chunks of whole runs never lack the lowest nodes.
    lowest = 0
    while CHUNK % ARITY ** (lowest + 1) == 0:
        lowest += 1
    wanted = wanted.withColumn("copy", F.col("chunk") % copies).drop("n")
    nodes = manifest.nodes.filter(F.col("level") >= lowest).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("n")
    return wanted.join(nodes, ["tree", "level", "idx", "copy"]).drop("copy")


def _fold(manifest: Manifest, schema: str, each, ways: bool = False) -> DataFrame:
    """``each`` over all chunks, with the nodes that the chunk fetched."""
    rows = manifest.leaves.withColumn("chunk", F.floor(F.col("pos") / CHUNK))
    # Renamed: both sides come from the leaves.
    found = fetched(manifest, ways).withColumnsRenamed({"tree": "of_tree", "chunk": "of_chunk"})
    pairs = rows.groupBy("tree", "chunk").cogroup(found.groupBy("of_tree", "of_chunk"))
    return pairs.applyInPandas(each, schema)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Chunk:
    """The nodes known to a chunk: for each, the hashes of its run and its place in it."""

    def __init__(self, pos, leaf, n: int, nodes: dict[tuple[int, int], str]):
        self.joined: list[dict[int, str]] = []
        self.above: dict[tuple[int, int], str] = {}
        own, level = dict(zip(pos, leaf)), 0
        while (last := (n - 1) >> (BITS * level)) > 0:
            runs = {}
            for parent in {i >> BITS for i in own}:
                members = range(parent << BITS, min((parent << BITS) + ARITY - 1, last) + 1)
                runs[parent] = "".join([own.get(i) or nodes[level, i] for i in members])
            self.joined.append(runs)
            own = {parent: _hash(run) for parent, run in runs.items()}
            level += 1
        self.height = level

    def siblings(self, level: int, i: int) -> tuple[str, str]:
        """Hashes left and right of the node in its run."""
        run, at = self.joined[level][i >> BITS], 64 * (i % ARITY)
        return run[:at], run[at + 64 :]

    def proof(self, level: int, i: int) -> str:
        """All siblings from the node to the tree's top; those above the leaves are kept."""
        if level == self.height:
            return ""
        if level and (level, i) in self.above:
            return self.above[level, i]
        text = "".join(self.siblings(level, i)) + self.proof(level + 1, i >> BITS)
        if level:
            self.above[level, i] = text
        return text

    def fold(self, i: int, leaf: str) -> str:
        """The tree's top from another leaf at this place and the original siblings."""
        for level in range(self.height):
            left, right = self.siblings(level, i)
            leaf, i = _hash(left + leaf + right), i >> BITS
        return leaf


def _chunk(rows, found) -> Chunk:
    nodes = dict(zip(zip(found["level"].tolist(), found["idx"].tolist()), found["hash"].tolist()))
    return Chunk(rows["pos"].tolist(), rows["leaf"].tolist(), int(rows["n"].iloc[0]), nodes)


def _way(rows, found):
    import pandas as pd

    chunk = _chunk(rows, found)
    ways = [
        "\n".join(",".join(chunk.siblings(level, i >> (BITS * level))) for level in range(chunk.height))
        for i in rows["pos"].tolist()
    ]
    return pd.DataFrame({"doc_id": rows["doc_id"], "way": ways})


def _prove(rows, found):
    import pandas as pd

    is_way = found["level"] == WAY
    root, subroot, *way = found.loc[is_way, "hash"].iloc[0].split("\n")
    way = [tuple(line.split(",")) for line in way if line]
    beyond = "".join(left + right for left, right in way)
    chunk = _chunk(rows, found[~is_way])
    proofs, folded = [], []
    for i, claimed in zip(rows["pos"].tolist(), rows["claimed"].tolist()):
        proofs.append(_hash(chunk.proof(0, i) + beyond))
        top = chunk.fold(i, claimed)
        for left, right in way:
            top = _hash(left + top + right)
        folded.append(top)
    out = pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["leaf"], "subroot": subroot, "root": root})
    out["proof_sha256"], out["folded_root"] = proofs, folded
    return out.assign(verified=[f == root for f in folded])


def prove(manifest: Manifest) -> DataFrame:
    """Proof of each leaf and the root that its claimed leaf folds to.

    ``verified`` says whether that is the dataset's root. NULL ids and repeated rows have
    a proof each; an empty table gives no rows.
    """
    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string"
    # Ids stay out of pandas numbers, which have no NULL.
    text = Manifest(manifest.leaves.withColumn("doc_id", F.col("doc_id").cast("string")), manifest.nodes)
    found = _fold(text, schema.replace(kind, "string", 1) + ", folded_root string, verified boolean", _prove, True)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
