"""Phrases whose words occur together more than apart, counted in a HAT-trie.

A task keeps the counts of its texts in a trie over word ids: hash containers for what
follows a first word, burst by the second word once they are large. When there are too
many entries, whole subtrees leave as sorted runs, dealt by prefix partition: the first two
words, and for three words one of ``SPLIT`` shares of the third, so that a hot pair spreads.
A run names its words once and its phrases by them. A prefix partition merges its runs and
keeps what is frequent. As no part of a phrase is
rarer than the phrase, everything later needs only these.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stationflow.llm.flat import mix
from stationflow.llm.shared import bound_batches, store

# Bits of a word id; three ids make one key.
BITS = 21
MASK = (1 << BITS) - 1
# Entries of a container before it bursts, the containers it bursts into (each for some of the
# second words), and the entries of all tries of a task before some leave.
BURST, FAN = 4_096, 64
ENTRIES = 1_000_000
# Words, and bytes of words, that a task tells apart before everything leaves.
WORDS, WORD_BYTES = 500_000, 64 << 20
# Bytes of a group's text that are counted at a time, and how many times that may wait in all groups.
SLICE, WAITING = 1 << 20, 8
# Prefix partitions: some at least, so that there are no more runs than entries times a
# constant, and one for so many bytes of text.
PARTS, PART_BYTES = 256, 4 << 20
SPLIT = 64
# Entries of a prefix partition before equal ones are added up.
PENDING = 2_000_000
# Shares of a language that are ranked by themselves before the last ranking.
SHARES = 64

# A-Z as a-z, white space within a piece as blanks, piece ends as a byte that UTF-8 does not have.
END = b"\xff"
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + b"\t" + _ENDS, bytes(range(97, 123)) + b" " + END * len(_ENDS)
)
_BETWEEN = re.compile(rb"[\t-\r .,;:!?]")


class Words(dict):
    """Ids of words from 1 in order of arrival; the end of a piece is 0."""

    def __init__(self):
        super().__init__({END: 0})
        self.names = [b""]
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        self.names.append(word)
        self.bytes += len(word)
        n = self[word] = len(self.names) - 1
        return n

    def full(self) -> bool:
        return len(self.names) > WORDS or self.bytes > WORD_BYTES


class Burst(list):
    """A burst container: ``FAN`` containers, each for some of the second words."""


class HatTrie:
    """Counts of one to three word ids, packed in one number, by first word."""

    def __init__(self):
        self.first: dict[int, dict] = {}
        self.sizes: dict[int, int] = {}
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct sorted keys."""
        if not len(keys):
            return
        firsts = keys >> (2 * BITS)
        cuts = np.flatnonzero(np.diff(firsts)) + 1
        starts = np.concatenate(([0], cuts)).tolist()
        ends = np.concatenate((cuts, [len(keys)])).tolist()
        rest, counts = (keys & ((1 << 2 * BITS) - 1)).tolist(), counts.tolist()
        for word, low, high in zip(firsts[starts].tolist(), starts, ends):
            node = self.first.get(word)
            if node is None:
                node = self.first[word] = dict(zip(rest[low:high], counts[low:high]))
                grown = len(node)
                if grown > BURST:
                    self.first[word] = self._burst(node)
            elif type(node) is Burst:
                before = sum(map(len, node))
                for key, n in zip(rest[low:high], counts[low:high]):
                    below = node[(key >> BITS) % FAN]
                    below[key] = below.get(key, 0) + n
                grown = sum(map(len, node)) - before
            else:
                before, get = len(node), node.get
                for key, n in zip(rest[low:high], counts[low:high]):
                    node[key] = get(key, 0) + n
                grown = len(node) - before
                if len(node) > BURST:
                    self.first[word] = self._burst(node)
            self.sizes[word] = self.sizes.get(word, 0) + grown
            self.size += grown

    @staticmethod
    def _burst(container: dict) -> Burst:
        node = Burst({} for _ in range(FAN))
        for key, n in container.items():
            node[(key >> BITS) % FAN][key] = n
        return node

    def take(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Removes the largest subtrees until at most ``keep`` entries stay; their keys and counts."""
        words, sizes, containers = [], [], []
        for word in sorted(self.sizes, key=self.sizes.get, reverse=True) if keep else list(self.sizes):
            if self.size <= keep:
                break
            size = self.sizes.pop(word)
            self.size -= size
            words.append(word)
            sizes.append(size)
            node = self.first.pop(word)
            if type(node) is Burst:
                containers += node
            else:
                containers.append(node)
        total = sum(sizes)
        keys = np.fromiter(chain.from_iterable(containers), np.int64, total)
        keys |= np.repeat(np.array(words, np.int64) << 2 * BITS, sizes)
        return keys, np.fromiter(chain.from_iterable(c.values() for c in containers), np.int64, total)


def count(ids: np.ndarray, old: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of all runs of up to ``most`` words that end after the first ``old`` ids."""
    keys = []
    for n in range(1, most + 1):
        low = max(old - n + 1, 0)
        rows = [ids[low + k : len(ids) - n + 1 + k] for k in range(n)]
        inside = np.logical_and.reduce([r > 0 for r in rows])
        key = np.zeros(int(inside.sum()), np.int64)
        for k, r in enumerate(rows):
            key |= r[inside] << (BITS * (2 - k))
        keys.append(key)
    return np.unique(np.concatenate(keys), return_counts=True)


def slices(text: bytes) -> Iterator[bytes]:
    """A text in slices that no word crosses."""
    low = 0
    while low < len(text):
        cut = _BETWEEN.search(text, low + SLICE) if len(text) - low > SLICE else None
        high = cut.start() if cut else len(text)
        yield text[low:high]
        low = high


def planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on, which packs better."""
    return numbers.reshape(-1).view(np.uint8).reshape(numbers.size, -1).T.tobytes()


def from_planes(data: bytes, kind: type, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T.copy().view(kind).reshape(n)


class Counter:
    """The tries of a task, by group, and the runs that leave them."""

    def __init__(self, parts: int, most: int):
        self.parts, self.most = parts, most
        self.words = Words()
        self.tries: dict[str, HatTrie] = {}
        self.waiting: dict[str, list[bytes]] = {}
        self.bytes: dict[str, int] = {}

    def add(self, group: str, text: bytes) -> Iterator[tuple]:
        if len(text) > SLICE:
            yield from self._long(group, text)
            return
        self.waiting.setdefault(group, []).append(text)
        self.bytes[group] = self.bytes.get(group, 0) + len(text) + 1
        if self.bytes[group] > SLICE:
            yield from self._some(group)
        elif sum(self.bytes.values()) > WAITING * SLICE:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        for group in list(self.waiting):
            yield from self._some(group)

    def _some(self, group: str) -> Iterator[tuple]:
        del self.bytes[group]
        self._count(group, self._ids(END.join(self.waiting.pop(group))), 0)
        yield from self._leave()

    def _long(self, group: str, text: bytes) -> Iterator[tuple]:
        """One text in slices; the last words of each go before the next."""
        carried: list[bytes] = []
        for part in slices(text):
            words = self._split(part)
            ids = [self.words[w] for w in carried + words]
            self._count(group, np.array(ids, np.int64), len(carried))
            # Words, not ids, as ids start anew when everything leaves.
            carried = (carried + words)[-(self.most - 1) :]
            yield from self._leave()

    @staticmethod
    def _split(text: bytes) -> list[bytes]:
        return text.translate(_TABLE).replace(END, b" \xff ").split()

    def _ids(self, text: bytes) -> np.ndarray:
        words = self.words
        return np.array([words[w] for w in self._split(text)], np.int64)

    def _count(self, group: str, ids: np.ndarray, old: int) -> None:
        self.tries.setdefault(group, HatTrie()).add(*count(ids, old, self.most))

    def _leave(self) -> Iterator[tuple]:
        if self.words.full():
            yield from self.rest()
        elif (total := sum(t.size for t in self.tries.values())) > ENTRIES:
            # Half of all; the largest tries first and whole, so that runs are few and long.
            more = total - total // 2
            for group, trie in sorted(self.tries.items(), key=lambda x: x[1].size, reverse=True):
                before = trie.size
                yield from self._runs(group, *trie.take(max(before - more, 0)))
                more -= before - trie.size
                if more <= 0:
                    break

    def rest(self) -> Iterator[tuple]:
        """All that is left."""
        for group, trie in self.tries.items():
            yield from self._runs(group, *trie.take(0))
        self.tries, self.words = {}, Words()

    def _runs(self, group: str, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        """(part, group, run) for each prefix partition, in the order of the words."""
        import zstandard

        if not len(keys):
            return
        columns = [keys >> 2 * BITS, (keys >> BITS) & MASK, keys & MASK]
        rank = np.zeros(len(self.words.names), np.int64)
        for c in columns:
            rank[c] = 1
        rank[0] = 1
        used = sorted(np.flatnonzero(rank).tolist(), key=self.words.names.__getitem__)
        rank[used] = np.arange(len(used))
        # From now on words are their rank; the empty one is first.
        columns = [rank[c] for c in columns]
        names = [self.words.names[i] for i in used]
        hashes = np.array([zlib.crc32(w) for w in names], np.uint64)
        share = np.where(columns[2] > 0, hashes[columns[2]] % np.uint64(SPLIT) + np.uint64(1), np.uint64(0))
        part = mix(mix(hashes[columns[0]] + np.uint64(zlib.crc32(group.encode()) << 32)) + hashes[columns[1]] * np.uint64(31))
        part = (mix(part + share) % np.uint64(self.parts)).astype(np.int64)
        # Keys are distinct, so only the parts need a stable order; 16 bits are dealt out without comparing.
        order = np.argsort(columns[0] << 2 * BITS | columns[1] << BITS | columns[2])
        dealt = part[order].astype(np.uint16 if self.parts <= 1 << 16 else np.int64)
        order = order[np.argsort(dealt, kind="stable")]
        part, counts = part[order], counts[order]
        columns = np.stack([c[order] for c in columns])
        cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
        pack = zstandard.ZstdCompressor(level=1).compress
        place = np.empty(len(names), np.uint32)
        for low, high in zip([0, *cuts], [*cuts, len(part)]):
            own = np.sort(columns[:, low:high], axis=None)
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            place[own] = np.arange(len(own))
            words = b"\n".join([names[i] for i in own.tolist()])
            # First words ascend, so their steps are small.
            ids = place[columns[:, low:high]].astype("<u4")
            ids[0, 1:] = np.diff(ids[0])
            run = (high - low).to_bytes(8, "little") + planes(counts[low:high]) + planes(ids)
            yield int(part[low]), group, pack(run + words)


class Merge:
    """Runs of one prefix partition, added up."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, run: bytes) -> None:
        n = int.from_bytes(run[:8], "little")
        counts = from_planes(run, np.int64, n, 8)
        ids = from_planes(run, np.uint32, 3 * n, 8 + 8 * n).reshape(3, n).astype(np.int64)
        ids[0] = np.cumsum(ids[0])
        known = self.words
        own = np.array([known.setdefault(w, len(known)) for w in run[8 + 20 * n :].split(b"\n")], np.int64)
        self.waiting.append((own[ids], counts))
        self.pending += n
        if self.pending > PENDING:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases as three word numbers each, and their counts."""
        ids = np.concatenate([i for i, _ in self.waiting], axis=1)
        counts = np.concatenate([c for _, c in self.waiting])
        if len(self.words) <= 1 << BITS:
            keys = ids[0] << 2 * BITS | ids[1] << BITS | ids[2]
        else:
            # Two numbers of 32 bits fit in one of 64, so pairs are numbered first.
            keys = np.unique(ids[0] << 32 | ids[1], return_inverse=True)[1] << 32 | ids[2]
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sums = np.add.reduceat(counts[order], first)
        ids = ids[:, order[first]]
        self.waiting = [(ids, sums)]
        # As many again may come, so that adding up costs no more than twice.
        self.pending = 0
        return ids, sums

    def frequent(self, least: int) -> tuple[list[bytes], list[int], int]:
        """Phrases of at least ``least`` occurrences, their counts, and the number of all words."""
        ids, sums = self.total()
        names = list(self.words)
        none = self.words.get(b"", -1)
        words = int(sums[ids[1] == none].sum())
        often = sums >= least
        phrases = [b" ".join([names[i] for i in row if i != none]) for row in ids[:, often].T.tolist()]
        return phrases, sums[often].tolist(), words


def runs(docs: DataFrame, parts: int, most: int, text_col: str, by: str) -> DataFrame:
    """Sorted runs (part, lang, run) of all texts."""
    import pyarrow as pa

    rows = docs.select(
        F.coalesce(F.col(by).cast("string"), F.lit("und")).alias("lang"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    ).filter("text IS NOT NULL")
    names = ["part", "lang", "run"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        counter = Counter(parts, most)
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                yield from counter.add(lang, text.as_py())
        yield from counter.flush()
        yield from counter.rest()

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for row in counted(batches):
            rows.append(row)
            held += len(row[2])
            if held > SLICE:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    return rows.mapInArrow(leave, "part long, lang string, run binary")


def merged(found: DataFrame, least: int) -> DataFrame:
    """Phrases of at least ``least`` occurrences, and with a NULL phrase the words of each partition."""
    import pyarrow as pa

    names = ["lang", "phrase", "words", "f"]

    def rows(lang: str, merge: Merge) -> pa.RecordBatch:
        phrases, counts, words = merge.frequent(least)
        columns = [
            pa.array([lang] * (len(phrases) + 1), pa.string()),
            pa.array([*phrases, None], pa.binary()).cast(pa.string()),
            pa.array([*[p.count(b" ") + 1 for p in phrases], 0], pa.int32()),
            pa.array([*counts, words], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        now, part = None, None
        for b in batches:
            for key, run in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2)):
                if key != now:
                    if part:
                        yield rows(now[1], part)
                    now, part = key, Merge()
                part.add(unpack(run.as_py()))
        if part:
            yield rows(now[1], part)

    dealt = found.repartition("part").sortWithinPartitions("part", "lang")
    return dealt.mapInArrow(merge, "lang string, phrase string, words int, f long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, wide(left) * wide(right)).cast("long")


def collocations(
    docs: DataFrame,
    most: int = 3,
    least: int = 10,
    inside: int = 50,
    top: int = 2_000,
    text_col: str = "text",
    by: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of two to ``most`` words of each group with their counts and score.

    A phrase with ``least`` occurrences or more is dropped if a longer one that has it inside
    occurs at least ``inside`` per cent as often. A NULL group is ``und``, a NULL text empty;
    a text of any length is counted in slices. Repeated rows count each. Equal scores go by
    count, then by the phrase in byte order. Other columns are not looked at.
    """
    if most not in (2, 3):
        raise ValueError("phrases have two or three words")
    bound_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    parts = max(PARTS, size // PART_BYTES)
    counts = store(merged(runs(docs, parts, most, text_col, by), least), "phrases")
    totals = counts.filter("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.filter("phrase IS NOT NULL")
    part = lambda p, n: frequent.select("lang", F.col("phrase").alias(p), F.col("f").alias(n))
    phrases = frequent.filter("words > 1")
    cuts = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cut = lambda n: F.call_function("substring_index", F.col("phrase"), F.lit(" "), n)
    cuts = cuts.withColumns({"head": cut(F.col("k")), "tail": cut(F.col("k") - F.col("words"))})
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    lowest = F.min(F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    around = phrases.filter("words = 3").select(
        "lang", F.explode(F.array(cut(F.lit(2)), cut(F.lit(-2)))).alias("phrase"), F.col("f").alias("longer")
    )
    around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))
    )
    # A large group is ranked in shares first; what a share ranks below the top is below it in all.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    kept = kept.withColumn("_share", share)
    for group in (["lang", "_share"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
        kept = kept.filter(F.col("rank") <= top)
    return kept.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
