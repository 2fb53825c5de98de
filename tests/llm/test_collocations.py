"""Phrase counts against a plain count, and the trie against a dict."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from stationflow.llm import collocations as ops
from stationflow.llm.shared import UPPER

FOLD = str.maketrans(UPPER, UPPER.lower())


def brute(rows, most=3, least=10, inside=50, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, most + 1):
                for i in range(len(words) - n + 1):
                    counts[lang or "und"][tuple(words[i : i + n])] += 1
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            score, _, left, right = min(
                (10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))
            )
            longer = [b for q, b in found.items() if len(q) > len(p) and p in (q[:-1], q[1:])]
            if not any(100 * b >= inside * a for b in longer):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        total = sum(a for p, a in c.items() if len(p) == 1)
        for i, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, total, -score))
    return sorted(out)


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    words = ["New", "york", "café", "\x1cx", "中", "of", "the", "THE", "a b", "z"]
    for i in range(n):
        some = [words[k] for k in rng.integers(0, len(words), 30)]
        gaps = rng.choice([" ", "  ", "\t", ". ", "\n", " ", " ", " "], 30)
        yield ["en", "de", None, "und"][i % 4], "".join(a + b for a, b in zip(some, gaps))


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string")
    return sorted(tuple(r) for r in ops.collocations(docs, **options).collect())


LONG = "in the beginning was the word, and so on " * 3_000


@pytest.mark.parametrize("small", [False, True])
def test_equals_a_plain_count(spark, monkeypatch, small):
    if small:
        # Containers burst, subtrees leave, ids start anew and long texts are sliced.
        for name, value in {"BURST": 3, "ENTRIES": 50, "WORDS": 30, "SLICE": 40, "SPLIT": 2, "SHARES": 3, "FAN": 2, "PENDING": 20, "PARTS": 5}.items():
            monkeypatch.setattr(ops, name, value)
    rows = [*texts(120), (None, None), ("en", ""), ("en", "..."), *[("fr", "hot pair x, hot pair y. hot pair z")] * 20]
    rows += [("long", LONG[: 8_000 if small else None])]
    assert run(spark, rows) == brute(rows)
    if not small:
        assert run(spark, rows, most=2, least=5, top=3) == brute(rows, 2, 5, top=3)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_products_beyond_64_bits(spark):
    frame = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, l long, r long")
    got = frame.select(ops._score(frame.a, frame.l, frame.r)).first()[0]
    assert got == 10**6 * 3_000_000_000**2 // (4_000_000_000 * 5_000_000_000)


def test_trie_keeps_every_count(monkeypatch):
    monkeypatch.setattr(ops, "BURST", 5)
    rng, trie, want = np.random.default_rng(2), ops.HatTrie(), Counter()
    got = Counter()
    for _ in range(30):
        ids = rng.integers(0, 6, 200)
        keys, counts = ops.count(ids, 0, 3)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        trie.add(keys, counts)
        assert trie.size == sum(trie.sizes.values())
        out = trie.take(trie.size - 10)
        for k, n in zip(*(x.tolist() for x in out)):
            got[k] += n
    for k, n in zip(*(x.tolist() for x in trie.take(0))):
        got[k] += n
    assert got == want and trie.size == 0 and any(k & ops.MASK for k in want)


def test_the_largest_tries_leave_whole(monkeypatch):
    monkeypatch.setattr(ops, "ENTRIES", 100)
    counter = ops.Counter(1, 3)
    for group, n in (("a", 5), ("b", 60), ("c", 10)):
        counter._count(group, counter._ids(b" ".join(b"%d" % i for i in range(n))), 0)
    sizes = {g: t.size for g, t in counter.tries.items()}
    assert [r[1] for r in counter._leave()] == ["b"]
    assert {g: t.size for g, t in counter.tries.items() if g != "b"} == {"a": sizes["a"], "c": sizes["c"]}
    assert sum(t.size for t in counter.tries.values()) <= sum(sizes.values()) / 2


@pytest.mark.parametrize("bits", [21, 2])
def test_runs_and_merges_sort_their_keys_once(monkeypatch, bits):
    """No inverse of a sort for runs, nor for a partition whose word numbers fit in one key."""
    monkeypatch.setattr(ops, "ENTRIES", 200)
    rows, counter, unique = list(texts(40)), ops.Counter(7, 3), np.unique
    if bits == 21:
        monkeypatch.setattr(ops.np, "unique", lambda x, return_inverse=False, **k: None if return_inverse else unique(x, **k))
    runs, want, got = [], Counter(), Counter()
    for _, text in rows:
        runs += counter.add("en", text.encode())
    runs += [*counter.flush(), *counter.rest()]
    monkeypatch.setattr(ops, "BITS", bits)
    parts = {}
    for part, _, run in runs:
        parts.setdefault(part, ops.Merge()).add(zstandard.ZstdDecompressor().decompress(run))
    for merge in parts.values():
        merge.total()
        phrases, counts, _ = merge.frequent(1)
        assert len(set(phrases)) == len(phrases)
        got.update(dict(zip(phrases, counts)))
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(FOLD)):
            words = [w.encode() for w in re.findall(r"[^\x20\x09]+", piece)]
            want.update(b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    assert got == want and len(runs) >= 14
