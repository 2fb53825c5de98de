"""Ids against the tokenizer itself, packing against its rules and a plain best fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stationflow.llm import packing, queries

FILES = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
PLAIN = Tokenizer.from_file(FILES[0])
ENCODER = packing.Encoder(*FILES)


def ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


PIECES = st.sampled_from(
    ["a", "it's", "don'T", "  ", " ", "\n", "\t", "\xa0", "\x1c", "\x85", "é", "ſ", "中文", "12", "½", "²",
     "<|endoftext|>", "<|", "|>", "_x", "...", " ", "́", "😀", "'ll", "ABC", "\r\n", "ǅ", "​"]
)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.lists(PIECES, max_size=30).map("".join), st.text(max_size=60)))
def test_ids_equal_the_tokenizer(text):
    assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == ids(text)


def test_long_texts_are_cut_where_nothing_changes(monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 7)
    for text in ("one two  three\n four five's " * 20, "x" * 100, " a b  c " * 30, " " * 50):
        assert np.frombuffer(packing.Encoder(*FILES).encode(text), "<u4").tolist() == ids(text)


def test_ranks_are_the_merges():
    """The faster way holds only if each merge makes the next id."""
    import json

    model = json.load(open(FILES[0]))["model"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    assert all(model["vocab"]["".join(m)] == 256 + i for i, m in enumerate(pairs))


def best_fit(lengths, capacity):
    gaps, n = [], 0
    for size in sorted(lengths, reverse=True):
        at = bisect_left(gaps, size)
        left = gaps.pop(at) if at < len(gaps) else capacity
        n += left == capacity
        if left > size:
            insort(gaps, left - size)
    return n


def check(rows, capacity):
    """Sequences that the rows fill, each from 0 without gaps and within the capacity."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


RNG = np.random.default_rng(3)
SHAPES = {
    "mixed": [*RNG.integers(1, 64, 900).tolist(), *[64] * 5],
    "small": RNG.integers(1, 6, 700).tolist(),
    "one size": [21] * 400,
    "large": RNG.integers(33, 64, 300).tolist(),
    "one row": [3],
    "full": [64] * 4,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_packing_is_as_tight_as_best_fit(spark, shape):
    lengths = SHAPES[shape]
    rows = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "doc_id long, length long, gap string")
    found = [r.asDict() for r in packing.pack(rows, 64).collect()]
    assert sorted((r["doc_id"], r["length"], r["gap"]) for r in found) == [(i, n, "x") for i, n in enumerate(lengths)]
    assert check(found, 64) <= best_fit(lengths, 64) + 1


def test_sweep_takes_the_smallest_gap():
    sizes, taken = {5: 3, 2: 1}, {5: 10}
    matches, changed = packing.sweep(sizes, taken, {6: 1, 11: 1, 4: 2}, 20)
    assert [(m.size, m.first, m.last, m.gap, m.each, m.offset) for m in matches] == [
        (5, 10, 11, 6, 1, 14),
        (5, 11, 13, 11, 2, 9),
        (2, 0, 1, 4, 1, 16),
    ]
    assert sorted(changed) == [(4, 0, 1, 2), (6, 0, 1, 1), (11, 0, 1, 1)] or sorted(changed) == [(4, 1, 2, 2), (6, 0, 1, 1), (11, 0, 1, 1)]
    assert sizes == {5: 0, 2: 0} and taken == {5: 13, 2: 1}


def test_odd_rows(spark):
    rows = [(None, None, "k"), (1, "", "k"), (1, "", "k"), (2, "w " * 5_000, None), (3, "y" * 60_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    found = [r.asDict() for r in packing.pack(packing.pieces(docs, *FILES)).collect()]
    want = []
    for i, text, _ in rows:
        every, at = [*ids(text or ""), 0], 0
        for k, n in enumerate(packing.piece_lengths(len(every), 2048)):
            want.append((i, k, at, n, zlib.crc32(np.array(every[at : at + n], "<u4").tobytes())))
            at += n
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    check(found, 2048)
    assert packing.pack(packing.pieces(docs.limit(0), *FILES)).count() == 0


def test_query_packs_every_document_tightly(spark, sf):
    found = [r.asDict() for r in queries.QUERIES["op13_best_fit_packing"](spark, sf).collect()]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lengths = defaultdict(int)
    for r in found:
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {i: len(ids(t)) + 1 for i, t in docs.items()}
    assert check(found, 2048) <= best_fit([r["length"] for r in found], 2048) + 1
