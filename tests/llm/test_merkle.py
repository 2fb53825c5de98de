"""The manifest against a plain tree over small tables."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from pyspark.sql import functions as F

from stationflow.llm import merkle, queries
from stationflow.llm.shared import UPPER

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos int, n int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """Levels of a tree, lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def way(levels, i):
    """(left, right) of each level from a leaf up."""
    for level in levels[:-1]:
        run = i - i % 8
        yield "".join(level[run:i]), "".join(level[i + 1 : run + 8])
        i //= 8


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            steps = [*way(trees[g], i), *way(top, at)]
            claimed = list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4]:
                claimed[4] = row[4].translate(str.maketrans(UPPER, UPPER.lower()))
            folded = leaf(claimed)
            for left, right in steps:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in steps))
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 7, 7) for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(tampered, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    made = merkle.build(merkle.leaf_rows(docs, FIELDS, claimed={"text": text}))
    return made, sorted([tuple(r) for r in merkle.prove(made).collect()], key=str)


LANGS = ["en", "de", None, "ä", *[f"x{i}" for i in range(9)]]


def rows(n):
    """Ids with gaps, NULLs and repeats; one tree holds most of them."""
    out = [(i * 3, f"s{i % 4}", "en" if i % 3 else LANGS[i % 13], i, f"Text É {i}") for i in range(n)]
    return out + [(None, None, None, None, None), (6, "s", "en", 1, ""), (6, "s", "en", 1, ""), (None, "s", "en", 0, "A" * 100_000)]


@pytest.mark.parametrize("n", [0, 1, 700])
def test_equals_a_plain_tree(spark, monkeypatch, n):
    # Small chunks that cut runs, and several copies of the nodes above.
    monkeypatch.setattr(merkle, "CHUNK", 21)
    monkeypatch.setattr(merkle, "SPREAD", 2)
    monkeypatch.setattr(merkle, "TIER", 2)
    made, found = run(spark, rows(n))
    assert found == brute(rows(n))
    if n == 700:
        many = merkle.fetched(made).groupBy("tree", "chunk", "level", "idx").count()
        assert many.filter("count > 1").count() == 0
        assert made.nodes.filter("level = 64").count() == len({r[2] for r in rows(n)})


def test_missing_is_the_least_union(spark):
    own = spark.createDataFrame([([0, 1, 9, 70], 80), ([5], 1), (list(range(8)), 9)], "own array<bigint>, n bigint")
    got = [
        {tuple(x) for x in r[0]}
        for r in own.select(merkle.missing(F.col("own"), F.col("n"))).collect()
    ]
    zero = {*range(8), *range(8, 16), *range(64, 72)} - {0, 1, 9, 70}
    one = {*range(2, 8), 9}
    assert got[0] == {(0, i) for i in zero} | {(1, i) for i in one}
    assert got[1] == set()
    assert got[2] == {(1, 1)}


def test_one_row_and_empty_table(spark):
    one = [(1, "a", "en", 2, "Ab")]
    assert run(spark, one)[1] == brute(one)
    assert run(spark, [])[1] == []


def test_text_ids_keep_their_kind(spark):
    docs = spark.createDataFrame([("b", "en"), ("a", "en"), (None, "en")], "doc_id string, lang string")
    found = merkle.prove(merkle.build(merkle.leaf_rows(docs, ["doc_id"])))
    assert {(r.doc_id, r.verified) for r in found.collect()} == {("a", True), ("b", True), (None, True)}


def test_query_finds_every_changed_text(spark, sf):
    found = queries.QUERIES["op11_merkle_manifest"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    changed = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").rlike("[A-Z]")
    wrong = found.join(docs, "doc_id").filter(F.col("verified") == F.coalesce(changed, F.lit(False)))
    assert wrong.count() == 0 and found.count() == docs.count()
