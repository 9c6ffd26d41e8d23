from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import SPACED, edge_table, empty_table, lower, prose

from garnetflow.llm import components as graph
from garnetflow.llm import jaccard_join as op
from garnetflow.llm.components import components


def shingles(text):
    w = SPACED.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    reach = list(range(len(docs)))

    def root(k):
        while reach[k] != k:
            k = reach[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                reach[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(docs):
        least[root(k)] = min(least.get(root(k), d), d)
    return [(d, len(s), least[root(k)]) for k, ((d, _), s) in enumerate(zip(docs, sets, strict=True))]


def corpus():
    r = random.Random(9)
    passage = prose(77, 60)
    docs = []
    for k in range(160):
        kind = k % 8
        if kind == 0:
            t = prose(5, 300)  # one large group: edits of one text, some too far from the others
            w = t.split(" ")
            for _ in range(r.randrange(0, 14)):
                w[r.randrange(len(w))] = r.choice(["changed", "words", "here"])
            t = " ".join(w)
        elif kind == 1:
            t = prose(6, 80)  # exact copies
        elif kind == 2:
            t = prose(200 + k, 30) + " " + passage  # a passage that many share
        elif kind == 3:
            t = prose(k % 3, r.randrange(1, 9))  # short ones
        elif kind == 4:
            t = passage + " " + prose(300 + k, r.randrange(0, 20))
        else:
            t = prose(400 + k // 16, 100) + " " + prose(k, r.choice([0, 5, 12, 20, 30]))
        docs.append((1000 - k, t))
    return docs


@pytest.mark.parametrize("chunk", [1024, 7])
def test_against_brute_force(spark, chunk):
    docs = corpus()
    want = brute(docs)
    old, op.CHUNK_SETS = op.CHUNK_SETS, chunk
    try:
        got = op.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    finally:
        op.CHUNK_SETS = old
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(want)
    assert len({c for *_, c in want}) < len(docs) - 30


def test_divide_skip_finds_all():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 62, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, r.integers(100, 200), replace=False), r.integers(0, 1 << 62, r.integers(0, 60)).astype(np.uint64)])) for _ in range(120)]
    lists = op.Lists(sets)
    for q in sets:
        want = [k for k, s in enumerate(sets) if 100 * (c := len(np.intersect1d(q, s))) >= 80 * (len(q) + len(s) - c)]
        assert sorted(lists.search(q).tolist()) == want


@pytest.mark.parametrize("local", [1_000_000, 3])
def test_components(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)  # one task at the end, or stars all the way
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (10, 11), (11, 12), (12, 13), (13, 14), (14, 15), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | dict.fromkeys(range(10, 16), 10)
    star = spark.range(1, 500).selectExpr("0L as a", "id as b")
    assert {r["component"] for r in components(star, "a", "b").collect()} == {0}
    assert components(star.limit(0), "a", "b").count() == 0


def test_keep_one_and_edges(spark):
    docs = corpus()
    df = spark.createDataFrame([(d, t, d) for d, t in docs], "doc_id long, text string, row long")
    kept = op.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for *_, c in brute(docs)})
    edge = edge_table(spark)
    got = op.near_duplicates(edge).collect()
    assert len(got) == edge.count() and {(r["doc_id"], r["n_shingles"]) for r in got} >= {(1, 0), (2, 0), (3, 1), (4, 0), (5, 1), (None, 3)}
    assert op.near_duplicates(empty_table(spark)).count() == 0


def test_keep_one_leaves_one_row_of_each_component(spark):
    a, b, c, d = (prose(k, 200) for k in (901, 902, 903, 904))
    near = a + " end"
    rows = [(None, a, "null"), (5, a, "copy"), (7, near, "near"), (None, b, "null 1"), (None, b, "null 2"), (8, c, "x"), (8, c, "x"), (8, c, "y"), (9, d, "one"), (9, d + " more", "two"), (9, b + d, "alone"), (3, None, "empty"), (3, None, "empty"), (None, " ", "blank")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = op.keep_one(df.repartition(3))
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    assert [r for r in got if r[1] in (a, near)] == [(5, a, "copy")]
    assert len([r for r in got if r[1] == b]) == 1 and len([r for r in got if r[1] == c]) == 1
    assert len([r for r in got if r[1] in (d, d + " more")]) == 1 and (9, b + d, "alone") in got
    assert len(got) == 8 and got.count((3, None, "empty")) == 2 and (None, " ", "blank") in got
    again = [tuple(r) for r in op.keep_one(df.repartition(2, "lang")).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)
    equal = spark.createDataFrame([(1, a)] * 50, "doc_id long, text string")
    assert [tuple(r) for r in op.keep_one(equal.repartition(4)).collect()] == [(1, a)]


def test_a_family_is_not_compared_with_itself_again(spark, monkeypatch):
    """A large family of near copies, a chain of others, and texts of their own in one block: all links are found, and sets do not move for each pair of chunks."""
    monkeypatch.setattr(op, "CHUNK_SETS", 16)
    r = random.Random(4)
    base, tail = prose(31, 120).split(" "), prose(32, 40)
    docs = []
    for k in range(200):
        w = list(base)
        w[r.randrange(len(w))] = f"own{k}"
        docs.append((k, " ".join(w)))
    chain = prose(33, 120).split(" ")
    for k in range(40):  # each links with the next few, the ends do not
        chain = [*chain[3:], *prose(500 + k, 3).split(" ")]
        docs.append((300 + k, " ".join(chain)))
    docs += [(400 + k, tail + " " + prose(800 + k, r.randrange(5, 90))) for k in range(60)]
    dealt = []
    search = op._search
    monkeypatch.setattr(op, "_search", lambda sets, placed, pairs: (dealt.append(pairs.count()), search(sets, placed, pairs))[1])
    got = op.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == sorted(brute(docs))
    assert len(dealt) == 3 and sum(dealt) < 100  # 13 chunks of the family alone would be 91 pairs
