from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import EDGES, edge_table, empty_table, prose

from garnetflow.llm import packing as op
from garnetflow.llm.subwords import Words


def check(rows, texts, end=(1,)):
    tokenizer = Words("word_bpe_49k.json").tokenizer
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["context"]))
        pieces[r["doc_id"]].append(r)
    for s in sequences.values():
        s.sort()
        assert [o for o, _, _ in s] == np.cumsum([0] + [n for _, n, _ in s])[:-1].tolist()
        total = sum(n for _, n, _ in s)
        assert total <= 2048 and total & (total - 1) == 0 and {c for _, _, c in s} == {total}  # no padding
    for d, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + list(end), "<u4")
        parts = sorted(pieces[d], key=lambda r: r["start"])
        assert [p["start"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
        assert sum(p["length"] for p in parts) == len(ids) == parts[0]["doc_tokens"]
        assert all(p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in parts)


@pytest.mark.parametrize("work", [500, 2 << 20])
def test_pieces(spark, work):
    texts = {k: prose(k, 3 * k % 700) for k in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    old, op.WORK = op.WORK, work
    try:
        rows = op.pack_documents(df).collect()
    finally:
        op.WORK = old
    check(rows, texts)
    assert len({r["context"] for r in rows}) > 2
    by_step = defaultdict(set)
    for r in rows:
        by_step[r["step_group"]].add((r["sequence_id"], r["context"]))
    assert all(len({c for _, c in s}) == 1 and sum(c for _, c in s) <= op.STEP for s in by_step.values())


def test_step_groups_are_balanced_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(op, "STEP", 8192)
    texts = {k: prose(k, 40 + 37 * k % 900) for k in range(150)}
    rows = op.pack_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)).collect()
    check(rows, texts)
    groups, tasks = defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for r in rows:
        groups[r["context"]][r["step_group"]].add(r["sequence_id"])
        tasks[r["step_group"]].add(r["sequence_id"] >> 32)
    for context, of in groups.items():
        sizes, n = [len(s) for s in of.values()], len({q for s in of.values() for q in s})
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and len(sizes) == -(-n * context // 8192)
        assert {g >> 40 for g in of} == {context.bit_length() - 1}
    assert max(map(len, tasks.values())) > 1  # a group takes sequences of several tasks


def test_null_ids_in_several_tasks(spark):
    texts = [prose(k, 300) for k in range(12)]
    rows = op.pack_documents(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(4)).collect()
    tokenizer = Words("word_bpe_49k.json").tokenizer
    assert sum(r["length"] for r in rows) == sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in texts) and {r["doc_id"] for r in rows} == {None}


def test_packer_keeps_every_id():
    p, got = op.Packer(256, 16), []
    for k, n in enumerate([0, 1, 255, 256, 257, 1000, 31, 16, 64, 128, 3]):
        got += p.add(k, n)
    got += [*p.pack(), *p.finish()]
    assert sum(n for w in got for _, _, n in w) == sum([0, 1, 255, 256, 257, 1000, 31, 16, 64, 128, 3]) and p.total == 0
    assert all(bin(sum(n for _, _, n in w)).count("1") == 1 for w in got)


def test_edges(spark):
    docs = edge_table(spark)
    rows = op.pack_documents(docs).collect()
    assert len({r["doc_id"] for r in rows}) == len({d for d, _ in EDGES})
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 2 * [r["doc_tokens"] for r in rows if r["doc_id"] == 3][0]
    assert op.pack_documents(empty_table(spark)).count() == 0
    assert {r["doc_id"] for r in op.pack_documents(docs, end_id=None).collect()}.isdisjoint({1, 2, 4})
