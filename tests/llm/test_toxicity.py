from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import edge_table, empty_table, prose
from pyspark.sql import functions as F

from garnetflow.llm import toxicity as op


def corpus(n=600):
    r = random.Random(3)
    rows = []
    for k in range(n):
        toxic = k % 5 == 0
        w = prose(1000 + k, r.randrange(20, 200)).split(" ")
        if toxic:
            for _ in range(r.randrange(2, 6)):
                w.insert(r.randrange(len(w)), r.choice(["moron", "vilefool", "scumbag"]) + r.choice(["", "en", "s"]))
        rows.append((k, " ".join(w), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    got = {r["doc_id"]: r for r in op.score(df.select("doc_id", "text"), op.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))).collect()}
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _, _ in rows)
    held = [(got[d]["predicted"], y) for d, _, y in rows if got[d]["held_out"]]
    assert np.mean([p == y for p, y in held]) > 0.97 and sum(y for _, y in held) > 10
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_pairs_are_learned():
    """Two terms that mean something only together: additive weights cannot tell these, factors can."""
    r = np.random.default_rng(1)
    a, b, labels, texts = 11, 12, [], []
    for k in range(1200):
        has = (k % 2, k // 2 % 2)
        texts.append(np.unique(np.concatenate([np.array([a] * has[0] + [b] * has[1], np.int64), r.integers(100, 160, 5)])))
        labels.append(float(has[0] == has[1]))
    old = op.EPOCHS
    op.EPOCHS = 60
    try:
        m = op.fit(texts, np.array(labels))
    finally:
        op.EPOCHS = old
    at = {p: k for k, p in enumerate(m.places.tolist())}
    assert a in at and b in at and float(m.factors[at[a]] @ m.factors[at[b]]) > 0.5


def test_same_rows_same_model(spark):
    rows = corpus(200)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    one, two = (op.train(d.select("doc_id", "text"), d.select("doc_id", "toxic")) for d in (df, df.repartition(5)))
    assert one.places.tolist() == two.places.tolist() and np.allclose(one.weights, two.weights)


def test_edges(spark):
    docs = edge_table(spark)
    labels = spark.createDataFrame([(1, 0), (3, None), (3, 1), (None, 1)], "doc_id long, toxic int")
    model = op.train(docs, labels)
    assert op.score(docs, model).count() == docs.count()
    kept = op.reject(docs, op.train(docs, labels.limit(0)))
    assert kept.columns == docs.columns and kept.count() == docs.count()  # without labels nothing is rejected
    assert op.score(empty_table(spark), model).count() == 0
    assert op.score(docs, model).where(F.col("score").isNull()).count() == 0


def test_scores_are_sums_over_pairs():
    """The quick form of the pairwise part against one product for each pair of terms."""
    r = np.random.default_rng(5)
    places = np.sort(r.choice(1 << op.BITS, 40, replace=False))
    m = op.Model(-0.3, places, r.normal(0, 0.5, 40), r.normal(0, 0.4, (40, op.FACTORS)))
    texts = [np.sort(r.choice(40, n, replace=False)) for n in (0, 1, 2, 7, 40)]
    docs, at = np.repeat(np.arange(5), [len(t) for t in texts]), np.concatenate(texts)
    got = m.scored(docs, places[at], 5)
    for g, t in zip(got, texts, strict=True):
        z = -0.3 + sum(m.weights[i] for i in t) + sum(float(m.factors[i] @ m.factors[j]) for i in t for j in t if i < j)
        assert abs(g - 1 / (1 + np.exp(-z))) < 1e-9


def test_rows_are_bounded_and_no_term_is_left_out(spark, monkeypatch):
    """The bound on pairs takes fewer rows, the first by hash; of these every term that three rows share is learned."""
    assert [op.within(np.array([5, 5, 5]), m) for m in (4, 5, 14, 15, 99)] == [1, 1, 2, 3, 3]
    docs = [(k, f"word{k % 7} other{k % 5} stem{'ming' * (k % 3)} both " + ("bad thing" if k % 4 == 0 else "fine")) for k in range(80)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)], "doc_id long, toxic int")
    order = [r["doc_id"] for r in table.where(~op.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).select("doc_id").collect()]
    places = {k: op.distinct(*op.terms_of(op.Words(*op._buffer(pa.array([t])))))[1] for k, t in docs}
    got = []
    monkeypatch.setattr(op, "calibrated", lambda texts, labels: got.append((texts, labels)))
    for bound in (10**6, 300, 1):
        op.train(table, labels, places=bound)
        rows, held = [], 0
        for k in order:
            held += len(places[k])
            if rows and held > bound:
                break
            rows.append(k)
        seen = np.bincount(np.concatenate([places[k] for k in rows]), minlength=1 << op.BITS)
        texts, toxic = got.pop()
        assert toxic.tolist() == [float(k % 4 == 0) for k in sorted(rows)]
        assert [t.tolist() for t in texts] == [[p for p in places[k].tolist() if seen[p] >= op.LEAST_DOCS] for k in sorted(rows)]
        assert bound > 300 or len(rows) < len(order)


def labelled(sf):
    """Texts, labels, and which rows learning must not see, by doc_id."""
    import duckdb

    rows = duckdb.sql(f"SELECT doc_id, text, toxic FROM '/root/testdata/{sf}/documents.parquet' JOIN '/root/testdata/{sf}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    return [t or "" for _, t, _ in rows], np.array([y for *_, y in rows], float), np.array([zlib.crc32(str(d).encode()) % 5 == 0 for d, *_ in rows])


def test_held_out_labels_of_the_test_data():
    """With the module's own settings: the recall on rows that learning did not see, few false alarms, and factors that carry weight."""
    texts, y, held = labelled("sf0.1")
    terms = []
    for t in texts:
        _, p = op.distinct(*op.terms_of(op.Words(*op._buffer(pa.array([t])))))
        terms.append(p.astype("<i4"))
    m = op.calibrated([terms[k] for k in np.flatnonzero(~held)], y[~held])
    column = pa.array([t for t, h in zip(texts, held, strict=True) if h])
    s = m.scores(column)
    recall, alarms = (s[y[held] > 0] >= 0.5).mean(), (s[y[held] == 0] >= 0.5).mean()
    assert recall >= 0.94 and alarms <= 0.01
    m.factors = np.zeros_like(m.factors)
    assert (m.scores(column)[y[held] > 0] >= 0.5).mean() < recall - 0.03
