"""Searches and text functions take all rows, all pairs and whole texts."""

from __future__ import annotations

import hashlib
import math

import pytest
from compare import cell
from pyspark.sql import functions as F

from garnetflow.functions import text as tx
from garnetflow.operators import bayes, classify, patterns, retrieval
from garnetflow.plans import QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(spark, name):
    return {tuple(map(cell, r)) for r in QUERIES[name](spark, SF).collect()}


def test_jaccard_search_scores_every_pair(spark):
    docs = [(k, "a b c d".split()[: 1 + k % 4] + ["x"] * (k % 3)) for k in range(50)] + [(7, ["a", "q"]), (8, []), (None, ["b"])]
    items = [(3, ["a", "a", "x"]), (4, ["q"]), (5, []), (100, ["b", "c"])]
    make = lambda rows: spark.createDataFrame(rows, "id long, words array<string>").repartition(3)
    got = [tuple(map(cell, r)) for r in retrieval.jaccard_search(make(docs), make(items)).collect()]
    want = []
    for q, a in items:
        for d, b in docs:
            o, both, n = sum(w in a for w in b), len({*a} & {*b}), len({*a}) + len({*b})
            if both:
                want.append((q, d, both / (n - both), None if n - o + 1 == 0 else o / (n - o + 1)))
    assert sorted(got, key=repr) == sorted((tuple(map(cell, r)) for r in want), key=repr)


def test_jaccard_meets_pairs_of_all_ids(spark):
    assert len({(i - d) % 40 for i, d, *_ in rows_of(spark, "jaccard")}) == 40


def test_all_pattern_tries_every_pattern(spark):
    types = {r[0] for r in spark.read.parquet(f"{SF}/part.parquet").select("p_type").distinct().collect()}
    docs = {r[0]: (r[1] or "").lower() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert rows_of(spark, "all_pattern") == {(d, t) for d, low in docs.items() for t in types if t[:2].lower() in low and t[-1].lower() in low}


def test_embedding_cosine_scores_every_vector(spark):
    ids = {r[0] for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id").collect()}
    assert {(q, v) for q, v, _ in rows_of(spark, "embedding_cosine")} == {(q, v) for q in ids if q % 100 == 0 for v in ids}


@pytest.mark.parametrize("most", [4096, 0])
def test_dense_search_by_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(retrieval, "BROADCAST_QUERIES", most)
    rows = [(k, [float(k % 5), float(k % 3), 1.0]) for k in range(20)] + [(20, [0.0, 0.0, 0.0]), (21, [1.0]), (22, None)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    got = {(r["query"], r["id"]): r["cosine"] for r in retrieval.dense_search(df, df.where("id < 7 or id = 20"), block=3).collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    for q, a in rows:
        for k, b in rows:
            if q < 7 or q == 20:
                same = a and b and len(a) == len(b) and any(a) and any(b)
                assert math.isclose(got.pop((q, k)), dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) if same else 0.0, abs_tol=1e-12)
    assert not got


def test_whole_pages_count(spark, tmp_path):
    rows = [(k, "u", "x" * 400 + end) for k, end in enumerate(["", "<b>&", " <i>y</i>  z'"])]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    got = {name: dict(map(tuple, QUERIES[name](spark, str(tmp_path)).collect())) for name in ("description_parts", "escape_html")}
    assert got["description_parts"] == {k: md5("u " + "x" * 400 + end) for k, end in enumerate(["", "&", " y z'"])}
    assert got["escape_html"] == {k: md5("u" + "x" * 400 + end) for k, end in enumerate(["", "&lt;b&gt;&amp;", " &lt;i&gt;y&lt;/i&gt;  z&#39;"])}


def test_id_set(spark):
    df = spark.createDataFrame([(["CWE-79", "x", "CWE-20", "CWE-79", "CWE-100"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(tx.id_set(tx.stripped_ids(F.col("v"), "CWE-"))).collect()] == [["100", "20", "79"], []]


def test_top_words_occur_three_times(spark):
    rows = [(1, "a", ["x"] * 3 + ["y"] * 2), (2, "a", ["y", "z"]), (3, "b", ["x", "x"])]
    model = bayes.train(spark.createDataFrame(rows, "id long, label string, words array<string>"))
    assert sorted((r["label"], r["word"], r["cnt"], r["rank"]) for r in bayes.top_words(model).collect()) == [("a", "x", 3, 1), ("a", "y", 3, 2)]
    assert tuple(bayes.total_words(model).first()) == (9, 2)
    model.release()


def test_overlap_confidence(spark):
    df = spark.createDataFrame([(0.151,), (0.15,), (0.081,), (0.08,), (0.0,)], "s double")
    assert [r[0] for r in df.select(retrieval.overlap_confidence(F.col("s"))).collect()] == ["high", "medium", "medium", "low", "low"]


def test_labels_without_a_limit_and_without_any(spark):
    """Labels join as a table; a vocabulary too large for every task is joined by word, with the same scores."""
    rows = [(k, f"l{k % 40}", ["w", f"u{k % 7}", f"v{k % 11}"]) for k in range(200)]
    docs = spark.createDataFrame(rows, "id long, label string, words array<string>")
    model = bayes.train(docs)
    score = lambda: {(r["id"], r["label"]): round(r["score"], 9) for r in bayes.log_scores(docs.drop("label"), model).collect()}
    small, most = score(), bayes.BROADCAST_WORDS
    try:
        bayes.BROADCAST_WORDS = 0
        assert len(small) == 200 * 40 and score() == small
    finally:
        bayes.BROADCAST_WORDS = most
    empty = bayes.train(docs.limit(0))
    assert bayes.log_scores(docs.drop("label"), empty).count() == 0


def test_the_text_is_read_once(spark):
    """Flags and hits are made once for a document, whatever number of weaknesses it has."""
    docs = spark.createDataFrame([(1, "a text that needs sql and a shell", [(0, "89", "SQL Injection", 2), (1, "1", None, 0)])], "item long, low string, w array<struct<pos:int,cwe:string,name:string,vectors:int>>")
    rows = classify.weighed(docs, F.col("w"))
    assert "low" not in rows.columns and [(r["cwe"], r["hits"]) for r in rows.orderBy("pos").collect()] == [("89", 1), ("1", None)]


def test_patterns_match_where_the_text_is(spark):
    docs = spark.createDataFrame([(1, "Alpha beta"), (2, "beta"), (3, None), (4, "alpha")], "id long, text string")
    candidates = spark.createDataFrame([(1, "v"), (1, "w"), (2, "v"), (3, "v"), (4, "none")], "item long, vector string")
    catalogue = spark.createDataFrame([("v", ["alpha", "beta"], 1.0), ("v", ["beta"], 2.0), ("w", ["gamma"], 3.0)], "vector string, keywords array<string>, boost double")
    got = sorted((r["item"], r["vector"], r["boost"]) for r in patterns.matches(docs, candidates, catalogue).collect())
    assert got == [(1, "v", 1.0), (1, "v", 2.0), (2, "v", 2.0)]
