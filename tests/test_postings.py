from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from garnetflow.operators import patterns, postings, retrieval


def corpus(r, n, vocabulary=400):
    """Words with a long tail, so that some terms are rare and some in most documents."""
    return [(k, [f"w{int(vocabulary * r.random() ** 3)}" for _ in range(r.choice([3, 8, 20, 60]))]) for k in range(n)] + [(n, []), (n + 1, None), (n + 2, ["w0"] * 40)]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    r = random.Random(1)
    docs = spark.createDataFrame(corpus(r, 3000), "id long, words array<string>").repartition(4).cache()
    queries = spark.createDataFrame([(k, [f"w{r.randrange(400)}" for _ in range(r.choice([1, 2, 5]))] + ["w0"]) for k in range(40)] + [(90, ["unknown"]), (91, ["w0"]), (92, [])], "query long, words array<string>")
    path = str(tmp_path_factory.mktemp("index"))
    yield docs, queries, postings.build(docs, path)
    docs.unpersist()


def best(rows, k):
    """The best k by rounded score and id, of (query, id, score)."""
    by_query = defaultdict(list)
    for q, d, s in rows:
        by_query[q].append((-round(s, 6) + 0.0, d))
    return {q: sorted(v)[:k] for q, v in by_query.items()}


def near(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [d for _, d in got[q]] == [d for _, d in want[q]]
        assert all(abs(a - b) < 1e-5 for (a, _), (b, _) in zip(got[q], want[q], strict=True))


@pytest.mark.parametrize("k", [1, 10, 5000])
def test_bm25_is_that_of_scoring_every_document(built, k):
    docs, queries, index = built
    want = retrieval.bm25(docs.where("words IS NOT NULL OR id >= 0"), queries.withColumnRenamed("query", "id")).select("query", "id", "score").collect()
    got = postings.search(index, postings.term_counts(queries), "bm25", k).collect()
    near(best(got, k), best(want, k))


@pytest.mark.parametrize("k", [1, 10])
def test_cosine_is_that_of_scoring_every_document(built, k):
    docs, queries, index = built
    n, df = docs.count(), patterns.document_frequency(docs)
    want = retrieval.sparse_cosine(retrieval.tfidf(queries.withColumnRenamed("query", "id"), n, df), retrieval.tfidf(docs, n, df)).collect()
    got = postings.search(index, postings.cosine_weights(index, queries), "cosine", k).withColumn("score", F.col("score") * 100)
    near(best(got.collect(), k), best(want, k))


@pytest.mark.parametrize("kind", postings.KINDS)
def test_bounds_hold_and_fewer_postings_are_read(built, kind):
    docs, queries, index = built
    weights = postings.term_counts(queries) if kind == "bm25" else postings.cosine_weights(index, queries)
    every = postings.bounded(index, weights, kind)
    bounds = {(x["query"], x["block"]): (x["bound"], x["n"]) for x in every.collect()}
    of = {x["id"]: x["block"] for x in index.blocks(docs.sparkSession).select("block", F.explode("postings").alias("p")).select("block", "p.id").distinct().collect()}
    for q, d, s in postings.scored(index, weights, every, kind).collect():
        assert s <= bounds[q, of[d]][0] + 1e-9
    first, rest = postings.chosen(index, weights, kind, 10)
    total = sum(n for _, n in bounds.values())
    read = sum(x["n"] for x in rest.collect()) + sum(bounds[k][1] for k in {(x["query"], of[x["id"]]) for x in first.collect()})
    assert read < 0.7 * total


def test_one_index_serves_many_searches_and_reads_bounds_only(built):
    docs, queries, index = built
    one, two = (sorted(map(tuple, postings.search(index, postings.term_counts(queries.where(f"query % 2 = {m}"))).collect())) for m in (0, 1))
    assert {q for q, *_ in one}.isdisjoint({q for q, *_ in two}) and one and two
    plan = postings.bounded(index, postings.term_counts(queries), "bm25")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "most_bm25" in line)
    assert "postings" not in scan.split("ReadSchema")[1]


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, [])], "id long, words array<string>")
    index = postings.build(docs, str(tmp_path / "i"))
    queries = spark.createDataFrame([(1, ["a"])], "query long, words array<string>")
    assert index.n == 1 and postings.search(index, postings.term_counts(queries)).count() == 0
    assert postings.build(docs.limit(0), str(tmp_path / "j")).n == 0
