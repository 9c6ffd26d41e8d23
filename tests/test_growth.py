"""Plans of queries whose tasks grew with few keys, gathered ends or pairs."""

from __future__ import annotations

import math

import pytest

from garnetflow.operators import retrieval
from garnetflow.plans import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, keys", [("granular", ["vector#"]), ("capec_overlap", ["key#", "capec#"]), ("attack_chain", ["technique#"])])
def test_no_shuffle_by_few_keys(spark, name, keys):
    """Few vectors, weaknesses or techniques have all rows between them: a join by one gathers them in a task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are large
    try:
        found = plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [k for k in keys if f"SortMergeJoin [{k}" in found]


def test_no_ends_are_gathered(spark):
    assert "collect_set" not in plan(QUERIES["rel_maps"](spark, SF))


def test_vectors_are_multiplied_where_they_lie(spark, monkeypatch):
    """Several scans for many queries, blocks that do not come out even, and vectors of other lengths, without norm or null."""
    monkeypatch.setattr(retrieval, "BROADCAST_QUERIES", 5)
    monkeypatch.setattr(retrieval, "VECTORS", 4)
    rows = [(k, [float(k % 3 - 1), 1.0 + k, k * 0.5]) for k in range(11)] + [(20, [1.0, 2.0]), (21, [0.0, 0.0, 0.0]), (22, []), (23, None)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(2)
    found = retrieval.dense_search(df, df, block=2)
    assert "Join" not in plan(found) and "zip_with" not in plan(found)
    got = {(r["query"], r["id"]): r["cosine"] for r in found.collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    for q, a in rows:
        for k, b in rows:
            same = a and b and len(a) == len(b) and any(a) and any(b)
            assert math.isclose(got.pop((q, k)), dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) if same else 0.0, abs_tol=1e-12)
    assert not got


def test_only_terms_of_the_catalogue_are_counted(spark):
    """Each document is a query to a small catalogue: its other words fall away before the first shuffle."""
    catalogue = spark.createDataFrame([("x", ["a", "b", "b"]), ("y", ["c"])], "id string, words array<string>")
    queries = spark.createDataFrame([(k, ["a", "a", "b", f"u{k}"]) for k in range(20)] + [(90, ["c"]), (91, ["z"])], "id long, words array<string>")
    few = retrieval.bm25(catalogue, queries, small=True)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in retrieval.bm25(catalogue, queries).collect()}
    first = plan(few).split("BroadcastHashJoin [term")
    assert any("LeftSemi" in part.splitlines()[0] for part in first[1:])
