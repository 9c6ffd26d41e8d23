from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from garnetflow.functions import fixed
from garnetflow.operators import keywords, patterns, retrieval


def words(r, n):
    return [r.choice(["al", "be", "ga", "del", "eps", "zé", "eta"]) + r.choice(["", "ta", "ma", "x9", "ôn"]) for _ in range(n)]


def texts(r, n):
    return [(k, " ".join(words(r, r.randrange(60)))) for k in range(n)] + [(n, None), (n + 1, ""), (n + 2, "ab"), (n + 3, "Alta\nAl"), (0, "alta ma")]


def catalogue(r, n):
    rows = []
    for k in range(n):
        text = " ".join(words(r, 12))
        at = [r.randrange(len(text) - 9) for _ in range(r.choice([1, 1, 2, 3]))]
        rows.append((k % 50, k, [text[i : i + r.choice([1, 2, 3, 5, 9])] for i in at]))
    return rows + [(1, n, []), (1, n + 1, [""]), (2, n + 2, ["ALTA", "ma"]), (3, n + 3, None), (3, n + 4, ["al", None]), (4, n + 5, ["zzzzzz"]), (4, n + 5, ["al"]), (4, n + 5, ["al"])]


def plain(docs, rows):
    return Counter((d, v, p) for d, t in docs if t is not None for v, p, ks in rows if ks is not None and None not in ks and all(k.lower() in t.lower() for k in ks))


@pytest.mark.parametrize(("direct", "broadcast"), [(10**6, 1), (0, 10**6), (0, 10)])
def test_matches_are_those_of_plain_search(spark, monkeypatch, direct, broadcast):
    """Without the index, with it in every task, and with it met by run."""
    monkeypatch.setattr(keywords, "DIRECT", direct)
    monkeypatch.setattr(keywords, "BROADCAST", broadcast)
    r = random.Random(1)
    docs, rows = texts(r, 80), catalogue(r, 600)
    found = keywords.match(spark.createDataFrame(docs, "id long, text string").select("id", F.lower("text").alias("low")), spark.createDataFrame(rows, "vector long, pattern long, keywords array<string>"))
    assert found.columns == ["id", "vector", "pattern"]
    assert Counter(map(tuple, found.collect())) == plain(docs, rows)


def test_empty_sides(spark, monkeypatch):
    monkeypatch.setattr(keywords, "DIRECT", -1)
    docs = spark.createDataFrame([(1, "text")], "id long, low string")
    rows = spark.createDataFrame([(1, ["text"])], "pattern long, keywords array<string>")
    assert keywords.match(docs, rows.limit(0)).count() == 0 and keywords.match(docs.limit(0), rows).count() == 0


def test_work_follows_candidates_with_ten_thousand_patterns(spark):
    r = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = [(k, " ".join("".join(r.choice(letters) for _ in range(6)) for _ in range(40))) for k in range(60)]
    rows = []
    for k in range(10_000):
        w = docs[k % 60][1].split()
        rows.append((k, [w[k % 40][:5], w[(k * 7) % 40][1:]] if k % 20 == 0 else ["".join(r.choice(letters) for _ in range(6)), w[0][:2]]))
    low, table = spark.createDataFrame(docs, "id long, low string"), spark.createDataFrame(rows, "pattern long, keywords array<string>")
    filed = keywords.index(table, low).cache()
    assert filed.count() == 10_000
    met = keywords.candidates(low, filed).count()
    found = keywords.match(low, table, filed)
    want = {(d, p) for d, t in docs for p, ks in rows if all(k in t for k in ks)}
    assert {tuple(x) for x in found.collect()} == want and len(want) >= 500
    assert met < 20 * len(want) < 600_000 / 10  # of 600,000 pairs
    filed.unpersist()


def test_a_pattern_is_filed_under_its_rarest_run(spark):
    low = spark.createDataFrame([("common rareword",), ("common",), ("common x",)], "low string")
    table = spark.createDataFrame([(1, ["common", "rarewo"]), (2, ["com"]), (3, ["Common"])], "pattern long, keywords array<string>")
    got = {x["pattern"]: x["gram"] for x in keywords.index(table, low).collect()}
    assert got[1] in ("rare", "arew", "rewo") and got[2] == "com" and got[3] == "comm"


def test_patterns_of_vectors_and_layers_by_the_index(spark, monkeypatch):
    r = random.Random(4)
    said = ["SQL injection in a query", "cross-site scripting via <script>", "ldap lookup", "buffer overflow in the heap", "nothing", "execute a shell command", "path traversal ../../etc"]
    docs = [(k, f"{r.choice(said)} and {r.choice(said)} {' '.join(words(r, 5))}") for k in range(60)]
    table = spark.createDataFrame(docs, "id long, text string")
    rows = spark.createDataFrame([(f"v{v}", p, ks, 1.0) for v, p, ks in catalogue(r, 300)], "vector string, pattern_id long, keywords array<string>, boost double").where("keywords IS NOT NULL AND NOT exists(keywords, k -> k IS NULL)")
    wanted = spark.createDataFrame([(k, f"v{(k + j) % 50}") for k in range(60) for j in (0, 3, 9)], "item long, vector string")
    one, other = (Counter(map(tuple, patterns.matches(table, wanted, rows, indexed).select("item", "vector", "pattern_id", "boost").collect())) for indexed in (False, True))
    assert one == other and len(one) > 10
    monkeypatch.setattr(keywords, "DIRECT", 0)
    of = F.when(F.col("id") % 3 == 0, F.array(F.lit("xss"), F.lit("other"))).otherwise(F.array().cast("array<string>"))
    plain_layers = table.select("id", F.explode(retrieval.keyword_layers(F.col("text"), F.lower("text"), of)).alias("f")).select("id", "f.vector", "f.confidence")
    by_word = spark.createDataFrame([(v, w) for v, ws in fixed.VECTOR_KEYWORDS.items() for w in ws], "vector string, word string")
    shown = spark.createDataFrame([(v, p, None) for v, ps in fixed.VECTOR_PATTERNS.items() for p in ps], "vector string, expression string, word string")
    indexed = retrieval.indexed_layers(table.select(F.col("id").alias("item"), "text", of.alias("vectors")), by_word, shown)
    assert {tuple(x) for x in indexed.collect()} == {tuple(x) for x in plain_layers.collect()}


def test_no_text_is_copied_for_its_runs(spark):
    """Keywords of any length, across the ends of texts, and beyond ASCII; the catalogue in a task needs no join by run."""
    docs = spark.createDataFrame([(1, "xxabcdefghij"), (2, "klm éàü abcdefghiz"), (3, ""), (4, "klm")], "doc_id long, low string").coalesce(1)
    rows = [("a", ["abcdefghij"]), ("b", ["klm", "éàü"]), ("c", ["ijklm"]), ("d", [""]), ("e", []), ("f", ["abcdefgh", "z"]), ("g", ["abcdefghijk"])]
    patterns = spark.createDataFrame(rows + [(f"n{k}", [f"none{k}"]) for k in range(600)], "name string, keywords array<string>")
    found = keywords.match(docs, patterns)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    every = {(d, p) for d in (1, 2, 3, 4) for p in "de"}
    assert {tuple(r) for r in found.collect()} == every | {(1, "a"), (2, "b"), (2, "f")}
