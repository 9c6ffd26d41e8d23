"""Words are found once for each use of a text, and only rare ones leave the task that holds it."""

from __future__ import annotations

import math

import pytest

from garnetflow.functions.text import tokenize
from garnetflow.operators import bayes, counting, patterns
from garnetflow.plans import counts


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_are_found_once_to_count_them(spark):
    texts = spark.createDataFrame([("a", "x1.2y 10.20.3 alpha cve-2020-1 Alpha beta"), ("b", "beta v1.0 xcve-2020-1"), ("b", None), (None, "beta"), ("c", "")], "label string, text string")
    counted = counting.word_counts(texts.select("label", tokenize("text", "serving").alias("words")))
    assert plan(counted).count("regexp_extract_all(") == 1
    got = {(r["label"], r["word"]): (r["cnt"], r["rows"]) for r in counted.collect()}
    assert got == {("a", "alpha"): (2, 1), ("a", "beta"): (1, 1), ("b", "beta"): (1, 1), ("b", "xcve"): (1, 1), (None, "beta"): (1, 1)}


@pytest.mark.parametrize("most", [0, 2, 100])
def test_only_rare_words_leave_the_task(spark, monkeypatch, most):
    """Words of all, some and no documents, ids that come twice, unknown and no words: the scores are those of the formula, however many words go to every task."""
    monkeypatch.setattr(bayes, "BROADCAST_WORDS", most)
    monkeypatch.setattr(bayes, "CELLS", 3)
    rows = [(k, f"l{k % 3}", ["w", "w", f"u{k % 4}", f"v{k}"]) for k in range(12)]
    model = bayes.train(spark.createDataFrame(rows, "id long, label string, words array<string>"))
    asked = [*[(k, w) for k, _, w in rows], (3, ["w", "v5"]), (90, ["new", "u1"]), (91, []), (92, None)]
    docs = spark.createDataFrame(asked, "id long, words array<string>").repartition(2)
    found = bayes.log_scores(docs, model)
    assert "explode(words" not in plan(found)
    if most == 2:
        words = [r[0] for r in bayes._scored(docs, model)[0].where("word is not null").select("word").collect()]
        assert "w" not in words and "v5" in words and "new" in words
    cnt = {(r["label"], r["word"]): r["cnt"] for r in model.counts.collect()}
    vocabulary = {w for _, w in cnt}
    said = {}
    for k, w in asked:
        said.setdefault(k, []).extend(x for x in w or [] if x in vocabulary)
    got = {(r["id"], r["label"]): r["score"] for r in found.collect()}
    for k, words in said.items():
        for label in ("l0", "l1", "l2"):
            total = sum(n for (of, _), n in cnt.items() if of == label)
            want = math.log(4 / 12) + sum(math.log((cnt.get((label, w), 0) + 1) / (total + len(vocabulary))) for w in words)
            assert math.isclose(got.pop((k, label)), want, abs_tol=1e-9)
    assert not got


def test_the_taxonomy_reads_the_texts_once(spark):
    found = counts.full_taxonomy(spark, "/root/testdata/sf0.001")
    assert "regexp_extract_all(" not in plan(found)  # counts and document frequencies come from one stored table


def test_patterns_are_matched_once(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "c"), (3, "b"), (4, None)], "id long, text string")
    wanted = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "z"), (4, "x")], "item long, vector string")
    rows = spark.createDataFrame([("x", 1, ["a", "b"], 1.0), ("x", 2, ["c"], 2.0), ("y", 1, ["b"], 3.0)], "vector string, pattern_id int, keywords array<string>, boost double")
    found = patterns.matches(docs, wanted, rows)
    assert plan(found).count("forall(") == 1
    assert sorted((r["item"], r["vector"], r["pattern_id"]) for r in found.collect()) == [(1, "x", 1), (1, "y", 1), (2, "x", 2)]
