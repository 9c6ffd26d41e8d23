"""Golden values of the rules, worked out by hand from their formulas."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from garnetflow.functions import fixed
from garnetflow.functions import text as tx
from garnetflow.operators import bayes, classify, frequency, hierarchy, linking, patterns, relabel, report, retrieval

CORPUS = [
    ("A", "SQL injection in login form allows attackers to read database via union select query", ["89"], ["sql_injection"]),
    ("B", "SQL injection in search query parameter exposes database", ["89", "20"], ["input_validation", "sql_injection"]),
    ("C", "Cross-site scripting via script tag in comment field", ["79"], ["xss"]),
    ("D", "Stored cross-site scripting: script injection in profile script", ["79", "79"], ["xss"]),
    ("E", "Log4j2 2.15.0 deserialization of untrusted object via JNDI lookup, see CVE-2021-44228", ["502"], ["deserialization"]),
    ("F", "Path traversal with ../ sequences", ["22"], ["path_traversal"]),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(CORPUS, "id string, text string, cwes array<string>, vectors array<string>")


@pytest.fixture(scope="module")
def labelled(corpus):
    return corpus.select("id", "text", "cwes", F.explode("vectors").alias("label"))


@pytest.fixture(scope="module")
def model(labelled):
    return bayes.train(labelled.select("id", "label", tx.tokenize("text", "train").alias("words")), 6)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("profile", "words"),
    [
        ("train", "log4j2 deserialization untrusted object jndi lookup see"),
        ("taxonomy", "log deserialization untrusted object jndi lookup see"),
        ("serving", "log deserialization untrusted object jndi lookup see"),
        ("batch", "log4j2 deserialization untrusted object via jndi lookup see cve 2021 44228"),
    ],
)
def test_tokens(corpus, profile, words):
    assert corpus.where("id = 'E'").select(F.array_join(tx.tokenize("text", profile), " ")).first()[0] == words


def test_word_lists():
    assert {k: len(v) for k, v in fixed.STOP_WORDS.items()} == {"train": 193, "taxonomy": 42, "serving": 185, "batch": 24, "retrieval": 45, "report": 61, "ranking": 55, "cwe_name": 15, "significant": 19}
    assert len(fixed.VECTOR_CATALOG) == 35 and len(fixed.CWE_VECTORS) == 91 and len(fixed.REPORT_CWE_VECTORS) == 38
    assert len({v for _, vs in fixed.CWE_VECTORS for v in vs}) == 36
    assert len({c for _, cs, _, _ in fixed.VECTOR_CATALOG for c in cs}) == 69


def test_clean_text(spark):
    assert one(spark, tx.clean(F.lit("<p>a  b</p><p>c</p>"))) == "a bc"
    assert one(spark, tx.clean(F.lit("\t a\n"))) == "a"
    assert one(spark, tx.day_of(F.lit("2024-01-02T03:04:05Z"))) == "2024-01-02"
    assert one(spark, tx.day_of(F.lit("2024-01-02T03:04:05.000"))) == "2024-01-02T03:04:05.000"
    assert one(spark, tx.escaped(F.lit("<a href=\"x\">'&'"))) == "&lt;a href=&quot;x&quot;&gt;&#39;&amp;&#39;"


def test_training(model):
    rows = {r["label"]: r for r in model.labels.collect()}
    assert (model.vocabulary, model.documents) == (30, 6)
    assert {k: (r["docs"], r["total"]) for k, r in rows.items()} == {"sql_injection": (2, 15), "input_validation": (1, 6), "xss": (2, 15), "deserialization": (1, 7), "path_traversal": (1, 3)}
    assert rows["xss"]["prior"] == pytest.approx(1 / 3)
    p = {(r["label"], r["word"]): r["likelihood"] for r in bayes.likelihood(model).collect()}
    assert p["sql_injection", "sql"] == pytest.approx(3 / 45) and p["xss", "script"] == pytest.approx(4 / 45)


def test_frequency(labelled, corpus):
    counts = frequency.pair_counts(labelled.select(F.col("label").alias("vector"), F.explode("cwes").alias("cwe")))
    totals = labelled.groupBy(F.col("label").alias("vector")).agg(F.count("*").alias("total"))
    rows = {(r["vector"], r["cwe"]): (r["cnt"], r["percentage"]) for r in frequency.ranked(counts, totals).collect()}
    assert rows["xss", "79"] == (3, 150.0) and rows["sql_injection", "20"] == (1, 50.0)
    counts = corpus.select(F.explode("cwes").alias("cwe")).groupBy("cwe").agg(F.count("*").alias("cnt"))
    assert {r["cwe"]: round(r["percentage"], 4) for r in frequency.ranked(counts, 6, by=None).collect()} == {"79": 50.0, "89": 33.3333, "20": 16.6667, "22": 16.6667, "502": 16.6667}


@pytest.fixture(scope="module")
def taxonomy(corpus, labelled):
    docs = corpus.select("id", tx.tokenize("text", "taxonomy").alias("words"))
    scores = patterns.term_scores(labelled.select("label", tx.tokenize("text", "taxonomy").alias("words")), docs, 6)
    return patterns.learned(scores), patterns.taxonomy(patterns.learned(scores), patterns.document_frequency(docs), 6)


def test_patterns(taxonomy):
    (r,) = taxonomy[0].collect()
    assert (r["vector"], r["term"], r["tf"], r["df"], r["specificity"]) == ("xss", "script", 3, 2, 1.5)
    assert r["tfidf"] == pytest.approx(1.5 * math.log(2))
    boost = {(r["vector"], "+".join(r["keywords"])): r["boost"] for r in taxonomy[1].collect()}
    expect = {("deserialization", "jndi"): 3.411980, ("deserialization", "ldap"): 3.671910, ("deserialization", "lookup"): 2.047188, ("deserialization", "unmarsh"): 3.671910, ("deserialization", "pickle"): 3.661479, ("jndi_injection", "naming"): 2.203146, ("sql_injection", "union+select"): 3.411980, ("sql_injection", "or+="): 1.468764}
    assert {k: round(boost[k], 6) for k in expect} == expect
    assert boost["xss", "script"] == pytest.approx(2.904909, abs=1e-6)


@pytest.fixture(scope="module")
def edges(spark):
    e = spark.createDataFrame([("89", "943"), ("943", "74")], "child string, parent string")
    m = spark.createDataFrame([("89", "sql_injection"), ("943", "nosql_injection"), ("74", "injection"), ("20", "input_validation")], "node string, vector string")
    return e, m


def test_classification(corpus, labelled, model, taxonomy, edges):
    b = corpus.where("id = 'B'")
    start = b.select(F.col("id").alias("item"), F.explode("cwes").alias("node"))
    found = hierarchy.candidates(start, *edges, depth=2)
    assert {r["vector"] for r in found.collect()} == {"injection", "input_validation", "nosql_injection", "sql_injection"}
    docs = b.select("id", "text", tx.tokenize("text", "serving").alias("words"))
    scores = {r["label"]: r["score"] for r in bayes.log_scores(docs, model, found).collect()}
    assert scores == pytest.approx({"sql_injection": -18.157844, "input_validation": -19.133990}, abs=1e-6)
    counts = frequency.pair_counts(labelled.select(F.col("label").alias("vector"), F.explode("cwes").alias("cwe")))
    lists = frequency.top(counts, 5).select("vector", "cwe")
    rows = classify.hybrid(docs, model, found, start.select("item", F.col("node").alias("cwe")), taxonomy[1], lists)
    got = {r["label"]: (round(r["probability"], 6), r["confidence"], r["layers"]) for r in rows.collect()}
    layers = ["CWE Hierarchy", "Naive Bayes", "CWE Frequency"]
    assert got == {"sql_injection": (0.726343, "high", layers), "input_validation": (0.273657, "low", layers)}
    assert [r["label"] for r in classify.gap_filter(rows).collect()] == ["sql_injection"]


def test_batch(spark, corpus, model, taxonomy, edges):
    docs = corpus.where("id = 'B'").select("id", "text", tx.tokenize("text", "batch").alias("words")).union(spark.createDataFrame([("Z", "nothing", ["nothing"])], "id string, text string, words array<string>"))
    start = corpus.where("id = 'B'").select(F.col("id").alias("item"), F.explode("cwes").alias("node"))
    rows = classify.hybrid_batch(docs, model, hierarchy.candidates(start, *edges, depth=1), taxonomy[1])
    assert {r["id"]: r["vectors"] for r in rows.collect()} == {"B": ["sql_injection", "input_validation", "nosql_injection"], "Z": ["unknown"]}


@pytest.mark.parametrize(
    ("text", "cwe", "name", "vectors", "score"),
    [
        ("a jndi flaw over ldap", "502", "Deserialization of Untrusted Data", 2, 160),
        ("a jndi flaw over ldap", "917", "Expression Language Injection", 2, 100),
        ("something", "20", "Improper Input Validation", 1, 0),
        ("inject a command", "78", "OS Command Thing", 1, 45 + 80 + 10 + 5),
        ("anything", "9999", None, 3, 0),
    ],
)
def test_relevance(spark, text, cwe, name, vectors, score):
    assert one(spark, relevance_of(text, cwe, name, vectors)) == score


def relevance_of(text, cwe, name, vectors, commands=True):
    low, name = F.lower(F.lit(text)), F.lit(name).cast("string")
    return classify.relevance(F.lit(cwe), name, F.lit(vectors), classify.name_hits(low, name), classify.triggers(low), commands)


def test_relevance_without_commands(spark):
    args = ("inject a command", "78", "OS Thing", 0)
    assert one(spark, relevance_of(*args)) - one(spark, relevance_of(*args, commands=False)) == 80


@pytest.mark.parametrize(("p", "kept"), [([0.55, 0.40, 0.05], 3), ([0.95, 0.80, 0.10], 2), ([0.70, 0.45, 0.30, 0.29], 2), ([0.3], 1)])
def test_gap(spark, p, kept):
    rows = spark.createDataFrame([("x", f"v{k}", q) for k, q in enumerate(p)], "id string, label string, probability double")
    assert classify.gap_filter(rows).count() == kept


def test_elimination_is_guarded(spark):
    rows = spark.createDataFrame([("a", "x", 0), ("a", "y", 2), ("a", "z", None), ("b", "x", 0), ("b", "y", 0)], "item string, vector string, matches long")
    assert sorted((r["item"], r["vector"]) for r in classify.eliminated(rows).collect()) == [("a", "y"), ("a", "z"), ("b", "x"), ("b", "y")]
    assert classify.eliminated(rows, guarded=False).count() == 2


def test_small_rules(spark):
    a = lambda *x: F.array(*map(F.lit, x))
    assert one(spark, relabel.same_labels(a("a", "b"), a("a", "a"))) is True
    assert one(spark, relabel.same_labels(a("a", "b"), a("a", "c"))) is False
    assert one(spark, retrieval.dense_cosine(a(1.0, 0.0), a(0.0, 1.0))) == 0
    assert one(spark, retrieval.dense_cosine(a(1.0, 0.0), a(1.0,))) == 0
    assert one(spark, retrieval.impact_penalty(F.lit("a crash"))) == 0.85
    assert one(spark, retrieval.impact_penalty(F.lit("a crash, rce"))) == 0.7
    assert one(spark, retrieval.impact_penalty(F.lit("x"))) == 1.0
    assert one(spark, linking.mismatched(F.lit("web form"), F.lit("DNS thing"), F.lit(None).cast("string"))) is True
    assert one(spark, tx.weakness_context(F.lit("CWE-94: Improper Control ('Code Injection')"))) == ["code injection", "code", "injection"]
    assert one(spark, F.array_sort(a("502", "20", "400"))) == ["20", "400", "502"]
    assert one(spark, tx.weakness_list(F.lit("cwe-79, CWE-89"))) == ["79", "89"]
    assert one(spark, tx.cve_name(F.lit("2021-44228"))) == "CVE-2021-44228"


def test_probabilities_sum_to_one(corpus, model):
    docs = corpus.select("id", tx.tokenize("text", "serving").alias("words"))
    sums = bayes.posterior(docs, model).groupBy("id").agg(F.sum("probability").alias("p")).collect()
    assert len(sums) == 6 and all(abs(r["p"] - 1) < 1e-9 for r in sums)


def test_row_order_does_not_matter(corpus, model):
    docs = corpus.select("id", tx.tokenize("text", "serving").alias("words"))
    a = sorted(map(tuple, bayes.posterior(docs, model).select("id", "label", F.round("probability", 9)).collect()))
    assert a == sorted(map(tuple, bayes.posterior(docs.orderBy(F.desc("id")).repartition(7), model).select("id", "label", F.round("probability", 9)).collect()))


def test_report_pages():
    data = {"id": "CVE-1", "description": "<b>&", "cards": {"x": "<"}, "sections": {"Vectors": [("<i>", 1)], "Empty": []}, "epss": {"days": ["2024-01-01"], "values": ["0.5"]}}
    page = report.page(data)
    assert "&lt;b&gt;&amp;" in page and "&lt;i&gt;" in page and "Empty" not in page and "<i>" not in page and "<svg" in page
    assert "Vectors" in report.console(data) and "Empty" not in report.console(data)


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "id string, words array<string>")
    assert bayes.posterior(none, model).count() == 0
    assert retrieval.bm25(none, none).count() == 0
    assert hierarchy.ancestors(spark.createDataFrame([], "item string, node string"), spark.createDataFrame([], "child string, parent string")).count() == 0


@pytest.mark.parametrize("most", range(4, 14))
def test_cut_in_bytes(spark, most):
    for text in ("aé漢\U0001f600b漢é", "abcdefghijklmnop", "éééééééé", "漢漢漢漢漢", "\U0001f600" * 4):
        want = text.encode()[:most].decode("utf-8", "ignore")
        assert one(spark, tx.cut_bytes(F.lit(f" {text}\n"), most)) == want
    assert one(spark, tx.cut_bytes(F.lit(" \n"), most)) is None
