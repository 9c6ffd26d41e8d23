"""Queries of frequencies, Naive Bayes and patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import tokenize
from ..operators import bayes, frequency, patterns
from .registry import query, sql_list, sql_words, table

_PAIRS = "SELECT o_orderpriority AS vector, l_suppkey AS cwe FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
_COUNTS = f"SELECT vector, cwe, count(*) AS cnt FROM ({_PAIRS}) GROUP BY ALL"


def pairs(spark, sf_dir):
    """A record's vector and each of its weaknesses."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(F.col("o_orderpriority").alias("vector"), F.col("l_suppkey").alias("cwe"))


@query(f"SELECT vector, cwe, cnt, round(cnt * 100.0 / total, 6) AS percentage, row_number() OVER (PARTITION BY vector ORDER BY cnt DESC, cwe) AS rank FROM ({_COUNTS}) JOIN (SELECT o_orderpriority AS vector, count(*) AS total FROM orders GROUP BY 1) USING (vector)")
def freq_vector_cwe(spark, sf_dir):
    totals = table(spark, sf_dir, "orders", "o_orderpriority").groupBy(F.col("o_orderpriority").alias("vector")).agg(F.count("*").alias("total"))
    rows = frequency.ranked(frequency.pair_counts(pairs(spark, sf_dir)), totals)
    return rows.select("vector", "cwe", "cnt", F.round("percentage", 6).alias("percentage"), "rank")


@query("SELECT l_suppkey AS cwe, count(*) AS cnt, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS percentage, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS rank FROM lineitem GROUP BY l_suppkey QUALIFY rank <= 20")
def freq_global(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()
    counts = frequency.overall(table(spark, sf_dir, "lineitem", "l_suppkey").groupBy(F.col("l_suppkey").alias("cwe")).agg(F.count("*").alias("cnt")), 20)
    return frequency.ranked(counts, n, by=None).select("cwe", "cnt", F.round("percentage", 6).alias("percentage"), "rank")


@query(f"SELECT vector, cwe, cnt, row_number() OVER (PARTITION BY vector ORDER BY cnt DESC, cwe) AS rank FROM ({_COUNTS}) QUALIFY rank <= 10")
def freq_top10(spark, sf_dir):
    return frequency.top(frequency.pair_counts(pairs(spark, sf_dir)), 10)


@query(f"SELECT vector, string_agg(CAST(cwe AS VARCHAR), ',' ORDER BY rank) AS cwes FROM (SELECT *, row_number() OVER (PARTITION BY vector ORDER BY cnt DESC, cwe) AS rank FROM ({_COUNTS}) QUALIFY rank <= 5) GROUP BY vector")
def freq_top5_map(spark, sf_dir):
    return frequency.short_lists(frequency.pair_counts(pairs(spark, sf_dir))).select("vector", F.array_join(F.col("cwes").cast("array<string>"), ",").alias("cwes"))


@query("SELECT count(*) AS n, CAST(sum(CASE WHEN c > 0 THEN 1 ELSE 0 END) AS BIGINT) AS mapped, round(avg(CASE WHEN c > 0 THEN 1 ELSE 0 END) * 100, 6) AS coverage FROM (SELECT c_custkey, count(o_orderkey) AS c FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)")
def coverage(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_custkey").distinct().select(F.col("o_custkey").alias("c_custkey"), F.array(F.lit(1)).alias("found"))
    rows = table(spark, sf_dir, "customer", "c_custkey").join(orders, "c_custkey", "left")
    return frequency.coverage(rows, "found").select("n", "mapped", F.round("coverage", 6).alias("coverage"))


def records(spark, sf_dir, profile="serving"):
    """id, label, words and text of each document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"), tokenize("text", profile).alias("words"), "text")


def model(spark, sf_dir, profile="serving"):
    return bayes.train(records(spark, sf_dir, profile).drop("text"))


def sql_model(profile="serving") -> str:
    """Common table expressions: d (documents and words), c (counts), l (labels), v (vocabulary)."""
    return f"""d AS MATERIALIZED (SELECT doc_id, text, lang, {sql_words(profile)} AS w FROM documents),
c AS MATERIALIZED (SELECT lang AS label, word, count(*) AS cnt FROM (SELECT lang, unnest(w) AS word FROM d) GROUP BY ALL),
v AS (SELECT count(DISTINCT word) AS v FROM c),
l AS MATERIALIZED (SELECT label, docs, coalesce(total, 0) AS total, docs / (SELECT count(DISTINCT doc_id) FROM d) AS prior FROM (SELECT lang AS label, count(*) AS docs FROM d GROUP BY lang) LEFT JOIN (SELECT label, sum(cnt) AS total FROM c GROUP BY label) USING (label))"""


def sql_scores(where: str = "") -> str:
    """s: doc_id, label and log score, after sql_model; `where` limits the pairs."""
    return f"""q AS MATERIALIZED (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM d) WHERE word IN (SELECT word FROM c) GROUP BY ALL),
s AS MATERIALIZED (SELECT p.doc_id, p.label, ln(p.prior) + coalesce(sum(q.tf * ln((coalesce(c.cnt, 0) + 1) / (p.total + p.v))), 0) AS score
FROM (SELECT d.doc_id, l.label, l.prior, l.total, v.v FROM d, l, v {where}) p LEFT JOIN q ON q.doc_id = p.doc_id LEFT JOIN c ON c.label = p.label AND c.word = q.word GROUP BY p.doc_id, p.label, p.prior)"""


@query(f"WITH {sql_model()} SELECT label, docs, CAST(total AS BIGINT) AS total, round(prior, 6) AS prior FROM l")
def nb_priors(spark, sf_dir):
    return model(spark, sf_dir).labels.select("label", "docs", "total", F.round("prior", 6).alias("prior"))


@query(f"WITH {sql_model()} SELECT label, word, cnt, round((cnt + 1) / (total + v), 9) AS likelihood FROM c JOIN l USING (label), v")
def nb_likelihood(spark, sf_dir):
    return bayes.likelihood(model(spark, sf_dir)).select("label", "word", "cnt", F.round("likelihood", 9).alias("likelihood"))


@query(f"WITH {sql_model('train')} SELECT label, word, cnt, row_number() OVER (PARTITION BY label ORDER BY cnt DESC, word) AS rank FROM c WHERE cnt >= 3 QUALIFY rank <= 15")
def nb_top_words(spark, sf_dir):
    return bayes.top_words(model(spark, sf_dir, "train"))


@query(f"WITH {sql_model('train')} SELECT CAST(coalesce(sum(cnt), 0) AS BIGINT) AS total_words, count(DISTINCT label) AS labels FROM c")
def total_words(spark, sf_dir):
    return bayes.total_words(model(spark, sf_dir, "train"))


@query(
    f"""WITH {sql_model()}, {sql_scores()}, p AS (SELECT doc_id, label, exp(score - max(score) OVER (PARTITION BY doc_id)) AS e FROM s),
r AS (SELECT doc_id, label, e / sum(e) OVER (PARTITION BY doc_id) AS probability FROM p)
SELECT doc_id, label, round(probability, 6) AS probability, CASE WHEN probability >= 0.7 THEN 'high' WHEN probability >= 0.4 THEN 'medium' ELSE 'low' END AS confidence FROM r"""
)
def nb_posterior(spark, sf_dir):
    docs = records(spark, sf_dir)
    rows = bayes.posterior(docs, bayes.train(docs.drop("text")))
    return rows.select(F.col("id").alias("doc_id"), "label", F.round("probability", 6).alias("probability"), "confidence")


@query(f"SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct({sql_words('taxonomy')})) AS term FROM documents) GROUP BY term")
def doc_freq(spark, sf_dir):
    return patterns.document_frequency(records(spark, sf_dir, "taxonomy"))


SQL_TERMS = f"""td AS MATERIALIZED (SELECT doc_id, lang, {sql_words('taxonomy')} AS w FROM documents),
tdf AS MATERIALIZED (SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct(w)) AS term FROM td) GROUP BY term),
tn AS (SELECT count(*) AS n FROM td),
ts AS MATERIALIZED (SELECT vector, term, tf, df, ln(n / (df + 1.0)) AS idf, tf / df AS specificity, tf / docs * ln(n / (df + 1.0)) AS tfidf
FROM (SELECT lang AS vector, term, count(*) AS tf FROM (SELECT lang, unnest(w) AS term FROM td) GROUP BY ALL) JOIN tdf USING (term) JOIN (SELECT lang AS vector, count(*) AS docs FROM td GROUP BY lang) USING (vector), tn),
tl AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY vector ORDER BY round(tfidf, 9) DESC, term) AS rank FROM ts WHERE tf >= 3 AND specificity >= 0.6 AND len(term) >= 3 QUALIFY rank <= 15)"""


def scores(spark, sf_dir):
    """Scores of terms, their document frequencies and the number of documents."""
    docs = records(spark, sf_dir, "taxonomy")
    tf, df = patterns.term_counts(docs)
    n = docs.count()
    return patterns.scored(tf, df, docs, n), df, n


def ranked_scores(spark, sf_dir):
    """Rounded, so that ties are ties on every engine."""
    rows, df, n = scores(spark, sf_dir)
    return rows.withColumn("tfidf", F.round("tfidf", 9)), df, n


@query(f"WITH {SQL_TERMS} SELECT vector, term, tf, df, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf, round(specificity, 6) AS specificity FROM ts WHERE tf >= 3")
def tfidf_terms(spark, sf_dir):
    rows, *_ = scores(spark, sf_dir)
    return rows.where("tf >= 3").select("vector", "term", "tf", "df", *[F.round(c, 6).alias(c) for c in ("idf", "tfidf", "specificity")])


@query(f"WITH {SQL_TERMS} SELECT vector, rank, term, df, tf AS support, round(specificity, 6) AS specificity FROM tl")
def pattern_taxonomy(spark, sf_dir):
    rows, *_ = ranked_scores(spark, sf_dir)
    return patterns.learned(rows).select("vector", "rank", "term", "df", F.col("tf").alias("support"), F.round("specificity", 6).alias("specificity"))


#: tx: vector, pattern_id, keywords, boost, after SQL_TERMS.
SQL_TAXONOMY = (
    "tm(vector, keywords, specificity, support, place) AS (VALUES " + ", ".join(f"('{v}', [{sql_list(k)}], {s!r}::DOUBLE, {c}, {i})" for i, (v, k, s, c) in enumerate(fixed.MANUAL_PATTERNS)) + f"""),
tp AS (SELECT * FROM tm UNION ALL SELECT vector, [term], specificity, tf, rank + {len(fixed.MANUAL_PATTERNS)} FROM tl),
tx AS MATERIALIZED (SELECT vector, row_number() OVER (PARTITION BY vector ORDER BY place) AS pattern_id, keywords, specificity, support,
least(greatest(CASE WHEN specificity >= 0.9 THEN 5.0 WHEN specificity >= 0.8 THEN 3.0 WHEN specificity >= 0.7 THEN 2.0 WHEN specificity >= 0.6 THEN 1.0 ELSE 0.1 END
* least(0.5 + ln(n / (coalesce(df, 0) + 1.0)) / 16, 1.5) * least(1 + ln(support + 1.0) / 20, 1.2), 0.1), 5.0) AS boost FROM tp LEFT JOIN tdf ON term = keywords[1], tn)"""
)


def full_taxonomy(spark, sf_dir):
    rows, df, n = ranked_scores(spark, sf_dir)
    return patterns.taxonomy(patterns.learned(rows), df, n)


@query(f"WITH {SQL_TERMS}, {SQL_TAXONOMY} SELECT vector, pattern_id, array_to_string(keywords, '+') AS keywords, CAST(support AS BIGINT) AS support, round(boost, 6) AS boost FROM tx")
def pattern_boost(spark, sf_dir):
    return full_taxonomy(spark, sf_dir).select("vector", "pattern_id", F.array_join("keywords", "+").alias("keywords"), "support", F.round("boost", 6).alias("boost"))


@query(f"WITH {SQL_TERMS}, {SQL_TAXONOMY} SELECT count(DISTINCT vector) FILTER (vector IN (SELECT vector FROM tl)) AS total_vectors, count(*) AS total_patterns FROM tx")
def taxonomy_stats(spark, sf_dir):
    rows = full_taxonomy(spark, sf_dir)
    trained = table(spark, sf_dir, "documents", "lang").distinct().select(F.col("lang").alias("vector"), F.lit(1).alias("t"))
    return rows.join(trained, "vector", "left").agg(F.countDistinct(F.when(F.col("t") == 1, F.col("vector"))).alias("total_vectors"), F.count("*").alias("total_patterns"))
