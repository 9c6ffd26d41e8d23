"""Queries of text functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as tx
from ..operators import keywords, linking
from .registry import query, sql_any, sql_list, sql_words, table


def _tokens(profile: str):
    def run(spark, sf_dir):
        rows = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("w", tx.tokenize("text", profile))
        return rows.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("tokens_md5"))

    sql = f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, md5(array_to_string(w, ' ')) AS tokens_md5 FROM (SELECT doc_id, {sql_words(profile)} AS w FROM documents)"
    query(sql, f"tok_{profile}")(run)


for _profile in ("train", "taxonomy", "serving", "batch", "retrieval", "report", "ranking"):
    _tokens(_profile)

_SQL_CLEAN = r"regexp_replace(regexp_replace(regexp_replace({}, '<[^>]+>', '', 'g'), '(^\s+)|(\s+$)', '', 'g'), '\s+', ' ', 'g')"


@query(f"SELECT page_id, md5({_SQL_CLEAN.format('html')}) AS clean_md5, CAST(length({_SQL_CLEAN.format('html')}) AS BIGINT) AS n_chars FROM pages")
def clean_html(spark, sf_dir):
    rows = table(spark, sf_dir, "pages", "page_id", "html").withColumn("c", tx.clean(F.col("html")))
    return rows.select("page_id", F.md5("c").alias("clean_md5"), F.length("c").cast("long").alias("n_chars"))


@query(f"SELECT page_id, md5(array_to_string(list_filter([{_SQL_CLEAN.format('url')}, {_SQL_CLEAN.format('html')}], lambda x: x <> ''), ' ')) AS text_md5 FROM pages")
def description_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return rows.select("page_id", F.md5(tx.described(F.col("url"), F.col("html"))).alias("text_md5"))


@query("SELECT p_partkey, substr(p_brand, 7) AS brand_id FROM part WHERE starts_with(p_brand, 'Brand#')")
def strip_prefix(spark, sf_dir):
    rows = table(spark, sf_dir, "part", "p_partkey", "p_brand").withColumn("ids", tx.stripped_ids(F.array("p_brand"), "Brand#"))
    return rows.where("size(ids) > 0").select("p_partkey", F.col("ids")[0].alias("brand_id"))


@query("SELECT conv_id, arg_min(text, turn) AS value FROM conversations WHERE role = 'user' GROUP BY conv_id HAVING arg_min(text, turn) <> ''")
def first_match(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return tx.first_of(turns, "conv_id", "role", "user", "turn", "text").where("value <> ''")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct([substr(v, 7) FOR v IN [p_brand, 'none', 'Brand#7', p_brand, 'Brand#' || p_size] IF starts_with(v, 'Brand#')])), ',') AS ids FROM part")
def cwe_set(spark, sf_dir):
    values = F.array(F.col("p_brand"), F.lit("none"), F.lit("Brand#7"), F.col("p_brand"), F.concat(F.lit("Brand#"), F.col("p_size").cast("string")))
    return table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size").select("p_partkey", F.array_join(tx.id_set(tx.stripped_ids(values, "Brand#")), ",").alias("ids"))


@query(f"SELECT p_partkey, array_to_string({sql_words('cwe_name', 'p_name')}, ',') AS keywords FROM part")
def cwe_keywords(spark, sf_dir):
    return table(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", F.array_join(tx.tokenize("p_name", "cwe_name"), ",").alias("keywords"))


_SQL_SIGNIFICANT = rf"""list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '(^\s+)|(\s+$)', '', 'g'), '\s+'), lambda w: regexp_replace(w, '(^[.,;:!?()\[\]{{}}"'']+)|([.,;:!?()\[\]{{}}"'']+$)', '', 'g')), lambda w: strlen(w) > 3 AND w NOT IN ({sql_list(fixed.STOP_WORDS["significant"])}))"""


@query(f"SELECT item_id, CAST(len(w) AS BIGINT) AS n, md5(array_to_string(w, ' ')) AS words_md5 FROM (SELECT item_id, {_SQL_SIGNIFICANT} AS w FROM benchmark)")
def significant_words(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark", "item_id", "text").withColumn("w", tx.significant_words(F.col("text")))
    return rows.select("item_id", F.size("w").cast("long").alias("n"), F.md5(F.array_join("w", " ")).alias("words_md5"))


@query(
    """SELECT p_partkey, array_to_string(list_concat([ph], list_filter(list_transform(regexp_split_to_array(ph, '\\s+'), lambda w: regexp_replace(w, '(^['',.]+)|(['',.]+$)', '', 'g')), lambda w: strlen(w) >= 4)), '|') AS context
FROM (SELECT p_partkey, regexp_replace(lower(CASE WHEN p_size % 2 = 0 THEN p_name ELSE 'improper ' || p_name END), '^improper ', '') AS ph FROM part)"""
)
def name_context(spark, sf_dir):
    # every second name holds its phrase in quoted parentheses, the others have a prefix that goes
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("CWE-7: Improper use ('"), "p_name", F.lit("')"))).otherwise(F.concat(F.lit("CWE-8: Improper "), "p_name"))
    return table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size").select("p_partkey", F.array_join(tx.weakness_context(name), "|").alias("context"))


_ANY = ["with the", "tion", "por", "eaux"]


@query(f"SELECT doc_id, {sql_any('lower(text)', _ANY)} AS hit FROM documents")
def any_pattern(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tx.any_of(F.lower("text"), _ANY).alias("hit"))


@query("SELECT doc_id, p_type FROM documents JOIN (SELECT DISTINCT p_type FROM part) ON contains(lower(text), lower(left(p_type, 2))) AND contains(lower(text), lower(right(p_type, 1)))")
def all_pattern(spark, sf_dir):
    types = table(spark, sf_dir, "part", "p_type").distinct().select("p_type", F.array(F.lower(F.substring("p_type", 1, 2)), F.lower(F.expr("right(p_type, 1)"))).alias("keywords"))
    return keywords.match(table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.lower("text").alias("low")), types)


_SQL_ITEM_WORDS = "list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))"


@query(
    f"""WITH w AS (SELECT item_id, {_SQL_ITEM_WORDS} AS w FROM benchmark), u AS (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS place FROM w),
p AS MATERIALIZED (SELECT DISTINCT left(w[place], 5) AS head, substring(coalesce(w[place + 1], 'there'), 2, 4) AS inner_part FROM u), d AS MATERIALIZED (SELECT doc_id, lower(text) AS low FROM documents)
SELECT doc_id, count(*) AS patterns, min(head || '+' || inner_part) AS first FROM d JOIN p ON contains(low, head) AND contains(low, inner_part) GROUP BY doc_id"""
)
def keyword_index(spark, sf_dir):
    """A large catalogue, two keywords for each pair of neighbouring words of the benchmark, against all documents."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"), 1))
    pairs = table(spark, sf_dir, "benchmark", "item_id", "text").select(found.alias("w")).select("w", F.posexplode("w").alias("place", "word"))
    after = F.substring(F.coalesce(F.get("w", F.col("place") + 1), F.lit("there")), 2, 4)
    pairs = pairs.select(F.substring("word", 1, 5).alias("head"), after.alias("inner_part")).distinct()
    catalogue = pairs.select(F.concat_ws("+", "head", "inner_part").alias("name"), F.array("head", "inner_part").alias("keywords"))
    rows = keywords.match(table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.lower("text").alias("low")), catalogue)
    return rows.groupBy("doc_id").agg(F.count("*").alias("patterns"), F.min("name").alias("first"))


_LAYERS = ["er.*(?:th|an)", r"(?:en|es)\s+de", "ch(?:er|en)"]


@query("SELECT doc_id, " + ", ".join(f"regexp_matches(text, '(?i){p}') AS layer{k}" for k, p in enumerate(_LAYERS)) + " FROM documents")
def regex_layers(spark, sf_dir):
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", *[F.col("text").rlike(f"(?i){p}").alias(f"layer{k}") for k, p in enumerate(_LAYERS)])


#: A phrase for each document, so that rules about attacks have something to find in the synthetic prose.
PHRASES = ["ldap directory lookup", "sql injection in a database query", "arbitrary code execution via eval", "cross-site scripting xss", "path traversal with ../", "ssrf url fetch", "heap overflow in xml parser", "authentication bypass over dns", "execute a shell command", "usb and bluetooth email", "nothing"]
SQL_SAID = f"concat(text, ' ', ([{sql_list(PHRASES)}])[CAST(doc_id % {len(PHRASES)} AS INTEGER) + 1])"


def said(doc_id="doc_id", text="text"):
    return F.concat(text, F.lit(" "), F.array(*map(F.lit, PHRASES))[(F.col(doc_id) % len(PHRASES)).cast("int")])


#: Names of attack patterns to link, as a stand-in for the catalogue.
CAPECS = [
    ("66", "SQL Injection", "injects sql into a database query", "High"),
    ("136", "LDAP Injection", "manipulates ldap queries", "High"),
    ("88", "OS Command Injection", "executes a command through the shell", "Very High"),
    ("63", "Cross-Site Scripting", "script code in a page", "Medium"),
    ("126", "Path Traversal", "reads files outside of a directory", "Medium"),
    ("250", "XML Injection", "crafted xml or xpath", "Low"),
    ("142", "DNS Cache Poisoning", "false dns records", "High"),
    ("100", "Overflow Buffers", "arbitrary code execution by overflow", "Very High"),
]
SQL_CAPECS = "(VALUES " + ", ".join(f"({sql_list(r)})" for r in CAPECS) + ") AS capecs(capec, name, description, severity)"
SQL_MISMATCH = " OR ".join(f"((contains(lower(name), '{p}') OR contains(lower(description), '{p}')) AND NOT {sql_any('lower(said)', words)})" for p, words in fixed.PROTOCOLS.items())


def capecs(spark):
    return spark.createDataFrame(CAPECS, "capec string, name string, description string, severity string")


def capec_links(spark, sf_dir):
    """item, said, low (said in lower case) and three attack patterns for each document."""
    order = [c for c, *_ in CAPECS]
    at = lambda k: F.array(*map(F.lit, order))[((F.col("doc_id") * k + k) % len(order)).cast("int")]
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").select("doc_id", "lang", said().alias("said"), F.lower(said()).alias("low"))
    return docs.select("*", F.explode(F.array_distinct(F.array(at(1), at(3), at(5)))).alias("capec")).join(F.broadcast(capecs(spark)), "capec")


SQL_LINKS = f"""(SELECT doc_id, lang, said, capec, name, description, severity FROM
(SELECT doc_id, lang, {SQL_SAID} AS said, unnest(list_distinct(list_transform([1, 3, 5], lambda k: ([{sql_list([c for c, *_ in CAPECS])}])[CAST((doc_id * k + k) % {len(CAPECS)} AS INTEGER) + 1]))) AS capec FROM documents)
JOIN {SQL_CAPECS} USING (capec))"""


@query(f"SELECT doc_id, capec FROM (SELECT doc_id, capec, ({SQL_MISMATCH}) AS bad FROM {SQL_LINKS}) QUALIFY NOT bad OR bool_and(bad) OVER (PARTITION BY doc_id)")
def mismatch_filter(spark, sf_dir):
    rows = capec_links(spark, sf_dir)
    rows = rows.select("doc_id", "capec", linking.mismatched(*map(F.col, ("low", "name", "description"))).alias("mismatch"))
    return linking.keep_related(rows, F.col("mismatch"), "doc_id").select("doc_id", "capec")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d1, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS d2 FROM orders")
def format_date(spark, sf_dir):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return rows.select("o_orderkey", tx.day_of(F.concat(stamp, F.lit("Z"))).alias("d1"), tx.day_of(F.concat(stamp, F.lit(".000"))).alias("d2"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(url || html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped_md5 FROM pages")
def escape_html(spark, sf_dir):
    return table(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", F.md5(tx.escaped(F.concat("url", "html"))).alias("escaped_md5"))


@query("SELECT s_suppkey, 'CVE-' || s_suppkey AS cve, list_aggregate([CAST(s_nationkey AS VARCHAR), 'X' || s_suppkey], 'string_agg', ',') AS cwes FROM supplier")
def id_normalise(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    typed = F.concat(F.lit("cwe-"), "s_nationkey", F.lit(" , CWE-x"), "s_suppkey")
    return rows.select("s_suppkey", tx.cve_name(F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lit("cve-")).otherwise(F.lit("")), F.col("s_suppkey").cast("string"))).alias("cve"), F.array_join(tx.weakness_list(typed), ",").alias("cwes"))


@query(
    "WITH m(cwe, vectors) AS (VALUES " + ", ".join(f"('{c}', [{sql_list(v)}])" for c, v in fixed.CWE_VECTORS) + "), n(id, name) AS (VALUES " + ", ".join(f"({sql_list(x)})" for x in fixed.VECTOR_NAMES.items()) + ") "
    "SELECT doc_id, vector, coalesce(name, vector) AS name FROM (SELECT DISTINCT doc_id, unnest(vectors) AS vector FROM documents JOIN m ON cwe = CAST(doc_id % 1000 AS VARCHAR)) LEFT JOIN n ON id = vector"
)
def vector_names(spark, sf_dir):
    """The vectors of the documents' weaknesses, with their display names."""
    from ..operators.classify import named

    vectors = spark.createDataFrame(fixed.CWE_VECTORS, "cwe string, vectors array<string>")
    docs = table(spark, sf_dir, "documents", "doc_id").select("doc_id", (F.col("doc_id") % 1000).cast("string").alias("cwe"))
    return named(docs.join(F.broadcast(vectors), "cwe").select("doc_id", F.explode("vectors").alias("vector")).distinct())


@query("SELECT p_partkey, p_name || ': ' || p_type AS text FROM part")
def embedding_text(spark, sf_dir):
    return table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type").select("p_partkey", tx.cut_bytes(tx.titled(F.col("p_name"), F.col("p_type"))).alias("text"))
