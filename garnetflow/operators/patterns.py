"""Keyword patterns of each vector by TF-IDF, with manual ones before them, and their boosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..sources.shared import stored
from . import counting, keywords

LEAST_TF, LEAST_SPECIFICITY, LEAST_LENGTH, MOST = 3, 0.6, 3, 15


def document_frequency(docs: DataFrame) -> DataFrame:
    """docs(id, words) to term, df."""
    return docs.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def idf(n: Column | int, df: Column) -> Column:
    """ln(n / (1 + df)); negative for terms in almost all documents."""
    return F.ln((F.lit(n) if isinstance(n, int) else n) / (df + 1.0))


def term_counts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """label, term, tf, and term, df, of records(label, words) with one label each, from one pass over these."""
    counted = stored(counting.word_counts(records).withColumnRenamed("word", "term"), "terms")
    return counted.select("label", "term", F.col("cnt").alias("tf")), counted.groupBy("term").agg(F.sum("rows").alias("df"))


def term_scores(records: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """vector, term, tf, df, idf, tfidf and specificity. records: vector, words (a row for each label); docs: id, words; n documents."""
    tf = counting.word_counts(records).select("label", F.col("word").alias("term"), F.col("cnt").alias("tf"))
    return scored(tf, document_frequency(docs), records, n)


def scored(tf: DataFrame, df: DataFrame, records: DataFrame, n: int) -> DataFrame:
    """term_scores() from counts that are known: tf(label, term, tf) and df(term, df)."""
    size = records.groupBy("label").agg(F.count("*").alias("docs"))
    rows = tf.join(df, "term").join(F.broadcast(size), "label")
    # occurrences over documents: may pass 1
    rows = rows.withColumns({"idf": idf(n, F.col("df")), "specificity": F.col("tf") / F.col("df")})
    return rows.withColumn("tfidf", F.col("tf") / F.col("docs") * F.col("idf")).withColumnRenamed("label", "vector")


def learned(scores: DataFrame) -> DataFrame:
    """The best terms of each vector that are frequent and specific enough."""
    keep = scores.where((F.col("tf") >= LEAST_TF) & (F.col("specificity") >= LEAST_SPECIFICITY) & (F.length("term") >= LEAST_LENGTH))
    order = Window.partitionBy("vector").orderBy(F.desc("tfidf"), "term")
    return keep.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= MOST)


def boost(specificity: Column, idf_first: Column, support: Column) -> Column:
    """Base by specificity, raised by the idf of the first keyword and by support, within 0.1 and 5."""
    base = F.when(specificity >= 0.9, 5.0).when(specificity >= 0.8, 3.0).when(specificity >= 0.7, 2.0).when(specificity >= 0.6, 1.0).otherwise(0.1)
    raised = base * F.least(0.5 + idf_first / 16, F.lit(1.5)) * F.least(1 + F.ln(support + 1.0) / 20, F.lit(1.2))
    return F.least(F.greatest(raised, F.lit(0.1)), F.lit(5.0))


def taxonomy(learned_rows: DataFrame, df: DataFrame, n: int, manual: list = fixed.MANUAL_PATTERNS) -> DataFrame:
    """vector, pattern_id, keywords, specificity, support, boost: manual patterns come first, and all boosts are computed."""
    spark = learned_rows.sparkSession
    own = spark.createDataFrame([(v, k, s, c, i) for i, (v, k, s, c) in enumerate(manual)], "vector string, keywords array<string>, specificity double, support long, place long")
    rest = learned_rows.select("vector", F.array("term").alias("keywords"), "specificity", F.col("tf").alias("support"), (F.col("rank") + len(manual)).alias("place"))
    rows = own.unionByName(rest)
    first = rows.withColumn("term", F.col("keywords")[0]).join(df, "term", "left")
    known = F.coalesce("df", F.lit(0))
    order = Window.partitionBy("vector").orderBy("place")
    return first.select("vector", F.row_number().over(order).cast("long").alias("pattern_id"), "keywords", "specificity", "support", boost(F.col("specificity"), idf(n, known), F.col("support")).alias("boost"))


def matches(docs: DataFrame, candidates: DataFrame, patterns: DataFrame, indexed: bool = False) -> DataFrame:
    """item, vector and each pattern of the vector whose keywords the lower-case text all holds.

    A document meets the list of its vectors and the catalogue as one row, so its text is copied for no vector
    and no pattern; only what matches becomes rows. indexed: a large catalogue is met through its index of rare q-grams.
    """
    if indexed:
        docs, wanted = docs.select(F.col("id").alias("item"), F.lower("text").alias("low")), candidates.select("item", "vector").distinct()
        return keywords.match(docs, patterns, keywords.index(patterns, docs)).join(wanted, ["item", "vector"], "left_semi").select("item", *patterns.drop("keywords").columns)
    others = [c for c in patterns.columns if c != "vector"]
    wanted = candidates.groupBy("item").agg(F.collect_list("vector").alias("wanted"))
    catalogue = patterns.groupBy("vector").agg(F.collect_list(F.struct(*others)).alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("vector", "of"))).alias("all"))
    rows = docs.select(F.col("id").alias("item"), F.lower("text").alias("low")).join(wanted, "item").join(F.broadcast(catalogue))
    of = lambda v: F.filter(F.coalesce(F.element_at("all", v), F.array()), lambda p: F.forall(p["keywords"], lambda k: F.contains(F.col("low"), k)))
    found = F.flatten(F.transform("wanted", lambda v: F.transform(of(v), lambda p: F.struct(v.alias("vector"), *[p[c].alias(c) for c in others]))))
    # inline() would have its lists made again for a filter on empty ones
    return rows.select("item", found.alias("found")).select("item", F.inline_outer("found")).where(F.col("vector").isNotNull())


def boosts(found: DataFrame) -> DataFrame:
    """The sum of the boosts of all matching patterns, uncapped."""
    return found.groupBy("item", "vector").agg(F.sum("boost").alias("boost"))
