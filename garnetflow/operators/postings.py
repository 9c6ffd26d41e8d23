"""A stored inverted index with the largest weight of each block, and top-k search that skips blocks.

Documents are put in blocks of 2**BLOCK_BITS, those of like length together. A row of the index is a term and a block: the documents
of the block that have the term, with what each weighs there under BM25 and under TF-IDF cosine, and the bounds of these weights.
The index is built once and probed by any number of searches.

A search adds up, for each query and block, the bounds of the query's terms, which no document of the block can pass. The SEEDS blocks
with the greatest sums are scored first; their k-th best score is a threshold, and of the other blocks only those whose sum
reaches it are read. So the bounds, a few numbers a row, are read of every block of a query's terms, and postings only where
they can matter. The results are those of scoring every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .patterns import idf

K1, B = 1.5, 0.75
BLOCK_BITS, SEEDS = 4, 12
#: Rows of queries and terms up to which the queries go to every task.
BROADCAST = 500_000
#: Digits to which scores are compared: what ties within them is kept and decided by the caller's order.
SLACK = 1e-6
KINDS = ("bm25", "cosine")


@dataclass
class Index:
    """Where the index lies, and what it counted: documents and their mean length."""

    path: str
    n: int
    mean: float

    def blocks(self, spark: SparkSession) -> DataFrame:
        """term, block, n, bounds of both kinds, postings."""
        return spark.read.parquet(f"{self.path}/blocks")

    def terms(self, spark: SparkSession) -> DataFrame:
        """term and df."""
        return spark.read.parquet(f"{self.path}/terms")


def build(docs: DataFrame, path: str) -> Index:
    """Writes the index of docs (id, words) under a path. Rows without words count as documents and have no postings; null words tell nothing of the mean length."""
    spark = docs.sparkSession
    sized = docs.select("id", "words", F.when(F.col("words").isNotNull(), F.size("words")).alias("len"))
    stats = sized.agg(F.count("*").alias("n"), F.avg("len").alias("mean")).first()
    n, mean = stats["n"], float(stats["mean"] or 0) or 1.0
    # like lengths side by side, so that the bounds of a block say something of all its documents
    rows = sized.where("len > 0").repartitionByRange("len", "id").sortWithinPartitions("len", "id")
    rows = rows.withColumn("at", F.monotonically_increasing_id()).select("at", "id", "len", F.explode("words").alias("term"))
    rows.groupBy("at", "id", "len", "term").agg(F.count("*").alias("tf")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    counts.groupBy("term").agg(F.count("*").alias("df")).write.parquet(f"{path}/terms")
    rows = counts.join(spark.read.parquet(f"{path}/terms"), "term")
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    bm25 = F.ln((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1) * part
    rows = rows.select("at", "id", "term", bm25.alias("bm25"), (F.col("tf") / F.col("len") * idf(F.lit(float(n)), F.col("df"))).alias("x"))
    norms = rows.groupBy("at").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    rows = rows.join(norms, "at").withColumn("cosine", F.when(F.col("norm") > 0, F.col("x") / F.col("norm")).otherwise(0.0))
    bounds = [f(k).alias(f"{name}_{k}") for k in KINDS for f, name in ((F.max, "most"), (F.min, "least"))]
    blocks = rows.groupBy("term", F.shiftright("at", BLOCK_BITS).alias("block")).agg(F.count("*").alias("n"), *bounds, F.collect_list(F.struct("id", *KINDS)).alias("postings"))
    # terms in ranges, so that a scan for some terms skips files and row groups
    blocks.repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/blocks")
    return Index(path, n, mean)


def cosine_weights(index: Index, queries: DataFrame) -> DataFrame:
    """query, term, weight of queries (query, words), weighted as the documents are and scaled to length 1. Terms the index has not fall away."""
    spark = queries.sparkSession
    rows = queries.select("query", F.size("words").alias("len"), F.explode("words").alias("term")).groupBy("query", "len", "term").agg(F.count("*").alias("tf"))
    rows = index.terms(spark).join(F.broadcast(rows) if rows.count() <= BROADCAST else rows, "term")
    rows = rows.select("query", "term", (F.col("tf") / F.col("len") * idf(F.lit(float(index.n)), F.col("df"))).alias("x"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("query")))
    return rows.select("query", "term", norm.alias("norm"), "x").select("query", "term", F.when(F.col("norm") > 0, F.col("x") / F.col("norm")).otherwise(0.0).alias("weight"))


def bounded(index: Index, queries: DataFrame, kind: str) -> DataFrame:
    """query, block, bound (no document of the block scores more) and n, the postings of its terms there. queries: query, term, weight."""
    w = F.col("weight")
    bound = F.greatest(w * F.col(f"most_{kind}"), w * F.col(f"least_{kind}"), F.lit(0.0))
    rows = index.blocks(queries.sparkSession).select("term", "block", "n", f"most_{kind}", f"least_{kind}")
    return rows.join(queries, "term").groupBy("query", "block").agg(F.sum(bound).alias("bound"), F.sum("n").alias("n"))


def scored(index: Index, queries: DataFrame, wanted: DataFrame, kind: str) -> DataFrame:
    """query, id and score of the documents in the wanted (query, block)."""
    asked = wanted.select("query", "block").join(queries, "query")
    rows = index.blocks(queries.sparkSession).select("term", "block", "postings").join(asked, ["term", "block"])
    rows = rows.select("query", "block", "weight", F.explode("postings").alias("p"))
    return rows.groupBy("query", "block", F.col("p.id").alias("id")).agg(F.sum(F.col("weight") * F.col(f"p.{kind}")).alias("score")).drop("block")


def _first(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.withColumn("__rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("__rank") <= n).drop("__rank")


def chosen(index: Index, queries: DataFrame, kind: str, k: int, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """The blocks that are scored first, with their documents' scores, and those of the others that may hold one of the best k."""
    every = bounded(index, queries, kind)
    first = _first(every, seeds, F.desc("bound"), F.asc("block"))
    scores = scored(index, queries, first, kind)
    best = _first(scores, k, F.desc("score")).groupBy("query").agg(F.count("*").alias("have"), F.min("score").alias("least"))
    floor = best.where(F.col("have") >= k).select("query", (F.col("least") - SLACK - F.abs("least") * 1e-9).alias("floor"))
    rest = every.join(first.select("query", "block"), ["query", "block"], "left_anti").join(floor, "query", "left")
    return scores, rest.where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor"))).drop("floor")


def search(index: Index, queries: DataFrame, kind: str = "bm25", k: int = 10, seeds: int = SEEDS) -> DataFrame:
    """query, id and score of the k best documents of each query, with all that tie with the k-th within SLACK.

    queries: query, term, weight; a query without terms of the index, or null terms, gives no row.
    """
    queries = queries.where(F.col("term").isNotNull())
    if queries.count() <= BROADCAST:
        queries = F.broadcast(queries)
    scores, rest = chosen(index, queries, kind, k, seeds)
    rows = scores.unionByName(scored(index, queries, rest, kind))
    rank = F.rank().over(Window.partitionBy("query").orderBy(F.desc(F.round("score", 6))))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= k).drop("__rank")


def term_counts(queries: DataFrame) -> DataFrame:
    """query, term, weight of queries (query, words) for BM25: how often the term occurs."""
    return queries.select("query", F.explode("words").alias("term")).groupBy("query", "term").agg(F.count("*").cast("double").alias("weight"))
