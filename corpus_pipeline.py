"""The corpus pipeline: documents to packed training sequences, in five stages.

Cases, in every stage: null and empty texts stay rows, and of rows without words none is a copy; equal rows and near copies leave
one, whether their ids are null, equal or repeated; a null doc_id is a value like any other; very long texts are taken whole;
further columns pass through, whatever their names; an empty table gives an empty one, with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from garnetflow.llm import decontaminate, jaccard_join, packing, suffix_dedup, toxicity
from garnetflow.llm.common import written

#: Bytes of a passage that repeats: 51 words of prose take more in the languages of the corpus.
PASSAGE = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels of the documents, does not reject."""
    return toxicity.reject(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of PASSAGE bytes or more that occur again, so those of over 50 words; n_chars follows."""
    return suffix_dedup.remove_repeats(docs, length=PASSAGE).withColumn("n_chars", F.length("text").cast("long"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences. Workers also serve the other stages, so they remember fewer chunks."""
    return packing.pack_documents(docs, remembered=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: The stages learn a model and run a tokenizer, which SQL cannot express; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
