"""Queries by name, each beside the SQL that checks it, and what both sides share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import fixed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = sql
        return f

    return add


#: Columns whose work is worth a shuffle where a file is one split.
HEAVY = {"text", "html", "embedding"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table with the columns that a query needs, heavy ones on all cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return spread(df) if HEAVY & {*df.columns} else df


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if its scan has fewer splits than these; a larger table stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)


# --- SQL of the tokenisers, written apart from the Spark expressions ---

_WORD = {"train": "[a-z][a-z0-9]*", "batch": "[a-z0-9]+", "retrieval": "[a-z0-9]+", "cwe_name": "[a-z0-9]+"}


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_words(profile: str, text: str = "text") -> str:
    low = f"lower({text})"
    if profile not in ("batch", "retrieval", "cwe_name"):
        ids = r"cve-\d{4}-\d+" if profile == "train" else r"\bcve-\d{4}-\d+\b"
        low = rf"regexp_replace(regexp_replace({low}, '\b\d+\.\d+(\.\d+)*\b', '', 'g'), '{ids}', '', 'g')"
    return f"list_filter(regexp_extract_all({low}, '{_WORD.get(profile, '[a-z]{3,}')}'), lambda w: len(w) >= 3 AND w NOT IN ({sql_list(fixed.STOP_WORDS[profile])}))"


def sql_any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {sql_list([w])})" for w in words) + ")"


#: Stand-ins for the weaknesses of a record, with repeats, and for the vectors of a weakness.
SQL_CWES = "[doc_id % 25, (doc_id * 7) % 25]"
LANGS = ["en", "fr", "de", "es"]
SQL_NODE_VECTOR = "SELECT CAST(n_nationkey AS BIGINT) AS node, (['en', 'fr', 'de', 'es'])[n_nationkey % 4 + 1] AS vector FROM nation"
