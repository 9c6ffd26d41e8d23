"""From feed records to training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import first_in_language, id_set, weakness_ids
from .report import cvss


def training_data(feed: DataFrame, *others: str) -> DataFrame:
    """cve_id, description, cwes, attack_vectors and published_date of records with an English description and a mapped weakness.

    feed: a row for each vulnerability with the column cve as sources.feeds reads it. cwes keeps repeats;
    attack_vectors is a sorted set. others: further columns that are kept.
    """
    rows = feed.select(*others, F.col("cve.id").alias("cve_id"), first_in_language(F.col("cve.descriptions")).alias("description"), weakness_ids(F.coalesce("cve.weaknesses", F.array())).alias("cwes"), F.col("cve.published").alias("published_date"))
    rows = rows.where("description <> '' and size(cwes) > 0")
    pairs = sorted((c, v) for v, cwes, _, _ in fixed.VECTOR_CATALOG for c in set(cwes))
    by_cwe: dict[str, list[str]] = {}
    for c, v in pairs:
        by_cwe.setdefault(c, []).append(v)
    # a literal map of fewer than 100 ids: no join, and the row stays in one piece
    table = F.create_map(*[x for c, vs in by_cwe.items() for x in (F.lit(c), F.array(*map(F.lit, vs)))])
    vectors = F.array_sort(F.array_distinct(F.flatten(F.transform("cwes", lambda c: F.coalesce(F.try_element_at(table, c), F.array())))))
    return rows.withColumn("attack_vectors", vectors).where("size(attack_vectors) > 0").select("cve_id", "description", "cwes", "attack_vectors", "published_date", *others)


def lookup(feed: DataFrame, ids: DataFrame) -> DataFrame:
    """id, text, cwes and cvss of the records with the ids, whatever they are like.

    The text is the English description, else the first one; the weaknesses are a sorted set and may be none or
    unmapped ones. cvss is the newest version's data, or null.
    """
    text = F.coalesce(first_in_language(F.col("cve.descriptions")), F.get("cve.descriptions.value", F.lit(0)), F.lit(""))
    rows = feed.select(F.col("cve.id").alias("id"), text.alias("text"), id_set(weakness_ids(F.coalesce("cve.weaknesses", F.array()))).alias("cwes"), cvss("cve.metrics").alias("cvss"))
    return rows.join(ids.select("id").distinct(), "id", "left_semi")


def newest(feed: DataFrame) -> DataFrame:
    """One row for each cve_id, the latest published, for feeds that overlap."""
    return feed.groupBy("cve_id").agg(F.max_by(F.struct(*[c for c in feed.columns if c != "cve_id"]), "published_date").alias("r")).select("cve_id", "r.*")
