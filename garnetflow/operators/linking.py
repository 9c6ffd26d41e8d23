"""From classified records to attack patterns and techniques."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import any_of
from .bayes import confidence
from .retrieval import jaccard_repeats, overlap_confidence, severe


def bare(key: Column) -> Column:
    """An id without its CWE- or CAPEC- prefix; both sides of a join use it, so keys match in any style."""
    return F.regexp_replace(key, "^(CWE|CAPEC)-", "")


def patterns_of(items: DataFrame, edges: DataFrame, small: bool = False) -> DataFrame:
    """items(item, cwe) with the attack patterns (capec) of its weakness; edges: src, dst. small: a catalogue that goes to every task, so that items do not move."""
    e = edges.select(bare(F.col("src")).alias("key"), bare(F.col("dst")).alias("capec")).distinct()
    return items.withColumn("key", bare(F.col("cwe"))).join(F.broadcast(e) if small else e, "key").drop("key")


def mismatched(low: Column, name: Column, description: Column) -> Column:
    """Whether an attack pattern speaks of a protocol that the lower-case text has no word for."""
    n, d = F.lower(name), F.lower(F.coalesce(description, F.lit("")))
    out = F.lit(False)
    for protocol, words in fixed.PROTOCOLS.items():
        out = out | ((F.contains(n, F.lit(protocol)) | F.contains(d, F.lit(protocol))) & ~any_of(low, words))
    return out


def keep_related(rows: DataFrame, mismatch: Column, *by: str) -> DataFrame:
    """rows without mismatches, except for keys that would lose all of theirs."""
    whole = Window.partitionBy(*by)
    rows = rows.withColumn("_bad", mismatch)
    return rows.withColumn("_all", F.min(F.col("_bad").cast("int")).over(whole) == 1).where("not _bad or _all").drop("_bad", "_all")


def rule_score(low: Column, name: Column, description: Column, severity: Column, vector: Column) -> Column:
    """Relevance by rules, before the pattern share: 30, name and vector, shared words, generic names, severity. low: the text in lower case."""
    n = F.lower(name)
    whole = F.concat(n, F.lit(" "), F.lower(F.coalesce(description, F.lit(""))))
    score = F.lit(30.0) + F.when(F.contains(n, F.lower(vector)), 40.0).otherwise(0.0)
    for w in fixed.IMPORTANT_WORDS:
        score = score + F.when(F.contains(whole, F.lit(w)) & F.contains(low, F.lit(w)), 3.0).otherwise(0.0)
    score = score + F.when(any_of(n, fixed.GENERIC_NAMES), 10.0).otherwise(0.0)
    return score + F.when(severity.isin("High", "Very High") & any_of(low, fixed.SEVERE_WORDS), 5.0).otherwise(0.0)


def judged(rows: DataFrame) -> DataFrame:
    """rows(low, vector, capec, name, description, severity and others) with `mismatch` and `rules` in place of the text.

    What needs the text is settled here, where it lies; windows and joins after this move short rows.
    """
    found = rows.withColumns({"mismatch": mismatched(*map(F.col, ("low", "name", "description"))), "rules": rule_score(*map(F.col, ("low", "name", "description", "severity", "vector")))})
    return found.drop("low")


def ranked(rows: DataFrame, taxonomy: DataFrame, n: int = 5) -> DataFrame:
    """rows(item, vector, capec, name, description, rules) with probability, confidence and rank, the first n of each item.

    Patterns of the vector add half their boost for the part of their keywords that the attack pattern has.
    """
    whole = F.concat(F.lower("name"), F.lit(" "), F.lower(F.coalesce("description", F.lit(""))))
    pairs = rows.select("capec", "vector", whole.alias("whole")).distinct().join(taxonomy.select("vector", "keywords", "boost"), "vector")
    hits = F.size(F.filter("keywords", lambda k: F.contains(F.col("whole"), F.lower(k))))
    share = pairs.groupBy("capec", "vector").agg(F.sum(hits / F.size("keywords") * F.col("boost") * 0.5).alias("share"))
    scored = rows.join(share, ["capec", "vector"], "left").withColumn("score", F.least(F.col("rules") + F.coalesce("share", F.lit(0.0)), F.lit(100.0)))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "capec")
    scored = scored.withColumns({"probability": F.col("score") / 100, "confidence": confidence(F.col("score"), 70, 50), "rank": F.row_number().over(order).cast("long")})
    return scored.where(F.col("rank") <= n).drop("share", "rules")


def overlap_ranked(rows: DataFrame, n: int = 5) -> DataFrame:
    """The older ranking: rows(item, words, capec, own, severity) by the overlap with repeats and severity, the first n of each item.

    words are the record's, own those of the attack pattern's description and name.
    """
    score = severe(jaccard_repeats(F.col("words"), F.col("own")), F.col("severity"))
    scored = rows.select("item", "capec", score.alias("probability"))
    order = Window.partitionBy("item").orderBy(F.desc("probability"), "capec")
    scored = scored.withColumns({"confidence": overlap_confidence(F.col("probability")), "rank": F.row_number().over(order).cast("long")})
    return scored.where(F.col("rank") <= n)


def techniques_of(items: DataFrame, mapping: DataFrame, techniques: DataFrame, fallback: list = fixed.FALLBACK_TECHNIQUES) -> DataFrame:
    """item and technique; items with attack patterns but no mapped technique get the fallback ones that exist.

    items: item, capec; mapping: src (attack pattern), dst (technique); techniques: technique.
    """
    known = techniques.select("technique").distinct()
    direct = items.join(mapping.select(F.col("src").alias("capec"), F.col("dst").alias("technique")), "capec").join(known, "technique").select("item", "technique").distinct()
    mapped = items.join(mapping.select(F.col("src").alias("capec")).distinct(), "capec", "left_semi").select("item")
    rest = items.select("item").distinct().join(mapped.distinct(), "item", "left_anti")
    spare = known.where(F.col("technique").isin(*fallback)).agg(F.array_sort(F.collect_list("technique")).alias("t")).first()["t"]  # `fallback` at most
    if not spare:
        return direct
    return direct.unionByName(rest.select("item", F.explode(F.array(*map(F.lit, spare))).alias("technique")))


def first_matching(items: DataFrame, mapping: DataFrame) -> DataFrame:
    """item and the first of its weaknesses whose vectors include the item's vector, else its best ranked one.

    items: item, pos, cwe, vector, best; mapping: cwe, vector.
    """
    norm = F.replace(F.lower("vector"), F.lit(" "), F.lit("_"))
    hits = items.withColumn("vector", norm).join(mapping.select("cwe", "vector").distinct(), ["cwe", "vector"]).groupBy("item").agg(F.min_by("cwe", "pos").alias("hit"))
    return items.select("item", "best").distinct().join(hits, "item", "left").select("item", F.coalesce("hit", "best").alias("cwe"))
