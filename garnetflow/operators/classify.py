"""The layered classifier: relevance of weaknesses, candidates, Naive Bayes, frequency and pattern layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import any_of, tokenize
from . import bayes, patterns

FLOOR = 1e-4


def triggers(low: Column) -> Column:
    """For each trigger rule whether the lower-case text sets it off: one pass over the text serves all weaknesses."""
    return F.array(*[reduce(lambda a, b: a & b, [any_of(low, s) for s in sets]) for sets, _ in fixed.CWE_TRIGGERS])


def name_hits(low: Column, name: Column) -> Column:
    """How many of a weakness's name words the lower-case text holds."""
    return F.aggregate(tokenize(name, "cwe_name"), F.lit(0), lambda a, k: a + F.contains(low, k).cast("int"))


def relevance(cwe: Column, name: Column, vectors: Column, hits: Column, flags: Column, commands: bool = True) -> Column:
    """How well a weakness fits a description: name words, priority, triggers, penalties, mapped vectors; 0 at least.

    hits and flags come from name_hits() and triggers(), so no text is needed here. commands=False leaves out the
    trigger of command and shell words, as relabelling does. A null name means an unknown weakness and scores 0.
    """
    of = lambda table: reduce(lambda c, kv: c.when(cwe == kv[0], kv[1]), table.items(), F.when(F.lit(False), 0)).otherwise(0)
    score = hits * 10 + of(fixed.CWE_PRIORITY) - of(fixed.CWE_PENALTY) + vectors * 5
    for k, (_, bonus) in enumerate(fixed.CWE_TRIGGERS):
        if commands or k != fixed.COMMAND_TRIGGER:
            score = score + F.when(F.get(flags, F.lit(k)), of(bonus)).otherwise(0)
    return F.when(name.isNull(), 0).otherwise(F.greatest(score, F.lit(0))).cast("long")


def weighed(docs: DataFrame, weaknesses: Column) -> DataFrame:
    """docs without `low`, a row for each of its weaknesses, with flags and hits. The text is read once and not copied.

    docs: low and others; weaknesses: array of structs of pos, cwe, name and vectors.
    """
    rest = [F.col(c) for c in docs.columns if c != "low"]
    fields = ("pos", "cwe", "name", "vectors")
    found = F.transform(weaknesses, lambda w: F.struct(*[w[f].alias(f) for f in fields], name_hits(F.col("low"), w["name"]).alias("hits")))
    return docs.select(*rest, triggers(F.col("low")).alias("flags"), found.alias("_found")).select(*rest, "flags", F.inline("_found"))


def first_by(rows: DataFrame, by: str, n: int, *order) -> DataFrame:
    """The first n rows of each key."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("rank") <= n)


def frequency_matches(pairs: DataFrame, cwes: DataFrame, lists: DataFrame) -> DataFrame:
    """(item, vector) with how many of the item's weaknesses, repeats included, its vector's short list has.

    pairs: item, vector; cwes: item, cwe; lists: vector, cwe. matches is null where the vector has no list.
    """
    listed = lists.select("vector").distinct().withColumn("listed", F.lit(True))
    hits = pairs.join(cwes, "item").join(lists, ["vector", "cwe"]).groupBy("item", "vector").agg(F.count("*").alias("matches"))
    rows = pairs.join(listed, "vector", "left").join(hits, ["item", "vector"], "left")
    return rows.select("item", "vector", F.when(F.col("listed"), F.coalesce("matches", F.lit(0))).alias("matches"))


def eliminated(rows: DataFrame, guarded: bool = True) -> DataFrame:
    """Rows that stay: a listed vector without a match goes, unless (guarded) that would leave an item none."""
    away = (F.coalesce("matches", F.lit(1)) == 0).cast("int")
    if not guarded:
        return rows.where(away == 0)
    whole = Window.partitionBy("item")
    return rows.withColumn("go", away).withColumn("all", F.sum("go").over(whole) == F.count("*").over(whole)).where("go = 0 or all").drop("go", "all")


def hybrid(docs: DataFrame, model: bayes.Model, candidates: DataFrame, cwes: DataFrame, taxonomy: DataFrame, lists: DataFrame, guarded: bool = True) -> DataFrame:
    """id, label, score, probability, confidence and layers of each document, by all layers.

    docs: id, text, words; candidates: item, vector; cwes: item, cwe (the document's own list, repeats
    included); taxonomy as patterns.taxonomy gives it; lists: vector, cwe.
    """
    scores = bayes.log_scores(docs, model, candidates).select(F.col("id").alias("item"), F.col("label").alias("vector"), "score")
    own = cwes.groupBy("item").agg(F.collect_list("cwe").alias("own"))
    listed = lists.groupBy("vector").agg(F.collect_set("cwe").alias("listed"))
    rows = scores.join(own, "item", "left").join(listed, "vector", "left")
    counted = F.size(F.filter(F.coalesce("own", F.array()), lambda c: F.array_contains("listed", c))).cast("long")
    rows = rows.select("item", "vector", "score", F.when(F.col("listed").isNotNull(), counted).alias("matches"), F.when(F.col("own").isNotNull(), F.size("own")).alias("n_cwes"))
    rows = eliminated(rows, guarded)
    boosted = patterns.boosts(patterns.matches(docs, candidates, taxonomy))
    marked = candidates.select("item", "vector", F.lit(True).alias("candidate"))
    rows = rows.join(boosted, ["item", "vector"], "left").join(marked, ["item", "vector"], "left")
    frequent = F.coalesce(F.when(F.col("matches") > 0, F.col("matches") / F.least("n_cwes", F.lit(5)) * 20.0), F.lit(0.0))
    rows = rows.withColumn("score", F.col("score") + F.coalesce("boost", F.lit(0.0)) + frequent)
    layers = F.array(F.when(F.col("candidate"), "CWE Hierarchy"), F.lit("Naive Bayes"), F.when(F.col("boost").isNotNull(), "Pattern Matching"), F.when(F.col("matches") > 0, "CWE Frequency"))
    rows = rows.select(F.col("item").alias("id"), F.col("vector").alias("label"), "score", F.filter(layers, lambda x: x.isNotNull()).alias("layers"))
    return bayes.softmax(rows).withColumn("confidence", bayes.confidence(F.col("probability")))


def gap_filter(rows: DataFrame, by: str = "id", label: str = "label", probability: str = "probability") -> DataFrame:
    """Rows worth showing: all if the leader is weak, near followers if it is strong, else three within a gap."""
    order = Window.partitionBy(by).orderBy(F.desc(probability), label)
    p, top = F.col(probability), F.first(probability).over(order)
    rows = rows.withColumns({"top": top, "rank": F.row_number().over(order).cast("long"), "gap": top - p})
    keep = F.when(F.col("top") < 0.6, True).when(F.col("rank") == 1, True).when(F.col("top") > 0.9, F.col("gap") < 0.2).otherwise((F.col("rank") <= 3) & (F.col("gap") < 0.3))
    return rows.where(keep).drop("top")


def hybrid_batch(docs: DataFrame, model: bayes.Model, candidates: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """id and its three best vectors for relabelling: 3 for each candidate, 2 p of the three likeliest, 1.5 of the three best pattern sums.

    Documents without a candidate are "unknown".
    """
    base = candidates.select("item", "vector", F.lit(3.0).alias("score"))
    likely = bayes.softmax(bayes.log_scores(docs.join(candidates.select(F.col("item").alias("id")).distinct(), "id"), model, candidates))
    likely = first_by(likely, "id", 3, F.desc("probability"), "label").select(F.col("id").alias("item"), F.col("label").alias("vector"), (F.col("probability") * 2.0).alias("score"))
    found = patterns.matches(docs, candidates, taxonomy).groupBy("item", "vector").agg(F.least(F.sum(F.col("boost") / 100.0 * F.col("specificity")), F.lit(5.0)).alias("p")).where("p > 0")
    found = first_by(found, "item", 3, F.desc("p"), "vector").select("item", "vector", (F.col("p") * 1.5).alias("score"))
    total = base.unionByName(likely).unionByName(found).groupBy("item", "vector").agg(F.sum("score").alias("score"))
    best = first_by(total, "item", 3, F.desc("score"), "vector")
    best = best.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("rank", "vector"))).alias("l")).select(F.col("item").alias("id"), F.col("l.vector").alias("vectors"))
    return docs.select("id").join(best, "id", "left").select("id", F.coalesce("vectors", F.array(F.lit("unknown"))).alias("vectors"))


def routed(items: DataFrame, nodes: DataFrame) -> DataFrame:
    """items(item, cwes) with `single`: whether the list has one entry, repeats counted, that is a node."""
    only = F.when(F.size("cwes") == 1, F.col("cwes")[0])
    rows = items.withColumn("only", only).join(nodes.select(F.col("node").alias("only"), F.lit(True).alias("known")).distinct(), "only", "left")
    return rows.withColumn("single", F.coalesce("known", F.lit(False))).drop("known", "only")


def named(rows: DataFrame, vector: str = "vector") -> DataFrame:
    """rows with the display name of a vector, or its id where it has none."""
    names = rows.sparkSession.createDataFrame(list(fixed.VECTOR_NAMES.items()), f"{vector} string, name string")
    return rows.join(F.broadcast(names), vector, "left").withColumn("name", F.coalesce("name", F.col(vector)))
