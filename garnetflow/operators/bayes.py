"""Multinomial Naive Bayes from counts. The likelihood table is never laid out: smoothing happens when scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import importable, stored
from . import counting

#: Occurrences in a label from which a word counts as one of its top words.
LEAST_COUNT = 3
#: The most frequent words, whose counts go to every task; the others are joined by word.
BROADCAST_WORDS = 200_000
#: Shares of words by label that a task lays out at a time.
CELLS = 1_000_000


@dataclass
class Model:
    """counts(label, word, cnt); labels(label, docs, total, prior); numbers of words and documents. `release` drops what is kept of it."""

    counts: DataFrame
    labels: DataFrame
    vocabulary: int
    documents: int

    def by_word(self) -> DataFrame:
        """word, total and its counts by label: one row for each word."""
        return self.counts.groupBy("word").agg(F.sum("cnt").alias("total"), F.collect_list(F.struct("label", "cnt")).alias("of"))

    def least(self) -> int | None:
        """The occurrences from which a word is among those that go to every task, BROADCAST_WORDS at most; None if all are."""
        if self.vocabulary <= BROADCAST_WORDS:
            return None
        words, most = 0, 1
        # how often each number of occurrences comes: few rows, since large numbers are rare
        for total, n in self.counts.groupBy("word").agg(F.sum("cnt").alias("total")).groupBy("total").count().orderBy(F.desc("total")).toLocalIterator():
            words, most = words + n, total + 1
            if words > BROADCAST_WORDS:
                break
        return most

    def release(self) -> None:
        self.counts.unpersist()


def train(records: DataFrame, documents: int | None = None) -> Model:
    """records: id, label, words; a record with several labels has a row for each, and `documents` then is the number of records."""
    counts = stored(counting.word_counts(records).drop("rows"), "counts")
    n = records.select("id").distinct().count() if documents is None else documents
    totals = counts.groupBy("label").agg(F.sum("cnt").alias("total"))
    labels = records.groupBy("label").agg(F.count("*").alias("docs")).join(totals, "label", "left")
    labels = labels.select("label", "docs", F.coalesce("total", F.lit(0)).alias("total"), (F.col("docs") / F.lit(n)).alias("prior"))
    return Model(counts, labels, counts.select("word").distinct().count(), n)


def likelihood(model: Model) -> DataFrame:
    """label, word and smoothed likelihood of the pairs that occur; any other word of a label has 1 / (total + vocabulary)."""
    rows = model.counts.join(model.labels.select("label", "total"), "label")
    return rows.select("label", "word", "cnt", ((F.col("cnt") + 1) / (F.col("total") + F.lit(model.vocabulary))).alias("likelihood"))


def total_words(model: Model) -> DataFrame:
    """One row: the words of all labels together, and the labels that have any."""
    return model.labels.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total_words"), F.count(F.when(F.col("total") > 0, 1)).alias("labels"))


def top_words(model: Model, n: int = 15, least: int = LEAST_COUNT) -> DataFrame:
    """The n likeliest words of each label among those that occur `least` times in it; within a label likelihood rises with the count."""
    order = Window.partitionBy("label").orderBy(F.desc("cnt"), "word")
    return model.counts.where(F.col("cnt") >= least).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def log_scores(docs: DataFrame, model: Model, candidates: DataFrame | None = None) -> DataFrame:
    """id, label, score: log prior plus the log likelihood of each word of the vocabulary.

    docs: id, words. candidates(item, vector) limits the labels of each document; documents without any get
    all labels. A word's share is ln(cnt + 1) where the label has it, so the join is on words that
    occur, and the smoothing term needs only the number of known words, which the same pass counts under no label.
    Frequent words are settled where the document is; only the others meet their counts by a join.
    """
    sums = _hits(docs, model).groupBy("id", "label").agg(F.sum("hit").alias("hit"), F.sum("n").alias("n"))
    every = sums.groupBy("id").agg(F.max(F.when(F.col("label").isNull(), F.col("n"))).alias("known"), F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "hit")))).alias("hits"))
    mass = F.struct("label", "prior", (F.col("total") + F.lit(float(model.vocabulary))).alias("mass"))
    if candidates is not None:
        wanted = candidates.groupBy(F.col("item").alias("id")).agg(F.collect_set("vector").alias("wanted"))
        every = every.join(wanted, "id", "left")
    # the catalogue of labels is one row with a list: no row is made that a candidate list rules out
    table = model.labels.agg(F.collect_list(mass).alias("labels"))
    every = every.join(F.broadcast(table))
    labels = F.col("labels") if candidates is None else F.when(F.col("wanted").isNull(), F.col("labels")).otherwise(F.filter("labels", lambda l: F.array_contains("wanted", l["label"])))
    every = every.select("id", F.coalesce("known", F.lit(0)).alias("known"), "hits", F.explode(labels).alias("l")).select("id", "known", "hits", "l.*")
    hit = F.coalesce(F.element_at("hits", F.col("label")), F.lit(0.0))
    return every.select("id", "label", (F.ln("prior") + hit - F.col("known") * F.ln("mass")).alias("score"))


def _hits(docs: DataFrame, model: Model) -> DataFrame:
    """id, label, hit and n: a row under no label for each document, with n, and shares of its words by label, in parts."""
    found, least = _scored(docs, model)
    if least is None:
        return found.drop("word")
    found = stored(found, "hits")
    rare = found.where(F.col("word").isNotNull()).select("id", "word").join(model.by_word().where(F.col("total") < least).select("word", "of"), "word")
    each = F.concat(F.col("of"), F.array(F.struct(F.lit(None).cast("string").alias("label"), F.lit(0).cast("long").alias("cnt"))))
    rare = rare.select("id", F.inline(each)).select("id", "label", F.ln(F.col("cnt") + 1.0).alias("hit"), F.when(F.col("label").isNull(), 1).otherwise(0).cast("long").alias("n"))
    return found.where(F.col("word").isNull()).drop("word").unionByName(rare)


def _scored(docs: DataFrame, model: Model) -> tuple[DataFrame, int | None]:
    """The rows of _hits() of frequent words and, if there are others, a row for each other word of a document; and what model.least() gave."""
    importable(docs.sparkSession)
    least = model.least()
    frequent = model.counts if least is None else model.by_word().where(F.col("total") >= least).select("word", F.inline("of"))
    pairs = frequent.select("word", "label", F.ln(F.col("cnt") + 1.0).alias("share")).orderBy("word", "label").toArrow().combine_chunks()  # BROADCAST_WORDS, whatever the number of words
    words, labels = (pc.unique(pairs[c]) for c in ("word", "label"))
    starts = np.append(0, np.cumsum(np.bincount(pc.index_in(pairs["word"], value_set=words).to_numpy(), minlength=len(words)))).astype(np.int64)
    of = pc.index_in(pairs["label"], value_set=labels).to_numpy().astype(np.int64)
    schema = T.StructType([docs.schema["id"], model.counts.schema["label"], T.StructField("word", T.StringType()), T.StructField("hit", T.DoubleType()), T.StructField("n", T.LongType())])
    found = docs.select("id", "words").mapInArrow(_scorer(words, labels, starts, of, pairs["share"].to_numpy(), least is not None), schema)
    return found, least


def _scorer(words: pa.Array, labels: pa.Array, starts: np.ndarray, of: np.ndarray, share: np.ndarray, rest: bool) -> Callable:
    """The rows of _scored() of documents; with `rest`, also a row for each word that is not among these."""
    fan, n_labels = np.diff(starts), max(1, len(labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = batch["words"].flatten(), counting.sizes(batch["words"])
            codes = pc.index_in(flat, value_set=words)
            there = codes.is_valid().to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            unknown = pa.array(rows[~there]), flat.filter(pa.array(~there))
            rows, codes = rows[there], codes.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            yield _rows(batch["id"], n=np.bincount(rows, minlength=len(sizes)))
            cuts = np.flatnonzero(np.diff(np.cumsum(fan[codes]) // CELLS, prepend=-1, append=-1))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                r, c = rows[a:b], codes[a:b]
                times = fan[c]
                at = np.repeat(starts[c] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
                cell, place = np.unique((r - r[0]).repeat(times) * n_labels + of[at], return_inverse=True)
                yield _rows(batch["id"].take(pa.array(cell // n_labels + r[0])), labels.take(pa.array(cell % n_labels)), hit=np.bincount(place, weights=share[at], minlength=len(cell)))
            if rest:
                yield _rows(batch["id"].take(unknown[0]), word=unknown[1])

    def _rows(ids, label=None, word=None, hit=None, n=None) -> pa.RecordBatch:
        none = lambda kind: pa.nulls(len(ids), kind)
        zero = np.zeros(len(ids), np.int64)
        columns = [ids, none(labels.type) if label is None else label, none(pa.string()) if word is None else word.cast(pa.string()), pa.array(zero.astype(float) if hit is None else hit), pa.array(zero if n is None else n)]
        return pa.RecordBatch.from_arrays(columns, ["id", "label", "word", "hit", "n"])

    return run


def softmax(scores: DataFrame, by: str = "id") -> DataFrame:
    """score to probability within each id, shifted by the largest."""
    whole = Window.partitionBy(by)
    e = F.exp(F.col("score") - F.max("score").over(whole))
    return scores.withColumn("e", e).withColumn("probability", F.col("e") / F.sum("e").over(whole)).drop("e")


def confidence(p, high: float = 0.7, medium: float = 0.4):
    return F.when(p >= high, "high").when(p >= medium, "medium").otherwise("low")


def posterior(docs: DataFrame, model: Model, candidates: DataFrame | None = None) -> DataFrame:
    """id, label, score, probability and its confidence."""
    return softmax(log_scores(docs, model, candidates)).withColumn("confidence", confidence(F.col("probability")))
