"""Many keywords against many texts: a catalogue indexed by rare q-grams.

A pattern is a row with an array of keywords that a text must all hold. Whatever holds them also holds every run of Q characters
in them, so a pattern is filed under one of these, the one that the fewest texts have; patterns whose longest keyword is
shorter are filed under that keyword. A text gives its distinct runs of the lengths in use, a join by run yields the candidates, at most one
for each text and pattern, and only for these are the keywords searched in the text. Work follows the candidates,
not the product of texts and patterns.

A catalogue that fits in a task needs no join: all its distinct keywords are looked up at once in the bytes of a batch of texts, as numbers of
up to WIDTH bytes, and patterns are settled on what was found. Nothing of a text is moved or copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import all_of
from ..sources.shared import importable

Q = 4
#: Patterns up to which each text meets the whole catalogue, and patterns up to which the index goes to every task.
DIRECT, BROADCAST = 500, 200_000
#: Bytes of a keyword that are looked up as a number; longer ones are searched where these are.
WIDTH = 8
#: Pairs of text and keyword, and bytes of texts, that a task lays out at a time.
CELLS, BYTES = 8_000_000, 1 << 20


def grams(low: Column, lengths: list[int]) -> Column:
    """The distinct runs of characters of these lengths; length 0 gives the empty one."""
    runs = [F.regexp_extract_all(low, F.lit(f"(?s)(?=(.{{{n}}}))"), 1) if n else F.when(low.isNotNull(), F.array(F.lit(""))) for n in lengths]
    return F.array_distinct(F.concat(F.array().cast("array<string>"), *runs))


def _filed(patterns: DataFrame) -> tuple[DataFrame, list[int]]:
    """The patterns with the runs that each may be filed under, and the lengths of these."""
    low = F.transform("keywords", F.lower)
    longest = F.array_max(F.transform(low, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))
    size = F.when(longest.isNull(), 0).otherwise(F.least(longest["n"], F.lit(Q)))
    rows = patterns.withColumn("keywords", low).withColumn("__size", size)
    every = F.array_distinct(F.flatten(F.transform(F.filter("keywords", lambda k: F.length(k) >= Q), lambda k: F.regexp_extract_all(k, F.lit(f"(?s)(?=(.{{{Q}}}))"), 1))))
    rows = rows.withColumn("__runs", F.when(F.col("__size") == Q, every).otherwise(F.array(F.coalesce(longest["k"], F.lit("")))))
    return rows, sorted(r[0] for r in rows.select("__size").distinct().collect())  # Q + 1 values at most


def index(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """The patterns with the run that each is filed under (gram). patterns: keywords and others; texts: low, in lower case.

    How many texts have a run is counted over all of them, for runs of the catalogue only.
    """
    rows, lengths = _filed(patterns)
    rows = rows.withColumn("__at", F.monotonically_increasing_id())
    asked = rows.select(F.explode("__runs").alias("gram")).distinct()
    if asked.count() <= BROADCAST:
        asked = F.broadcast(asked)
    df = texts.select(F.explode(grams(F.col("low"), lengths)).alias("gram")).join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("df"))
    others = [c for c in patterns.columns if c != "keywords"]
    filed = rows.withColumn("gram", F.explode("__runs")).join(df, "gram", "left").groupBy("__at")
    filed = filed.agg(F.min_by("gram", F.struct(F.coalesce("df", F.lit(0)), F.col("gram"))).alias("gram"), F.first(F.struct("keywords", "__size", *others)).alias("__p"))
    return filed.select("gram", F.col("__p")["__size"].alias("gram_size"), F.col("__p")["keywords"].alias("keywords"), *[F.col("__p")[c].alias(c) for c in others])


def candidates(texts: DataFrame, index: DataFrame) -> DataFrame:
    """Each text beside the patterns whose run it has. texts: any columns, and low; a text's columns are not moved while the index fits in a task."""
    lengths = sorted(r[0] for r in index.select("gram_size").distinct().collect())
    if not lengths:
        return texts.join(index.drop("gram", "gram_size"), F.lit(False))
    if index.count() <= BROADCAST:
        found = texts.withColumn("gram", F.explode(grams(F.col("low"), lengths)))
        return found.join(F.broadcast(index.drop("gram_size")), "gram").drop("gram")
    # a larger index is met by run, and what was found goes back to its text
    key = F.xxhash64(*[F.col(c) for c in texts.columns])
    runs = texts.select(key.alias("__key"), F.explode(grams(F.col("low"), lengths)).alias("gram")).distinct()
    found = runs.join(index.drop("gram_size"), "gram").drop("gram")
    return texts.withColumn("__key", key).join(found, "__key").drop("__key")


def _windows(data: np.ndarray, n: int) -> np.ndarray:
    """The number that the n bytes from each place on make."""
    out = np.zeros(max(0, len(data) - n + 1), np.uint64)
    for k in range(n):
        out <<= np.uint64(8)
        out |= data[k : k + len(out)]
    return out


def _spread(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.intp)


def _tables(words: list[bytes]) -> list[tuple]:
    """For each length: the sorted numbers, a table of their hashes, and the keywords of each number."""
    by_size: dict[int, dict[int, list[int]]] = {}
    for k, w in enumerate(words):
        by_size.setdefault(min(len(w), WIDTH), {}).setdefault(int.from_bytes(w[:WIDTH]), []).append(k)
    out = []
    for n, of in sorted(by_size.items()):
        codes = np.array(sorted(of), np.uint64)
        seen = np.zeros(1 << 20, bool)
        seen[_spread(codes)] = True
        out.append((n, codes, seen, [of[int(c)] for c in codes]))
    return out


def _held(texts: list[bytes], words: list[bytes], tables: list[tuple]) -> np.ndarray:
    """Whether each text holds each keyword; one more column holds for all."""
    held = np.zeros((len(texts), len(words) + 1), bool)
    held[:, -1] = True
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    for n, codes, seen, of in tables:
        if not n:
            held[:, of[0]] = True
            continue
        numbers = _windows(data, n)
        at = np.flatnonzero(seen[_spread(numbers)])
        found = np.minimum(np.searchsorted(codes, numbers[at]), len(codes) - 1)
        right = codes[found] == numbers[at]
        at, found = at[right], found[right]
        row = np.searchsorted(ends, at, side="right")
        right = at + n <= ends[row]  # not across texts
        if n < WIDTH:
            held[row[right], np.array([k for k, *_ in of])[found[right]]] = True
        else:
            for r, f in np.unique(np.stack([row[right], found[right]]), axis=1).T:
                for k in of[f]:
                    held[r, k] = len(words[k]) == WIDTH or words[k] in texts[r]
    return held


def _searcher(patterns: pa.Table) -> Callable:
    """Texts beside the patterns whose keywords they all hold. patterns: keywords and others."""
    others = [c for c in patterns.column_names if c != "keywords"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [[k.encode() for k in ks] for ks in patterns["keywords"].to_pylist()]
        words = sorted({k for ks in lists for k in ks})
        place, tables = {w: k for k, w in enumerate(words)}, _tables(words)
        width = max([1, *map(len, lists)])
        of = np.array([[place[k] for k in ks] + [len(words)] * (width - len(ks)) for ks in lists], np.intp).reshape(len(lists), width)
        named = pa.RecordBatch.from_arrays([patterns[c].combine_chunks() for c in others], others)
        most = max(1, CELLS // (len(words) + 1))
        for batch in batches:
            texts = batch["low"].cast(pa.binary()).to_pylist()
            slab = np.cumsum([len(t) for t in texts]) // BYTES
            cuts = sorted({*range(0, len(texts), most), *(np.flatnonzero(np.diff(slab)) + 1), len(texts)})
            for a, b in zip(cuts, cuts[1:], strict=False):
                held = _held(texts[a:b], words, tables)
                # a pattern is tried where the keyword is that the fewest of these texts hold
                by = of[np.arange(len(of)), held.sum(axis=0)[of].argmin(axis=1)]
                order = np.argsort(by, kind="stable")
                starts = np.searchsorted(by[order], np.arange(len(words) + 2))
                row, word = np.nonzero(held)
                times = np.diff(starts)[word]
                at = np.repeat(starts[word] - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
                row, found = np.repeat(row, times), order[at]
                for k in range(width):
                    right = held[row, of[found, k]]
                    row, found = row[right], found[right]
                yield pa.RecordBatch.from_arrays([*batch.drop_columns(["low"]).take(pa.array(a + row)).columns, *named.take(pa.array(found)).columns], [*(c for c in batch.schema.names if c != "low"), *others])

    return run


def match(texts: DataFrame, patterns: DataFrame, filed: DataFrame | None = None) -> DataFrame:
    """The columns of texts (without low) and of the patterns (without keywords) for each text that holds all keywords of a pattern.

    texts: low, in lower case, and others; patterns: keywords and others. filed: the patterns' index, if there is one. A
    pattern without keywords matches every text, one whose keyword is null none; null texts match nothing; repeated rows of either side count each.
    """
    texts = texts.where(F.col("low").isNotNull())
    patterns = patterns.where(F.col("keywords").isNotNull() & ~F.exists("keywords", lambda k: k.isNull()))
    if filed is None and patterns.count() <= DIRECT:
        # the catalogue is one row with a list, so a text is copied for no pattern
        others = [c for c in patterns.columns if c != "keywords"]
        catalogue = patterns.agg(F.collect_list(F.struct(F.transform("keywords", F.lower).alias("keywords"), *others)).alias("__all"))
        found = F.filter("__all", lambda p: all_of(F.col("low"), p["keywords"]))
        rows = texts.join(F.broadcast(catalogue)).select(*[c for c in texts.columns if c != "low"], F.explode(found).alias("__p"))
        return rows.select(*[c for c in texts.columns if c != "low"], *[F.col("__p")[c].alias(c) for c in others])
    if patterns.count() <= BROADCAST:
        importable(texts.sparkSession)
        catalogue = patterns.withColumn("keywords", F.transform("keywords", F.lower))
        return texts.mapInArrow(_searcher(catalogue.toArrow()), T.StructType([*texts.drop("low").schema.fields, *patterns.drop("keywords").schema.fields]))
    filed = index(patterns, texts) if filed is None else filed
    return candidates(texts, filed).where(all_of(F.col("low"), F.col("keywords"))).drop("low", "keywords")
