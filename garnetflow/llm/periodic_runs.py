"""Runs (maximal repetitions) of words by the runs theorem, over all documents.

Every run has a Lyndon root that is the longest Lyndon word at one of its first positions, in one of the two orders of the
alphabet. The longest Lyndon word at a position ends where the next suffix that is smaller starts, so the roots are the next smaller
values of the inverse suffix array and, for the opposite order, its next greater values. A root is extended to its run by the longest
common extension of two positions, ahead in the text and back in the reversed one: a minimum of the LCP array over a range of the suffix
array, read from a sparse table.

Documents are worked on in slices of about SLICE bytes, as one array of word numbers. Suffixes are ranked by prefix
doubling with the document as the leading key, so they are compared within their document only, and a position drops out
as soon as its rank is unique. Roots that cannot belong to a run of at least `exponent` periods are sieved by comparing
a few words of neighbouring periods; the LCP arrays are made only for documents that have a root left. No row leaves its partition.

Cases: null and empty texts, or texts of white space, have no word and no run; repeated rows are rows of their own; ties of the exponent go
to the smallest start, then period; the text of a null doc_id is taken as it is; very long texts are one slice each; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of, tidy

SLICE = 1 << 20
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def inverse_suffix_array(w: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes, document by document; `end` is where the document of each position ends, and an end is smaller than any word."""
    n = len(w)
    active = np.argsort(doc * (int(w.max()) + 1) + w, kind="stable")
    first, places = np.ones(n, bool), np.arange(n)
    first[1:] = (w[active][1:] != w[active][:-1]) | (doc[active][1:] != doc[active][:-1])
    rank = np.empty(n, np.int64)
    rank[active] = np.maximum.accumulate(np.where(first, places, 0))
    active, ahead = active[~(first & np.append(first[1:], True))], 1
    while len(active):
        then = active + ahead
        then = np.where(then < end[active], rank[np.minimum(then, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + then
        order = np.argsort(key)
        active, key = active[order], key[order]
        was, places = rank[active], np.arange(len(active))
        group, first = np.ones(len(active), bool), np.ones(len(active), bool)
        group[1:], first[1:] = was[1:] != was[:-1], key[1:] != key[:-1]
        rank[active] = was + np.maximum.accumulate(np.where(first, places, 0)) - np.maximum.accumulate(np.where(group, places, 0))
        active = active[~(first & np.append(first[1:], True))]
        ahead *= 2
    return rank


def sparse_table(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Level k holds the least of 2**k values from each place on."""
    levels = [values]
    while 2 << len(levels) - 1 <= longest:
        half, last = 1 << len(levels) - 1, levels[-1]
        levels.append(np.minimum(last[: len(last) - half], last[half:]))
    return levels


def next_smaller(values: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The next place before `end` with a smaller value, else `end`.

    A place that is not settled jumps to where the place it points at points to. What long chains leave after 24 jumps
    descends a sparse table of minima.
    """
    n = len(values)
    to, left = np.arange(1, n + 1), np.arange(n)
    for _ in range(24):
        at = to[left]
        inside = at < end[left]
        left, at = left[inside], at[inside]
        above = values[at] > values[left]
        left, at = left[above], at[above]
        if not len(left):
            return to
        to[left] = to[at]
    levels = sparse_table(values, int((end[left] - to[left]).max()))
    at, value = to[left], values[left]
    for k in range(len(levels) - 1, -1, -1):
        fits = at + (1 << k) <= end[left]
        fits &= levels[k][np.minimum(at, len(levels[k]) - 1)] > value
        at = at + (fits << k)
    to[left] = at
    return to


class Extensions:
    """Longest common extensions of pairs of positions of one document."""

    def __init__(self, w: np.ndarray, end: np.ndarray, rank: np.ndarray):
        self.rank, n = rank, len(w)
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        words, ends, ranks, before = w.tolist(), end.tolist(), rank.tolist(), order.tolist()
        lcp, have = [0] * n, 0
        for i, r in enumerate(ranks):  # the common prefix shrinks by one word at most from one position to the next
            j, stop = before[r - 1] if r else i, ends[i]
            if not r or ends[j] != stop:  # the first of its document
                have = 0
                continue
            stop -= max(i, j)
            while have < stop and words[i + have] == words[j + have]:
                have += 1
            lcp[r] = have
            have = max(0, have - 1)
        sizes = np.bincount(end)
        self.levels = sparse_table(np.array(lcp, np.int32), int(sizes.max()))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        low, high = np.minimum(self.rank[i], self.rank[j]) + 1, np.maximum(self.rank[i], self.rank[j]) + 1
        k = np.frexp(high - low)[1] - 1
        out = np.empty(len(i), np.int64)
        for level in np.unique(k):
            m = k == level
            table = self.levels[level]
            out[m] = np.minimum(table[low[m]], table[high[m] - (1 << int(level))])
        return out


def runs(w: np.ndarray, sizes: np.ndarray, exponent: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start (in the array), length and period of all runs of at least `exponent` (3 or more) periods and `least` words, by start, then period.

    `w` holds the word numbers of documents one after another, `sizes` how many each has.
    """
    none = (np.empty(0, np.int64),) * 3
    if not len(w):
        return none
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.cumsum(sizes)[doc]
    rank = inverse_suffix_array(w, doc, end)
    places, found = np.arange(len(w)), []
    for values in (rank, -rank):
        period = next_smaller(values, end) - places
        # the first root starts within a period of the run's start, so the run goes on for more than exponent - 1 periods
        at = np.flatnonzero(places + (exponent - 1) * period < end)
        for ahead in (lambda q: 0 * q, lambda q: (exponent - 2) * q, lambda q: q // 2, lambda q: q - 1, lambda q: q):
            q = period[at]
            at = at[w[at + ahead(q)] == w[at + ahead(q) + q]]
        found.append((at, period[at]))
    at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(at):
        return none
    # what follows takes only the documents that have a root left
    kept = np.zeros(len(sizes), bool)
    kept[doc[at]] = True
    inside = kept[doc]
    moved = np.cumsum(inside) - 1  # a position's place among those that are kept
    w, sizes, rank = w[inside], sizes[kept], rank[inside]
    order = np.argsort(rank)
    rank[order] = np.arange(len(rank))
    i, q = moved[at], period
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.cumsum(sizes)[doc]
    begin = end - sizes[doc]
    stop = i + q + Extensions(w, end, rank).of(i, i + q)
    n = len(w)
    back_end = (n - begin)[::-1]
    back = Extensions(w[::-1], back_end, inverse_suffix_array(w[::-1], doc[::-1].max() - doc[::-1], back_end))
    start, more = i.copy(), np.flatnonzero(i > begin[i])
    start[more] -= back.of(n - i[more], n - i[more] - q[more])
    long_enough = stop - start >= np.maximum(least, exponent * q)
    place = places[inside]
    all_runs = np.unique(np.stack([place[start], stop - start, q], axis=1)[long_enough], axis=0)
    start, length, q = all_runs[np.lexsort((all_runs[:, 2], all_runs[:, 0]))].T
    return start, length, q


def repeated_tail(words: list[bytes], seed: int) -> list[bytes]:
    """The query's planted periods: for seeds divisible by 10, words from some place on repeat a stretch."""
    n, g = len(words), seed // 10
    if seed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a : a + p]
    return words[:a] + (head * ((n - a) // p + 1))[: n - a]


def collapsed(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, np.add(start, period), 1)
    np.add.at(gone, np.add(start, length), -1)
    return [w for w, g in zip(words, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]


def _rows(ids: list, texts: list[str], plant: bool) -> Iterator[tuple]:
    split = [t.encode().split() for t in texts]  # bytes part at the six ASCII blanks only
    if plant:
        split = [w if d is None else repeated_tail(w, zlib.crc32(str(d).encode())) for d, w in zip(ids, split, strict=True)]
    sizes = np.array([len(w) for w in split], np.int64)
    numbers: dict[bytes, int] = {}
    w = np.fromiter((numbers.setdefault(x, len(numbers)) for words in split for x in words), np.int64, int(sizes.sum()))
    start, length, period = runs(w, sizes)
    begins = np.cumsum(sizes) - sizes
    bounds = np.searchsorted(start, np.append(begins, len(w))).tolist()
    for k, (d, words, begin) in enumerate(zip(ids, split, begins.tolist(), strict=True)):
        part = slice(bounds[k], bounds[k + 1])
        s, n, p = (start[part] - begin).tolist(), length[part].tolist(), period[part].tolist()
        best, kept = (None,) * 4, words
        if s:
            top = 0
            for x in range(1, len(s)):  # in order of start, then period, so the first of equals stays
                top = x if n[x] * p[top] > n[top] * p[x] else top
            best = s[top], n[top], p[top], 1000 * n[top] // p[top]
            kept = collapsed(words, s, n, p)
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, n, p, strict=True))
        yield d, len(words), len(s), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()


def word_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """Runs of each document: how many, the one with the greatest exponent, digests of all and of the text without the repetitions.

    plant repeats a stretch in a tenth of the documents first, as the query asks.
    """
    types = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE):
            rows = zip(*_rows(b.column(0).to_pylist(), texts_of(b.column(1)), plant), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(run), SCHEMA)
