"""Benchmark decontamination: a broadcast set of hashed test windows, scanned over whole documents.

A benchmark item gives its windows of N consecutive words (one window of all its words if it has fewer). The distinct
windows' 64-bit hashes and their words are broadcast in blocks of a stated number and size, however many items share a window;
the driver gathers and sends them one by one. One scan of the documents goes through the blocks: a task holds GROUP slices of texts and, beyond one block, one
block at a time. The scan hashes the words of many documents at once, finds the windows whose hash is in the
block and compares their words, so that a hash alone decides nothing. Which items the hit windows belong to is joined after the scan,
once for each distinct set of hit windows, so copies of a document cost nothing more.

Cases: null texts have no words; an item without words has no window; equal items each count under their own
id, repeated rows once; a null item_id is called "null"; each row of docs gives one row, repeated ones
too; empty tables give no hits or no rows; further columns of docs, whatever their names, pass through
remove_leaks() as they are.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tidy, written

N = 10
#: Windows in a broadcast block, about 60 MB in a worker, and bytes of their words.
BLOCK = 200_000
BLOCK_BYTES = 32 << 20
#: Slices of texts that meet a block before the next one is loaded.
GROUP = 24

_B, _C = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_MASK = (1 << 64) - 1
#: Lower-case ASCII letters, digits and all bytes from 0x80 on stay; others become 0 and end a word.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
_powers: dict[tuple[int, int], np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**k mod 2**64 for k up to n at least."""
    have = _powers.get((base, 0))
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 20), np.uint64(base), np.uint64)
        have[0] = 1
        have = _powers[base, 0] = np.multiply.accumulate(have)
    return have


def _runs(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial hash of values[start:end] for each start and end."""
    p = _power(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * _power(pow(base, -1, 1 << 64), len(values))[starts]


class Words:
    """The words of many texts that lie one after another in a buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.bytes = _FOLD[data]
        inside = self.bytes != 0
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(inside))]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        after[edges - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.first = np.searchsorted(self.starts, offsets)  # the first word of each text, and the number of words
        hashed = _runs(self.bytes.astype(np.uint64), _B, self.starts, self.ends)
        hashed ^= hashed >> np.uint64(29)
        self.hashes = hashed * np.uint64(_C)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the windows of n words within a text."""
        if len(self.starts) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :])
        found = _runs(self.hashes, _C, at, at + n)
        return at, found ^ (found >> np.uint64(31))

    def text(self, at: int, n: int) -> bytes:
        return b" ".join([self.bytes[s:e].tobytes() for s, e in zip(self.starts[at : at + n], self.ends[at : at + n], strict=True)])


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins, and the end."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def windows_of(benchmark: DataFrame, n: int = N, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """n_words, hash, words and item of each distinct window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w, ids = Words(*_buffer(batch.column(1))), batch.column(0).to_pylist()
            sizes = np.diff(w.first)
            out: dict[str, list] = {"n_words": [], "hash": [], "words": [], "item": []}
            for size in {int(min(s, n)) for s in sizes if s}:
                for at, h in zip(*w.windows(size), strict=True):
                    if min(int(sizes[w.doc[at]]), n) == size:
                        for k, v in zip(out, (size, int(h.astype(np.int64)), w.text(at, size), ids[w.doc[at]]), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), (pa.int32(), pa.int64(), pa.binary(), pa.string()), strict=True)], list(out))

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(tidy(run), "n_words int, hash long, words binary, item string").distinct()


class Block:
    """A bounded part of the windows, laid out for the scan."""

    def __init__(self, rows: list):
        self.numbers: dict[bytes, int] = {}
        by_size: dict[int, list[int]] = {}
        for r in rows:
            self.numbers[bytes(r["words"])] = r["number"]
            by_size.setdefault(r["n_words"], []).append(r["hash"])
        self._lay_out({n: np.unique(np.array(h, np.int64).astype(np.uint64)) for n, h in by_size.items()})

    def __getstate__(self):
        return self.numbers, self.hashes  # tables of bits are made anew where they are used

    def __setstate__(self, state):
        self.numbers, hashes = state
        self._lay_out(hashes)

    def _lay_out(self, hashes: dict[int, np.ndarray]) -> None:
        self.hashes, self.seen = hashes, {}
        for n, h in self.hashes.items():
            self.seen[n] = np.zeros(1 << 20, bool)
            self.seen[n][h >> np.uint64(44)] = True

    def hits(self, w: Words) -> Iterator[tuple[int, int, int]]:
        """First word, number of words and the window's number of each occurrence."""
        for n, hashes in self.hashes.items():
            at, found = w.windows(n)
            keep = np.flatnonzero(self.seen[n][found >> np.uint64(44)])
            at, found = at[keep], found[keep]
            near = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for k in at[hashes[near] == found].tolist():
                if (number := self.numbers.get(w.text(k, n))) is not None:
                    yield k, n, number


def numbered(windows: DataFrame, most: int, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """n_words, hash, words of the distinct windows with a number and the block of each: at most `most` windows and `most_bytes` of words a block, or one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        count = block = held = size = 0
        for batch in batches:
            blocks = []
            for n in pc.binary_length(batch.column(2)).to_pylist():
                if held and (held == most or size + n > most_bytes):
                    block, held, size = block + 1, 0, 0
                held, size = held + 1, size + n
                blocks.append(first + block)
            numbers = range(first + count, first + count + len(blocks))
            count += len(blocks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64()), pa.array(blocks, pa.int64())], [*batch.schema.names, "number", "block"])

    distinct = written(windows.select("n_words", "hash", "words").distinct(), "distinct")
    parts = -(-distinct.count() // most) or 1
    # `most` windows or so a task, whatever the number of partitions: few windows are one block
    return written(distinct.coalesce(parts).mapInArrow(tidy(run), "n_words int, hash long, words binary, number long, block long"), "numbered")


def _scan(docs: DataFrame, windows: DataFrame, emit: str, text: str) -> DataFrame:
    """One pass over docs. emit: hits (words, hit words and numbers of the windows), documents (those without hits) or spans (texts without hit words)."""
    spark, schema = docs.sparkSession, docs.schema
    blocks = [r[0] for r in windows.select("block").distinct().orderBy("block").collect()] or [0]
    # a block at a time goes through the driver
    shared = [spark.sparkContext.broadcast(Block(windows.where(F.col("block") == b).collect())) for b in blocks]
    names = ["n_words", "n_hit", "windows"]

    def made(batch: pa.RecordBatch, w: Words, words: dict[int, set], found: dict[int, set]) -> pa.RecordBatch:
        m, k = batch.num_rows, batch.schema.get_field_index(text)
        if emit == "hits":
            hit = [len(words.get(d, ())) for d in range(m)]
            numbers = pa.array([sorted(found.get(d, ())) for d in range(m)], pa.list_(pa.int64()))
            rest = [batch.column(c) for c in range(batch.num_columns) if c != k]
            return pa.RecordBatch.from_arrays([*rest, pa.array(np.diff(w.first).astype(np.int64)), pa.array(hit, pa.int64()), numbers], [n for n in batch.schema.names if n != text] + names)
        if emit == "documents":
            return batch.filter(pa.array([d not in words for d in range(m)]))
        texts = batch.column(k).to_pylist()
        begin = np.concatenate([[0], np.cumsum([len((t or "").encode()) for t in texts])])
        for d, found in words.items():
            texts[d] = _without(texts[d].encode(), sorted((int(w.starts[x] - begin[d]), int(w.ends[x] - begin[d])) for x in found))
        return batch.set_column(k, batch.schema.field(text), pa.array(texts, batch.schema.field(text).type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = slices(batches, text)
        while group := list(itertools.islice(parts, GROUP if len(shared) > 1 else 1)):
            scanned = [(Words(*_buffer(b.column(b.schema.get_field_index(text)))), {}, {}) for b in group]  # hit words and windows by text
            for one in shared:
                # a lone block stays with the worker; of several, only the one in use is held
                block = one.value if len(shared) == 1 else one.load_from_path(one._path)
                for w, words, found in scanned:
                    for at, size, number in block.hits(w):
                        d = int(w.doc[at])
                        found.setdefault(d, set()).add(number)
                        words.setdefault(d, set()).update(range(at, at + size))
            yield from (made(b, *s) for b, s in zip(group, scanned, strict=True))

    if emit == "hits":
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != text)
        return docs.mapInArrow(tidy(run), f"{kept}, n_words long, n_hit long, windows array<long>")
    return docs.mapInArrow(tidy(run), schema)


def _without(data: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; what stood between two hit words goes with them if it holds no word."""
    out, at = [], 0
    for k, (s, e) in enumerate(spans):
        if k == 0 or _FOLD[np.frombuffer(data[at:s], np.uint8)].any():
            out.append(data[at:s])
        at = e
    return b"".join([*out, data[at:]]).decode()


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = N, most: int = BLOCK, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """For each document its words, hit words, items with occurring windows, and whether it is contaminated."""
    found = written(windows_of(benchmark, n, item_id, item_text), "windows")
    windows = numbered(found, most)
    rows = written(_scan(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), windows, "hits", "text"), "hits")
    sets = rows.where("n_hit > 0").select("windows").distinct().select("windows", F.explode("windows").alias("number"))
    items = found.join(windows.select("words", "number"), "words").select("number", "item")
    items = sets.join(items, "number").groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("items"))
    items = items.select("windows", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    counts = rows.select("doc_id", "n_words", "n_hit", "windows")
    hit = counts.where("n_hit > 0").join(items, "windows")
    clean = counts.where("n_hit = 0").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.lit(hashlib.sha256(b"").hexdigest())})
    return hit.unionByName(clean).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, whole: bool = True, n: int = N, most: int = BLOCK, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the contaminated documents, or (whole=False) with the hit words cut out of their texts."""
    return _scan(docs, numbered(windows_of(benchmark, n, item_id, item_text), most), "documents" if whole else "spans", text)
