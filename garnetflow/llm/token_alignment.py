"""Alignment of two tokenizers over all documents, by a cogroup of postings.

A text is tokenized by both; byte offsets where a token of each ends cut it into groups, and the two tokens that end there are linked.
How often two ids are linked in the corpus, and which partners of a B id are its most frequent, needs all links of that id in one place:

1. Documents are tokenized once, in blocks of about BLOCK bytes. A block is written as one row of its documents and, for each B id, one
   posting row: the A ids with their multiplicities and, for each, the documents (numbered in the block) with theirs.
2. The multiplicities of each pair of ids are summed by Spark, with partial sums on each side of the shuffle: one row for each B id,
   which holds at most the A vocabulary.
3. Cogroup: the postings and these rows are dealt by B id and sorted by Spark, which spills; a B id with more than HOT postings is split
   by block into as many parts as it needs, and its row goes to each part. A task streams through its sorted rows, takes the counts and
   their maximum of the id at hand, and emits for each posting row what it adds to the documents of its block.
4. Contributions are dealt by block and summed by document. No group is held but one block's documents.

Neither vocabulary merges from a character that is no white space into white space (but for those in `glued`, found in
the pieces), so texts are cut there and a worker remembers the tokens of chunks, at most `most`.

Cases: null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros and an empty digest; texts of
white space are texts; equal rows count as often as they occur; a null doc_id stays; a very long text is a block of its own; an empty
table gives no row; other columns are ignored. Pieces have bytes, so each common end holds one link.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import slices, texts_of, tidy, written
from .rank_queue import SPACES
from .subwords import BYTE_TO_CHAR

BLOCK = 8 << 20
#: Documents of a block, and postings of a B id that one task takes.
BLOCK_DOCS = 50_000
HOT = 4_000_000
SHIFT = 16  # a pair of ids is one number: B id, then A id in 16 bits
POSTINGS = (
    "block long, b int, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups_sha256 array<string>, "
    "a array<int>, total array<long>, n_docs array<int>, docs array<int>, times array<int>"
)
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_int, _long = pa.list_(pa.int32()), pa.list_(pa.int64())


class _Known(dict):
    """Chunks that are remembered, and behind them those of the texts at hand."""

    fresh: dict = {}

    def __missing__(self, chunk: str):
        return self.fresh[chunk]


class Aligner:
    """Tokens of both vocabularies and their groups, chunk by chunk."""

    def __init__(self, a: str, b: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(public_tokenizers.path(a))
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        if self.a.get_vocab_size() > 1 << SHIFT or self.b.get_piece_size() > 1 << 31 - SHIFT:
            raise ValueError("the vocabularies do not fit into a pair's number")
        back = {chr(c): byte for byte, c in BYTE_TO_CHAR.items()}
        tokens = (self.a.id_to_token(i) for i in range(self.a.get_vocab_size()))
        self.a_bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        glued = {c for i, p in enumerate(pieces) if not self.b.is_byte(i) for c in re.findall(f"[^{SPACES}▁]([{SPACES}▁])", p)}
        if glued & {" ", "▁"}:
            raise ValueError("a piece goes on after a space")
        on = f"(?:[{re.escape(''.join(sorted(glued)))}][{SPACES}]*[^{SPACES}]*)*" if glued else ""
        self.chunks = re.compile(f"[{SPACES}]*[^{SPACES}]+{on}|[{SPACES}]+").findall
        self.lead = "a"  # the B tokenizer adds a space in front of it, so that it adds none to the chunk
        self.skip = len(self.b.encode(self.lead))
        self.most, self.known = most, _Known()

    def learn(self, chunks: list[str]) -> dict[str, tuple[str, bytes, int, int] | None]:
        """For each chunk its groups as text, its links as numbers, and how many tokens of each kind; None if a tokenizer does not give it back."""
        found = {}
        ids_a = self.a.encode_batch_fast(chunks, add_special_tokens=False)
        ids_b = self.b.encode([self.lead + c for c in chunks], num_threads=1)
        for chunk, x, y in zip(chunks, ids_a, ids_b, strict=True):
            x, y = x.ids, y[self.skip :]
            a_bytes, b_bytes = [self.a_bytes[i] for i in x], [self.b_bytes[i] for i in y]
            whole = chunk.encode()
            if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
                found[chunk] = None
                continue
            groups, links, i, j, k, end_a, end_b = [], [], 0, 0, 0, len(a_bytes[0]), len(b_bytes[0])
            first_a = first_b = 0
            while True:
                if end_a == end_b:
                    groups.append(f"{','.join(map(str, x[first_a : i + 1]))}|{','.join(map(str, y[first_b : j + 1]))}")
                    links.append(y[j] << SHIFT | x[i])
                    first_a, first_b = i + 1, j + 1
                    if first_a == len(x):
                        break
                    k = 3
                else:
                    k = 1 if end_a < end_b else 2
                if k & 1:
                    i += 1
                    end_a += len(a_bytes[i])
                if k & 2:
                    j += 1
                    end_b += len(b_bytes[j])
            found[chunk] = ";".join(groups), np.array(links, "<i4").tobytes(), len(x), len(y)
        return found

    def align(self, texts: list[str]) -> Iterator[tuple[int, int, str, bytes]]:
        """n_a, n_b, digest of the groups and the links of each text."""
        split = [self.chunks(" " + t) if t else [] for t in texts]
        known = self.known
        fresh = self.learn(list({c for chunks in split for c in chunks if c not in known}))
        if len(known) < self.most:
            known.update((c, v) for c, v in fresh.items() if len(c) <= 64)
        known.fresh = fresh
        for chunks in split:
            rows = list(map(known.__getitem__, chunks))
            if not rows or None in rows:
                yield 0, 0, "", b""
                continue
            groups, links, n_a, n_b = zip(*rows, strict=True)
            yield sum(n_a), sum(n_b), hashlib.sha256(";".join(groups).encode()).hexdigest(), b"".join(links)


_open: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """The worker's aligner of two vocabularies; kept while the worker lives."""
    if (a, b) not in _open:
        _open[a, b] = Aligner(a, b)
    return _open[a, b]


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values, kind.value_type))


def _block(number: int, docs: list[tuple], links: list[bytes]) -> Iterator[pa.RecordBatch]:
    """A block's row of documents, then its postings: for each B id the A ids, and for each of these the documents."""
    one, none = np.array([len(docs)]), lambda n, kind: pa.nulls(n, kind)
    heads = [pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.array(c, t)) for c, t in zip(zip(*docs, strict=True), [*[pa.int64()] * 4, pa.string()], strict=True)]
    names = [c.split()[0] for c in POSTINGS.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[_long] * 4, pa.list_(pa.string()), _int, _long, _int, _int, _int]
    yield pa.RecordBatch.from_arrays([pa.array([number]), none(1, pa.int32()), *heads, *[none(1, k) for k in kinds[7:]]], names)
    pairs = np.frombuffer(b"".join(links), "<i4").astype(np.int64)
    if not len(pairs):
        return
    doc = np.repeat(np.arange(len(docs)), [len(x) // 4 for x in links])
    keys, times = np.unique(pairs << 32 | doc, return_counts=True)  # by B id, A id, document
    pairs, doc = keys >> 32, keys & 0xFFFFFFFF
    starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    n_docs, total = np.diff(np.append(starts, len(pairs))), np.add.reduceat(times, starts)
    ids = pairs[starts]
    b = ids >> SHIFT
    rows = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    ends, n = np.append(rows[1:], len(ids)), len(rows)
    doc_ends = np.cumsum(n_docs)[ends - 1]
    values = [
        pa.array(np.full(n, number)), pa.array(b[rows], pa.int32()), *[none(n, k) for k in kinds[2:7]], _lists(ids & (1 << SHIFT) - 1, ends, _int),
        _lists(total, ends, _long), _lists(n_docs, ends, _int), _lists(doc, doc_ends, _int), _lists(times, doc_ends, _int),
    ]
    out = pa.RecordBatch.from_arrays(values, names)
    yield from (out.slice(k, 2000) for k in range(0, n, 2000))


def postings(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Blocks of documents and their postings, from columns doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, number = aligner(a, b), TaskContext.get().partitionId() << 32
        rows, links, size = [], [], 0
        for batch in slices(batches, "text"):
            texts = texts_of(batch.column(1))
            for d, (n_a, n_b, sha, found) in zip(batch.column(0).to_pylist(), both.align(texts), strict=True):
                rows.append((d, n_a, n_b, len(found) // 4, sha))
                links.append(found)
            size += sum(map(len, texts))
            if size >= BLOCK or len(rows) >= BLOCK_DOCS:
                yield from _block(number, rows, links)
                rows, links, size, number = [], [], 0, number + 1
        if rows:
            yield from _block(number, rows, links)

    return docs.mapInArrow(tidy(run), POSTINGS)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and how many each row has."""
    c = batch.column(batch.schema.get_field_index(name))
    sizes = np.nan_to_num(c.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return c.flatten().to_numpy(zero_copy_only=False), sizes


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each posting row adds to the documents of its block; rows come by B id, its counts first."""
    keys, counts, tops = (np.empty(0, np.int64) for _ in range(3))
    for batch in batches:
        b = batch.column(0).to_numpy().astype(np.int64)
        a, n_a = _flat(batch, "a")
        pairs = np.repeat(b, n_a) << SHIFT | a
        total, n_total = _flat(batch, "total")
        if len(total):
            is_head = np.repeat(n_total > 0, n_a)
            rows = n_total[n_total > 0]
            highest = np.maximum.reduceat(total, np.cumsum(rows) - rows)
            keys, first = np.unique(np.concatenate([keys, pairs[is_head]]), return_index=True)  # the parts of an id repeat its counts
            counts, tops = np.concatenate([counts, total])[first], np.concatenate([tops, np.repeat(highest, rows)])[first]
            pairs = pairs[~is_head]
        posts = batch.filter(pa.array(n_total == 0))
        if posts.num_rows:
            place = np.searchsorted(keys, pairs)
            docs, sizes = _flat(posts, "docs")
            n_docs, times = _flat(posts, "n_docs")[0], _flat(posts, "times")[0].astype(np.int64)
            found = np.repeat(counts[place], n_docs)
            best = np.where(found == np.repeat(tops[place], n_docs), times, 0)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [posts.column(posts.schema.get_field_index("block")), _lists(docs, ends, _int), _lists(best, ends, _int), _lists(times * found, ends, _long)],
                ["block", "docs", "best", "added"],
            )
        if len(keys):  # the counts of the id that may go on
            last = np.searchsorted(keys >> SHIFT, keys[-1] >> SHIFT)
            keys, counts, tops = keys[last:], counts[last:], tops[last:]


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contributions summed by document; a block's documents come before what is added to them."""
    head, best, added = None, None, None
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def done() -> Iterator[pa.RecordBatch]:
        if head is not None:
            doc_id, n_a, n_b, n_groups, sha = (c.flatten() for c in head)
            yield pa.RecordBatch.from_arrays([doc_id, n_a, n_b, n_groups, n_groups, pa.array(best), pa.array(added), sha], names)

    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        for at, to in zip(cuts, np.append(cuts[1:], len(block)), strict=True):
            part = batch.slice(at, to - at)
            if part.column(1).is_valid()[0].as_py():
                yield from done()
                head = [part.column(k).slice(0, 1) for k in range(1, 6)]
                n = len(head[0].flatten())
                best, added = np.zeros(n, np.int64), np.zeros(n, np.int64)
            docs = _flat(part, "docs")[0]
            np.add.at(best, docs, _flat(part, "best")[0].astype(np.int64))
            np.add.at(added, docs, _flat(part, "added")[0])
    yield from done()


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups and links of both vocabularies in each document, with the corpus counts of its links."""
    table = written(postings(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), a, b), "postings")
    rows = table.where("b IS NOT NULL")
    counts = rows.select("b", F.explode(F.arrays_zip("a", "total", "n_docs")).alias("x")).groupBy("b", "x.a").agg(F.sum("x.total").alias("total"), F.sum("x.n_docs").alias("n"))
    each = F.array_sort(F.collect_list(F.struct("a", "total")))
    counts = counts.groupBy("b").agg(each.alias("x"), F.ceil(F.sum("n") / HOT).cast("int").alias("parts"))
    counts = written(counts.select("b", F.col("x.a").alias("a"), F.col("x.total").alias("total"), "parts"), "counts")
    parts = F.broadcast(counts.select("b", "parts"))  # a row for each id of the B vocabulary at most
    posts = rows.join(parts, "b").select("b", F.pmod(F.hash("block"), "parts").alias("part"), "block", "a", F.lit(None).cast("array<long>").alias("total"), "n_docs", "docs", "times")
    empty = [F.lit(None).cast("array<int>").alias(c) for c in ("n_docs", "docs", "times")]
    heads = counts.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("block"), "a", "total", *empty)
    both = posts.unionByName(heads).repartition("b", "part").sortWithinPartitions("b", "part", "block")  # nulls first: the counts
    added = both.select("b", "block", "a", "total", "n_docs", "docs", "times").mapInArrow(tidy(_contribute), "block long, docs array<int>, best array<int>, added array<long>")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    heads = table.where("b IS NULL").select("block", *columns, *[F.lit(None).cast(t).alias(c) for c, t in (("docs", "array<int>"), ("best", "array<int>"), ("added", "array<long>"))])
    added = added.select("block", *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in columns], "docs", "best", "added")
    added = heads.unionByName(added).repartition("block").sortWithinPartitions("block", F.col("doc_id").isNull())
    return added.mapInArrow(tidy(_sum), SCHEMA)
