"""Token ids in binary files: Simple-8b words with escapes and an offset for each block.

A file holds the documents of one range of doc_id in ascending order. Ids are coded in blocks of BLOCK ids.
A block is a run of 64-bit words; a word's top four bits select how many ids share the other 60 bits. Ids
that are wider than the block's escape width are stored as zero and listed after the words with their
places. The file's tail lists the blocks and the documents, so that a reader finds any document's ids and
decodes whole blocks with array operations.

Layout, little-endian: MAGIC; blocks (words, escaped places as u2, escaped ids as u4); block table (byte
offset u8, ids u4, words u4, escapes u4); document table (doc_id i8, flag of a null doc_id u1, ids u8);
counts of blocks and documents (u8, u8); MAGIC.

Cases: null texts count as empty and hold the end id alone; equal doc_ids stand in the order of their text;
a null doc_id comes first; an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fs_of, scratch_path, texts_of, tidy, written
from .subwords import words

MAGIC = b"GS8B0001"
BLOCK = 1 << 14
#: Ids in a word by selector. 60 bits are shared evenly; the selector 15 holds one id.
COUNTS = np.array([60, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], dtype=np.int64)
BITS = 60 // COUNTS
MANIFEST = "part string, first_id long, n_docs long, n_tokens long"
_order = [s for s in range(15) if s != 1]  # selectors in use, most ids first


def _widths(ids: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.ceil(np.log2(ids.astype(np.float64) + 1))).astype(np.uint8)


def pack(ids: np.ndarray) -> bytes:
    """Simple-8b words of ids below 2**32: at each place the word that holds most ids is taken."""
    n = len(ids)
    if n == 0:
        return b""
    ids = ids.astype(np.uint64)
    wide = np.concatenate([_widths(ids), np.zeros(60, np.uint8)])
    best = np.full(n, 14, np.uint8)
    most, have = wide.copy(), 1  # most[i]: the greatest width among `have` ids from i on
    for s in reversed(_order[:-1]):
        while have < COUNTS[s]:
            step = min(have, int(COUNTS[s]) - have)
            most = np.maximum(most, np.concatenate([most[step:], np.zeros(step, np.uint8)]))
            have += step
        best[most[:n] <= BITS[s]] = s
    jump = COUNTS[best].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts)
    chosen = best[starts]
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    out = np.empty(len(starts), np.uint64)
    for s in np.unique(chosen):
        rows = np.flatnonzero(chosen == s)
        word = np.full(len(rows), np.uint64(int(s) << 60), np.uint64)
        for k in range(int(COUNTS[s])):
            word |= padded[starts[rows] + k] << np.uint64(k * int(BITS[s]))
        out[rows] = word
    return out.astype("<u8").tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    """The n ids of pack()'s words."""
    w = np.frombuffer(data, "<u8")
    chosen = (w >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    for s in np.unique(chosen):
        rows = np.flatnonzero(chosen == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[starts[rows] + k] = (w[rows] >> np.uint64(k * int(BITS[s]))) & mask
    return out[:n]


def encode_block(ids: np.ndarray) -> tuple[bytes, int, int]:
    """A block's bytes, its number of words and of escapes; the escape width that costs least is taken."""
    wide = _widths(ids)
    by_width = np.bincount(wide, minlength=33)
    usable = sorted({int(b) for b in BITS if b <= 32} | {32})
    bits = {b: next((u for u in usable if u >= b), 32) for b in range(33)}
    at = min((sum(int(by_width[w]) * bits[min(w, e)] for w in range(33)) + 48 * int(by_width[e + 1 :].sum()), e) for e in usable)[1]
    away = np.flatnonzero(wide > at)
    left = ids.copy()
    left[away] = 0
    packed = pack(left)
    return packed + away.astype("<u2").tobytes() + ids[away].astype("<u4").tobytes(), len(packed) // 8, len(away)


def decode_block(data: bytes, n: int, n_words: int, n_away: int) -> np.ndarray:
    ids = unpack(data[: 8 * n_words], n)
    places = np.frombuffer(data, "<u2", n_away, 8 * n_words)
    ids[places] = np.frombuffer(data, "<u4", n_away, 8 * n_words + 2 * n_away)
    return ids


class Writer:
    """Writes one file; add() takes a document's ids."""

    def __init__(self, sink):
        self.sink, self.blocks, self.docs, self.wait, self.waiting = sink, [], [], [], 0
        self.at = sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.wait.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 16 * BLOCK:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate(self.wait) if self.wait else np.empty(0, np.uint32)
        upto = len(ids) if all_of_it else len(ids) // BLOCK * BLOCK
        for k in range(0, upto, BLOCK):
            part = ids[k : min(k + BLOCK, upto)]
            data, n_words, n_away = encode_block(part)
            self.sink.write(data)
            self.blocks.append((self.at, len(part), n_words, n_away))
            self.at += len(data)
        self.wait, self.waiting = [ids[upto:]], len(ids) - upto

    def close(self) -> None:
        self._flush(True)
        self.sink.write(np.array(self.blocks, dtype=BLOCK_ROW).tobytes())
        self.sink.write(np.array(self.docs, dtype=DOC_ROW).tobytes())
        self.sink.write(np.array([len(self.blocks), len(self.docs)], "<u8").tobytes() + MAGIC)
        self.sink.close()


BLOCK_ROW = np.dtype([("at", "<u8"), ("n", "<u4"), ("words", "<u4"), ("away", "<u4")])
DOC_ROW = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u8")])


def read_file(source, size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of a file; one block is decoded at a time."""
    source.seek(size - 24)
    n_blocks, n_docs = np.frombuffer(tail := source.read(24), "<u8", 2)
    if tail[16:] != MAGIC:
        raise ValueError("not a token file, or cut short")
    source.seek(size - 24 - int(n_docs) * DOC_ROW.itemsize - int(n_blocks) * BLOCK_ROW.itemsize)
    blocks = np.frombuffer(source.read(int(n_blocks) * BLOCK_ROW.itemsize), BLOCK_ROW)
    docs = np.frombuffer(source.read(int(n_docs) * DOC_ROW.itemsize), DOC_ROW)
    source.seek(len(MAGIC))
    have, todo = np.empty(0, np.uint32), iter(blocks)
    for doc_id, null, n in docs.tolist():
        parts, short = [have], n - len(have)
        while short > 0:
            b = next(todo)
            ids = decode_block(source.read(8 * int(b["words"]) + 6 * int(b["away"])), int(b["n"]), int(b["words"]), int(b["away"]))
            parts.append(ids)
            short -= len(ids)
        whole = np.concatenate(parts) if len(parts) > 1 else have
        have = whole[n:]
        yield (None if null else doc_id), whole[:n]


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = None, doc_id: str = "doc_id", text: str | Column = "text", files: int | None = None) -> DataFrame:
    """Writes the ids of `text` under `path` and returns the manifest (a row for each file).

    Files are ranges of doc_id, written under a name of the attempt and then renamed: a task that runs
    again replaces its file whole.
    """
    spark = docs.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = fs_of(path)
        fs.create_dir(root)
        encoder, out, part = words(vocabulary), None, ""
        first = n_docs = n_tokens = 0
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                if out is None:
                    first = -(1 << 63) if d is None else d
                    part = f"part-{'n' if d is None else ''}{d if d is not None else 0}-{uuid.uuid4().hex}.gs8b"
                    out = Writer(fs.open_output_stream(f"{root}/_{part}"))
                ids = np.frombuffer(encoder.encode(t) + end, "<u4")
                out.add(d, ids)
                n_docs, n_tokens = n_docs + 1, n_tokens + len(ids)
        if out is not None:
            out.close()
            fs.move(f"{root}/_{part}", f"{root}/{part}")
            yield pa.RecordBatch.from_pydict({"part": [part], "first_id": [first], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    return written(rows.mapInArrow(tidy(write), MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files that the manifest lists."""
    spark = manifest.sparkSession
    parts = manifest.orderBy("first_id", "part").collect()  # a row for each file
    base, rows = 0, []
    for p in parts:
        rows.append((p["part"], base))
        base += p["n_tokens"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = fs_of(path)
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[tuple] = []
                with fs.open_input_file(f"{root}/{part}") as source:
                    for d, ids in read_file(source, source.size()):
                        out.append((d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    todo = spark.createDataFrame(rows, "part string, start long").repartition(len(rows))
    return todo.mapInArrow(tidy(read), schema)


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The query: ids of byte_bpe_50k with end id 2, written and read back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, "byte_bpe_50k.json", end_id=2), path)


def listed(path: str) -> list[str]:
    """Finished files under a path."""
    from pyarrow import fs as pfs

    fs, root = fs_of(path)
    return sorted(os.path.basename(f.path) for f in fs.get_file_info(pfs.FileSelector(root)) if os.path.basename(f.path).startswith("part-"))
