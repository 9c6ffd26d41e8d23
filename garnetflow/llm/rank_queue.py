"""Byte-level BPE by a queue of merge ranks, and back.

Pieces of the pattern are merged by a queue with one bucket for each merge rank. A bucket holds places of a linked list of tokens whose
pair has that rank; a bitmap of three levels, 64 bits a word, marks buckets that hold something, so the next rank is three
find-first-set steps away, however many ranks and places there are. A merge takes two tokens out of the list and puts at most two new pairs into
buckets; what the queue holds of pairs that are gone is skipped when it comes up. Equal ranks go from left to right. A piece
of n bytes takes time in proportion to n and to the logarithm of a bucket, so pre-tokens of millions of bytes are no special case.

A pre-token never reaches from a character that is no white space into white space, so texts are cut there and a worker remembers the ids
of the short chunks it has met, at most `most`.

Cases: null counts as empty; no text has no ids and decodes to no bytes; strings of special tokens are plain text; equal rows are rows
of their own; very long texts are taken whole, one at a time; a null doc_id stays; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of, tidy

# The characters of Unicode's White_Space.
SPACES = "\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
NARROW = "\u024f"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankQueue:
    """Places by rank. pop() gives the least rank that holds any, or -1; `place` is then its leftmost place."""

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.low = [0] * (ranks + 63 >> 6)
        self.mid = [0] * (len(self.low) + 63 >> 6)
        self.top = 0  # a word of as many bits as `mid` has words: 64 for up to 262,144 ranks
        self.place = -1

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, place)
        else:
            bucket.append(place)
            a = rank >> 6
            if not self.low[a]:
                self.mid[a >> 6] |= 1 << (a & 63)
                self.top |= 1 << (a >> 6)
            self.low[a] |= 1 << (rank & 63)

    def pop(self) -> int:
        top = self.top
        if not top:
            return -1
        b = (top & -top).bit_length() - 1
        mid = self.mid[b]
        first = mid & -mid
        a = (b << 6) + first.bit_length() - 1
        low = self.low[a]
        rank = (a << 6) + (low & -low).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            self.place = heappop(bucket)
            return rank
        self.place = bucket.pop()
        self.low[a] = low = low & (low - 1)
        if not low:
            self.mid[b] = mid = mid ^ first
            if not mid:
                self.top = top & (top - 1)
        return rank


def library_class(kind: str) -> str:
    """All characters of a Unicode class as the library's version of Unicode has it."""
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    singles = {bytes([b]): b for b in range(256)}
    probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks=singles, special_tokens={})
    return bytes(probe.encode_ordinary(points)).decode()


def as_ranges(characters: str) -> str:
    """Ascending characters as ranges of a set of `re`."""
    out, first, last = [], None, None
    for c in [*map(ord, characters), None]:
        if first is not None and c != last + 1:
            out.append(f"{re.escape(chr(first))}-{re.escape(chr(last))}")
            first = c
        first, last = c if first is None else first, c
    return "".join(out)


def patterns(own: str, narrow: str = NARROW) -> tuple[re.Pattern, re.Pattern]:
    """public_tokenizers.PATTERN for `re`, with the classes spelled out: for all texts, and a quicker one for characters up to `narrow`."""
    letters, numbers = library_class(r"\p{L}"), library_class(r"\p{N}")

    def spelled(most: str) -> re.Pattern:
        a, b = (as_ranges("".join(c for c in kind if c <= most)) for kind in (letters, numbers))
        out = own.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACES}{a}{b}]").replace(r"\p{L}", f"[{a}]").replace(r"\p{N}", f"[{b}]")
        return re.compile(out.replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]"))

    return spelled(chr(0x10FFFF)), spelled(narrow)


class Bpe:
    """Encodes and decodes with the ranks of a file; ids are ranks."""

    def __init__(self, path: str, pat: str, most: int = 1_000_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.queue = RankQueue(max(self.tokens) + 1)
        (self.wide, self.narrow), self.most, self.known = patterns(pat), most, {}

    def piece(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        find = self.ranks.get
        if (whole := find(data)) is not None:
            return [whole]
        queue, n = self.queue, len(data)
        push, pop = queue.push, queue.pop
        stops, left = [*range(1, n + 1)], [*range(-1, n - 1)]  # a token at place i goes up to stops[i]; 0 once it is merged away
        pairs = [find(data[i : i + 2], -1) for i in range(n - 1)]
        pairs.append(-1)
        for i, rank in enumerate(pairs):
            if rank >= 0:
                push(rank, i)
        while (rank := pop()) >= 0:
            i = queue.place
            if pairs[i] != rank:
                continue  # the pair is gone
            j = stops[i]
            stops[i] = stop = stops[j]
            stops[j] = 0
            pairs[j] = -1
            if stop < n:
                left[stop] = i
                pairs[i] = rank = find(data[i : stops[stop]], -1)
                if rank >= 0:
                    push(rank, i)
            else:
                pairs[i] = -1
            if i:
                i = left[i]
                pairs[i] = rank = find(data[i:stop], -1)
                if rank >= 0:
                    push(rank, i)
        ranks, out, i = self.ranks, [], 0
        while i < n:
            stop = stops[i]
            out.append(ranks[data[i:stop]])
            i = stop
        return out

    def _chunk(self, chunk: str) -> bytes:
        ids = array("I")
        for p in (self.narrow if max(chunk) <= NARROW else self.wide).findall(chunk):
            ids.extend(self.piece(p.encode()))
        out = ids.tobytes()
        if len(chunk) <= 64 and len(self.known) < self.most:
            self.known[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known = self.known.get
        return b"".join([known(c) or self._chunk(c) for c in CHUNK.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


_open: dict[tuple, Bpe] = {}


def opened(path: str, pat: str) -> Bpe:
    """The worker's coder for a file; kept while the worker lives."""
    if (path, pat) not in _open:
        _open[path, pat] = Bpe(path, pat)
    return _open[path, pat]


def encode_decode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of each text's ids, and the digest of the bytes that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = opened(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
        for b in slices(batches, "text"):
            n, ids_sha, decoded_sha = [], [], []
            for t in texts_of(b.column(1)):
                ids = coder.encode(t)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(run), SCHEMA)
