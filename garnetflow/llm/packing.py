"""Hierarchical packing of token sequences for several context sizes.

Each document's ids fill whole windows of the longest context first; what is left is routed to the smallest
context size (a power of two) that holds it. Windows are then filled from the longest tier down: a window
takes one remainder of its tier, and its gap takes the longest remainders of shorter tiers that fit; the last
gap is closed by cutting one remainder. What cannot fill a window waits for the next documents of the task,
and what waits at a task's end is cut at powers of two, so no sequence is padded.

Documents are packed within a task, in the order that the task reads them: texts and ids are not shuffled, and memory is bound by
WORK ids and one document. sequence_id holds the task's number above 2**32 and a count below. Step groups are balanced over
all tasks: the sequences of a context are numbered through by the tasks' counts, a row for each task and context, and
dealt to as many groups as STEP tokens ask for; groups of a context differ by one sequence at most.

Cases: a null text counts as empty; with an end id each document has one id at least, without one an empty
document has no piece; repeated rows are packed each on its own; other columns are ignored; an empty
table gives no row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, texts_of, tidy, written
from .subwords import words

LONGEST = 2048
SHORTEST = 64
WORK = 2 << 20
STEP = 1 << 19
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, place long"


class Packer:
    """Packs pieces (key, start, length) into sequences; finish() hands over what still waits."""

    def __init__(self, longest: int = LONGEST, shortest: int = SHORTEST):
        self.longest, self.tiers = longest, []
        while longest >= shortest:
            self.tiers.append(longest)
            longest //= 2
        self.waits: list[tuple[int, int, int]] = []  # (length, key, start), ascending
        self.total = 0  # ids that wait

    def add(self, key: int, n: int) -> Iterator[list[tuple[int, int, int]]]:
        """Takes a document of n ids; yields its whole windows."""
        whole = n // self.longest * self.longest
        for at in range(0, whole, self.longest):
            yield [(key, at, self.longest)]
        if n > whole:
            insort(self.waits, (n - whole, key, whole))
            self.total += n - whole

    def pack(self) -> Iterator[list[tuple[int, int, int]]]:
        """Windows, tier by tier from the longest, each filled to the last place."""
        for tier in self.tiers:
            below = tier // 2 if tier != self.tiers[-1] else 0
            while self.total >= tier and self.waits[-1][0] > below:
                yield self._window(tier)

    def _window(self, tier: int) -> list[tuple[int, int, int]]:
        got, gap = [], tier
        self.total -= tier
        while gap:
            k = bisect_right(self.waits, (gap, 1 << 62, 0)) - 1
            if k >= 0:
                n, key, at = self.waits.pop(k)
                got.append((key, at, n))
                gap -= n
            else:  # all are longer than the gap: the shortest is cut
                n, key, at = self.waits.pop(0)
                got.append((key, at, gap))
                insort(self.waits, (n - gap, key, at + gap))
                gap = 0
        return got

    def finish(self) -> Iterator[list[tuple[int, int, int]]]:
        """The rest, laid end to end and cut at powers of two."""
        rest, total = self.waits[::-1], self.total
        self.waits, self.total = [], 0
        size = self.longest
        while total:
            while size > total:
                size //= 2
            got, gap = [], size
            while gap:
                n, key, at = rest.pop(0)
                take = min(n, gap)
                got.append((key, at, take))
                gap -= take
                if take < n:
                    rest.insert(0, (n - take, key, at + take))
            yield got
            total -= size


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int | None = 1, longest: int = LONGEST, doc_id: str = "doc_id", text: str = "text", remembered: int = 900_000) -> DataFrame:
    """A row for each piece: the document, the piece's place in it, its sequence and its place there.

    remembered: chunks whose ids a worker keeps, about 200 bytes each; fewer save memory and cost time.

    context is the sequence's length, step_group the group of sequences of that length that are
    trained together: the binary logarithm of the length above 2**40, and a count below.
    """
    return balanced(written(_packed(docs, vocabulary, end_id, longest, doc_id, text, remembered), "packed"))


def balanced(packed: DataFrame) -> DataFrame:
    """The pieces with the step group of their sequence in place of its place in the task."""
    task = F.shiftright("sequence_id", 32)
    counts = packed.where("offset = 0").groupBy(task.alias("task"), "context").agg(F.count("*").alias("n"))
    before = Window.partitionBy("context").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("context")
    counts = counts.select("task", "context", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(whole).alias("all"))
    rows = packed.withColumn("task", task).join(counts, ["task", "context"])
    groups = F.ceil(F.col("all") * F.col("context") / STEP)
    group = F.floor((F.col("first") + F.col("place")).cast("double") * groups / F.col("all")) + F.shiftleft(F.log2("context").cast("long"), 40)
    return rows.select(*[c.split()[0] for c in SCHEMA.split(", ")[:-1]], group.cast("long").alias("step_group"))


def _packed(docs: DataFrame, vocabulary: str, end_id: int | None, longest: int, doc_id: str, text: str, remembered: int) -> DataFrame:
    """The pieces by task; place counts the sequences of a context in the task."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = words(vocabulary, remembered), Packer(longest)
        context = TaskContext.get()
        task = (context.partitionId() if context else 0) << 32
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        held: dict[int, tuple] = {}  # key: doc_id, ids, ids that are not packed yet
        seen = sequences = fresh = 0
        in_step: dict[int, int] = defaultdict(int)

        def rows_of(windows) -> Iterator[tuple]:
            nonlocal sequences
            for window in windows:
                size, offset = sum(w[2] for w in window), 0
                place = in_step[size]
                in_step[size] += 1
                for key, at, n in window:
                    d, ids, left = held[key]
                    yield d, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), len(ids) // 4, task + sequences, offset, size, place
                    offset += n
                    if left == n:
                        del held[key]
                    else:
                        held[key] = (d, ids, left - n)
                sequences += 1

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

        for batch in slices(batches, "text"):
            found: list[tuple] = []
            for d, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids = encoder.encode(t) + end
                if not ids:
                    continue
                seen += 1
                held[seen] = (d, ids, len(ids) // 4)
                found += rows_of(packer.add(seen, len(ids) // 4))
                fresh += len(ids) // 4
                if fresh >= WORK:
                    found += rows_of(packer.pack())
                    fresh = 0
            if found:
                yield out(found)
        found = [*rows_of(packer.pack()), *rows_of(packer.finish())]
        if found:
            yield out(found)

    return rows.mapInArrow(tidy(run), SCHEMA)
