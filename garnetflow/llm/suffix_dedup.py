"""Exact substring deduplication by distributed prefix doubling over sampled positions.

A byte goes if a string of LENGTH bytes that covers it starts anywhere else too. Ranking every position of a corpus
would cost many times its size, so positions are sampled by content: a position is a cut if the hash of
its ANCHOR bytes is the least of any `window` consecutive positions. A start's head is the least of the window at
the start, so equal strings have the same cuts at the same places from their head on, and each start belongs to one cut.

Prefix doubling runs over the cuts, one row for each. Round 0 ranks the piece from a cut to the next; round h
joins the rank at cut i with the rank at cut i + h, sorts the pairs, ranks them anew and carries the ranks on. Cuts
whose pair is unique drop out. A cut stops when its ranks span its core, the n pieces that all strings with this head
contain; if n is no power of two, the last step overlaps its halves (the ranks at i and i + n - h).

What is left are cuts whose core occurs again. A string is then its core's rank with the bytes before and after the core:
the starts of a cut are settled together if the whole span of their strings is equal to another's; where spans differ under one
core, one of each kind goes on, by CHUNK starts in the same way and then one by one.

Passages of fewer bytes than LENGTH can be counted beside it (repeats(passage=...), n_passage_bytes). Their head is a long anchor that every such
string holds whole, so its name is the core's rank and no rounds are needed; what is beside it is settled in the same way. A string of LENGTH
bytes that repeats consists of passages that repeat, so the rounds then run only over the stretches of passages that are as long as that.

The method per key: pairs are counted by partial aggregation before they move, and the ranks come back by joins whose
skewed partitions Spark splits, so a passage that a third of all documents share makes no heavy task. Pieces and
the bytes beside a core are compared by 64-bit hashes; results are exact up to collisions of these.

Cases: null counts as empty text; texts shorter than LENGTH lose nothing; equal rows are occurrences of each other; matches
never cross documents; a null doc_id is a value like any other; an empty table gives no row; other
columns pass through remove_repeats() as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, setting, slices, texts_of, tidy, written
from .decontaminate import _B, _buffer, _C, _power

LENGTH = 400
ANCHOR = 24
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
#: Starts that are looked at together where spans differ; more where the core is a long anchor, as few are left then.
CHUNK = 8
PASSAGE_CHUNK = 32
#: Bytes of a passage, of which 51 words of prose in the languages of the corpus take more. Not the length at which bytes are removed.
PASSAGE = 240
CUTS = "row long, k int, name long, n int, top int, head int, shape long, edge long"
HEADS = "row long, head int, shape long, n int, rank long, edge long"
#: What a cut takes along: the shape holds how far from the head the first and the last start are and the core's end, each in SHAPE bits.
OWN = ["row", "k", "n", "top", "head", "shape", "edge"]
SHAPE = 20


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_C)
    return h ^ (h >> np.uint64(32))


def _window(length: int) -> int:
    return max(1, length // 3)


class Names:
    """64-bit names of the strings of a buffer, from one pass over its bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        values = (data.astype(np.uint64) + np.uint64(1)) * _power(_B, n)[:n]
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=self.total[1:])
        self.back = _power(pow(_B, -1, 1 << 64), n)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.total[ends] - self.total[starts]) * self.back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def pieces(self, size: int) -> np.ndarray:
        """The names of all strings of a size."""
        return _mixed((self.total[size:] - self.total[:-size]) * self.back[: len(self.total) - size])

    def beside(self, lo: np.ndarray, head: np.ndarray, tail: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Names of the bytes from lo to head with those from tail to hi."""
        return _mixed(self(lo, head) * np.uint64(0x9E3779B97F4A7C15) + self(tail, hi))


def _heads(names: Names, offsets: np.ndarray, long: np.ndarray, anchor: int, window: int) -> tuple[np.ndarray, ...]:
    """The cuts of some texts of a buffer: first window that has the cut, which of the texts, the cut, and the last window of each text."""
    wide = window + anchor - 1
    least = names.pieces(anchor)
    least &= np.uint64(0xFFFFFFFF00000000)
    least |= np.arange(len(least), dtype=np.uint64)
    have = 1
    while have < window:  # least[i]: of the positions from i on, `have` many
        step = min(have, window - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    mark = least.astype(np.uint32)  # the position in the lower half
    # windows with the same cut stand together; a text's windows go from its begin to its end less `wide`
    begins, ends = offsets[long], offsets[long + 1] - wide
    lo = np.unique(np.concatenate([np.flatnonzero(mark[1:] != mark[:-1]) + 1, begins]))
    of = np.searchsorted(begins, lo, side="right") - 1
    inside = (of >= 0) & (lo <= ends[np.maximum(of, 0)])
    lo, of = lo[inside], of[inside]
    return lo, of, mark[lo].astype(np.int64), ends


def passages_of(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The cuts of all texts of a buffer whose anchor, half as long as a passage, is the core: text, where it begins, shape, name, and the name of what lies beside it."""
    anchor = length // 2
    long = np.flatnonzero(np.diff(offsets) >= length)
    if not len(long):
        return {"doc": long, "head": np.empty(0, np.int32), "shape": long, "rank": np.empty(0, np.uint64), "edge": np.empty(0, np.uint64)}
    names = Names(data)
    lo, of, cut, ends = _heads(names, offsets, long, anchor, length - anchor + 1)
    hi = np.where(np.append(of[1:] != of[:-1], True), ends[of], np.append(lo[1:], 0) - 1)
    edge = names.beside(lo, cut, cut + anchor, hi + length) + (hi - lo).astype(np.uint64)
    shape = (cut - lo) << 2 * SHAPE | (cut - hi) << SHAPE | anchor
    return {"doc": long[of], "head": (cut - offsets[long[of]]).astype(np.int32), "shape": shape, "rank": names(cut, cut + anchor), "edge": edge}


def cuts_of(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> dict[str, np.ndarray]:
    """The cuts of all texts of a buffer that have a piece: text, number within it, name of the piece, pieces of the core (0
    without starts), the most pieces of a rank that is asked of the cut, where the core begins in the text, the shape, and the name of what lies
    beside the core in the span of the starts."""
    window = _window(length)
    kinds = {"doc": np.int64, "k": np.int32, "name": np.uint64, "n": np.int32, "top": np.int32, "head": np.int32, "shape": np.int64, "edge": np.uint64}
    none = {k: np.empty(0, t) for k, t in kinds.items()}
    long = np.flatnonzero(np.diff(offsets) >= length)
    if not len(long):
        return none
    names = Names(data)
    lo, of, cut, ends = _heads(names, offsets, long, anchor, window)
    doc = long[of]
    last = np.append(of[1:] != of[:-1], True)  # the last cut of a text begins no piece
    after = np.append(lo[1:], 0)
    hi = np.minimum(np.where(last, ends[of], after - 1), offsets[doc + 1] - length)
    starts = lo <= hi
    # the core ends with the cut that the window at cut + reach has, whatever start of the cut a string has
    reach = length - 2 * window - anchor + 2
    at = np.arange(len(cut))
    stop = np.where(starts, np.searchsorted(lo, cut + reach, side="right") - 1, at)
    n = stop - at
    tail = np.where(starts, cut[stop] + anchor, cut)
    first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    k = at - np.repeat(first, np.diff(np.append(first, len(at))))
    name = names(cut, np.where(last, cut, np.append(cut[1:], 0)) + anchor)
    edge = np.zeros(len(cut), np.uint64)
    s = np.flatnonzero(starts)
    edge[s] = names.beside(lo[s], cut[s], tail[s], hi[s] + length) + (hi[s] - lo[s]).astype(np.uint64)
    shape = np.where(starts, (cut - lo) << 2 * SHAPE | (cut - hi) << SHAPE | (tail - cut), 0)
    # ranks are asked up to the core's end of the cuts before; these ends ascend, and a text begins after all of the one before
    top = np.maximum(np.maximum.accumulate(stop) - at, 0)
    out = {"doc": doc, "k": k, "name": name, "n": n, "top": top, "head": cut - offsets[doc], "shape": shape, "edge": edge}
    return {k: v[~last].astype(kinds[k]) for k, v in out.items()}


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of [lo, hi) in ascending order; touching ones join."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.append(np.flatnonzero(new)[1:], len(hi)) - 1]


def _signed(v: np.ndarray) -> pa.Array:
    return pa.array(v.view(np.int64) if v.dtype == np.uint64 else v)


def _cut(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """The cuts of texts, or where rows have los and his, those of the stretches that these span."""
    within = "los" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, (data, offsets) = np.asarray(batch.column(0)), _buffer(batch.column(1))
            if within:
                los, his = batch.column(2), batch.column(3)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(los.offsets)))
                lo, hi = np.asarray(los.flatten()), np.asarray(his.flatten())
                doc, lo, hi = (v[hi - lo >= length] for v in (doc, lo, hi))
                data = np.concatenate([data[:0], *(data[offsets[d] + x : offsets[d] + y] for d, x, y in zip(doc, lo, hi, strict=True))])
                row, offsets = row[doc], np.append(0, np.cumsum(hi - lo, dtype=np.int64))
            c = cuts_of(data, offsets, length, anchor)
            at = c.pop("doc")
            if within:  # where the stretch begins is below the numbers of its cuts and above all before
                c |= {"k": c["k"] + lo[at].astype(np.int32), "head": c["head"] + lo[at].astype(np.int32)}
            yield pa.RecordBatch.from_arrays([pa.array(row[at]), *map(_signed, c.values())], [f.split()[0] for f in CUTS.split(", ")])

    return rows.select("row", "text", *["los", "his"] * within).mapInArrow(tidy(run), CUTS)


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def reranked(pairs: DataFrame) -> DataFrame:
    """The rows of `pairs` whose (kind, r1, r2) occurs again, with its rank in the sorted order of these."""
    key = ["kind", "r1", "r2"]
    again = written(pairs.groupBy(*key).agg(F.count("*").alias("times")).where("times > 1").drop("times"), "again")
    ranks = again.orderBy(*key).select(*key, F.monotonically_increasing_id().alias("rank"))
    out = written(pairs.join(ranks, key).select(*OWN, "kind", "rank"), "ranks")
    discard(again)
    return out


def _asked(live: DataFrame, h: int) -> DataFrame:
    """Round h: for each cut the rank of its h pieces with that at k + h, and of cores of h to 2h - 1 pieces with that of the last h."""
    on = F.when(F.col("top") >= 2 * h, F.struct(F.lit(0).alias("kind"), (F.col("k") + h).alias("at")))
    end = F.when((F.col("n") >= h) & (F.col("n") < 2 * h), F.struct(F.col("n").alias("kind"), (F.col("k") + F.col("n") - h).alias("at")))
    # a text's cuts come to one place, where both sides of the join are
    live = live.repartition(_parts(live), "row")
    asks = live.select(*OWN, F.col("rank").alias("r1"), F.coalesce(end, on).alias("a")).where("a is not null")
    told = live.groupBy("row", F.col("k").alias("at")).agg(F.max("rank").alias("r2"))  # equal rows have equal ranks
    return asks.select(*OWN, "r1", "a.kind", "a.at").join(told, ["row", "at"]).select(*OWN, "kind", "r1", "r2")


def cores(cuts: DataFrame) -> DataFrame:
    """row, head, shape, n, rank and edge of each cut with starts whose core occurs again, by prefix doubling."""
    live = reranked(cuts.select(*OWN, F.lit(0).alias("kind"), F.col("name").alias("r1"), F.lit(0).cast("long").alias("r2")))
    h, tables, out = 1, [live], None
    while True:
        most = live.agg(F.max("top")).first()[0]
        if most is None or most < h:
            break
        with setting(cuts.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            pairs = written(_asked(live, h), f"pairs-{h}")
        ranked = reranked(pairs)
        discard(pairs)
        ended = ranked.where("kind > 0").select("row", "head", "shape", "n", "rank", "edge")
        out = ended if out is None else out.union(ended)
        tables.append(ranked)
        live = ranked.where("kind = 0")
        h *= 2
    out = written(live.select("row", "head", "shape", "n", "rank", "edge").limit(0) if out is None else out, "cores")
    discard(*tables)
    return out


def _sorted_out(rows: DataFrame, group: list[str], kind: str, place: list[str]) -> tuple[DataFrame, DataFrame]:
    """The places whose kind occurs again within its group; and of groups with several kinds one place of each kind, with its core. Both are written."""
    kinds = written(rows.groupBy(*group, kind).agg(F.count("*").alias("times"), *(F.first(c).alias(c) for c in place)), "kinds")
    settled = written(rows.join(kinds.where("times > 1").select(*group, kind), [*group, kind]).select(*place), "settled")
    # written, as the ranks are, so that Spark can split a group that many kinds share
    several = written(kinds.groupBy(*group).agg(F.count("*").alias("kinds")).where("kinds > 1").drop("kinds"), "several")
    apart = written(kinds.join(several, group).select(*place, "n", "rank"), "apart")
    discard(kinds, several)
    return settled, apart


def _beside_cores(rows: DataFrame, apart: DataFrame, length: int, chunk: int) -> DataFrame:
    """The starts of some cuts by chunks: row, rank, n, head, shape (of the chunk), whole and edge.

    whole names the bytes beside the core that all starts of a chunk share, and the chunk; edge those that any of them has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 18):
            data, offsets = _buffer(batch.column(1))
            heads = batch.column(2)
            flat, per = heads.flatten(), np.diff(np.asarray(heads.offsets))
            doc = np.repeat(np.arange(batch.num_rows), per)
            rank, n, head, shape = (np.asarray(flat.field(k)) for k in range(4))
            far, near, core = (shape >> 2 * SHAPE), shape >> SHAPE & (1 << SHAPE) - 1, shape & (1 << SHAPE) - 1
            many = far // chunk - near // chunk + 1
            of = np.repeat(np.arange(len(doc)), many)
            c = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + (near // chunk)[of]
            a1, a2 = np.maximum(near[of], c * chunk), np.minimum(far[of], c * chunk + chunk - 1)
            at = offsets[doc[of]] + head[of]
            tail, names = at + core[of], Names(data)
            whole = names.beside(at - c * chunk, at, tail, np.maximum(tail, at - c * chunk - chunk + 1 + length))
            edge = names.beside(at - a2, at, tail, at - a1 + length)
            shapes = a2 << 2 * SHAPE | a1 << SHAPE | core[of]
            out = (np.asarray(batch.column(0))[doc[of]], rank[of], n[of], head[of], shapes, (whole + c.astype(np.uint64)).view(np.int64), (edge + (a2 - a1).astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in out], ["row", "rank", "n", "head", "shape", "whole", "edge"])

    listed = apart.groupBy("row").agg(F.collect_list(F.struct("rank", "n", "head", "shape")).alias("heads"))
    texts = rows.select("row", "text").join(listed.hint("merge"), "row").select("row", "text", "heads")
    return texts.mapInArrow(tidy(run), "row long, rank long, n int, head int, shape long, whole long, edge long")


def _settled(rows: DataFrame, heads: DataFrame, length: int, chunk: int) -> DataFrame:
    """row and its spans (los and his, not merged) of the strings at `heads` that repeat, for rows that have any. heads is a scratch table, which goes."""
    place = ["row", "head", "shape"]
    by_cut, apart = _sorted_out(heads, ["n", "rank"], "edge", place)
    discard(heads)
    chunks = written(_beside_cores(rows, apart, length, chunk), "chunks")
    by_chunk, left = _sorted_out(chunks, ["n", "rank", "whole"], "edge", place)
    discard(apart, chunks)
    starts = written(_beside_cores(rows, left, length, 1), "starts")
    again = starts.groupBy("n", "rank", "edge", "shape").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    again = written(again, "again")
    alone = starts.join(again, ["n", "rank", "edge", "shape"]).select(*place)
    far, near = F.shiftright("shape", 2 * SHAPE).cast("int"), F.shiftright("shape", SHAPE).bitwiseAND((1 << SHAPE) - 1).cast("int")
    found = by_cut.union(by_chunk).union(alone).select("row", (F.col("head") - far).alias("lo"), (F.col("head") - near + length).alias("hi"))
    spans = written(found.groupBy("row").agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his")), "spans")
    discard(by_cut, by_chunk, left, starts, again)
    return spans


def repeated_spans(rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """row and its spans (los and his, not merged) of what repeats, for documents that have any. rows: row, text, and maybe los and his, outside which nothing repeats."""
    if length - 2 * _window(length) - anchor + 2 < 1 or anchor < 1 or length >= 1 << SHAPE:
        raise ValueError(f"strings of {length} bytes have no core for anchors of {anchor}")
    cuts = written(_cut(rows, length, anchor), "cuts")
    heads = cores(cuts)
    discard(cuts)
    return _settled(rows, heads, length, CHUNK)


def passages(rows: DataFrame, length: int = PASSAGE) -> DataFrame:
    """row, the merged spans (los and his) of strings of `length` bytes that repeat, and the bytes of the longest, for documents that have any."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            c = passages_of(*_buffer(batch.column(1)), length)
            n = np.zeros(len(c["doc"]), np.int32)
            out = (np.asarray(batch.column(0))[c["doc"]], c["head"], c["shape"], n, c["rank"], c["edge"])
            yield pa.RecordBatch.from_arrays([*map(_signed, out)], [f.split()[0] for f in HEADS.split(", ")])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged(np.asarray(lo.values), np.asarray(hi.values)) for lo, hi in zip(batch.column(1), batch.column(2), strict=True)]
            los, his = (pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1))
            most = pa.array([int((hi - lo).max()) for lo, hi in spans], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), los, his, most], ["row", "los", "his", "most"])

    cuts = written(rows.select("row", "text").mapInArrow(tidy(cut), HEADS), "passages")
    again = written(cuts.groupBy("rank").agg(F.count("*").alias("times")).where("times > 1").drop("times"), "again")
    heads = written(cuts.join(again, "rank").select(*(f.split()[0] for f in HEADS.split(", "))), "heads")
    discard(cuts, again)
    spans = _settled(rows, heads, length, PASSAGE_CHUNK)
    out = written(spans.mapInArrow(tidy(merge), "row long, los array<int>, his array<int>, most int"), "merged")
    discard(spans)
    return out


def _keyed(docs: DataFrame, key: str, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """docs with `key`, and their rows and texts."""
    marked = docs.withColumn(key, F.xxhash64(F.col(doc_id), F.col(text)))
    return marked, marked.select(F.col(key).alias("row"), F.col(text).alias("text")).dropna()


def _with(marked: DataFrame, spans: DataFrame, key: str, to: str) -> DataFrame:
    """The spans beside the rows of `marked`, in `to`l and `to`h; the text stays as it is."""
    return marked.join(spans.select(F.col("row").alias(key), F.col("los").alias(to + "l"), F.col("his").alias(to + "h")).hint("merge"), key, "left")


def _with_spans(docs: DataFrame, key: str, doc_id: str, text: str, length: int, anchor: int) -> DataFrame:
    """docs with `key` and the spans in `key`l and `key`h; the text stays as it is."""
    marked, rows = _keyed(docs, key, doc_id, text)
    return _with(marked, repeated_spans(rows, length, anchor), key, key)


def _with_passages(docs: DataFrame, length: int, anchor: int, passage: int) -> DataFrame:
    """docs with the spans of `length` in keyl and keyh and those of passages in nearl and nearh."""
    marked, rows = _keyed(docs, "key", "doc_id", "text")
    short = passages(rows, passage)
    # equal rows have one key; their spans are the same
    long = written(rows.join(short.where(F.col("most") >= length).drop("most").hint("merge"), "row"), "stretches")
    spans = repeated_spans(long, length, anchor)
    discard(long)
    return _with(_with(marked, spans, "key", "key"), short, "key", "near")


def _spans(batch: pa.RecordBatch, at: int) -> Iterator[list[list[int]]]:
    """The merged spans of each row; columns `at` and at + 1 hold los and his."""
    for lo, hi in zip(batch.column(at), batch.column(at + 1), strict=True):
        yield np.stack(merged(np.asarray(lo.values), np.asarray(hi.values))).T.tolist() if lo.is_valid and len(lo.values) else []


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, passage: int | None = None) -> DataFrame:
    """For each document its bytes, the bytes and spans that go, and the digest of what is left. With `passage`, fewer bytes than length, also
    n_passage_bytes: how many bytes lie in strings of that many bytes that start anywhere else too; these are counted only."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if passage is not None and not 2 <= passage < length:
        raise ValueError(f"a passage has 2 to {length - 1} bytes, not {passage}")
    schema = SCHEMA + (", n_passage_bytes long" if passage else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            near = _spans(batch, 4) if passage else iter([[]] * batch.num_rows)
            for d, t, spans, short in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), _spans(batch, 2), near, strict=True):
                data, at, kept = t.encode(), 0, hashlib.sha256()
                for lo, hi in spans:
                    kept.update(data[at:lo])
                    at = hi
                kept.update(data[at:])
                out.append((d, len(data), sum(hi - lo for lo, hi in spans), len(spans), kept.hexdigest(), *[sum(hi - lo for lo, hi in short)] * bool(passage)))
            kinds = [pa.string() if f.endswith("string") else pa.int64() for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])

    if passage:
        return _with_passages(rows, length, anchor, passage).select("doc_id", "text", "keyl", "keyh", "nearl", "nearh").mapInArrow(tidy(run), schema)
    return _with_spans(rows, "key", "doc_id", "text", length, anchor).select("doc_id", "text", "keyl", "keyh").mapInArrow(tidy(run), schema)


def without(text: str, spans: list[list[int]]) -> str:
    """The text without the characters whose bytes all lie in the spans."""
    data, out, at = text.encode(), [], 0
    for lo, hi in spans:
        while lo < hi and data[lo] & 0xC0 == 0x80:  # the span begins within a character, which stays
            lo += 1
        if hi < len(data):
            while hi > lo and data[hi] & 0xC0 == 0x80:  # it ends within one
                hi -= 1
        out.append(data[at:lo])
        at = max(lo, hi)
    return b"".join([*out, data[at:]]).decode()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """docs with the texts cut down to what does not repeat. A character that is covered only in part stays."""
    schema = docs.schema
    key = "key_" + "_" * max(len(c) for c in docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            names = batch.schema.names
            k, own = names.index(text), len(names) - 2
            texts = [without(t, s) if s else t for t, s in zip(batch.column(k).to_pylist(), _spans(batch, own), strict=True)]
            kept = pa.RecordBatch.from_arrays(batch.columns[:own], names[:own])
            yield kept.set_column(k, batch.schema.field(text), pa.array(texts, batch.schema.field(text).type))

    rows = _with_spans(docs, key, doc_id, text, length, anchor).select(*docs.columns, key + "l", key + "h")
    return rows.mapInArrow(tidy(run), schema)
