"""N-gram Jaccard join by T-occurrence search, exact, with DivideSkip in bounded blocks.

A document's set holds the 64-bit hashes of its distinct word shingles. Two sets link when 100 * common >=
PERCENT * united, so a set of s shingles shares T = ceil(PERCENT / 100 * s) at least with any partner.

1. Of each set the first s - T + l hashes (l a tenth of s) enter inverted lists. Partners share l' of these at
   least (l' a tenth of the smaller set), so a document with fewer hashes on lists with others has no link.
2. What is left is reduced to distinct sets. Full inverted lists give how many sets hold each shingle.
   Ordered from rare to frequent, partners share one of the first s - T + 1 shingles; lists of these
   shingles chain sets into blocks, whose number of chains is the number of list entries.
3. A block is cut into chunks of bounded size, and each pair of chunks whose sizes allow a link is one group.
   There a set's inverted lists are searched by DivideSkip: the longest lists are put aside, the
   short ones merged, and sets that occur often enough are looked up in the long lists by binary search.
4. Components of the links, and of equal sets, by stars over tables of edges.

Lists travel packed, one row for many entries, and what a slice or task can tell by itself (hashes that several of
its texts share, sets that share a needed shingle) is counted or chained there, with one entry for each shingle
sent on; no step writes the pairs within a list or group.

Cases: null and empty texts have no set and no link; fewer than five words make one shingle; each row gives one
row, repeated doc_ids too (they link if their texts do, and share the id); a null doc_id is its own
component unless linked; empty tables give no row; other columns pass through keep_one() as they are, which
leaves one row of each component, whether ids are null, repeated or equal rows; rows without words all stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, tidy, written
from .components import components
from .decontaminate import _B, _buffer, _C, _runs

PERCENT = 80
WORDS = 5
#: Sets and shingles of a chunk of a block.
CHUNK_SETS, CHUNK_SHINGLES = 1024, 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def shingle_sets(column: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after another, and where each text's begin."""
    data, offsets = _buffer(column)
    data = _LOWER[data]
    inside = ~_SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    words = _runs(data.astype(np.uint64) + np.uint64(1), _B, starts, ends)
    words ^= words >> np.uint64(29)
    words *= np.uint64(_C)
    first = np.searchsorted(doc, np.arange(len(column) + 1))
    sizes = np.diff(first)
    begin = np.flatnonzero(np.arange(len(starts)) + n <= first[1:][doc]) if len(starts) else np.empty(0, np.int64)
    hashes, of = _runs(words, _C, begin, begin + n), doc[begin]
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    hashes = np.concatenate([hashes, _runs(words, _C, first[short], first[short + 1]) + sizes[short].astype(np.uint64)])
    of = np.concatenate([of, short])
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    keep = np.ones(len(of), bool)
    keep[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, of = hashes[keep], of[keep]
    return hashes, np.searchsorted(of, np.arange(len(column) + 1))


def needed(s: np.ndarray | int):
    """The least overlap of a set of s shingles with any partner."""
    return -(-PERCENT * s // 100)


def _packed(keys: np.ndarray, parts: int, done: bool | None = None, absent: tuple[str, ...] = (), **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Entries as rows of a part number and packed columns; a row for each part that has entries.

    With `done`, rows also say whether their entries are settled, and columns that these lack are null.
    """
    if not len(keys):
        return
    part = (keys % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(np.diff(cuts))
    out = {"part": pa.array(used, pa.int32())}
    for name, values in columns.items():
        values = values[order]
        out[name] = pa.array([values[cuts[k] : cuts[k + 1]].tobytes() for k in used], pa.binary())
    out |= {name: pa.nulls(len(used), pa.binary()) for name in absent}
    if done is not None:
        out["done"] = pa.array([done] * len(used))
    yield pa.RecordBatch.from_pydict(out)


def _gathered(batches: Iterator[pa.RecordBatch], *kinds: str) -> list[np.ndarray]:
    """The packed columns of all rows of a task, in 8-byte entries or as told."""
    found: list[list[bytes]] = [[] for _ in kinds]
    for batch in batches:
        for k in range(len(kinds)):
            found[k] += batch.column(k + 1).to_pylist()
    return [np.frombuffer(b"".join(f), kind) for f, kind in zip(found, kinds, strict=True)]


def _mix(ids: np.ndarray) -> np.ndarray:
    """Spreads ids over parts."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sets_of(docs: DataFrame, doc_id: str, text: str, with_sets: bool) -> DataFrame:
    """row (a hash of doc_id and text), doc_id, n, the set's digest and, if asked for, its hashes."""
    schema = "row long, doc_id long, n long, digest binary" + ", hashes binary" * with_sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, cuts = shingle_sets(batch.column(2))
            blobs = [hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            out = [batch.column(0), batch.column(1), pa.array(np.diff(cuts), pa.int64()), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in blobs], pa.binary())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(blobs, pa.binary())] * with_sets, [c.split()[0] for c in schema.split(", ")])

    return _rows(docs, doc_id, text).mapInArrow(tidy(run), schema)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    d = F.col(doc_id).cast("long")
    return docs.select(F.xxhash64(d, F.col(text)).alias("row"), d.alias("doc_id"), F.col(text).alias("text"))


def linked_at_all(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row of each document that shares enough of its first hashes with others to have a link."""
    parts = _parts(docs)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, cuts = shingle_sets(batch.column(1))
            rows, s = np.asarray(batch.column(0)), np.diff(cuts)
            take = np.minimum(s, s - needed(s) + np.maximum(1, s // 10))
            keep = np.flatnonzero(np.arange(len(hashes)) - np.repeat(cuts[:-1], s) < np.repeat(take, s))
            of, hashes = np.repeat(np.arange(len(s)), s)[keep], hashes[keep]
            least = np.maximum(1, needed(s) // 10).astype(np.uint32)
            # hashes that several texts of the slice have are counted here; one entry of each hash goes on, marked if it is counted
            _, one, at, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            n = np.bincount(of[times[at] > 1], minlength=len(s)).astype(np.int32)
            some = np.flatnonzero(n)
            yield from _packed(_mix(rows[some]), parts, done=True, absent=("hashes", "counted"), rows=rows[some], sizes=n[some], least=least[some])
            of, hashes, counted = of[one], hashes[one], (times > 1).astype(np.uint8)
            # in each part: 32 bits of each hash (an equal one by chance only keeps a document in), and each document's id, number of entries and least overlap
            part = (hashes % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((of, part))
            of, part, hashes, counted = of[order], part[order], (hashes[order] // np.uint64(parts)).astype(np.uint32), counted[order]
            runs = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (part[1:] != part[:-1])])) if len(of) else np.empty(0, np.int64)
            sizes = np.diff(np.append(runs, len(of))).astype(np.int32)
            docs_at, parts_at = of[runs], part[runs]
            out: dict[str, list] = {"part": [], "rows": [], "sizes": [], "least": [], "hashes": [], "counted": []}
            for k in np.unique(parts_at).tolist():
                a, b = np.searchsorted(parts_at, [k, k + 1])
                c, d = np.searchsorted(part, [k, k + 1])
                for name, value in zip(out, (k, rows[docs_at[a:b]].tobytes(), sizes[a:b].tobytes(), least[docs_at[a:b]].tobytes(), hashes[c:d].tobytes(), counted[c:d].tobytes()), strict=True):
                    out[name].append(value)
            if out["part"]:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if m == "part" else pa.binary()) for m, v in out.items()] + [pa.array([False] * len(out["part"]))], [*out, "done"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[list[bytes]]] = {}
        for batch in batches:
            for k, *blobs in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                by_part.setdefault(k, []).append(blobs)
        for found in by_part.values():
            rows, sizes, least, hashes, counted = (np.frombuffer(b"".join(f[c] for f in found), kind) for c, kind in enumerate(("<i8", "<i4", "<u4", "<u4", "<u1")))
            order = np.argsort(hashes, kind="stable")
            same = hashes[order[1:]] == hashes[order[:-1]]
            shared = np.zeros(len(hashes), np.int32)
            shared[order[1:][same]] = 1
            shared[order[:-1][same]] = 1
            shared[counted > 0] = 0
            n = np.add.reduceat(shared, np.cumsum(sizes.astype(np.int64)) - sizes).astype(np.int32)
            keep = n > 0
            yield from _packed(_mix(rows[keep]), parts, rows=rows[keep], sizes=n[keep], least=least[keep])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n, least = _gathered(batches, "<i8", "<i4", "<u4")
        rows, first, at = np.unique(rows, return_index=True, return_inverse=True)
        total = np.bincount(at, n, len(rows))
        yield pa.RecordBatch.from_arrays([pa.array(rows[total >= least[first]], pa.int64())], ["row"])

    rows = _rows(docs, doc_id, text).select("row", "text")
    columns = "part int, rows binary, sizes binary, least binary"
    lists = written(rows.mapInArrow(tidy(emit), f"{columns}, hashes binary, counted binary, done boolean"), "lists")
    counts = lists.where("not done").drop("done").repartition(parts, "part").mapInArrow(tidy(count), columns)
    counts = lists.where("done").select("part", "rows", "sizes", "least").union(counts).repartition(parts, "part")
    out = written(counts.mapInArrow(tidy(judge), "row long"), "some")
    discard(lists)
    return out


def chains(sets: DataFrame) -> DataFrame:
    """a, b: sets that follow each other on the list of a shingle that is rare enough to be needed."""
    parts = _parts(sets)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hashes"):
            rows, blobs = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            s = np.array([len(b) // 8 for b in blobs])
            hashes = np.frombuffer(b"".join(blobs), "<u8")
            yield from _packed(hashes, parts, hashes=hashes, rows=np.repeat(rows, s), n=np.repeat(s, s).astype(np.int32))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, n = _gathered(batches, "<u8", "<i8", "<i4")
        _, at, seen = np.unique(hashes, return_inverse=True, return_counts=True)
        seen = seen[at]
        keep = seen > 1
        yield from _packed(_mix(rows[keep]), parts, rows=rows[keep], hashes=hashes[keep], seen=seen[keep].astype(np.int32), n=n[keep])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, hashes, seen, n = _gathered(batches, "<i8", "<u8", "<i4", "<i4")
        order = np.lexsort((hashes, seen, rows))
        rows, hashes, n = rows[order], hashes[order], n[order].astype(np.int64)
        _, first, shared = np.unique(rows, return_index=True, return_counts=True)
        at = np.arange(len(rows)) - np.repeat(first, shared) + np.repeat(n[first] - shared, shared)  # shingles of its own come first
        keep = at <= n - needed(n)
        hashes, rows = hashes[keep], rows[keep]
        # sets of this task that share a shingle are chained here, and one of them goes on for each shingle
        a, b, one = _chained(hashes, rows)
        yield from _packed(_mix(a), parts, done=True, rows=a, hashes=b)
        yield from _packed(hashes[one], parts, done=False, rows=rows[one], hashes=hashes[one])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, hashes = _gathered(batches, "<i8", "<u8")
        a, b, _ = _chained(hashes, rows)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _gathered(batches, "<i8", "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    lists = sets.select("row", "hashes").mapInArrow(tidy(emit), "part int, hashes binary, rows binary, n binary").repartition(parts, "part")
    seen = lists.mapInArrow(tidy(frequent), "part int, rows binary, hashes binary, seen binary, n binary").repartition(parts, "part")
    first = written(seen.mapInArrow(tidy(rare), "part int, rows binary, hashes binary, done boolean"), "first")
    across = first.where("not done").drop("done").repartition(parts, "part").mapInArrow(tidy(chain), "a long, b long")
    return across.union(first.where("done").drop("done").mapInArrow(tidy(spread), "a long, b long"))


def _chained(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows that follow each other among those with the same hash, and the place of the first of each hash."""
    order = np.lexsort((rows, hashes))
    same = hashes[order[1:]] == hashes[order[:-1]]
    pairs = np.unique(np.stack([rows[order[:-1]][same], rows[order[1:]][same]]), axis=1).astype(np.int64)
    one = np.concatenate([order[:1], order[1:][~same]])
    return pairs[0], pairs[1], one


class Lists:
    """Inverted lists of some sets, as sorted arrays of shingles and sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        hashes, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.sets = hashes[order], of[order]
        self.keys, first = np.unique(self.hashes, return_index=True)
        self.first = np.append(first, len(self.hashes))
        self.group = np.arange(len(sets))  # sets that links of earlier queries have joined

    def search(self, query: np.ndarray) -> np.ndarray:
        """The sets that link with the query, by DivideSkip."""
        s = len(query)
        t = needed(s)
        at = np.searchsorted(self.keys, query)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == query)]
        if len(at) < t:
            return np.empty(0, np.int64)
        lengths = self.first[at + 1] - self.first[at]
        at = at[np.argsort(lengths, kind="stable")]
        aside = min(t - 1, int(t / (0.01 * np.log2(max(2, int(lengths.max()))) * 10 + 1)))
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        n = self.first[short + 1] - self.first[short]
        places = np.repeat(self.first[short] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        counts = np.bincount(self.sets[places], minlength=len(self.sizes))  # the merge of the short lists
        found = np.flatnonzero(counts >= max(1, t - aside))
        found = found[(needed(self.sizes[found]) <= s) & (self.sizes[found] >= t)]
        common = counts[found]
        for k in long[::-1]:  # binary search in each long list
            if not len(found):
                break
            members = self.sets[self.first[k] : self.first[k + 1]]
            where = np.minimum(np.searchsorted(members, found), len(members) - 1)
            common = common + (members[where] == found)
        return found[100 * common >= PERCENT * (s + self.sizes[found] - common)]


def _chunked(rows: DataFrame, *by: str) -> DataFrame:
    """rows(row, n, block and others) with `chunk`: sets of a block and of `by` with like sizes, about CHUNK_SETS sets or CHUNK_SHINGLES shingles."""
    rows = rows.withColumn("range", F.floor(F.log2("n") * 4).cast("int"))
    key = ["block", *by, "range"]
    cuts = rows.groupBy(*key).agg(F.ceil(F.greatest(F.count("*") / CHUNK_SETS, F.sum("n") / CHUNK_SHINGLES)).alias("cuts"))
    cuts = written(cuts, "cuts")  # a table, so that the join can split a large block
    chunk = F.struct(*by, "range", F.pmod(F.xxhash64("row"), F.col("cuts")).alias("k"))
    return rows.join(cuts, key).select("row", "n", "block", *by, chunk.alias("chunk"))


def _search(sets: DataFrame, placed: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b: links of the sets of pairs of chunks (block, x, y); of sets that several links join, a spanning part for each pair."""
    ends = F.explode(F.array(F.struct(F.col("x").alias("chunk"), F.lit(False).alias("index")), F.struct(F.col("y").alias("chunk"), F.lit(True).alias("index"))))
    sides = pairs.select("block", F.xxhash64("block", "x", "y").alias("task"), ends.alias("e")).select("block", "task", "e.chunk", "e.index")
    dealt = placed.select("row", "block", "chunk").join(sides, ["block", "chunk"]).select("row", "task", "index").join(sets.select("row", "hashes"), "row")
    dealt = dealt.select("task", "index", "row", "hashes").repartition(_parts(sets), "task").sortWithinPartitions("task", F.desc("index"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, index, lists, members = None, {}, None, []
        for batch in slices(batches, "hashes"):
            out: set[tuple[int, int]] = set()
            for t, indexed, row, blob in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if t != task:
                    task, index, lists, members = t, {}, None, []
                if indexed:
                    index[row] = np.frombuffer(blob, "<u8")
                    continue
                if lists is None:
                    members = list(index)
                    lists = Lists(list(index.values()))
                out |= {(row, members[k]) for k in _spanning(lists, np.frombuffer(blob, "<u8")) if members[k] != row}
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(out), strict=True)], ["a", "b"])

    return dealt.mapInArrow(tidy(run), "a long, b long")


def _pairs(placed: DataFrame, *kept: str) -> DataFrame:
    """block, x, y and `kept` of both sides: chunks of a block whose sizes allow a link, each pair once."""
    chunks = placed.groupBy("block", "chunk", *kept).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    side = lambda s: chunks.select("block", F.col("chunk").alias(s), *[F.col(c).alias(s + c) for c in ("lo", "hi", *kept)])
    fits = (F.col("ylo") * PERCENT <= F.col("xhi") * 100) & (F.col("xlo") * PERCENT <= F.col("yhi") * 100)
    return side("x").join(side("y"), "block").where((F.col("x") <= F.col("y")) & fits)


def links(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """a, b: links within blocks; of sets that several links join, a spanning part.

    Each chunk of a block is first joined within itself. A block of several chunks then goes on: one set of each class so
    far meets one of each other class, and what joins there joins the classes. Only sets of different classes are left to
    be compared, and of these only pairs with a set that did not stand for its class. A class that fills chunks of its own is
    not compared with itself again, so a family of near copies, however large, takes work in proportion to its sets.
    """
    sized = sets.select("row", "n").join(blocks.select(F.col("node").alias("row"), F.col("component").alias("block")), "row")
    first = written(_chunked(sized), "chunks")
    inner = first.select("block", F.col("chunk").alias("x"), F.col("chunk").alias("y")).distinct()
    found = written(_search(sets, first, inner), "links-within")
    many = written(first.select("block", "chunk").distinct().groupBy("block").agg(F.count("*").alias("m")).where("m > 1").select("block"), "many")
    rest = first.select("row", "n", "block").join(many, "block")
    rest = written(rest, "rest")
    discard(first, many)
    if rest.isEmpty():
        return found
    classes = components(found, "a", "b").select(F.col("node").alias("row"), "component")
    heads = rest.join(classes, "row", "left").where("component is null or component = row").select("row", "n", "block")
    heads = written(_chunked(heads), "heads")
    found = written(found.union(_search(sets, heads, _pairs(heads).select("block", "x", "y"))), "links-heads")
    classes = written(components(found, "a", "b").select(F.col("node").alias("row"), "component"), "classes")
    rest = rest.join(classes, "row", "left").withColumn("class", F.coalesce("component", "row"))
    # a class fills chunks of its own from CHUNK_SETS sets on; smaller ones share chunks, and so do sets without links
    sizes = written(rest.groupBy("block", "class").agg(F.count("*").alias("size")), "sizes")
    rest = rest.join(sizes, ["block", "class"]).withColumn("own", F.when(F.col("size") >= CHUNK_SETS, F.col("class"))).withColumn("lone", F.col("size") == 1)
    placed = written(_chunked(rest.select("row", "n", "block", F.coalesce("own", F.lit(0)).alias("own"), F.col("own").isNotNull().alias("large"), "lone"), "lone", "large", "own"), "placed")
    met = _pairs(placed, "lone", "large", "own").where("not (xlone and ylone) and not (xlarge and ylarge and xown = yown)")
    return written(found.union(_search(sets, placed, met.select("block", "x", "y"))), "links-across")


def _spanning(lists: Lists, query: np.ndarray) -> list[int]:
    """Of the sets that link with the query, those that earlier queries of the task have not joined already, and one of each joined group."""
    found = lists.search(query)
    kept = []
    groups, first = np.unique(lists.group[found], return_index=True) if len(found) else (found, found)
    for g, k in zip(groups.tolist(), found[first].tolist(), strict=True):
        kept.append(k)
        if g != groups[0]:
            lists.group[lists.group == g] = groups[0]
    return kept


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """row, doc_id, n and component (the least row of its sets) of each document."""
    rows = written(sets_of(docs, doc_id, text, False), "rows")
    some = linked_at_all(docs, doc_id, text)
    # always a sort-merge join: the ids that are left grow with the documents
    left = _rows(docs, doc_id, text).join(some.hint("merge"), "row", "left_semi").select("doc_id", "text")
    sets = sets_of(left, "doc_id", "text", True).where("n > 0").groupBy("digest").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("hashes").alias("hashes"))
    sets = written(sets, "sets")
    discard(some)
    found = links(sets, components(chains(sets), "a", "b"))
    joined = components(found, "a", "b").select(F.col("node").alias("row"), "component")
    # a class of equal sets goes where its set goes
    classes = written(sets.select("digest", "row").join(joined, "row", "left").select("digest", F.coalesce("component", "row").alias("component")), "classes")
    discard(sets, found)
    return rows.join(classes, "digest", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "row")).otherwise(F.col("row")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, n_shingles and component_id of each document."""
    placed = _placed(docs, doc_id, text)
    least = placed.groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("m")).where("m > 1").drop("m")
    least = written(least, "least")  # a table, so that the join below can split a large component
    out = placed.join(least, "component", "left")
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id, null ids last.

    Of different texts under that id the one with the least hash stays, of equal rows the one whose columns have it.
    """
    spare = "row_" + "_" * max(len(c) for c in docs.columns)
    marked = docs.withColumn(spare, F.xxhash64(F.col(doc_id).cast("long"), F.col(text)))
    placed = _placed(docs, doc_id, text).where("n > 0").select("row", "doc_id", "component")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row"))["row"]
    best = written(placed.groupBy("component").agg(best.alias("best"), F.count("*").alias("m")).where("m > 1").drop("m"), "best")
    fate = placed.join(best, "component").groupBy("row", (F.col("row") != F.col("best")).alias("gone")).agg(F.count("*").alias("m"))
    fate = written(fate.where("gone or m > 1").select(F.col("row").alias(spare), "gone"), "fate")
    out = marked.join(fate, spare, "left_anti").drop(spare)
    twice = fate.where("not gone")
    if twice.isEmpty():
        return out
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    one = marked.join(twice, spare, "left_semi").groupBy(spare).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias(spare + "d"))
    return out.union(one.select(f"{spare}d.*"))
