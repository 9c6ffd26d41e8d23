"""Elements of large JSON documents, read by many tasks.

A document is read by the text source with } as the end of a line, so a large file is split and every store that Spark reads will do. What a
split's pieces mean depends on whether it begins inside a string, and how deep. So a first pass sums up each split for both cases:
where it ends and how the depth changes. Folding these few rows in order gives the state at the start of each split, and a second pass cuts the
elements out. Those that lie within a split leave it whole; the two ends of each split, parts of elements that cross into the next, are put
together by the element's number. Elements are objects: those of a top-level array or object, or of one under a key of
the top-level object. Only the asked fields are decoded later, by from_json.

Cases: pretty or compact text, braces and quotes within strings, other members beside the asked key, empty documents; members that are
no objects are left out; a document that is cut short gives its whole elements and perhaps one that does not parse.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_token = re.compile(r'"((?:[^"\\]|\\.)*)"(\s*:\s*(?=[\[{]))?|[\[\]{]|"', re.S)
_rest_of_string = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_key = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*\Z', re.S)
_keyed = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*(?={)', re.S)
SUMMARY = "file string, block long, ends_out boolean, delta_out int, keys_out map<int,string>, ends_in boolean, delta_in int, keys_in map<int,string>"
START = "file string, block long, inside boolean, depth int, top string"


class Walk:
    """Goes through pieces of text, each followed by }, from a state: inside a string or not, at a depth, under a key at depth 1."""

    def __init__(self, inside: bool = False, depth: int = 0, top: str | None = None):
        self.inside, self.depth, self.top = inside, depth, top
        self.begun_under: str | None = None  # the key at depth 1 where the last object began
        self.keys: dict[int, str] = {}  # the last key of an array or object at each depth

    def piece(self, text: str, at: int = -1) -> int:
        """Takes in a piece; returns where in it an object begins at depth `at`, the last such place, or -1."""
        begin, place = -1, 0
        if self.inside:
            m = _rest_of_string.match(text)
            if m is None:
                return begin  # the brace is part of the string, too
            self.inside, place = False, m.end()
        for m in _token.finditer(text, place):
            c = m[0]
            if c == "{" or c == "[":
                if c == "{" and self.depth == at:
                    begin, self.begun_under = m.start(), self.top
                self.depth += 1
            elif c == "]":
                self.depth -= 1
            elif c == '"':
                self.inside = True
                return begin
            elif m[2] is not None:
                self.keys[self.depth] = m[1]
                if self.depth == 1:
                    self.top = m[1]
        self.depth -= 1
        return begin


def _pieces(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, walks = None, None

    def row() -> list[dict]:
        out = {"file": at[0], "block": at[1]}
        for case, w in zip(("out", "in"), walks, strict=True):
            out |= {f"ends_{case}": w.inside, f"delta_{case}": w.depth, f"keys_{case}": list(w.keys.items())}
        return [out]

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), *((f"{n}_{s}", t) for s in ("out", "in") for n, t in (("ends", pa.bool_()), ("delta", pa.int32()), ("keys", pa.map_(pa.int32(), pa.string()))))])
    for batch in batches:
        for file, block, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != (file, block):
                if at is not None:
                    yield pa.RecordBatch.from_pylist(row(), schema)
                at, walks = (file, block), (Walk(), Walk(True))
            for w in walks:
                w.piece(text)
    if at is not None:
        yield pa.RecordBatch.from_pylist(row(), schema)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state at the start of each split, from the summaries in the order of the file."""
    file, inside, depth, top = None, False, 0, None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["file"] != file:
                file, inside, depth, top = r["file"], False, 0, None
            rows.append({"file": file, "block": r["block"], "inside": inside, "depth": depth, "top": top})
            case = "in" if inside else "out"
            top = dict(r[f"keys_{case}"]).get(1 - depth, top)
            inside, depth = r[f"ends_{case}"], depth + r[f"delta_{case}"]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int32()), ("top", pa.string())]))


def _cutter(under: str | None):
    """Whole elements of a split (part null), and what stands before its first and after its last end of an element (part 0 and the number of ends)."""
    level = 1 if under is None else 2
    ours = lambda top: under is None or top == under
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("ends", pa.int64()), ("part", pa.int32()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, walk, held, begun, ends = None, None, [], False, 0
        rows: list[tuple] = []

        def rest() -> None:
            if at is not None:
                rows.append((*at, ends, 1 if ends else 0, "".join(held) if begun else ""))

        for batch in batches:
            for file, block, text, inside, depth, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (file, block):
                    rest()
                    at, walk, held, ends = (file, block), Walk(inside, depth, top), [], 0
                    begun = depth > level and ours(top)  # the split begins within an element
                begin = walk.piece(text, level)
                if begin >= 0 and ours(walk.begun_under):
                    # all before the element goes, but for its key
                    before = _key.search("".join([*held, text[:begin]]))
                    held, begun = [before[0] if before else "", text[begin:], "}"], True
                else:
                    held += [text, "}"]
                if begun and walk.depth == level and not walk.inside:
                    rows.append((*at, ends, None if ends else 0, "".join(held)))  # the first may have begun in an earlier split
                    held, begun, ends = [], False, ends + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows = []
        rest()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return run


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and value of an element's text; text without an object gives no row."""
    for batch in batches:
        keys, values = [], []
        for text in batch.column(0).to_pylist():
            m = _keyed.match(text)
            begin = m.end() if m else text.find("{")
            if begin < 0:
                continue
            keys.append(json.loads(f'"{m[1]}"') if m else None)
            values.append(text[begin:])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.string())], ["key", "value"])


def elements(spark: SparkSession, path, under: str | None = None) -> DataFrame:
    """key (null in arrays) and value, as text, of the objects in the top-level array or object, or in the one under a key."""
    pieces = _pieces(spark, path)
    summed = pieces.mapInArrow(_summed, SUMMARY)
    # a few numbers for each split, folded file by file
    starts = summed.repartition("file").sortWithinPartitions("file", "block").mapInArrow(_folded, START)
    known = pieces.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "value", "inside", "depth", "top")
    cut = known.mapInArrow(_cutter(under), "file string, block long, ends long, part int, value string")
    whole = cut.where("part IS NULL").select("value")
    # the ends of the splits: an element's number is how many have ended before it
    parts = cut.where("part IS NOT NULL")
    blocks = parts.groupBy("file", "block").agg(F.max("ends").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = parts.join(blocks.select("file", "block", "n", before.alias("before")), ["file", "block"])
    numbered = numbered.withColumn("element", F.when(F.col("part") == 0, F.col("before")).otherwise(F.col("before") + F.col("n")))
    joined = numbered.groupBy("file", "element").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "part", "value"))), lambda x: x["value"]), "").alias("value"))
    return whole.unionByName(joined.select("value")).mapInArrow(_parted, "key string, value string")


def parsed(spark: SparkSession, path, schema: str, under: str | None = None) -> DataFrame:
    """key and the fields of a schema of each element."""
    return elements(spark, path, under).select("key", F.from_json("value", schema).alias("n")).select("key", "n.*")
