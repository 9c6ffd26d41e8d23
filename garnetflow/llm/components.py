"""Connected components of a graph that is only ever a table of edges.

Alternating large and small stars: each round joins every node's neighbours to the least of them, above the
node and then below it, until the edges no longer change. Counts of rows do not grow and hubs are
pre-aggregated. Each round first joins the edges of each partition on their own; once all edges that are left fit
in one task (LOCAL, counted first), such a task finishes at once. Nothing goes to the driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, tidy, written


#: Edges that one task takes: 16 bytes each, and about ten times that while it works.
LOCAL = 1_000_000


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the least node that each reaches."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while (new != (far := new[new])).any():
            new = far
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition to stars, by pieces of LOCAL edges."""
    held: list[pa.RecordBatch] = []

    def stars() -> Iterator[pa.RecordBatch]:
        if held:
            nodes, least = roots(*(np.concatenate([np.asarray(b.column(k)) for b in held]) for k in range(2)))
            keep = nodes != least
            yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(least[keep])], ["u", "v"])
            held.clear()

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= LOCAL:
            yield from stars()
    yield from stars()


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the least node reached) of every node of the edges; nodes are longs.

    Loops and edges with a null end are ignored; without edges there is no row.
    """
    a, b = F.col(a).cast("long"), F.col(b).cast("long")
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    now = written(now.mapInArrow(tidy(_contract), "u long, v long"), "edges")
    was = None
    while (mark := _mark(now)) != was:
        was = mark
        if mark[0] <= LOCAL:
            last, now = now, written(now.coalesce(1).mapInArrow(tidy(_contract), "u long, v long"), "stars")
            discard(last)
            break
        # large star: neighbours above u go to the least neighbour of u, or u itself
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        m = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its neighbours below go to the least of them
        m = _least(large)
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
        last, now = now, written(small.where("u <> v").distinct(), "edges")
        discard(last)
    tops = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
