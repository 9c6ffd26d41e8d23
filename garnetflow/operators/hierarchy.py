"""Catalogue maps and hierarchies as edge tables: inversion, mapping, children, ancestors to a depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inverted(catalog: DataFrame, key: str, values: str) -> DataFrame:
    """One row (value, key) for each listed value, repeats included."""
    return catalog.select(F.explode(values).alias("value"), F.col(key).alias("key"))


def mapped(items: DataFrame, item: str, node: str, mapping: DataFrame) -> DataFrame:
    """Distinct (item, vector) of items whose node is in mapping(node, vector)."""
    return items.select(F.col(item).alias("item"), F.col(node).alias("node")).join(mapping, "node").select("item", "vector").distinct()


def children(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """parent and its children in order, for parents that are nodes; one entry for each edge."""
    found = edges.join(nodes.select(F.col("node").alias("parent")).distinct(), "parent")
    return found.groupBy("parent").agg(F.array_sort(F.collect_list("child")).alias("children"))


def parents(edges: DataFrame) -> DataFrame:
    """child and its parents in order, whether these are nodes or not."""
    return edges.groupBy("child").agg(F.array_sort(F.collect_list("parent")).alias("parents"))


def ancestors(items: DataFrame, edges: DataFrame, depth: int = 2) -> DataFrame:
    """item, node and level of each node reached in 0 to `depth` steps up, at its least level.

    A step is a join, so the depth is a small constant. A parent without edges of its own ends its path.
    """
    up = edges.select(F.col("child").alias("node"), F.col("parent")).distinct()
    level = items.select("item", "node").distinct()
    found = level.withColumn("level", F.lit(0).cast("long"))
    for k in range(1, depth + 1):
        level = level.join(up, "node").select("item", F.col("parent").alias("node")).distinct()
        found = found.unionByName(level.withColumn("level", F.lit(k).cast("long")))
    return found.groupBy("item", "node").agg(F.min("level").alias("level"))


def candidates(items: DataFrame, edges: DataFrame, mapping: DataFrame, depth: int = 2) -> DataFrame:
    """Distinct (item, vector) of the nodes of an item and their ancestors."""
    return ancestors(items, edges, depth).join(mapping, "node").select("item", "vector").distinct()
