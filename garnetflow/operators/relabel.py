"""Relabelling: what changed, and which rows are still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_labels(old: Column, new: Column) -> Column:
    """Equal length and every new label among the old ones; repeats can make unequal lists equal."""
    return (F.size(old) == F.size(new)) & (F.size(F.array_except(new, old)) == 0)


def changes(rows: DataFrame, old: str, new: str) -> DataFrame:
    """total, changed and the share changed in percent."""
    moved = (~same_labels(F.col(old), F.col(new))).cast("long")
    return rows.agg(F.count("*").alias("total"), F.sum(moved).alias("changed"), F.try_divide(F.sum(moved) * 100.0, F.count("*")).alias("share"))


def added(rows: DataFrame, old: str, new: str, n: int = 10) -> DataFrame:
    """The labels that were added most often."""
    return rows.select(F.explode(F.array_except(new, old)).alias("vector")).groupBy("vector").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "vector").limit(n)


def unprocessed(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """rows with an id and a text that no earlier run has written."""
    return rows.where(f"{key} is not null and cast({key} as string) <> '' and text <> ''").join(done.select(key).distinct(), key, "left_anti")
