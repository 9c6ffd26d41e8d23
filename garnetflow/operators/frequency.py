"""How often weaknesses occur with each vector: counts, shares of records, ranks and short lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Rows of each (vector, cwe); a weakness that a record lists twice counts twice."""
    return pairs.groupBy("vector", "cwe").agg(F.count("*").alias("cnt"))


def ranked(counts: DataFrame, totals: DataFrame | int, by: str | None = "vector") -> DataFrame:
    """counts with the share of records in percent and the rank, by count and then by id.

    totals has the records of each vector (column total); with by=None it is the number of all records,
    and the rank runs over all rows. Shares may pass 100, as records list weaknesses twice.
    """
    if by:
        counts = counts.join(totals, by)
        window = Window.partitionBy(by)
    else:
        counts = counts.withColumn("total", F.lit(totals).cast("long"))
        window = Window.partitionBy(F.lit(0))
    order = window.orderBy(F.desc("cnt"), "cwe")
    return counts.withColumns({"percentage": F.col("cnt") * 100.0 / F.col("total"), "rank": F.row_number().over(order).cast("long")})


def top(counts: DataFrame, n: int, by: str = "vector") -> DataFrame:
    """The first n of each vector; Spark cuts each partition before it shuffles."""
    order = Window.partitionBy(by).orderBy(F.desc("cnt"), "cwe")
    return counts.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n)


def overall(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent weaknesses of all, without a global window."""
    return counts.groupBy("cwe").agg(F.sum("cnt").alias("cnt")).orderBy(F.desc("cnt"), "cwe").limit(n)


def short_lists(counts: DataFrame, n: int = 5) -> DataFrame:
    """vector and its n most frequent weaknesses, in order, as one array."""
    listed = top(counts, n).groupBy("vector").agg(F.array_sort(F.collect_list(F.struct("rank", "cwe"))).alias("l"))
    return listed.select("vector", F.col("l.cwe").alias("cwes"))


def coverage(rows: DataFrame, values: str) -> DataFrame:
    """How many rows have a value in an array column, and their share in percent."""
    has = (F.size(F.coalesce(values, F.array())) > 0).cast("int")
    return rows.agg(F.count("*").alias("n"), F.sum(has).cast("long").alias("mapped"), (F.avg(has) * 100).alias("coverage"))
