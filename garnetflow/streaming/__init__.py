"""Incremental work: feed folders as streams, and exports that resume."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.collect import training_data
from ..operators.relabel import unprocessed
from ..sources import artifacts, schemas, versions


def feed_stream(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """A row (cve) for each vulnerability of the 2.0 feed files that arrive in a folder."""
    rows = spark.readStream.option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).schema(schemas.NVD_FEED).json(folder)
    return rows.select(F.explode("vulnerabilities").alias("v")).select("v.cve")


REVISED = f"{schemas.TRAINING}, revised string"


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Upserts the training rows of new feed files into a table of versions; stops when all files are read.

    Of each cve_id the row with the latest revision stays, whichever file it came in. A batch that is repeated after a failure is
    left out, as the table knows the last batch of this folder; a record whose revision has no English text or mapped weakness leaves the older row.
    """
    table = versions.Table(spark, out)

    def add(batch: DataFrame, number: int) -> None:
        revised = batch.select(F.col("cve.id").alias("cve_id"), F.coalesce("cve.lastModified", "cve.published", F.lit("")).alias("revised"), "cve")
        rows = training_data(revised, "revised")
        table.upsert(rows, "cve_id", ["revised"], batch=(folder, number))

    return feed_stream(spark, folder).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def export_stream(spark: SparkSession, folder: str, schema: str, out: str, embed: Callable[[DataFrame], DataFrame], checkpoint: str, files: int = 8) -> StreamingQuery:
    """Embeddings of the rows (id, type, text, metadata) in a folder of Parquet files, each file once; stops when all files are read.

    A batch is `files` files. It is written beside its place, out/batch=<number>, and renamed to it once, so a batch that was killed has
    written nothing and one that is repeated adds nothing. Rows whose embedding is missing or no vector of numbers go to out/_rejected with
    the reason, batch by batch in the same way. Nothing that is written is read again.
    """
    fs = spark._jvm.org.apache.hadoop.fs

    def add(batch: DataFrame, number: int) -> None:
        done, new = fs.Path(f"{out}/batch={number}"), f"{out}/_new-{uuid.uuid4().hex}"
        system = done.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(done):
            return
        made = embed(batch.where("id is not null and id <> '' and text <> ''"))
        if "problem" not in made.columns:
            made = made.withColumn("problem", F.lit(None).cast("string"))
        good = F.coalesce((F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)), F.lit(False))
        made = made.select("id", "type", "text", "embedding", "metadata", F.when(~good, F.coalesce("problem", F.lit("no vector"))).alias("problem"), good.alias("good"))
        made.write.partitionBy("good").parquet(new)  # the service is asked once for both kinds
        for kind, place in (("false", f"{out}/_rejected/batch={number}"), ("true", f"{out}/batch={number}")):
            source, target = fs.Path(f"{new}/good={kind}"), fs.Path(place)
            system.mkdirs(target.getParent())
            if kind == "false" and system.exists(target):
                system.delete(target, True)  # of an attempt that broke off here
            if not system.exists(source):
                system.mkdirs(source)
            if not system.rename(source, target):
                raise OSError(f"{place} cannot be written")
        system.delete(fs.Path(new), True)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def exported(spark: SparkSession, out: str) -> DataFrame:
    """What export_stream has written, with the number of the batch."""
    return spark.read.schema(f"{schemas.EMBEDDINGS}, batch int").option("basePath", out).parquet(out)


def rejected(spark: SparkSession, out: str) -> DataFrame:
    """What the service has not embedded, with the reason; it can be exported again from here."""
    return spark.read.schema(f"{schemas.EMBEDDINGS}, problem string, batch int").option("basePath", f"{out}/_rejected").parquet(f"{out}/_rejected")


def export_embeddings(rows: DataFrame, out: str, embed: Callable[[DataFrame], DataFrame]) -> int:
    """Appends embeddings of rows (id, type, text, metadata) that `out` has not; returns how many were due.

    The output is its own progress: ids that are in it are done. One job scans the rows; what it has finished when it is killed is not
    visible, as its files are committed together. embed takes and returns a frame and adds the column embedding, within the limits of its service
    (operators.embedding.service). Rows whose embedding is null or empty, or holds something that is no number, are not written, and so are due again.
    """
    spark = rows.sparkSession
    done = artifacts.optional(spark, out, schemas.EMBEDDINGS, lambda s, p: s.read.schema(schemas.EMBEDDINGS).parquet(p))
    todo = unprocessed(rows, done)
    n = todo.count()
    if n:
        made = embed(todo).where(F.size("embedding") > 0).where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)))
        made.select("id", "type", "text", "embedding", "metadata").write.mode("append").parquet(out)
    return n


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums of events(ts, event_type, value) in windows of event time, late events up to `late`."""
    rows = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "total")
