"""What the operators of this subpackage share: scratch tables, row streams and byte helpers."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import importable

BATCH_BYTES = 8 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine a folder of our own where that is unset."""
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("garnetflow.shared.dir", None)
    if not told:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that all machines share")
        told = "file://" + tempfile.mkdtemp(prefix="garnetflow-")
        spark.conf.set("garnetflow.shared.dir", told)
    return told.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends, or before by discard()."""
    path = f"{shared_dir(spark)}/garnetflow-{uuid.uuid4().hex}/{name}"
    atexit.register(_remove, spark, path.rpartition("/")[0])
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone at exit; the folder is scratch
        pass


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while; what the caller had comes back."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and outlives lost executors.

    Nothing reads the shuffle files of the plan again, so they go as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that written() gave, once all that is made of them is written itself."""
    for table in tables:
        _remove(table.sparkSession, table.scratch.rpartition("/")[0])


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a string column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about `limit` bytes of a string or binary column, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def tidy(function):
    """A function for mapInArrow whose batches are bounded and whose worker gives memory back after a task.

    Spark fills batches by rows; BATCH_BYTES also bounds their bytes, since texts may be very long. Workers
    serve task after task, and their allocators would else keep what the largest needed.
    """
    spark = SparkSession.getActiveSession()
    if spark is not None:
        importable(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def give_back() -> None:
    """Memory that the allocators hold and nobody uses goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def fs_of(uri: str):
    """pyarrow's file system and path of a URI, for executors that write files in the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
