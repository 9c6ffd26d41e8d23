"""What driver and executors share: a folder for what is built once and read by later jobs, and where workers find this package."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; on one machine, where that is unset, under a temporary folder. It goes when the driver ends."""
    sc = spark.sparkContext
    told = sc.getConf().get("spark.checkpoint.dir", None)
    if not told:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all machines share")
        told = "file://" + tempfile.mkdtemp(prefix="garnetflow-")
    folder = f"{told.rstrip('/')}/garnetflow-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return f"{folder}/{name}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """rows, computed once, as a table in the shared folder."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def importable(spark: SparkSession) -> None:
    """Workers find this package where the driver found it, from whatever folder the driver was started."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = env.get("PYTHONPATH", "").split(":")
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone at exit; what is left is scratch
        pass
