"""Tables of versions: whole snapshots under numbers, and upserts that rewrite only the buckets they touch.

A version is a small JSON file, versions/<number>.json, that lists the data folders it consists of. It is written beside its place and
renamed to it only if nothing is there, so of two writers one is told that it lost, and a reader sees a version whole or not at all.
Data folders are never changed. A reader stays with the version that it has opened, whatever is committed meanwhile; what a
writer that broke off has left behind is in no version, and vacuum() removes it.

Rows of a keyed table lie in a fixed number of buckets by a hash of the key. An upsert reads and writes the buckets of the new rows, keeps
for each key the row that comes last by `order`, and takes over all other buckets as they are. A version remembers the last
batch of each source, so a batch that a stream repeats after a failure is left out.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer has committed the version."""


class Table:
    """A table of versions under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        """The numbers of all versions, ascending."""
        if not self.fs.exists(self._at("versions")):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self._at("versions"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """What a version consists of; the last one, or None if there is none."""
        version = version or max(self.versions(), default=None)
        if version is None:
            return None
        source = self.fs.open(self._at(f"versions/{version}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the last. The frame stays with it."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version under {self.path}")
        return self._rows(m, m["parts"].values())

    def _rows(self, m: dict, folders) -> DataFrame:
        schema = StructType.fromJson(m["schema"])
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _commit(self, m: dict) -> int:
        """Makes a version visible, or raises Conflict."""
        new = self._at(f"versions/_{uuid.uuid4().hex}")
        self.fs.mkdirs(self._at("versions"))
        out = self.fs.create(new)
        out.write(bytearray(json.dumps(m).encode()))
        out.close()
        context = self.hadoop.FileContext.getFileContext(new.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(self.spark._jvm, "org.apache.hadoop.fs.Options$Rename").NONE
        try:
            context.rename(new, self._at(f"versions/{m['version']}.json"), options)
        except Exception as e:
            self.fs.delete(new, False)
            raise Conflict(f"version {m['version']} of {self.path} is there already") from e
        return m["version"]

    def replace(self, df: DataFrame, applied: dict[str, int] | None = None) -> int:
        """A version that consists of df, which may read this table itself."""
        was = self.manifest() or {"version": 0, "applied": {}}
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return self._commit({"version": was["version"] + 1, "schema": df.schema.jsonValue(), "parts": {"all": folder}, "buckets": 0, "applied": applied or was["applied"]})

    def upsert(self, rows: DataFrame, key: str, order: list[str], buckets: int = BUCKETS, batch: tuple[str, int] | None = None) -> int | None:
        """A version with the rows: of each key the one stays that is last by `order`, of equal ones the new. Rows without a key are left out.

        batch: a source and a number; if the table has taken in this number or a later one of the source, nothing happens.
        """
        was = self.manifest() or {"version": 0, "schema": rows.schema.jsonValue(), "parts": {}, "buckets": buckets, "applied": {}}
        if batch and was["applied"].get(batch[0], -1) >= batch[1]:
            return None
        if not was["buckets"]:
            raise ValueError("the table is not in buckets")
        schema = StructType.fromJson(was["schema"])
        if [f.name for f in schema] != rows.columns:
            raise ValueError(f"the table has the columns {schema.names}")
        bucket = F.pmod(F.xxhash64(key), F.lit(was["buckets"])).cast("int").alias("__bucket")
        # the new rows are staged once, however they are made; what they touch is known from the folders
        staged = f"data/{uuid.uuid4().hex}"
        rows.where(F.col(key).isNotNull()).select("*", bucket).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{staged}")
        names = [f.getPath().getName() for f in self.fs.listStatus(self._at(staged))]
        touched = sorted(int(n.partition("=")[2]) for n in names if n.startswith("__bucket="))
        parts = dict(was["parts"])
        if touched:
            new = self.spark.read.schema(schema).parquet(*[f"{self.path}/{staged}/__bucket={k}" for k in touched])
            old = self._rows(was, [parts[str(k)] for k in touched if str(k) in parts])
            both = new.withColumn("__new", F.lit(1)).unionByName(old.withColumn("__new", F.lit(0)))
            last = F.max_by(F.struct(*[F.col(c) for c in schema.names]), F.struct(*order, "__new", F.xxhash64(*schema.names)))
            merged = both.groupBy(F.col(key).alias("__key")).agg(last.alias("r")).select("r.*")
            folder = f"data/{uuid.uuid4().hex}"
            merged.select("*", bucket).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
            parts |= {str(k): f"{folder}/__bucket={k}" for k in touched}
        applied = was["applied"] | ({batch[0]: batch[1]} if batch else {})
        done = self._commit(was | {"version": was["version"] + 1, "parts": parts, "applied": applied})
        self.fs.delete(self._at(staged), True)
        return done

    def vacuum(self, keep: int = 2) -> int:
        """Removes all but the last versions, and data that none of these has; returns how many folders went. Not while others write."""
        numbers = self.versions()
        used = {f for n in numbers[-keep:] for f in self.manifest(n)["parts"].values()}
        for n in numbers[:-keep]:
            self.fs.delete(self._at(f"versions/{n}.json"), False)
        names = lambda at: [f.getPath().getName() for f in self.fs.listStatus(self._at(at))] if self.fs.exists(self._at(at)) else []
        gone = []
        for folder in (f"data/{n}" for n in names("data")):
            if not any(u == folder or u.startswith(f"{folder}/") for u in used):
                gone.append(folder)
            elif folder not in used:
                gone += [f"{folder}/{n}" for n in names(folder) if n.startswith("__bucket=") and f"{folder}/{n}" not in used]
        for folder in gone:
            self.fs.delete(self._at(folder), True)
        return len(gone)
