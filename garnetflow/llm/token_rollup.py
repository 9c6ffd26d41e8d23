"""Delta-maintained token counts by source, language and tokenizer version.

A batch is a table of signed rows: inserts count up, deletes count down, a revision takes the old count back
and adds the new one. A batch is summed to one row for each key before it is stored, so totals are sums
of small tables however many documents there are. A batch is written aside and renamed to its id; an id that is
there already is not written again, so a batch may be sent any number of times. Compaction sums batches into a
base that names them, and readers take the newest base and the batches that it does not name. Counts come from the
public vocabularies (TOKENIZERS), each under its version name, or from a column of the caller's.

Cases: null keys are keys like any other; null text counts as empty; repeated rows count each; keys whose sums
are all 0 leave the totals; an empty batch is committed and changes nothing; no batches give no row;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path, slices, texts_of, tidy, written
from .subwords import words

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Versions that are counted here, by their vocabulary files; other tokenizers bring their counts as a column.
TOKENIZERS = {"byte_bpe_50k": "byte_bpe_50k.json", "word_bpe_49k": "word_bpe_49k.json"}
#: Chunks that a worker remembers for each vocabulary.
REMEMBERED = 900_000


def counted(docs: DataFrame, text: str = "text", tokenizers: dict[str, str] = TOKENIZERS) -> DataFrame:
    """docs without the text, with a column of token counts for each tokenizer and the SHA-256 of the text."""
    rest = [c for c in docs.columns if c != text]
    schema = T.StructType([f for f in docs.schema.fields if f.name != text] + [T.StructField("text_sha", T.BinaryType())] + [T.StructField(k, T.LongType()) for k in tokenizers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [words(f, REMEMBERED) for f in tokenizers.values()]
        for batch in slices(batches, text):
            texts = texts_of(batch.column(text))
            shas = pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())
            counts = [pa.array(map(e.count, texts), pa.int64()) for e in encoders]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), shas, *counts], schema.names)

    return docs.mapInArrow(tidy(run), schema)


def signed(rows: DataFrame, tokenizer: str, n_tokens: str | Column, sign: int, source: str = "source", lang: str = "lang") -> DataFrame:
    """Rows of a batch: one document more (sign 1) or less (-1) for each row."""
    n = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    return rows.select(F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"), (n * sign).cast("long").alias("n_tokens"))


def revised(rows: DataFrame, tokenizer: str, old: str | Column, new: str | Column, source: str = "source", lang: str = "lang") -> DataFrame:
    """Rows of a batch that replaces the old counts of documents by new ones."""
    return signed(rows, tokenizer, old, -1, source, lang).union(signed(rows, tokenizer, new, 1, source, lang))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """Totals under a path that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _listed(self) -> tuple[str | None, list[str]]:
        """The newest base and the batches beside it, by one listing."""
        root = self._path(self.path)
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(root)) if self._fs.exists(root) else []
        return next((n for n in reversed(names) if n.startswith("base-")), None), [n.removeprefix("batch-") for n in names if n.startswith("batch-")]

    def _named(self, base: str | None) -> DataFrame:
        """The rows of a base that name its batches."""
        if base is None:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{base}").where("tokenizer is null and n_docs is null")

    def _known(self, base: str | None, batches: list[str]) -> set[str]:
        """Which of these few batches a base names already."""
        return {r[0] for r in self._named(base).where(F.col("source").isin(batches)).select("source").collect()} if base and batches else set()

    def _publish(self, rows: DataFrame, name: str) -> bool:
        """Writes rows aside, then renames them to `name`; False if the name is taken."""
        aside = f"{self.path}/_{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(aside)  # a row for each key
        final = self._path(f"{self.path}/{name}")
        done = not self._fs.exists(final) and self._fs.rename(self._path(aside), final)
        if done and self._fs.exists(self._path(f"{self.path}/{name}/{self._path(aside).getName()}")):
            # another writer came first, and the rename moved ours into its folder
            self._fs.delete(self._path(f"{self.path}/{name}/{self._path(aside).getName()}"), True)
            return False
        if not done:
            self._fs.delete(self._path(aside), True)
        return done

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Adds a batch once. False if its id is known already, in a base or on its own."""
        if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", batch):
            raise ValueError(f"{batch!r} cannot name a batch")
        base, batches = self._listed()
        if batch in batches or self._known(base, [batch]):
            return False
        return self._publish(summed(rows).where("n_docs <> 0 or n_tokens <> 0"), f"batch-{batch}")

    def totals(self, listed: tuple[str | None, list[str]] | None = None) -> DataFrame:
        """source, lang, tokenizer, n_docs and n_tokens of all batches, or of those that were listed."""
        base, batches = listed or self._listed()
        known = self._known(base, batches)  # a compaction that broke off leaves batches that its base names
        parts = [f"{self.path}/batch-{b}" for b in batches if b not in known] + ([f"{self.path}/{base}"] if base else [])
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*parts).where("n_docs is not null")
        return summed(rows).where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> None:
        """Sums everything that one listing shows into a new base, which also names its batches; then drops these and the older base.

        A batch that comes meanwhile is neither summed nor named. After a break between base and deletion the batches are
        named by the base and count once.
        """
        listed = base, batches = self._listed()
        new = self.spark.createDataFrame([(b, None, None, None, None) for b in batches], SCHEMA)
        named = self._named(base).union(new).distinct()
        if not self._publish(self.totals(listed).unionByName(named), f"base-{int(base[5:]) + 1 if base else 0:09d}"):
            return
        for name in [f"batch-{b}" for b in batches] + [base] * bool(base):
            self._fs.delete(self._path(f"{self.path}/{name}"), True)


def maintained(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The query: totals after inserts for both vocabularies, the deletion of all copies of a text but the first, a
    revision of the byte vocabulary's counts to those with an end id for each document, and a second delivery of each batch."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    rows = written(counted(rows), "counts")
    first = rows.groupBy("text_sha").agg(F.min(F.struct("doc_id", "source", "lang", *TOKENIZERS)).alias("d")).select("d.*")
    first = written(first, "first")
    rollup = Rollup(spark, path or scratch_path(spark, "rollup"))
    batches = {f"insert-{k}": signed(rows, k, k, 1) for k in TOKENIZERS}
    for k in TOKENIZERS:
        batches[f"delete-copies-{k}"] = signed(rows, k, k, -1).union(signed(first, k, k, 1))
    batches["revise-byte_bpe_50k"] = revised(first, "byte_bpe_50k", "byte_bpe_50k", F.col("byte_bpe_50k") + 1)
    for delivery in range(2):
        for name, delta in batches.items():
            if rollup.commit(name, delta) != (delivery == 0):
                raise AssertionError(f"batch {name} was committed twice or not at all")
    rollup.compact()
    return rollup.totals()
