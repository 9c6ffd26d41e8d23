"""Quartile bucket digests of documents, and their bounded difference.

Byte triplets of the UTF-8 text, taken at the spacings of SPANS so that they cross word ends, are hashed to
BUCKETS counters. A bucket's digit is the quartile of its count among all buckets; the digest is the
length on a logarithmic scale and two bits for each bucket, in hexadecimal. Likeness is 1 less the
digit distances and the difference of lengths, bounded by LIMIT.

Cases: null counts as empty text; an empty text has all digits 0; equal texts have equal digests; texts with the
same doc_id follow by their hash; a null doc_id comes last; the only document is its own next; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

BUCKETS = 256
SPANS = ((4, 9), (7, 13))
LIMIT = 1.5 * BUCKETS
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _hashed(b: np.ndarray, p: int, q: int, salt: int) -> np.ndarray:
    n = len(b) - q
    x = (b[:n] * np.uint32(0x9E3779B1)) ^ (b[p : p + n] * np.uint32(0x85EBCA6B)) ^ (b[q : q + n] * np.uint32(0xC2B2AE35))
    x += np.uint32(salt)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return (x >> np.uint32(13)) & np.uint32(BUCKETS - 1)


def digest(data: bytes) -> tuple[int, np.ndarray]:
    """The length code and the quartile digit of each bucket."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    found = [_hashed(b, p, q, 1 + 7919 * k) for k, (p, q) in enumerate(SPANS) if len(b) > q]
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS) if found else np.zeros(BUCKETS, np.int64)
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return round(np.log1p(len(b)) / np.log(1.1)), np.searchsorted(cuts, counts, side="left").astype(np.int8)


def encoded(d: tuple[int, np.ndarray]) -> str:
    digits = d[1].reshape(-1, 4).astype(np.uint8)
    return f"{d[0] & 0xFFF:03x}" + (digits[:, 0] << 6 | digits[:, 1] << 4 | digits[:, 2] << 2 | digits[:, 3]).astype(np.uint8).tobytes().hex()


def decoded(text: str) -> tuple[int, np.ndarray]:
    b = np.frombuffer(bytes.fromhex(text[3:]), np.uint8)
    return int(text[:3], 16), np.stack([b >> 6, b >> 4 & 3, b >> 2 & 3, b & 3], axis=1).reshape(-1).astype(np.int8)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """1 for equal digests, 0 from a difference of LIMIT on. Opposite quartiles count double."""
    apart = np.abs(a[1] - b[1])
    score = int(apart.sum()) + 3 * int((apart == 3).sum()) + 8 * max(0, abs(a[0] - b[0]) - 5)
    return 1.0 - min(score, LIMIT) / LIMIT


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of the next one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit with the next one in descending order of doc_id.

    Documents are dealt into ranges of doc_id. Each range also gets the first document of the next, so
    every text moves once and each task holds two texts at a time.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    cuts = sorted(set(rows.approxQuantile("doc_id", [k / (4 * n) for k in range(1, 4 * n)], 1 / (16 * n))), reverse=True)
    cut = F.array(*[F.lit(int(c)).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(cut, lambda c: c > F.col("doc_id"))))
    rows = rows.withColumn("bucket", bucket)
    # the first document of each range: as many rows as ranges
    tops = sorted(rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "tie")).alias("top")).collect())
    if not tops:
        return spark.createDataFrame([], SCHEMA)
    ends = [(t["bucket"], *tops[(k + 1) % len(tops)]["top"]) for k, t in enumerate(tops)]
    ends = spark.createDataFrame(ends, "bucket int, end_id long, end_tie long")
    tails = rows.drop("bucket").join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("end_id")) & (F.col("tie") == F.col("end_tie")))
    both = rows.withColumn("tail", F.lit(False)).unionByName(tails.select("doc_id", "text", "tie", "bucket", F.lit(True).alias("tail")))
    both = both.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.desc_nulls_last("doc_id"), F.desc("tie"))
    return both.select("bucket", "tail", "doc_id", "text").mapInArrow(tidy(_run), SCHEMA)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    waits = None  # the document that waits for its next: bucket, doc_id, text, digest
    for batch in batches:
        found: list[tuple] = []
        for bucket, tail, d, t in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if waits and waits[0] != bucket:
                raise AssertionError("a range has no end")
            if tail and not waits:
                continue  # a repeated end row
            now = digest(t.encode())
            if waits:
                e = edited(waits[2], t).encode()
                changed = digest(e)
                found.append((waits[1], len(waits[2]), hashlib.sha256(e).hexdigest(), encoded(waits[3]), encoded(changed), likeness(waits[3], changed), likeness(waits[3], now)))
            waits = None if tail else (bucket, d, t, now)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, p) for c, p in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2), strict=True)], names)
