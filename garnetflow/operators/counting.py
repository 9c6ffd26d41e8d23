"""Counts of words by label, added up where the texts lie: what leaves a task is a row for each label and word of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import importable


def word_counts(rows: DataFrame) -> DataFrame:
    """rows(label, words) to label, word, cnt (occurrences) and rows (how many rows hold it).

    The words go to Python as they are and not through explode(), whose filter on empty lists would find all words of a text again.
    """
    importable(rows.sparkSession)
    schema = T.StructType([rows.schema["label"], T.StructField("word", T.StringType()), T.StructField("cnt", T.LongType()), T.StructField("rows", T.LongType())])
    counted = rows.select("label", "words").mapInArrow(_counts, schema)
    return counted.groupBy("label", "word").agg(F.sum("cnt").alias("cnt"), F.sum("rows").alias("rows"))


def sizes(words: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, labels = batch["words"], batch["label"].dictionary_encode(null_encoding="encode")
        coded = words.flatten().dictionary_encode(null_encoding="encode")
        n = max(1, len(coded.dictionary))
        places = np.repeat(np.arange(len(words)), sizes(words))
        keys, times = np.unique(places * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        of = labels.indices.to_numpy(zero_copy_only=False).astype(np.int64)[keys // n]
        pairs, at = np.unique(of * n + keys % n, return_inverse=True)
        cnt = np.bincount(at, weights=times, minlength=len(pairs)).astype(np.int64)
        columns = [labels.dictionary.take(pa.array(pairs // n)), coded.dictionary.take(pa.array(pairs % n)), pa.array(cnt), pa.array(np.bincount(at, minlength=len(pairs)))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "word", "cnt", "rows"])
