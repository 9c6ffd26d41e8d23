"""Small tables and plain versions that the operators are held against."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lower(text):
    return (text or "").translate(_LOWER)


def words(text):
    return WORD.findall(lower(text))


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(["Alpha", "beta", "gämma", "delta,", "eps.", "zeta", "eta\n", "theta", "iota", "kappa", "λ", "mu", "nu", "xi", "omicron", "42"]) + r.choice(["", "", "x", "ry", "z"]) for _ in range(n))


#: Nulls, an empty text, a very long one, ties and repeated rows.
EDGES = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "null id here " * 20), (4, " \n\t "), (5, "word " * 30_000), (6, "a" * 5000), (6, "other text, same id"), (7, "<|endoftext|> 漢字 \U0001f600 é İ")]


def edge_table(spark):
    """EDGES with columns whose names clash with those the operators make."""
    return spark.createDataFrame([(d, t, "s", None, 1, "k") for d, t in EDGES], "doc_id long, text string, source string, lang string, row int, key string").repartition(3)


def empty_table(spark):
    return edge_table(spark).limit(0)
