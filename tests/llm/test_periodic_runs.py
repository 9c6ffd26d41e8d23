from __future__ import annotations

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from garnetflow.llm import periodic_runs as R
from helpers import SPACED, digest, edge_table, empty_table


def plain_runs(w, exponent=4, least=6):
    """Every maximal stretch for every period, kept if no smaller period holds it."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= 2 * q and (i, j + q) not in found:
                found[i, j + q] = q
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, exponent * q))


def plain_row(d, text):
    w = [] if text is None else [x.encode() for x in SPACED.findall(text)]
    n, h = len(w), zlib.crc32(str(d).encode()) if d is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (d, n, len(found), *row, digest("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()), digest(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def random_words(r, letters, n):
    """Words with repeated stretches of many periods, some inside others."""
    w = [r.randrange(letters) for _ in range(n)]
    for _ in range(r.randrange(4)):
        i, q, k = r.randrange(n + 1), r.randrange(1, 7), r.randrange(2, 9)
        w[i:i] = (w[i : i + q] * k)[: q * k - r.randrange(q)]
    return w


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_many_documents_match_the_plain_version(seed):
    r = random.Random(seed)
    docs = [random_words(r, r.choice([1, 2, 3, 8]), r.randrange(60)) for _ in range(300)]
    sizes = np.array([len(w) for w in docs])
    found = list(zip(*(x.tolist() for x in R.runs(np.array(sum(docs, [])), sizes)), strict=True))
    want = [(s + b, k, q) for w, b in zip(docs, (np.cumsum(sizes) - sizes).tolist(), strict=True) for s, k, q in plain_runs(w)]
    assert found == want and len(want) > 50


def test_other_exponents_and_the_whole_of_one_document():
    r = random.Random(9)
    for w in (random_words(r, 2, 400), [0] * 500, list(range(300)), ([1, 2, 3] * 80 + [0]) * 3):
        found = list(zip(*(x.tolist() for x in R.runs(np.array(w), np.array([len(w)]), 3, 3)), strict=True))
        assert found == plain_runs(w, 3, 3)


def test_suffix_ranks_and_next_smaller_values():
    r = random.Random(3)
    docs = [[r.randrange(2) for _ in range(r.randrange(1, 90))] for _ in range(40)] + [list(range(200, 0, -1)), list(range(200)), [0, *range(300, 0, -1)]]
    sizes = np.array([len(w) for w in docs])
    doc = np.repeat(np.arange(len(docs)), sizes)
    end = np.cumsum(sizes)[doc]
    rank = R.inverse_suffix_array(np.array(sum(docs, [])), doc, end)
    at = 0
    for w in docs:
        order = sorted(range(len(w)), key=lambda i: w[i:])
        assert np.argsort(rank[at : at + len(w)]).tolist() == order
        at += len(w)
    for values in (rank, -rank):
        to = R.next_smaller(values, end)
        for i in range(len(values)):
            assert to[i] == next((j for j in range(i + 1, end[i]) if values[j] < values[i]), end[i])


def test_rows_match_the_plain_version_with_planted_periods(spark):
    r = random.Random(1)
    texts = [(d, " ".join(f"w{x}" for x in random_words(r, r.choice([2, 30, 900]), r.randrange(1, 120)))) for d in range(400)]
    texts += [(1000, "one\x1ctwo\x85three " * 8), (1001, "a b a b\t\x0b\x0c\r\n" * 5), (1002, "ha " * 6), (1003, "ha " * 5)]
    rows = R.word_runs(spark.createDataFrame(texts, "doc_id long, text string"), plant=True).collect()
    assert sorted(map(tuple, rows)) == [plain_row(d, t) for d, t in texts]
    assert sum(x["n_runs"] > 0 and zlib.crc32(str(x["doc_id"]).encode()) % 10 == 0 for x in rows) > 20


def test_edge_cases(spark):
    rows = R.word_runs(edge_table(spark), plant=True).collect()
    key = lambda x: tuple((v is not None, v) for v in x)
    small = [(x["doc_id"], x["text"]) for x in edge_table(spark).collect() if len(x["text"] or "") < 10_000]
    assert sorted([tuple(x) for x in rows if x["doc_id"] != 5], key=key) == sorted([plain_row(d, t) for d, t in small], key=key)
    long_one = next(x for x in rows if x["doc_id"] == 5)
    assert long_one["n_words"] == 30_000 and long_one["n_runs"] == 1 and (long_one["start"], long_one["length"], long_one["period"]) == (0, 30_000, 1)
    assert R.word_runs(empty_table(spark)).count() == 0
