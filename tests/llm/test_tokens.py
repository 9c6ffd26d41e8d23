"""Token files, the words' encoder, fingerprints and rollups."""

from __future__ import annotations

import io
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import EDGES, digest, edge_table, empty_table, prose
from pyspark.sql import functions as F

from garnetflow.llm import fingerprint, token_binary, token_rollup
from garnetflow.llm.subwords import Words

ENCODERS = {n: Words(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name", ENCODERS)
def test_words_encode_as_the_library_does(name):
    w, r = ENCODERS[name], random.Random(1)
    alphabet = "abcXYZ'  \t\n\xa0.,!?0129éÉßÀ½²İſǅΣσ’ \x1c\x85<|endoftext|>漢"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(1500)] + ["it's We'Ll don't I'M", "", "   ", "a  b", "\n\n x", " a", "a ", "a\n", "x\ty", prose(1, 400)]
    for t in texts + [t for _, t in EDGES if t and len(t) < 6000]:
        ids = w.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(w.encode(t), "<u4").tolist() == ids and w.count(t) == len(ids), t


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids):
    a = np.array(ids, np.uint32)
    data, n_words, n_away = token_binary.encode_block(a)
    assert token_binary.decode_block(data, len(a), n_words, n_away).tolist() == ids
    assert token_binary.unpack(token_binary.pack(a), len(a)).tolist() == ids


def test_file_round_trip():
    r = np.random.default_rng(3)
    docs = [(k if k else None, r.integers(0, 50_257, n).astype(np.uint32)) for k, n in enumerate([3, 0, 1, 40_000, 17, 300_000, 5])]
    sink = io.BytesIO()
    sink.close, close = lambda: None, sink.close
    w = token_binary.Writer(sink)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    data = sink.getvalue()
    got = list(token_binary.read_file(io.BytesIO(data), len(data)))
    assert [d for d, _ in got] == [d for d, _ in docs] and all((a == b).all() for (_, a), (_, b) in zip(got, docs, strict=True))
    assert len(data) < 8 / 3 * sum(len(i) for _, i in docs)  # ids of 16 bits: three to a word at least
    with pytest.raises(ValueError, match="cut short"):
        list(token_binary.read_file(io.BytesIO(data[:-1]), len(data) - 1))
    close()


def test_token_files(spark):
    rows = [(50 - k, prose(k, 5 * k % 300)) for k in range(50)] + [(200, None), (201, "")]
    got = token_binary.token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).orderBy("doc_id").collect()
    start = 0
    for r, (d, t) in zip(got, sorted(rows), strict=True):
        ids = ENCODERS["byte_bpe_50k.json"].tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    edges = edge_table(spark)
    got = token_binary.token_files(edges).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in EDGES), key=lambda d: (d is not None, d))
    assert token_binary.token_files(empty_table(spark)).count() == 0


def test_fingerprints(spark):
    rows = [(k, prose(k, 20 + 13 * k % 400)) for k in range(60)] + [(100, rows_text := prose(3, 59)), (101, rows_text), (102, ""), (103, None)]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    order = sorted(rows, reverse=True)
    for k, (d, t) in enumerate(order):
        t, following, r = t or "", order[(k + 1) % len(order)][1] or "", got[d]
        e = fingerprint.edited(t, following)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), digest(e.encode()))
        mine, theirs, changed = (fingerprint.digest(x.encode()) for x in (t, following, e))
        assert fingerprint.decoded(r["fingerprint"])[0] == mine[0] and r["fingerprint"] == fingerprint.encoded(mine) and r["edited_fingerprint"] == fingerprint.encoded(changed)
        assert r["near_edited"] == fingerprint.likeness(mine, changed) and r["near_next"] == fingerprint.likeness(mine, theirs)
    assert got[100]["fingerprint"] == got[101]["fingerprint"] and got[101]["near_next"] == 1.0
    long = [r for r in got.values() if r["n_chars"] > 600]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)


def plain_fingerprint(data: bytes) -> tuple[int, list[int]]:
    """The length code and the digits, one byte triplet at a time, without the module's arithmetic."""
    counts = [0] * 256
    for k, (p, q) in enumerate(((4, 9), (7, 13))):
        for i in range(len(data) - q):
            x = (data[i] * 0x9E3779B1 ^ data[i + p] * 0x85EBCA6B ^ data[i + q] * 0xC2B2AE35) & 0xFFFFFFFF
            x = x + 1 + 7919 * k & 0xFFFFFFFF
            x = (x ^ x >> 15) * 0x2C1B3C6D & 0xFFFFFFFF
            counts[x >> 13 & 255] += 1
    ranked = sorted(counts)
    cuts = ranked[63], ranked[127], ranked[191]
    return round(math.log(1 + len(data)) / math.log(1.1)), [sum(c > cut for cut in cuts) for c in counts]


def plain_likeness(a, b) -> float:
    apart = [abs(x - y) for x, y in zip(a[1], b[1], strict=True)]
    return 1 - min(384, sum(apart) + 3 * apart.count(3) + 8 * max(0, abs(a[0] - b[0]) - 5)) / 384


def test_fingerprints_against_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 6000 or text is null")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    assert sorted(got) == sorted(texts)
    shown = lambda d: f"{d[0]:03x}" + bytes(d[1][k] << 6 | d[1][k + 1] << 4 | d[1][k + 2] << 2 | d[1][k + 3] for k in range(0, 256, 4)).hex()
    plain = {d: plain_fingerprint(t.encode()) for d, t in texts.items()}
    for k, d in enumerate(order):
        t, following = texts[d], texts[order[(k + 1) % len(order)]]
        cut = len(t) // 3
        e = (t[: len(t) - cut] + following[:cut]).encode()
        changed, r = plain_fingerprint(e), got[d]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), digest(e), shown(plain[d]), shown(changed))
        assert abs(r["near_edited"] - plain_likeness(plain[d], changed)) < 1e-12 and abs(r["near_next"] - plain_likeness(plain[d], plain[order[(k + 1) % len(order)]])) < 1e-12


def test_edits_match_sql(spark):
    """n_chars and edited_sha256, which SQL can say, over a whole table."""
    import duckdb

    sql = """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM '/root/testdata/sf0.01/documents.parquet'),
    n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS f FROM d)
    SELECT doc_id, length(t) AS n_chars, sha256(left(t, length(t) - length(t) // 3) || left(f, length(t) // 3)) AS edited_sha256 FROM n"""
    rows = fingerprint.fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, rows)) == sorted(duckdb.sql(sql).fetchall())


def test_fingerprint_edges(spark):
    edges = edge_table(spark)
    assert fingerprint.fingerprints(edges).count() == edges.count()
    assert fingerprint.fingerprints(empty_table(spark)).count() == 0
    one = fingerprint.fingerprints(edges.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_rollup(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    docs = spark.createDataFrame([("a", "en", 5, 7), ("a", "en", 3, 3), (None, "fr", 2, 1)], "source string, lang string, n long, m long")
    state = lambda: sorted((tuple(r) for r in rollup.totals().collect()), key=str)
    assert rollup.commit("1", token_rollup.signed(docs, "v1", "n", 1)) and not rollup.commit("1", token_rollup.signed(docs, "v1", "n", 1))
    assert state() == [("a", "en", "v1", 2, 8), (None, "fr", "v1", 1, 2)]
    assert rollup.commit("2", token_rollup.revised(docs, "v1", "n", "m"))
    assert state() == [("a", "en", "v1", 2, 10), (None, "fr", "v1", 1, 1)]
    rollup.compact()
    assert not rollup.commit("2", token_rollup.signed(docs, "v1", "n", 1))
    assert rollup.commit("3", token_rollup.signed(docs.where("source is null"), "v1", "m", -1)) and rollup.commit("4", docs.limit(0).select("source", "lang", F.lit("v").alias("tokenizer"), F.lit(1).alias("n_docs"), F.lit(1).alias("n_tokens")))
    assert state() == [("a", "en", "v1", 2, 10)]
    rollup.compact()
    rollup.compact()
    assert state() == [("a", "en", "v1", 2, 10)] and not rollup.commit("1", docs)
    with pytest.raises(ValueError, match="cannot name"):
        rollup.commit("../x", docs)


def test_batches_that_come_during_a_compaction(spark, tmp_path, monkeypatch):
    """A batch committed between the listing and the sum counts once; so do batches of a compaction that broke off."""
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    docs = spark.createDataFrame([("a", "en", 5)], "source string, lang string, n long")
    add = lambda name: rollup.commit(name, token_rollup.signed(docs, "v1", "n", 1))
    total = lambda: [tuple(r)[3:] for r in rollup.totals().collect()]
    assert add("1")
    sums = rollup.totals
    with monkeypatch.context() as m:
        m.setattr(rollup, "totals", lambda listed: (add("2"), sums(listed))[1])
        rollup.compact()
    assert total() == [(2, 10)] and not add("1") and not add("2")
    rollup.compact()
    assert total() == [(2, 10)] and not add("2") and add("3")
    with monkeypatch.context() as m:  # the driver dies after the base is published
        m.setattr(rollup, "_publish", lambda rows, name, put=rollup._publish: put(rows, name) and False)
        rollup.compact()
    assert total() == [(3, 15)] and not add("3")
    rollup.compact()
    assert total() == [(3, 15)]


def test_two_writers_of_a_batch(spark, tmp_path):
    docs = spark.createDataFrame([("a", "en", 5)], "source string, lang string, n long")
    one, two = (token_rollup.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    delta = token_rollup.summed(token_rollup.signed(docs, "v1", "n", 1))
    assert one._publish(delta, "batch-1") and not two._publish(delta, "batch-1")  # both had found the id free
    assert [tuple(r)[3:] for r in two.totals().collect()] == [(1, 5)]


def test_rollup_counts_as_the_library_does(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in token_rollup.maintained(docs).collect()}
    first: dict[str, tuple] = {}
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", (r["source"], r["lang"]))
    want: dict[tuple, list[int]] = {}
    for name, w in ENCODERS.items():
        version = name.removesuffix(".json")
        for text, key in first.items():
            n = want.setdefault((*key, version), [0, 0])
            n[0] += 1
            n[1] += len(w.tokenizer.encode(text, add_special_tokens=False).ids) + (version == "byte_bpe_50k")
    assert got == {k: tuple(v) for k, v in want.items()}


def test_sums_match_sql(spark, tmp_path):
    """The additive part: signed batches against one sum by SQL."""
    import duckdb

    events = duckdb.sql("SELECT 's' || (event_id % 5) AS source, 'l' || (event_id % 3) AS lang, event_id % 97 AS n, event_id % 89 AS m, event_id % 4 AS part FROM '/root/testdata/sf0.001/events.parquet'").df()
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    for part in range(4):
        rows = spark.createDataFrame(events[events["part"] == part])
        assert rollup.commit(f"in-{part}", token_rollup.signed(rows, "v", "n", 1))
        assert rollup.commit(f"change-{part}", token_rollup.revised(rows.where("n > 50"), "v", "n", "m"))
        if part == 1:
            rollup.compact()
    assert rollup.commit("out", token_rollup.signed(spark.createDataFrame(events[events["part"] == 2]).where("n <= 50"), "v", "n", -1))
    want = duckdb.sql("SELECT source, lang, 'v' AS tokenizer, count(*) AS n_docs, sum(CASE WHEN n > 50 THEN m ELSE n END)::BIGINT AS n_tokens FROM events WHERE NOT (part = 2 AND n <= 50) GROUP BY source, lang").fetchall()
    assert sorted(map(tuple, rollup.totals().collect())) == sorted(want)


def test_rollup_edges(spark):
    assert token_rollup.maintained(empty_table(spark)).count() == 0
    rows = {r["tokenizer"]: (r["n_docs"], r["n_tokens"]) for r in token_rollup.maintained(edge_table(spark)).collect()}
    texts = {t or "" for _, t in EDGES}
    count = lambda name: sum(len(ENCODERS[name].tokenizer.encode(t, add_special_tokens=False).ids) for t in texts)
    assert rows == {"byte_bpe_50k": (len(texts), count("byte_bpe_50k.json") + len(texts)), "word_bpe_49k": (len(texts), count("word_bpe_49k.json"))}
