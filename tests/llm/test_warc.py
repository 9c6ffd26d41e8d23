from __future__ import annotations

import gzip
import re
from pathlib import Path

import pytest
from helpers import digest
from pyspark.sql import functions as F

from garnetflow.llm import warc as op

LONG, SHORT = "<p>" + "é" * 100 + "</p>", "<p>x</p>"
PAGES = [(5, "http://a/ b\r\nX: y", LONG), (2, "http://b/", LONG), (9, None, LONG), (1, "u", SHORT), (3, "u", SHORT), (4, "u", None), (7, "u", ""), (None, "n", LONG), (8, "big", "z" * 300_000 + "\r\n\r\nWARC/1.1\r\n")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)


def test_round_trip(pages):
    got = {r["page_id"]: tuple(r)[1:] for r in op.archive(pages).collect()}
    for d, _, html in PAGES:
        data = (html or "").encode()
        again = html == LONG and d != 2  # also the one without an id
        assert got[d] == (len(data), digest(data), "revisit" if again else "response", 2 if again else None)


@pytest.mark.parametrize("level", [0, 4])
def test_payloads_and_predicates(spark, pages, tmp_path, level):
    op.register(spark)
    path = str(tmp_path / "w")
    op.records_of(pages).write.format("warc").mode("append").option("level", level).option("max_mb", 0.01).save(path)
    rows = spark.read.format("warc").load(path)
    html = {d: (h or "").encode() for d, _, h in PAGES}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in rows.where("record_type = 'response'").collect())
    some = spark.read.format("warc").option("payload", "none").load(path).where("record_type = 'revisit' and page_id >= 6")
    assert [r["page_id"] for r in some.collect()] == [9]
    assert "Filter" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert rows.where("target_uri = 'http://a/%20b%0D%0AX:%20y'").count() == 1
    assert rows.where("http_status = 200 and payload_bytes > 1000").count() == 1
    if level:  # any gzip reader can read the members
        data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("*.warc.gz"))
        assert len(re.findall(rb"(?:\A|\r\n\r\n)WARC/1\.1\r\nWARC-Type", data)) == len(PAGES)


def test_members_without_lengths(spark, tmp_path):
    records = [op.record_of(k, f"u{k}", b"p" * k, digest(b"p" * k), k, "response", None) for k in (1, 200_000, 3)]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    op.register(spark)
    rows = spark.read.format("warc").option("payload", "none").load(str(tmp_path)).where(F.col("page_id").isin(1, 3))
    assert sorted(r["payload_bytes"] for r in rows.collect()) == [1, 3]


def test_damage_is_told(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(op.record_of(1, "u", b"data", digest(b"other"), 4, "response", None))
    op.register(spark)
    with pytest.raises(Exception, match="differs from its digest"):
        spark.read.format("warc").load(str(tmp_path)).collect()


def test_empty(pages):
    assert op.archive(pages.limit(0)).count() == 0


def test_other_columns_and_many_equal_pages(spark, tmp_path):
    """Columns named like a record's own change nothing; null ids revisit, and half of all pages are equal."""
    same = "equal " * 40
    rows = [(k, "u", same if k % 2 else f"page {k} " * 30) for k in range(1, 41)] + [(None, "u", same), (None, "u", same), (50, "u", None), (51, "u", ""), (52, "u", "short"), (53, "u", "short")]
    df = spark.createDataFrame([(*r, "f", 7, "d", 9) for r in rows], "page_id long, url string, html string, file string, offset long, first string, payload_digest int").repartition(3)
    got = [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in op.archive(df, str(tmp_path / "w")).collect()]
    want = [(d, *(("revisit", 1) if h == same and d != 1 else ("response", None)), len((h or "").encode())) for d, _, h in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
