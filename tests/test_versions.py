from __future__ import annotations

import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from garnetflow import streaming
from garnetflow.operators import embedding
from garnetflow.sources import schemas, versions

SCHEMA = "id string, v long, text string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def held(df):
    return sorted(map(tuple, df.collect()))


def test_upserts_match_a_dictionary(spark, tmp_path):
    """Later revisions win, older ones lose, repeated batches do nothing, rows without a key go."""
    r, t, want = random.Random(1), versions.Table(spark, str(tmp_path / "t")), {}
    for number in range(5):
        batch = [(f"k{r.randrange(40)}", r.randrange(30), f"t{number}.{k}") for k in range(25)]
        for k, v, x in sorted(batch, key=lambda b: b[1]):
            if k not in want or v >= want[k][0]:
                want[k] = v, x
        batch = list({(k, v): (k, v, x) for k, v, x in sorted(batch, key=lambda b: b[1])}.values())
        for _ in range(2):
            t.upsert(rows(spark, *batch, (None, 1, "no key")), "id", ["v"], buckets=7, batch=("s", number))
        got = {k: v for k, v, _ in held(t.read())}
        assert got == {k: v for k, (v, _) in want.items()} and t.read().count() == len(want)
    assert t.versions() == [1, 2, 3, 4, 5]


def test_only_touched_buckets_are_written_and_readers_stay(spark, tmp_path):
    t = versions.Table(spark, str(tmp_path / "t"))
    t.upsert(rows(spark, *[(f"k{k}", 1, "a") for k in range(200)]), "id", ["v"], buckets=16)
    reader, before = t.read(), t.manifest()["parts"]
    t.upsert(rows(spark, ("k3", 2, "b"), ("new", 1, "c")), "id", ["v"])
    after = t.manifest()["parts"]
    assert 1 <= sum(before.get(k) != v for k, v in after.items()) <= 2 and before.keys() <= after.keys()
    assert reader.count() == 200 and reader.where("v = 2").count() == 0  # pinned
    assert t.read().count() == 201 and t.read(1).count() == 200
    assert held(t.read().where("id = 'k3'")) == [("k3", 2, "b")]
    t.upsert(rows(spark).limit(0), "id", ["v"])
    assert t.read().count() == 201 and t.vacuum(keep=1) >= 1
    assert t.versions() == [3] and t.read().count() == 201
    with pytest.raises(ValueError, match="columns"):
        t.upsert(rows(spark).select("id"), "id", ["id"])


def test_a_version_may_be_made_of_the_last(spark, tmp_path):
    t = versions.Table(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.replace(rows(spark, ("a", 1, "x")))
    old = t.read()
    t.replace(old.withColumn("v", F.col("v") + 1))
    assert held(old) == [("a", 1, "x")] and held(t.read()) == [("a", 2, "x")]
    with pytest.raises(ValueError, match="buckets"):
        t.upsert(rows(spark), "id", ["v"])


@pytest.mark.parametrize("step", ["write", "commit", "after"])
def test_a_crash_leaves_the_old_version_whole(spark, tmp_path, monkeypatch, step):
    t = versions.Table(spark, str(tmp_path / "t"))
    t.upsert(rows(spark, ("a", 1, "x"), ("b", 1, "y")), "id", ["v"], batch=("s", 0))
    if step == "write":
        bad = rows(spark, ("a", 2, "z")).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    else:
        bad = rows(spark, ("a", 2, "z"))
        keep = versions.Table._commit
        monkeypatch.setattr(versions.Table, "_commit", (lambda self, m: 1 / 0) if step == "commit" else lambda self, m: keep(self, m) and 1 / 0)
    with pytest.raises(Exception, match="lost|division"):
        t.upsert(bad, "id", ["v"], batch=("s", 1))
    monkeypatch.undo()
    done = step == "after"  # the version was committed, only the tidying is missing
    assert held(t.read()) == ([("a", 2, "z"), ("b", 1, "y")] if done else [("a", 1, "x"), ("b", 1, "y")])
    t.upsert(rows(spark, ("a", 2, "z")), "id", ["v"], batch=("s", 1))  # the stream sends it again
    assert held(t.read()) == [("a", 2, "z"), ("b", 1, "y")] and len(t.versions()) == 2
    t.vacuum(keep=1)
    assert held(t.read()) == [("a", 2, "z"), ("b", 1, "y")]


def test_of_two_writers_one_is_told(spark, tmp_path):
    t = versions.Table(spark, str(tmp_path / "t"))
    t.replace(rows(spark, ("a", 1, "x")))
    m = t.manifest()
    t.replace(rows(spark, ("b", 1, "x")))
    with pytest.raises(versions.Conflict):
        t._commit(m | {"version": 2})
    assert held(t.read()) == [("b", 1, "x")]


def feed(*items):
    cve = lambda i, modified, text, cwe="CWE-79": {"cve": {"id": i, "published": "2024-01-01", "lastModified": modified, "descriptions": [{"lang": "en", "value": text}], "weaknesses": [{"description": [{"lang": "en", "value": cwe}]}]}}
    return json.dumps({"vulnerabilities": [cve(*i) for i in items]})


def test_a_later_revision_arrives_and_an_earlier_one_does_not(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = (spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    table = versions.Table(spark, args[2])
    texts = lambda: {r["cve_id"]: r["description"] for r in table.read().collect()}
    (tmp_path / "in/1.json").write_text(feed(("CVE-1", "2024-02", "first"), ("CVE-2", "2024-02", "other")))
    streaming.ingest(*args).awaitTermination(120)
    assert texts() == {"CVE-1": "first", "CVE-2": "other"}
    (tmp_path / "in/2.json").write_text(feed(("CVE-1", "2024-05", "revised"), ("CVE-2", "2024-01", "stale"), ("CVE-3", "2024-01", "new"), ("CVE-4", "2024-01", "unmapped", "CWE-0")))
    streaming.ingest(*args).awaitTermination(120)
    assert texts() == {"CVE-1": "revised", "CVE-2": "other", "CVE-3": "new"}
    n = len(table.versions())
    streaming.ingest(*args).awaitTermination(120)
    assert len(table.versions()) == n


META = "struct<name: string, published: string, cvss: double, severity: string, likelihood: string>"


def test_export_as_a_stream(spark, tmp_path):
    """One file a batch; the second batch is killed before it is in its place, and the stream goes on where it was."""
    source, out = str(tmp_path / "rows"), str(tmp_path / "out")
    data = [(f"i{k}", "CVE", f"text {k}" if k % 5 else "bad", None) for k in range(20)] + [("", "CVE", "x", None), ("e", "CVE", "", None)]
    schema = f"id string, type string, text string, metadata {META}"
    spark.createDataFrame(data, schema).repartition(4).write.parquet(source)
    seen = []

    def embed(df):
        seen.append(df.count())
        if len(seen) == 2:
            raise RuntimeError("killed")
        return df.withColumn("embedding", F.when(F.col("text") == "bad", F.array(F.lit(float("nan")))).otherwise(F.array(F.length("text").cast("double"))))

    run = lambda: streaming.export_stream(spark, source, schema, out, embed, str(tmp_path / "check"), files=1).awaitTermination(120)
    with pytest.raises(Exception, match="killed"):
        run()
    one = streaming.exported(spark, out).count()
    run()
    run()
    got = streaming.exported(spark, out).collect()
    assert 0 < one < len(got) == 16 and {r["id"] for r in got} == {f"i{k}" for k in range(20) if k % 5}
    assert sorted(r["id"] for r in streaming.rejected(spark, out).collect()) == ["i0", "i10", "i15", "i5"]
    assert sum(seen) - seen[1] == 20 and len(seen) == 5  # no row is read for two batches


def test_answers_are_validated():
    good = [0.1, 2.0]
    assert embedding.problem(good, 2) is None and embedding.problem(good, None) is None
    assert [embedding.problem(x, 2) for x in (None, [], [1.0], [1.0, math.nan], [math.inf, 1.0], [0.0, 0.0], ["a", 1.0])] == ["empty", "empty", "1 numbers", "not a number", "not a number", "zero", "not a number"]


def test_a_pace_keeps_calls_apart():
    now, slept = [0.0], []
    p = embedding.Pace(4.0, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for late in (0.0, 0.1, 0.0, 5.0, 0.0):
        now[0] += late
        p.wait()
    assert [round(s, 6) for s in slept] == [0.15, 0.25, 0.25]


def test_the_limit_holds_over_four_tasks_and_failures_are_kept_apart(spark):
    def call(text):
        if text == "fails":
            raise OSError("no answer")
        return [1.0, math.nan] if text == "nan" else [time.time(), 1.0]

    texts = ["ok"] * 40 + ["fails", "nan", "", None]
    df = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "id string, text string")
    got = embedding.service(call, per_second=20.0, tasks=4, size=2, tries=2, wait=0.01)(df).collect()
    stamps = sorted(r["embedding"][0] for r in got if r["embedding"])
    assert len(stamps) == 40
    for t in stamps:
        assert sum(t <= u < t + 1 for u in stamps) <= 20 + 4  # one call of each task may stand at either end of a second
    assert {r["text"]: r["problem"] for r in got if not r["embedding"]} == {"fails": "OSError: no answer", "nan": "not a number", "": "no text", None: "no text"}
