from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from garnetflow.sources import artifacts, bigjson, feeds


@pytest.fixture
def small_splits(spark):
    """Splits of 150 bytes, so that elements, strings and keys lie across many."""
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1", "spark.sql.shuffle.partitions": "4"}
    was = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def text(r):
    return "".join(r.choice(["a", "é", "}", "{", '"', "\\", "]", "[", ":", ",", "\n", "漢", " ", '\\"}']) for _ in range(r.randrange(12)))


def value(r, deep=3):
    kind = r.randrange(6 if deep else 3)
    if kind < 3:
        return [text(r), r.randrange(1000), None][kind]
    if kind == 3:
        return [value(r, deep - 1) for _ in range(r.randrange(4))]
    return thing(r, deep - 1)


def thing(r, deep=2):
    return {f"k{k}": value(r, deep) for k in range(r.randrange(5))}


def dumped(r, doc):
    return json.dumps(doc, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1, 4]))


def read(spark, path, under=None):
    return sorted((x["key"] or "", json.dumps(json.loads(x["value"]), sort_keys=True)) for x in bigjson.elements(spark, str(path), under).collect())


def want(pairs):
    return sorted((k, json.dumps(v, sort_keys=True)) for k, v in pairs)


@pytest.mark.parametrize("seed", range(3))
def test_elements_are_those_of_the_parser(spark, tmp_path, small_splits, seed):
    r = random.Random(seed)
    items = [thing(r) for _ in range(40)]
    listed = [x if r.random() < 0.9 else r.choice([1, "}", None, [{"no": 1}], [[]]]) for x in items]
    keyed = {f"{'a b' if k % 3 else chr(92) + chr(34)}{k}": x for k, x in enumerate(listed)}
    objects = [("", x) for x in listed if isinstance(x, dict)]
    by_key = [(k, x) for k, x in keyed.items() if isinstance(x, dict)]
    (tmp_path / "list.json").write_text(dumped(r, listed))
    (tmp_path / "keyed.json").write_text(dumped(r, keyed))
    around = {"n": 1, "meta": {"items": {"x": {}}, "y": [{"z": 1}]}}
    (tmp_path / "under.json").write_text(dumped(r, {**around, "items": listed, "after": {"items": [{"q": "}"}]}, "more": [{"w": 1}, {"v": {}}]}))
    (tmp_path / "under_keyed.json").write_text(dumped(r, {"other": [{"a": 1}], "items": keyed, "last": {"b": {"c": 2}}}))
    assert bigjson._pieces(spark, str(tmp_path / "list.json")).rdd.getNumPartitions() > 10
    assert read(spark, tmp_path / "list.json") == want(objects)
    assert read(spark, tmp_path / "keyed.json") == want(by_key)
    assert read(spark, tmp_path / "under.json", "items") == want(objects)
    assert read(spark, tmp_path / "under_keyed.json", "items") == want(by_key)


def test_many_files_and_small_ones(spark, tmp_path, small_splits):
    r = random.Random(9)
    docs = [[thing(r) for _ in range(n)] for n in (0, 1, 30, 2)]
    for k, d in enumerate(docs):
        (tmp_path / f"{k}.json").write_text(dumped(r, d))
    (tmp_path / "empty.json").write_text("")
    assert read(spark, tmp_path) == want(("", x) for d in docs for x in d)
    (tmp_path / "one").mkdir()
    (tmp_path / "one/o.json").write_text("{}")
    assert read(spark, tmp_path / "one") == [] and read(spark, tmp_path / "one", "items") == []


def test_readers_give_what_whole_files_gave(spark, tmp_path, small_splits):
    cves = [{"cve": {"id": f"CVE-{k}", "published": "2024", "descriptions": [{"lang": "en", "value": f"text {{{k}}} \"q\""}], "weaknesses": None}} for k in range(60)]
    (tmp_path / "nvd.json").write_text(json.dumps({"resultsPerPage": 60, "vulnerabilities": cves, "x": {"y": {}}}))
    got = feeds.nvd(spark, str(tmp_path / "nvd.json"))
    whole = feeds._json(spark, str(tmp_path / "nvd.json"), feeds.schemas.NVD_FEED).select(F.explode("vulnerabilities").alias("v")).select("v.cve")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())) and got.schema == whole.schema
    plan = got.select("cve.id")._jdf.queryExecution().optimizedPlan().toString()
    assert "descriptions" not in plan.split("from_json")[0]
    nodes = {str(k): {"name": f"n{k}", "platforms": ["Linux"]} for k in range(40)}
    (tmp_path / "k.json").write_text(json.dumps(nodes))
    rows = {x["id"]: x["name"] for x in artifacts.keyed(spark, str(tmp_path / "k.json"), "struct<name: string, platforms: array<string>>").collect()}
    assert rows == {k: v["name"] for k, v in nodes.items()}
    train = [{"cve_id": f"CVE-{k}", "description": "d}", "cwes": ["79"], "attack_vectors": None, "published_date": "2024"} for k in range(40)]
    (tmp_path / "t.json").write_text(json.dumps(train))
    assert {x["cve_id"] for x in artifacts.training(spark, str(tmp_path / "t.json")).collect()} == {x["cve_id"] for x in train}
