"""Scans, sinks and streams over small files written by the tests."""

from __future__ import annotations

import functools
import gzip
import http.server
import json
import os
import sys
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from garnetflow import cli, streaming
from garnetflow.operators import collect, knowledge
from garnetflow.sources import artifacts, feeds, schemas, versions

CWE = """<?xml version="1.0"?><Weakness_Catalog><Weaknesses>
<Weakness ID="89" Name="SQL Injection" Abstraction="Base"><Description>Bad  query</Description><Extended_Description><p>More</p><p>text</p></Extended_Description>
<Related_Weaknesses><Related_Weakness Nature="ChildOf" CWE_ID="943" View_ID="1000"/><Related_Weakness Nature="ChildOf" CWE_ID="74" View_ID="1003"/></Related_Weaknesses>
<Related_Attack_Patterns><Related_Attack_Pattern CAPEC_ID="66"/></Related_Attack_Patterns></Weakness>
<Weakness ID="943" Name="Query Logic" Abstraction="Class"><Description>Logic</Description></Weakness></Weaknesses></Weakness_Catalog>"""
CAPEC = """<?xml version="1.0"?><Attack_Pattern_Catalog><Attack_Patterns>
<Attack_Pattern ID="66" Name="SQL Injection"><Description>Injects sql</Description><Likelihood_Of_Attack>High</Likelihood_Of_Attack><Typical_Severity>High</Typical_Severity>
<Execution_Flow><Attack_Step><Step>1</Step><Phase>Explore</Phase><Description>Look <b>around</b></Description><Technique>t</Technique></Attack_Step></Execution_Flow>
<Prerequisites><Prerequisite>A database</Prerequisite></Prerequisites><Skills_Required><Skill Level="Low">Some sql</Skill></Skills_Required>
<Consequences><Consequence><Scope>Integrity</Scope><Impact>Modify Data</Impact></Consequence></Consequences>
<Related_Weaknesses><Related_Weakness CWE_ID="89"/></Related_Weaknesses>
<Taxonomy_Mappings><Taxonomy_Mapping Taxonomy_Name="ATTACK"><Entry_ID>1190</Entry_ID><Entry_Name>x</Entry_Name></Taxonomy_Mapping><Taxonomy_Mapping Taxonomy_Name="OWASP"><Entry_ID>7</Entry_ID></Taxonomy_Mapping></Taxonomy_Mappings></Attack_Pattern>
</Attack_Patterns></Attack_Pattern_Catalog>"""


def obj(kind, key, ext=None, **more):
    refs = [{"source_name": "other", "external_id": "z"}] + ([{"source_name": "mitre-attack", "external_id": ext, "url": f"http://{ext}"}] if ext else [])
    return {"type": kind, "id": key, "external_references": refs, **more}


BUNDLES = {
    "enterprise": [obj("attack-pattern", "ap1", "T1190", name="First", x_mitre_platforms=["Linux"], kill_chain_phases=[{"kill_chain_name": "k", "phase_name": "initial"}]), obj("intrusion-set", "g1", "G1", name="Group"), obj("attack-pattern", "none", name="no id"),
                   {"type": "relationship", "id": "r1", "source_ref": "g1", "target_ref": "ap1", "relationship_type": "uses"}, {"type": "relationship", "id": "r2", "source_ref": "g1", "target_ref": "ap2", "relationship_type": "uses"}],
    "mobile": [obj("attack-pattern", "ap2", "T1190", name="Second", x_mitre_platforms=["Android", "Linux"])],
}


def feed(*cves):
    return {"vulnerabilities": [{"cve": {"id": i, "published": "2024-01-01T00:00:00.000", "descriptions": [{"lang": "es", "value": "no"}, *([{"lang": "en", "value": d}] if d else [])], "weaknesses": [{"description": [{"lang": "en", "value": w}]} for w in ws]}} for i, d, ws in cves]}


CVES = [("CVE-0-A", "SQL injection", ["CWE-89", "NVD-CWE-noinfo"]), ("CVE-0-B", None, ["CWE-89"]), ("CVE-0-C", "none", ["NVD-CWE-noinfo"]), ("CVE-0-D", "odd", ["CWE-9999"]), ("CVE-0-E", "script", ["CWE-79", "CWE-79"])]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    home = tmp_path_factory.mktemp("files")
    (home / "cwe.xml").write_text(CWE)
    (home / "capec.xml").write_text(CAPEC)
    for k, v in BUNDLES.items():
        (home / f"{k}.json").write_text(json.dumps({"objects": v}))
    (home / "feeds").mkdir()
    with gzip.open(home / "feeds/2024.json.gz", "wt") as out:
        json.dump(feed(*CVES), out)
    (home / "v11.json").write_text(json.dumps({"CVE_Items": [{"cve": {"CVE_data_meta": {"ID": "CVE-0-Z"}, "problemtype": {"problemtype_data": [{"description": [{"lang": "en", "value": "CWE-22"}]}]}, "description": {"description_data": [{"lang": "en", "value": "old"}]}}, "publishedDate": "2020", "impact": {"baseMetricV3": {"cvssV3": {"baseScore": 7.5}}}}]}))
    return home


def test_weaknesses(spark, files):
    raw = feeds.cwe_xml(spark, str(files / "cwe.xml"))
    rows = {r["id"]: r for r in knowledge.weaknesses(raw).collect()}
    assert rows["89"]["description"] == "Bad query Moretext" and rows["89"]["child_of"] == ["943"] and rows["89"]["related_attack_patterns"] == ["66"]
    tree = {r["id"]: r for r in knowledge.hierarchy(raw).collect()}
    assert tree["89"]["parents"] == ["74", "943"] and tree["943"]["children"] == ["89"] and tree["89"]["attack_vectors"] == ["sql_injection"]


def test_attack_patterns(spark, files):
    (r,) = knowledge.attack_patterns(feeds.capec_xml(spark, str(files / "capec.xml"))).collect()
    assert (r["id"], r["severity"], r["techniques"], r["weaknesses"], r["prerequisites"]) == ("66", "High", ["T1190"], ["89"], ["A database"])
    assert r["execution_flow"][0]["description"] == "Look around" and r["skills"][0]["level"] == "Low" and r["consequences"][0]["scopes"] == ["Integrity"]


def test_stix(spark, files):
    objects = knowledge.stix_objects(feeds.stix(spark, {k: str(files / f"{k}.json") for k in BUNDLES}))
    (t,) = knowledge.techniques(objects).collect()
    assert (t["ext_id"], t["name"], t["x_mitre_platforms"], t["tactics"], t["url"]) == ("T1190", "First", ["Linux", "Android"], ["initial"], "http://T1190")
    edges = knowledge.typed_edges(objects, objects.where("type = 'relationship'").select("domain_ord", "source_ref", "target_ref", "relationship_type"))
    assert [(r["src"], r["dst"]) for r in edges.collect()] == [("G1", "T1190")]  # the other target is in another domain
    out = knowledge.fan_out(edges)
    assert out["group_techniques"].first()["ids"] == ["T1190"] and out["group_techniques_reverse"].first()["ids"] == ["G1"]
    assert knowledge.routed(objects, "intrusion-set").count() == 1


def test_feeds(spark, files):
    rows = collect.training_data(feeds.nvd(spark, str(files / "feeds"))).orderBy("cve_id").collect()
    assert [(r["cve_id"], r["cwes"], r["attack_vectors"]) for r in rows] == [("CVE-0-A", ["89"], ["sql_injection"]), ("CVE-0-E", ["79", "79"], ["xss"])]
    old = collect.training_data(feeds.nvd_any(spark, str(files / "v11.json"))).collect()
    assert [(r["cve_id"], r["attack_vectors"]) for r in old] == [("CVE-0-Z", ["path_traversal"])]
    assert feeds.nvd_v11(spark, str(files / "v11.json")).first()["cve"]["base_score"] == 7.5


def test_epss_and_zip(spark, tmp_path):
    (tmp_path / "epss.json").write_text(json.dumps({"data": [{"cve": "CVE-1", "epss": "0.5", "percentile": "0.9", "date": "2024-01-02", "time-series": [{"epss": "0.4", "percentile": "0.8", "date": "2024-01-01"}, {"epss": "bad", "percentile": "1", "date": "2024-01-02"}]}]}))
    rows = feeds.epss(spark, str(tmp_path / "epss.json")).orderBy("day").collect()
    assert [(r["day"], r["epss"]) for r in rows] == [("2024-01-01", 0.4), ("2024-01-02", None)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/cwec_v4.1.xml", "hi")
    assert open(feeds.unzipped(str(tmp_path / "a.zip"), r"cwec_v\d+\.\d+\.xml", str(tmp_path / "out"))).read() == "hi"
    with pytest.raises(FileNotFoundError):
        feeds.unzipped(str(tmp_path / "a.zip"), "none", str(tmp_path))


def test_artifacts(spark, tmp_path):
    (tmp_path / "rel.json").write_text(json.dumps({"CweToCapec": {"89": ["66", "7"]}, "capec_to_attack": {"66": ["T1"]}}))
    maps = artifacts.relationships(spark, str(tmp_path / "rel.json"))
    assert maps["cwe_to_capec"].count() == 2 and maps["capec_to_attack"].count() == 1 and maps["attack_to_capec"].count() == 0
    node = {"name": "n", "typicalSeverity": "High"}
    for k, doc in enumerate(({"66": node}, [{**node, "capecId": "CAPEC-66"}], {"capecs": [{**node, "id": "66"}]})):
        (tmp_path / f"c{k}.json").write_text(json.dumps(doc))
        (r,) = artifacts.capec(spark, str(tmp_path / f"c{k}.json")).collect()
        assert (r["id"], r["name"], r["typicalSeverity"]) == ("66", "n", "High")
    (tmp_path / "h.json").write_text(json.dumps({"cwes": {"89": {"id": "89", "name": "x", "parents": ["74"], "children": None}}}))
    (r,) = artifacts.cwe_hierarchy(spark, str(tmp_path / "h.json")).collect()
    assert r["parents"] == ["74"] and r["children"] == []
    (tmp_path / "nb.json").write_text(json.dumps({"word_counts": {"x": {"a": 2}}, "total_words": {"x": 2}, "vector_doc_counts": {"x": 1}, "total_documents": 2, "vocabulary": ["a"]}))
    m = artifacts.naive_bayes(spark, str(tmp_path / "nb.json"))
    assert (m.vocabulary, m.documents, m.labels.first()["prior"]) == (1, 2, 0.5)
    assert artifacts.optional(spark, str(tmp_path / "none"), "a int", None).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "id string, n int")
    artifacts.write_json(df, str(tmp_path / "j"), "id")
    text = next((tmp_path / "j").glob("part-*")).read_text()
    assert json.loads(text) == {"a": {"n": 2}, "b": {"n": 1}}
    path = str(tmp_path / "t")
    artifacts.replace_table(df, path)
    artifacts.replace_table(spark.read.parquet(path).withColumn("n", F.col("n") + 1), path)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [2, 3]
    (tmp_path / "t").rename(tmp_path / "t.0.old")  # the driver died between the two renames
    assert artifacts.restored(spark, path) and not artifacts.restored(spark, path) and spark.read.parquet(path).count() == 2
    artifacts.write_metadata(spark, str(tmp_path / "m"), cwe="4.1")
    assert spark.read.json(str(tmp_path / "m")).first()["cwe"] == "4.1"


def test_one_document_grows(spark, tmp_path):
    """Arrays and objects, appended to whatever layout is there; no row at all; a document that is none."""
    path, rows = tmp_path / "d.json", [(f"id {k} \"q\"", k, "é\n}]") for k in range(40)]
    df = spark.createDataFrame(rows, "id string, n int, t string").repartition(5)
    plain = lambda part: [{"id": a, "n": b, "t": c} for a, b, c in part]
    order = lambda found: sorted(found, key=lambda x: x["n"])
    assert artifacts.write_document(df.where("n < 10"), str(path)) == path.stat().st_size
    assert order(json.loads(path.read_text())) == plain(rows[:10])
    artifacts.write_document(df.where("n >= 10 AND n < 20"), str(path), append=True)
    artifacts.write_document(df.where("n < 0"), str(path), append=True)
    assert order(json.loads(path.read_text())) == plain(rows[:20])
    for k, start in enumerate(("[]", "[ ]\n\n", json.dumps(plain(rows[:3])), json.dumps(plain(rows[:3]), indent=2) + " " * 5000)):
        path = tmp_path / f"other{k}.json"  # not the writer's own
        path.write_text(start)
        artifacts.write_document(df.where("n >= 3"), str(path), append=True)
        assert order(json.loads(path.read_text())) == plain(rows[3:] if len(start) < 8 else rows)
    artifacts.write_document(df.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    for part in ("n < 7", "n >= 7"):
        artifacts.write_document(df.where(part), str(tmp_path / "k.json"), "id", append=True)
    assert json.loads((tmp_path / "k.json").read_text()) == {a: {"n": b, "t": c} for a, b, c in rows}
    path = tmp_path / "no_array.json"
    path.write_text('{"a": 1}')
    with pytest.raises(ValueError, match="does not end"):
        artifacts.write_document(df, str(path), append=True)
    assert path.read_text() == '{"a": 1}'


def test_stream_of_feeds(spark, files, tmp_path):
    args = (spark, str(files / "feeds"), str(tmp_path / "out"), str(tmp_path / "check"))
    for _ in range(2):  # the second run finds nothing new
        streaming.ingest(*args).awaitTermination(120)
        assert versions.Table(spark, str(tmp_path / "out")).read().count() == 2


def test_export_resumes(spark, tmp_path):
    meta = F.struct(F.lit("n").alias("name"), F.lit("p").alias("published"), F.lit(1.0).alias("cvss"), F.lit("s").alias("severity"), F.lit("l").alias("likelihood"))
    rows = spark.createDataFrame([("a", "x"), ("b", ""), ("c", "y")], "id string, text string").select("id", F.lit("CVE").alias("type"), "text", meta.alias("metadata"))
    embed = lambda df: df.withColumn("embedding", F.array(F.length("text").cast("double")))
    assert streaming.export_embeddings(rows.where("id = 'a'"), str(tmp_path / "e"), embed) == 1
    assert streaming.export_embeddings(rows, str(tmp_path / "e"), embed) == 1
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "e")).collect()) == ["a", "c"]


def test_readers_of_training_taxonomy_and_techniques(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"cve_id": "CVE-1", "description": "d", "cwes": ["79"], "attack_vectors": None, "published_date": "2024"}, {"cve_id": "CVE-2", "description": None}]))
    rows = {r["cve_id"]: (r["cwes"], r["attack_vectors"]) for r in artifacts.training(spark, str(tmp_path / "t.json")).collect()}
    assert rows == {"CVE-1": (["79"], []), "CVE-2": ([], [])}
    artifacts.training(spark, str(tmp_path / "t.json")).write.parquet(str(tmp_path / "t"))
    assert artifacts.training(spark, str(tmp_path / "t")).count() == 2
    (tmp_path / "p.json").write_text(json.dumps({"patterns": {"xss": [{"keywords": ["script", "tag"], "specificity": 0.9, "boost": 2.5, "support": 4}, {"keywords": ["dom"], "specificity": 0.7, "boost": 1.0, "support": 3}]}}))
    got = artifacts.pattern_taxonomy(spark, str(tmp_path / "p.json")).orderBy("pattern_id").collect()
    assert [(r["vector"], r["pattern_id"], r["keywords"], r["boost"]) for r in got] == [("xss", 1, ["script", "tag"], 2.5), ("xss", 2, ["dom"], 1.0)]
    (tmp_path / "k.json").write_text(json.dumps({"T1": {"name": "n", "platforms": ["Linux"], "url": "u"}}))
    (r,) = artifacts.keyed(spark, str(tmp_path / "k.json"), schemas.TECHNIQUE_NODE).collect()
    assert (r["id"], r["name"], r["platforms"], r["tactics"]) == ("T1", "n", ["Linux"], None)
    assert artifacts.optional(spark, str(tmp_path / "k.json"), "a int", lambda s, p: artifacts.keyed(s, p, schemas.TECHNIQUE_NODE)).count() == 1


def test_windows_of_event_time(spark, tmp_path):
    """As a stream: late events within the bound count in their window, later ones do not."""
    schema = "ts timestamp, event_type string, value double"
    folder = tmp_path / "events"
    folder.mkdir()
    query = streaming.event_windows(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder)))
    batches = [["2024-01-01T00:01:00Z", "2024-01-01T00:04:00Z", "2024-01-01T00:20:00Z"], ["2024-01-01T00:02:00Z", "2024-01-01T00:12:00Z"], ["2024-01-01T00:03:00Z", "2024-01-01T01:00:00Z"]]
    for k, times in enumerate(batches):
        (folder / f"{k}.json").write_text("\n".join(json.dumps({"ts": t, "event_type": "a", "value": 1.5}) for t in times))
        os.utime(folder / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    query.writeStream.format("memory").queryName("windows_of_events").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    got = [(str(r["start"])[11:16], r["n"], r["total"]) for r in spark.table("windows_of_events").orderBy("start").collect()]
    # the first file moves the watermark to 00:10, which holds against late events one batch on: 00:02 counts, 00:03 doesn't
    assert got == [("00:00", 3, 4.5), ("00:10", 1, 1.5), ("00:20", 1, 1.5)]


def test_full_frequency_map(spark, tmp_path):
    doc = {"total_cves": 3, "attack_vectors": {"xss": {"total_cves": 2, "cwe_frequencies": [{"cwe_id": "79", "count": 2, "percentage": 100.0, "rank": 1}, {"cwe_id": "80", "count": 1, "percentage": 50.0, "rank": 2}]}}}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    assert sorted(map(tuple, artifacts.frequencies(spark, str(tmp_path / "f.json")).collect())) == [("xss", 2, "79", 2, 100.0, 1), ("xss", 2, "80", 1, 50.0, 2)]


def test_land_and_vector_lists(spark, tmp_path):
    (tmp_path / "source.json").write_text(json.dumps({"xss": ["79", "80"]}))
    served = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(http.server.SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=served.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{served.server_port}"
    path = feeds.land_first([f"{base}/none.json", f"{base}/source.json"], str(tmp_path / "in" / "lists.json"))
    with pytest.raises(OSError):
        feeds.land(f"{base}/none.json", str(tmp_path / "in" / "none.json"))
    served.shutdown()
    assert not (tmp_path / "in" / "none.json").exists()
    assert [(r["vector"], r["cwe"]) for r in artifacts.vector_lists(spark, path).orderBy("pos").collect()] == [("xss", "79"), ("xss", "80")]


def test_lookup_drops_nothing(spark, files):
    """A record without English text, without a weakness or with unmapped ones is found."""
    rows = feeds.nvd_any(spark, [str(files / "feeds/2024.json.gz"), str(files / "v11.json")])
    ids = spark.createDataFrame([(c,) for c in ("CVE-0-B", "CVE-0-C", "CVE-0-D", "CVE-0-E", "CVE-0-Z", "CVE-0-none")], "id string")
    got = {r["id"]: (r["text"], r["cwes"], r["cvss"] and r["cvss"]["baseScore"]) for r in collect.lookup(rows, ids).collect()}
    assert got == {"CVE-0-B": ("no", ["89"], None), "CVE-0-C": ("none", [], None), "CVE-0-D": ("odd", ["9999"], None), "CVE-0-E": ("script", ["79"], None), "CVE-0-Z": ("old", ["22"], 7.5)}


def test_report_has_every_section(spark, files, tmp_path, capsys):
    """The whole chain of a record: vectors, weaknesses, attack patterns, techniques, actors, CVSS and the EPSS series, on both pages."""
    home, page = ["--home", str(tmp_path / "kb")], tmp_path / "r.html"
    full = feed(*CVES, ("CVE-0-F", "SQL injection in a <b>query</b>", ["CWE-89", "CWE-943"]))
    full["vulnerabilities"][-1]["cve"]["metrics"] = {"cvssMetricV31": [{"cvssData": {"version": "3.1", "vectorString": "CVSS:3.1/AV:N", "baseScore": 9.8, "baseSeverity": "CRITICAL"}}]}
    (tmp_path / "feed.json").write_text(json.dumps(full))
    (tmp_path / "epss.json").write_text(json.dumps({"data": [{"cve": "CVE-0-F", "time-series": [{"epss": "0.4", "percentile": "0.8", "date": "2024-01-02"}, {"epss": "0.2", "percentile": "0.7", "date": "2024-01-01"}]}]}))
    cli.main([*home, "update", "--cwe", str(files / "cwe.xml"), "--capec", str(files / "capec.xml"), "--enterprise", str(files / "enterprise.json"), "--mobile", str(files / "mobile.json")])
    cli.main([*home, "collect", str(files / "feeds")])
    cli.main([*home, "train"])
    capsys.readouterr()
    cli.main([*home, "classify", "--cve", "0-F", "--feed", str(tmp_path / "feed.json"), "--epss", str(tmp_path / "epss.json"), "--html", str(page), "-v"])
    text, html = capsys.readouterr().out, page.read_text()
    for part in ("CVE-0-F", "9.8 CRITICAL (3.1)", "CVSS:3.1/AV:N", "0.4 on 2024-01-02", "Attack vectors", "CWE Hierarchy", "Weaknesses", "Query Logic", "Attack patterns", "66", "Techniques", "T1190", "First", "Actors", "G1", "Group"):
        assert part in text and part in html, part
    assert "Exploit prediction" in html and html.index("2024-01-01: 0.2") < html.index("2024-01-02: 0.4") and "<b>query" not in html and "&lt;b&gt;query" in html
    cli.main([*home, "classify", "--cve", "0-F", "--feed", str(tmp_path / "feed.json"), "--epss", str(tmp_path / "epss.json"), "--html", str(page)])
    cli.main([*home, "reports", str(tmp_path / "feed.json"), str(tmp_path / "pages"), "--epss", str(tmp_path / "epss.json")])
    pages = {r["id"]: r["page"] for r in spark.read.parquet(str(tmp_path / "pages")).collect()}
    assert pages["CVE-0-F"] == page.read_text() and pages.keys() == {v["cve"]["id"] for v in full["vulnerabilities"]}
    assert all(k in v and v.endswith("</html>") for k, v in pages.items())
    capsys.readouterr()
    for cve in ("CVE-0-D", "CVE-0-C", "CVE-0-none"):  # an unmapped weakness, none at all, no record
        cli.main([*home, "classify", "--cve", cve, "--feed", str(tmp_path / "feed.json")])
        assert cve in capsys.readouterr().out
    cli.main([*home, "stats"])
    out = capsys.readouterr().out
    assert "2 training rows" in out and "total_words" in out and "sql_injection" in out
    (tmp_path / "own_embedder.py").write_text("from pyspark.sql import functions as F\ndef embed(df):\n    return df.withColumn('embedding', F.when(F.col('type') == 'CVE', F.array(F.lit(1.0))).otherwise(F.array().cast('array<double>')))\n")
    sys.path.insert(0, str(tmp_path))
    cli.main([*home, "export", str(tmp_path / "emb"), "--embed", "own_embedder:embed"])
    assert capsys.readouterr().out.strip() == "3" and {r["id"] for r in spark.read.parquet(str(tmp_path / "emb")).collect()} == {"CVE-0-A", "CVE-0-E"}
    cli.main([*home, "export", str(tmp_path / "emb"), "--embed", "own_embedder:embed"])
    assert capsys.readouterr().out.strip() == "1"  # an empty embedding is no embedding: it is due again


def test_command_line(spark, files, tmp_path, capsys):
    home = ["--home", str(tmp_path / "kb")]
    cli.main([*home, "update", "--cwe", str(files / "cwe.xml"), "--capec", str(files / "capec.xml"), "--enterprise", str(files / "enterprise.json"), "--mobile", str(files / "mobile.json")])
    cli.main([*home, "collect", str(files / "feeds")])
    cli.main([*home, "train"])
    capsys.readouterr()
    cli.main([*home, "classify", "-d", "SQL injection in a query", "-c", "CWE-89,CWE-943", "--json"])
    found = json.loads(capsys.readouterr().out)
    assert found[0]["label"] == "sql_injection" and found[0]["probability"] == 1.0
    cli.main([*home, "classify", "-d", "SQL injection in a query", "-c", "89,943", "--html", str(tmp_path / "r.html")])
    assert "T1190" in capsys.readouterr().out and "SQL Injection" in (tmp_path / "r.html").read_text()
    cli.main([*home, "relabel"])
    assert {r["cve_id"]: r["attack_vectors"] for r in versions.Table(spark, str(tmp_path / "kb/training")).read().collect()}["CVE-0-A"][0] == "sql_injection"
