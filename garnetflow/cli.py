"""Command line: python -m garnetflow.cli STEP ...; each step reads and writes tables under one folder."""

from __future__ import annotations

import argparse
import importlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import streaming
from .functions.text import cut_bytes, cve_name, titled, tokenize, weakness_list
from .operators import bayes, classify, collect, embedding, frequency, hierarchy, knowledge, linking, patterns, relabel, report
from .sources import artifacts, feeds, versions
from .sources.shared import shared_path


class Store:
    """The tables of one knowledge base."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")

    def read(self, name: str) -> DataFrame:
        """The last version; the frame stays with it while others write."""
        return versions.Table(self.spark, f"{self.home}/{name}").read()

    def write(self, name: str, df: DataFrame) -> None:
        """A new version, which df may be made of the last for. Older ones stay until vacuum()."""
        versions.Table(self.spark, f"{self.home}/{name}").replace(df)


def update(store: Store, cwe: str, capec: str, stix: dict[str, str]) -> None:
    """Catalogues to tables: weaknesses, hierarchy, attack patterns, adversary objects and the maps between them."""
    spark = store.spark
    raw = feeds.cwe_xml(spark, cwe)
    store.write("cwe", knowledge.weaknesses(raw))
    store.write("hierarchy", knowledge.hierarchy(raw))
    store.write("capec", knowledge.attack_patterns(feeds.capec_xml(spark, capec)))
    objects = knowledge.stix_objects(feeds.stix(spark, stix))
    store.write("techniques", knowledge.techniques(objects))
    for name, types in (("groups", ["intrusion-set"]), ("software", ["malware", "tool"]), ("mitigations", ["course-of-action"])):
        store.write(name, knowledge.routed(objects, *types))
    edges = knowledge.typed_edges(objects, objects.where("type = 'relationship'").select("domain_ord", "source_ref", "target_ref", "relationship_type"))
    store.write("edges", edges)
    for name, listed in knowledge.fan_out(edges).items():
        store.write(name, listed)
    for name, e in knowledge.relationship_maps(store.read("cwe"), store.read("capec")).items():
        store.write(name, e)
    artifacts.write_metadata(spark, f"{store.home}/metadata")


def gather(store: Store, feed: str) -> None:
    """Feeds to training rows."""
    store.write("training", collect.newest(collect.training_data(feeds.nvd_any(store.spark, feed))))


def learn(store: Store) -> None:
    """Training rows to counts, patterns and short lists of weaknesses."""
    rows = store.read("training")
    n = rows.count()
    labelled = rows.select(F.col("cve_id").alias("id"), F.explode("attack_vectors").alias("label"), "description", "cwes")
    model = bayes.train(labelled.select("id", "label", tokenize("description", "train").alias("words")), n)
    store.write("nb_counts", model.counts)
    store.write("nb_labels", model.labels)
    docs = rows.select(F.col("cve_id").alias("id"), tokenize("description", "taxonomy").alias("words"))
    terms = patterns.term_scores(labelled.select("label", tokenize("description", "taxonomy").alias("words")), docs, n)
    store.write("taxonomy", patterns.taxonomy(patterns.learned(terms), patterns.document_frequency(docs), n))
    counts = frequency.pair_counts(labelled.select(F.col("label").alias("vector"), F.explode("cwes").alias("cwe")))
    totals = labelled.groupBy(F.col("label").alias("vector")).agg(F.count("*").alias("total"))
    store.write("frequency", frequency.ranked(counts, totals))
    store.write("lists", frequency.top(counts, 5).select("vector", "cwe"))
    store.write("size", store.spark.createDataFrame([(n,)], "documents long"))


def _model(store: Store) -> bayes.Model:
    counts = store.read("nb_counts")
    return bayes.Model(counts, store.read("nb_labels"), counts.select("word").distinct().count(), store.read("size").first()["documents"])


def _best(store: Store, rows: DataFrame, commands: bool = True, n: int = 2) -> DataFrame:
    """item, cwe: the n most relevant weaknesses of each record, in order of score and place."""
    nodes = store.read("hierarchy").select(F.col("id").alias("cwe"), "name", F.size("attack_vectors").alias("vectors"))
    own = rows.select(F.col("id").alias("item"), F.posexplode("cwes").alias("pos", "cwe")).join(nodes, "cwe", "left")
    own = own.groupBy("item").agg(F.collect_list(F.struct("pos", "cwe", "name", F.coalesce("vectors", F.lit(0)).alias("vectors"))).alias("own"))
    docs = rows.select(F.col("id").alias("item"), F.lower("text").alias("low")).join(own, "item")
    pairs = classify.weighed(docs, F.col("own")).drop("own")
    pairs = pairs.withColumn("score", classify.relevance(*map(F.col, ("cwe", "name", "vectors", "hits", "flags")), commands))
    return classify.first_by(pairs, "item", n, F.desc("score"), "pos").select("item", "cwe", "rank")


def _candidates(store: Store, best: DataFrame, depth: int) -> DataFrame:
    nodes = store.read("hierarchy")
    edges = nodes.select(F.col("id").alias("child"), F.explode("parents").alias("parent"))
    mapping = nodes.select(F.col("id").alias("node"), F.explode("attack_vectors").alias("vector"))
    return hierarchy.candidates(best.select("item", F.col("cwe").alias("node")), edges, mapping, depth)


def classified(store: Store, rows: DataFrame) -> DataFrame:
    """id, label, probability, confidence and layers of rows(id, text, cwes).

    A record whose only weakness is known to the hierarchy is not classified: it comes with no label.
    """
    rows = classify.routed(rows, store.read("hierarchy").select(F.col("id").alias("node"))).persist()
    open_rows = rows.where("not single")
    docs = open_rows.select("id", "text", tokenize("text", "serving").alias("words"))
    cwes = open_rows.select(F.col("id").alias("item"), F.explode("cwes").alias("cwe"))
    found = classify.hybrid(docs, _model(store), _candidates(store, _best(store, open_rows), 2), cwes, store.read("taxonomy"), store.read("lists"))
    found = found.where(F.col("probability") >= classify.FLOOR)
    only = rows.where("single").select("id", F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("score"), F.array(F.lit("Single weakness")).alias("layers"), F.lit(1.0).alias("probability"), F.lit("high").alias("confidence"))
    return found.unionByName(only)


def linked(store: Store, rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranked attack patterns of each record, and its techniques."""
    best = _best(store, rows).where("rank = 1").select("item", F.col("cwe").alias("best"))
    top = classify.first_by(found, "id", 1, F.desc("probability"), "label").select(F.col("id").alias("item"), F.coalesce("label", F.lit("")).alias("vector"))
    parts = rows.select(F.col("id").alias("item"), "text", F.posexplode("cwes").alias("pos", "cwe")).join(top, "item").join(best, "item")
    mapping = store.read("hierarchy").select(F.col("id").alias("cwe"), F.explode("attack_vectors").alias("vector"))
    chosen = linking.first_matching(parts.select("item", "pos", "cwe", "vector", "best"), mapping)
    capec = store.read("capec").select(F.col("id").alias("capec"), "name", "description", "severity")
    pairs = linking.patterns_of(chosen, store.read("cwe_to_capec")).join(capec, "capec").join(rows.select(F.col("id").alias("item"), "text"), "item").join(top, "item")
    pairs = linking.judged(pairs.withColumn("low", F.lower("text")).drop("text"))
    pairs = linking.keep_related(pairs, F.col("mismatch"), "item").drop("mismatch")
    ranked = linking.ranked(pairs, store.read("taxonomy"))
    techniques = linking.techniques_of(ranked.select("item", "capec"), store.read("capec_to_attack"), store.read("techniques").select(F.col("ext_id").alias("technique")))
    return ranked, techniques


def relabelled(store: Store) -> None:
    """All training rows again by the batch rules; they become a new version of the table, and what changed is printed."""
    rows = store.read("training")
    docs = rows.select(F.col("cve_id").alias("id"), F.col("description").alias("text"), "cwes", tokenize("description", "batch").alias("words"))
    candidates = _candidates(store, _best(store, docs, commands=False), 1)
    new = classify.hybrid_batch(docs.select("id", "text", "words"), _model(store), candidates, store.read("taxonomy"))
    both = rows.join(new.select(F.col("id").alias("cve_id"), F.col("vectors").alias("new")), "cve_id").persist()
    relabel.changes(both, "attack_vectors", "new").show()
    relabel.added(both, "attack_vectors", "new").show()
    store.write("training", both.select("cve_id", "description", "cwes", F.col("new").alias("attack_vectors"), "published_date"))
    both.unpersist()


AROUND = [("Actors", "groups", "group_techniques"), ("Software", "software", "software_techniques"), ("Mitigations", "mitigations", "mitigation_techniques")]


def _around(store: Store, techniques: list[str]) -> dict[str, list[tuple]]:
    """Groups, software and mitigations of a few techniques, with their names."""
    wanted = store.spark.createDataFrame([(t,) for t in techniques], "id string")
    out = {}
    for title, table, lists in AROUND:
        ids = store.read(f"{lists}_reverse").join(wanted, "id", "left_semi").select(F.explode("ids").alias("ext_id")).distinct()
        out[title] = [tuple(r) for r in ids.join(store.read(table).select("ext_id", "name"), "ext_id", "left").orderBy("ext_id").limit(20).collect()]
    return out


def _report(store: Store, rows: DataFrame, a: argparse.Namespace) -> str:
    one = rows.first()  # a report is about one record
    if one is None:
        return f"{a.cve}: no such record"
    found = _landed(classified(store, rows))
    ranked, techniques = map(_landed, linked(store, rows, found))
    listed = classify.named(classify.gap_filter(found.where("label is not null")), "label").orderBy("rank").limit(a.top).collect()
    capecs = ranked.orderBy("rank").limit(5).collect()
    used = [r["technique"] for r in techniques.orderBy("technique").limit(5).collect()]
    names = store.read("techniques").where(F.col("ext_id").isin(used)).select("ext_id", "name", "url").orderBy("ext_id").collect() if used else []
    texts = {t: Path(a.atomics, t, f"{t}.yaml") for t in used} if a.atomics else {}
    tests = feeds.atomic_tests(store.spark, {t: p.read_text(encoding="utf-8") for t, p in texts.items() if p.is_file()}).collect() if texts else []
    cards = {"weaknesses": ", ".join(one["cwes"])}
    if one["cvss"]:
        cards |= {"CVSS": f"{one['cvss']['baseScore']} {one['cvss']['baseSeverity'] or ''} ({one['cvss']['version']})".replace(" ()", ""), "CVSS vector": one["cvss"]["vectorString"] or "-"}
    days = feeds.epss(store.spark, a.epss).where(F.col("cve") == one["id"]).where("epss is not null").orderBy("day").collect() if a.epss else []
    if days:
        cards["EPSS"] = f"{days[-1]['epss']} on {days[-1]['day']}"
    data = {
        "id": one["id"], "description": one["text"], "cards": cards, "epss": {"days": [r["day"] for r in days], "values": [r["epss"] for r in days]},
        "sections": {
            "Attack vectors": [(r["name"], f"{r['probability']:.4f}", r["confidence"], *([", ".join(r["layers"])] if a.verbose else [])) for r in listed],
            "Weaknesses": [(r["id"], r["name"]) for r in store.read("cwe").where(F.col("id").isin(one["cwes"])).select("id", "name").orderBy("id").collect()] if one["cwes"] else [],
            "Attack patterns": [(r["capec"], r["name"], f"{r['probability']:.2f}", r["confidence"], r["severity"] or "-") for r in capecs],
            "Techniques": [tuple(r) for r in names],
            **(_around(store, used) if used else {}),
            "Atomic tests": [(r["technique"], r["name"], ", ".join(r["platforms"] or []), r["executor"] or "-", r["command"] or "-") for r in tests],
        },
    }
    if a.html:
        with open(a.html, "w", encoding="utf-8") as out:
            out.write(report.page(data))
    return report.console(data)


def _landed(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder."""
    path = shared_path(df.sparkSession, "reports")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reports(store: Store, rows: DataFrame, top: int = 3, epss: DataFrame | None = None) -> DataFrame:
    """id and page of every record of rows(id, text, cwes, cvss): the report of one record, for all of them by joins, without a collect."""
    parts = report.section
    rows = _landed(rows)
    found = _landed(classified(store, rows))
    ranked, techniques = map(_landed, linked(store, rows, found))  # every section reads these
    listed = classify.named(classify.gap_filter(found.where("label is not null")), "label").where(F.col("rank") <= top).withColumnRenamed("id", "item")
    weak = rows.select(F.col("id").alias("item"), F.explode(F.array_distinct("cwes")).alias("cwe")).join(store.read("cwe").select(F.col("id").alias("cwe"), "name"), "cwe")
    used = classify.first_by(techniques.select("item", "technique").distinct(), "item", 5, "technique").drop("rank")
    names = store.read("techniques").select(F.col("ext_id").alias("technique"), "name", "url")
    sections = [
        parts(0, "Attack vectors", listed, ["rank"], ["name", F.format_string("%.4f", "probability"), "confidence"]),
        parts(1, "Weaknesses", weak, ["cwe"], ["cwe", "name"]),
        parts(2, "Attack patterns", ranked.where("rank <= 5"), ["rank"], ["capec", "name", F.format_string("%.2f", "probability"), "confidence", F.coalesce(F.nullif("severity", F.lit("")), F.lit("-"))]),
        parts(3, "Techniques", used.join(names, "technique"), ["technique"], ["technique", "name", "url"]),
    ]
    for k, (title, table, lists) in enumerate(AROUND):
        near = used.join(store.read(f"{lists}_reverse").withColumnRenamed("id", "technique"), "technique").select("item", F.explode("ids").alias("ext_id")).distinct()
        near = classify.first_by(near, "item", 20, "ext_id").join(store.read(table).select("ext_id", "name"), "ext_id", "left")
        sections.append(parts(4 + k, title, near, ["ext_id"], ["ext_id", "name"]))
    score = F.concat_ws(" ", F.col("cvss.baseScore").cast("string"), F.nullif("cvss.baseSeverity", F.lit("")), F.concat(F.lit("("), "cvss.version", F.lit(")")))
    cards = [("weaknesses", F.array_join("cwes", ", ")), ("CVSS", F.when(F.col("cvss").isNotNull(), score)), ("CVSS vector", F.when(F.col("cvss").isNotNull(), F.coalesce(F.nullif("cvss.vectorString", F.lit("")), F.lit("-"))))]
    cards = F.filter(F.array(*[F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in cards]), lambda c: c["value"].isNotNull())
    days = None if epss is None else epss.where("epss is not null").select(F.col("cve").alias("item"), "day", "epss")
    return report.pages(rows.select("id", F.col("text").alias("description"), cards.alias("cards")), sections, days)


def statistics(store: Store, rows: int = 20) -> None:
    """What the tables hold: vectors and their frequent weaknesses, the taxonomy, the model, the hierarchy's coverage."""
    n = store.read("training").count()
    print(f"{n} training rows")
    vectors = store.read("training").select(F.explode("attack_vectors").alias("vector")).groupBy("vector").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "vector")
    vectors.withColumn("share", F.round(F.col("records") * 100.0 / F.lit(max(n, 1)), 2)).show(rows, False)
    store.read("frequency").where("rank <= 5").orderBy("vector", "rank").show(rows, False)
    store.read("taxonomy").groupBy("vector").agg(F.count("*").alias("patterns"), F.round(F.avg("specificity"), 3).alias("specificity"), F.round(F.max("boost"), 3).alias("best")).orderBy(F.desc("patterns"), "vector").show(rows, False)
    bayes.total_words(_model(store)).show()
    frequency.coverage(store.read("hierarchy"), "attack_vectors").show()


def exported(store: Store, out: str, embed: str, per_second: float | None) -> int:
    """Embeddings of the training rows and catalogues that `out` has not; embed names a function as module:name: of a frame, or with per_second of one text, called no oftener."""
    module, _, name = embed.partition(":")
    metadata = lambda name, published, severity, likelihood: F.struct(name.alias("name"), published.alias("published"), F.lit(None).cast("double").alias("cvss"), severity.alias("severity"), likelihood.alias("likelihood"))
    none = F.lit(None).cast("string")
    cves = store.read("training").select(F.col("cve_id").alias("id"), F.lit("CVE").alias("type"), cut_bytes(F.col("description")).alias("text"), metadata(F.col("cve_id"), F.col("published_date"), none, none).alias("metadata"))
    capecs = store.read("capec").select(F.concat(F.lit("CAPEC-"), "id").alias("id"), F.lit("CAPEC").alias("type"), cut_bytes(titled(F.col("name"), F.col("description"))).alias("text"), metadata(F.col("name"), none, F.col("severity"), F.col("likelihood")).alias("metadata"))
    return streaming.export_embeddings(cves.unionByName(capecs), out, getattr(importlib.import_module(module), name) if per_second is None else embedding.service(getattr(importlib.import_module(module), name), per_second))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="garnetflow", description=__doc__)
    p.add_argument("--home", default="resources", help="folder of the tables")
    steps = p.add_subparsers(dest="step", required=True)
    u = steps.add_parser("update")
    for name in ("--cwe", "--capec"):
        u.add_argument(name, required=True)
    for name in feeds.DOMAINS:
        u.add_argument(f"--{name}")
    steps.add_parser("collect").add_argument("feed")
    steps.add_parser("train")
    steps.add_parser("relabel")
    steps.add_parser("stats")
    e = steps.add_parser("export")
    e.add_argument("out")
    e.add_argument("--embed", required=True, help="module:function that adds the column embedding to a frame, or with --per-second gives the vector of one text")
    e.add_argument("--per-second", type=float, help="calls a second, over all tasks")
    r = steps.add_parser("reports")
    r.add_argument("feed", help="landed feed whose records get a page each")
    r.add_argument("out", help="folder of a table of id and page")
    r.add_argument("--epss", help="landed EPSS series")
    r.add_argument("--top", type=int, default=3)
    c = steps.add_parser("classify")
    c.add_argument("--cve", default="CVE-0-0")
    c.add_argument("--feed", help="landed feed that has the record")
    c.add_argument("-d", "--description")
    c.add_argument("-c", "--cwes", default="")
    c.add_argument("--top", type=int, default=3)
    c.add_argument("--html")
    c.add_argument("--epss", help="landed EPSS series")
    c.add_argument("--atomics", help="folder of atomic tests by technique")
    c.add_argument("-v", "--verbose", action="store_true", help="name the layers that found a vector")
    c.add_argument("--json", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("garnetflow").getOrCreate()
    store = Store(spark, a.home)
    if a.step == "update":
        update(store, a.cwe, a.capec, {d: getattr(a, d) for d in feeds.DOMAINS if getattr(a, d)})
    elif a.step == "collect":
        gather(store, a.feed)
    elif a.step == "train":
        learn(store)
    elif a.step == "relabel":
        relabelled(store)
    elif a.step == "stats":
        statistics(store)
    elif a.step == "reports":
        feed = feeds.nvd_any(spark, a.feed)
        rows = collect.lookup(feed, feed.select("cve.id"))
        reports(store, rows, a.top, feeds.epss(spark, a.epss) if a.epss else None).write.mode("overwrite").parquet(a.out)
    elif a.step == "export":
        print(exported(store, a.out, a.embed, a.per_second))
    else:
        typed = spark.createDataFrame([(a.cve, a.description, a.cwes)], "id string, text string, typed string")
        rows = typed.select(cve_name(F.col("id")).alias("id"), "text", F.filter(weakness_list(F.col("typed")), lambda c: c != "").alias("cwes"), F.lit(None).cast("struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>").alias("cvss"))
        if a.feed:
            found = collect.lookup(feeds.nvd_any(spark, a.feed), rows)
            rows = spark.createDataFrame(found.collect(), found.schema)  # the one record: the feed is read once
        if a.json:
            print(json.dumps([r.asDict(recursive=True) for r in classified(store, rows).orderBy(F.desc("probability"), "label").limit(a.top).collect()]))
        else:
            print(_report(store, rows, a))


if __name__ == "__main__":
    main()
