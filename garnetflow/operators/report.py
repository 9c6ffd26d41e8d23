"""Attack-chain reports: joins from a record to its actors, and the pages that show them."""

from __future__ import annotations

from collections.abc import Iterator
from html import escape
from string import Template

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Edges from techniques to groups that go to every task.
BROADCAST_GROUPS = 500_000


def best_weaknesses(vectors: DataFrame, cwes: DataFrame, mapping: DataFrame, n: int = 2, repeats: bool = True) -> DataFrame:
    """item, cwe, pos: the first n weaknesses, in the order of vectors, whose vectors include one of the item's.

    vectors: item, vector, ord; cwes: item, cwe, pos; mapping: cwe, vector. With repeats a weakness that
    serves two vectors fills two places.
    """
    hits = vectors.join(cwes, "item").join(mapping, ["cwe", "vector"]).select("item", "cwe", "ord", "pos")
    if not repeats:
        hits = hits.groupBy("item", "cwe").agg(F.min(F.struct("ord", "pos")).alias("o")).select("item", "cwe", "o.*")
    order = Window.partitionBy("item").orderBy("ord", "pos", "cwe")
    return hits.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= n).select("item", "cwe", "rank")


def chain(items: DataFrame, cwe_capec: DataFrame, capec_technique: DataFrame, technique_group: DataFrame) -> DataFrame:
    """item, capec, technique and group of every path from an item's weaknesses, without repeats. Edges: src, dst.

    Techniques are few and the paths through one many, so up to BROADCAST_GROUPS edges to groups go to every task.
    """
    rows = items.select("item", "cwe").distinct().join(cwe_capec.select(F.col("src").alias("cwe"), F.col("dst").alias("capec")).distinct(), "cwe").select("item", "capec").distinct()
    rows = rows.join(capec_technique.select(F.col("src").alias("capec"), F.col("dst").alias("technique")).distinct(), "capec", "left")
    groups = technique_group.select(F.col("src").alias("technique"), F.col("dst").alias("group")).distinct()
    rows = rows.join(F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups, "technique", "left")
    return rows.select("item", "capec", "technique", "group")  # each step's edges are distinct, so paths are


def nested(rows: DataFrame) -> DataFrame:
    """One row for each item, its attack patterns, techniques and groups as sorted arrays."""
    return rows.groupBy("item").agg(*[F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in ("capec", "technique", "group")])


def cvss(metrics: str = "metrics"):
    """The newest version's data that a record has: 3.1, then 3.0, then 2."""
    return F.coalesce(*[F.get(F.col(f"{metrics}.{v}"), F.lit(0))["cvssData"] for v in ("cvssMetricV31", "cvssMetricV30", "cvssMetricV2")])


def series(rows: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """key, labels and values of a chart, by day ascending."""
    listed = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(day).alias("day"), F.col(value).alias("value")))).alias("s"))
    return listed.select(key, F.array_join(F.col("s.day"), ",").alias("labels"), F.array_join(F.transform("s", lambda x: x["value"].cast("string")), ",").alias("data"))


_PAGE = Template(
    "<!DOCTYPE html><html lang=\"en\"><head><meta charset=\"utf-8\"><title>$title</title><style>body{font-family:sans-serif;max-width:60em;margin:auto}section{border-top:1px solid #ccc}"
    ".tag{background:#eee;border-radius:3px;padding:0 .4em}</style></head><body><h1>$title</h1><p>$description</p>$sections<footer>$generated</footer></body></html>"
)


def page(report: dict) -> str:
    """A report of one record as a page of its own. Every field is escaped; empty sections are left out.

    report: id, description, generated, cards (name to value), sections (title to rows of fields), epss
    (days and values) if there is a series.
    """
    e = lambda x: escape("" if x is None else str(x))
    parts = ["<section><h2>Overview</h2>" + "".join(f"<p>{e(k)}: <span class='tag'>{e(v)}</span></p>" for k, v in report.get("cards", {}).items()) + "</section>"]
    if (epss := report.get("epss")) and epss["days"]:
        top = max(map(float, epss["values"])) or 1.0
        bars = "".join(f"<rect x='{8 * k}' y='{60 - 60 * float(v) / top:.1f}' width='6' height='{60 * float(v) / top:.1f}'><title>{e(d)}: {e(v)}</title></rect>" for k, (d, v) in enumerate(zip(epss["days"], epss["values"], strict=True)))
        parts.append(f"<section><h2>Exploit prediction</h2><svg width='{8 * len(epss['days'])}' height='60'>{bars}</svg></section>")
    for title, rows in report.get("sections", {}).items():
        if rows:
            parts.append(f"<section><h2>{e(title)}</h2><ul>" + "".join("<li>" + " ".join(f"<span class='tag'>{e(x)}</span>" for x in row) + "</li>" for row in rows) + "</ul></section>")
    return _PAGE.substitute(title=e(report.get("id")), description=e(report.get("description")), sections="".join(parts), generated=e(report.get("generated")))


def section(place: int, title: str, rows: DataFrame, order: list, fields: list) -> DataFrame:
    """item and one section of its report: its rows (arrays of fields as text) in an order."""
    text = F.array(*[F.col(f).cast("string") if isinstance(f, str) else f.cast("string") for f in fields])
    listed = rows.select("item", F.struct(*order, text.alias("fields")).alias("r")).groupBy("item").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    return listed.select("item", F.struct(F.lit(place).alias("place"), F.lit(title).alias("title"), F.transform("rows", lambda r: r["fields"]).alias("rows")).alias("section"))


def pages(records: DataFrame, sections: list[DataFrame], days: DataFrame | None = None) -> DataFrame:
    """id and page of each record, however many there are: sections meet their record by id, and a task writes the pages of its rows.

    records: id, description, cards (array of structs of name and value); sections: item, section; days: item, day, epss. Records with the same id share their sections.
    """
    every = sections[0]
    for other in sections[1:]:
        every = every.unionByName(other)
    parts = every.groupBy(F.col("item").alias("id")).agg(F.array_sort(F.collect_list("section")).alias("sections"))
    rows = records.select("id", "description", "cards").join(parts, "id", "left")
    if days is None:
        rows = rows.withColumn("days", F.lit(None).cast("array<struct<day: string, epss: double>>"))
    else:
        rows = rows.join(days.groupBy(F.col("item").alias("id")).agg(F.array_sort(F.collect_list(F.struct("day", "epss"))).alias("days")), "id", "left")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                cards, days = {c["name"]: c["value"] for c in r["cards"] or []}, r["days"] or []
                if days:
                    cards["EPSS"] = f"{days[-1]['epss']} on {days[-1]['day']}"
                made.append(page({"id": r["id"], "description": r["description"], "cards": cards, "epss": {"days": [d["day"] for d in days], "values": [d["epss"] for d in days]}, "sections": {s["title"]: s["rows"] for s in r["sections"] or []}}))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["id", "page"])

    return rows.select("id", "description", "cards", "sections", "days").mapInArrow(render, "id string, page string")


def console(report: dict, most: int = 10, preview: int = 100) -> str:
    """The same report as lines of text: at most `most` rows of a section, long fields cut after `preview` bytes."""
    lines = [str(report.get("id")), str(report.get("description") or "")]
    lines += [f"  {k}: {v}" for k, v in report.get("cards", {}).items()]
    for title, rows in report.get("sections", {}).items():
        if rows:
            lines += [title, *("  - " + " | ".join(str(x).encode()[:preview].decode("utf-8", "ignore") for x in row) for row in rows[:most])]
    return "\n".join(lines)
