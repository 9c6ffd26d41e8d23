"""Artifacts of earlier steps: keyed JSON objects, edge maps, models and tables, read to rows and written whole."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bigjson, schemas


def _text(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("wholetext", True).text(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def optional(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    """What read(spark, path) gives, or an empty frame of the schema if there is nothing."""
    return read(spark, path) if exists(spark, path) else spark.createDataFrame([], schema)


def keyed(spark: SparkSession, path, node: str) -> DataFrame:
    """id and fields of a JSON object whose keys are ids, read by many tasks."""
    rows = bigjson.elements(spark, path).select("key", F.from_json("value", node).alias("n"))
    inner = [f for f in rows.select("n.*").columns if f != "id"]
    return rows.select(F.col("key").alias("id"), *[F.col(f"n.{f}").alias(f) for f in inner])


def training(spark: SparkSession, path) -> DataFrame:
    """Training rows from a JSON array or from Parquet; null lists become empty ones."""
    if re.search(r"\.json(\.gz)?$", str(path)):
        rows = bigjson.parsed(spark, path, schemas.TRAINING).drop("key")
    else:
        rows = spark.read.schema(schemas.TRAINING).parquet(path)
    return rows.withColumns({c: F.coalesce(c, F.array()) for c in ("cwes", "attack_vectors")})


def cwe_hierarchy(spark: SparkSession, path) -> DataFrame:
    """Nodes of a hierarchy file: id, name, abstraction, parents, children, attack_vectors."""
    rows = bigjson.elements(spark, path, "cwes").select("key", F.from_json("value", schemas.CWE_NODE).alias("n"))
    return rows.select(F.col("key").alias("id"), "n.name", "n.abstraction", *[F.coalesce(f"n.{c}", F.array()).alias(c) for c in ("parents", "children", "attack_vectors")])


def capec(spark: SparkSession, path) -> DataFrame:
    """Attack patterns in any of three layouts: an object by id, an array, or an array under "capecs"."""
    one = schemas.CAPEC_NODE.replace("struct<", "struct<capecId: string, capec_id: string, id: string, ", 1)
    text = _text(spark, path)
    first = text.select(F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1).alias("c"), F.get_json_object("value", "$.capecs").isNotNull().alias("under")).first()
    if first is None:
        return spark.createDataFrame([], f"id string, {schemas.CAPEC_NODE[7:-1]}")
    if first["c"] == "[":
        rows = text.select(F.explode(F.from_json("value", f"array<{one}>")).alias("n"))
    elif first["under"]:
        rows = text.select(F.explode(F.from_json("value", f"struct<capecs: array<{one}>>")["capecs"]).alias("n"))
    else:
        rows = text.select(F.explode(F.from_json("value", f"map<string,{one}>")).alias("key", "n"))
    key = F.coalesce("n.capecId", "n.capec_id", "n.id", F.col("key") if "key" in rows.columns else F.lit(None).cast("string"))
    names = re.findall(r"(\w+): (?:string|array)", schemas.CAPEC_NODE)
    return rows.select(F.regexp_replace(key, "^CAPEC-", "").alias("id"), *[F.col(f"n.{c}").alias(c) for c in names])


def relationships(spark: SparkSession, path) -> dict[str, DataFrame]:
    """The four edge maps as (src, dst) rows, whichever style their names have."""
    text = _text(spark, path)
    out = {}
    for snake, pascal in (("cwe_to_capec", "CweToCapec"), ("capec_to_cwe", "CapecToCwe"), ("capec_to_attack", "CapecToAttack"), ("attack_to_capec", "AttackToCapec")):
        both = F.coalesce(*[F.from_json("value", f"struct<{n}: map<string,array<string>>>")[n] for n in (snake, pascal)])
        out[snake] = text.select(F.explode(both).alias("src", "l")).select("src", F.explode("l").alias("dst"))
    return out


def vector_lists(spark: SparkSession, path) -> DataFrame:
    """vector and cwe of a map from vectors to short lists."""
    return _text(spark, path).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("vector", "l")).select("vector", F.posexplode("l").alias("pos", "cwe"))


def frequencies(spark: SparkSession, path) -> DataFrame:
    """vector, total_cves, cwe, cnt, percentage and rank of the full frequency map."""
    one = "struct<cwe_id: string, count: long, percentage: double, rank: long>"
    rows = _text(spark, path).select(F.explode(F.from_json("value", f"struct<attack_vectors: map<string,struct<total_cves: long, cwe_frequencies: array<{one}>>>>")["attack_vectors"]).alias("vector", "s"))
    rows = rows.select("vector", F.col("s.total_cves").alias("total_cves"), F.explode("s.cwe_frequencies").alias("w"))
    return rows.select("vector", "total_cves", F.col("w.cwe_id").alias("cwe"), F.col("w.count").alias("cnt"), "w.percentage", "w.rank")


def pattern_taxonomy(spark: SparkSession, path) -> DataFrame:
    """vector, pattern_id, keywords, specificity, boost, support of a taxonomy file."""
    rows = _text(spark, path).select(F.explode(F.from_json("value", "struct<patterns: map<string,array<struct<keywords: array<string>, specificity: double, boost: double, support: long>>>>")["patterns"]).alias("vector", "l"))
    return rows.select("vector", F.posexplode("l").alias("pattern_id", "p")).select("vector", (F.col("pattern_id") + 1).cast("long").alias("pattern_id"), "p.*")


def naive_bayes(spark: SparkSession, path):
    """A model from its JSON form: counts and totals; likelihoods in the file are not needed."""
    from ..operators.bayes import Model

    schema = "struct<word_counts: map<string,map<string,long>>, total_words: map<string,long>, vector_doc_counts: map<string,long>, total_documents: long, vocabulary: array<string>>"
    m = _text(spark, path).select(F.from_json("value", schema).alias("m")).select("m.*")
    head = m.select("total_documents", F.size("vocabulary").alias("v")).first()
    counts = m.select(F.explode("word_counts").alias("label", "w")).select("label", F.explode("w").alias("word", "cnt"))
    docs = m.select(F.explode("vector_doc_counts").alias("label", "docs"))
    total = m.select(F.explode("total_words").alias("label", "total"))
    labels = docs.join(total, "label").withColumn("prior", F.col("docs") / F.lit(head["total_documents"]))
    return Model(counts, labels, head["v"], head["total_documents"])


# --- writing ---


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str, key: str | None = None) -> None:
    """One JSON document: an object by `key`, or an array. For interchange; tables stay Parquet.

    The document is one line by nature, so this is for catalogues and not for data that grows.
    """
    if key:
        rest = F.struct(*[c for c in df.columns if c != key])
        doc = df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), rest)))).alias("d"))
    else:
        doc = df.agg(F.collect_list(F.struct(*df.columns)).alias("d"))
    doc.select(F.to_json("d", {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_document(df: DataFrame, path: str, key: str | None = None, append: bool = False) -> int:
    """One JSON document in one file: an object by `key`, or an array; append adds to the document that is there. Returns the bytes of it.

    The rows become fragments that tasks write; these are joined as streams of bytes, so no memory grows with the document. An older document
    is taken over up to its closing bracket. The new one is written beside the path and renamed, so a document is never seen half
    written; what a run that broke off has left has another name. The order of rows is that of df; keys that repeat stay.
    """
    spark = df.sparkSession
    jvm, (first, last) = spark._jvm, ("[", "]") if key is None else ("{", "}")
    p, copy = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils.copyLarge
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    row = F.to_json(F.struct(*[c for c in df.columns if c != key]), {"ignoreNullFields": "false"})
    if key is not None:
        # a JSON array of the key alone, without its brackets
        name = F.to_json(F.array(F.col(key).cast("string")))
        row = F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(": "), row)
    folder, new = f"{path}.{uuid.uuid4().hex}.parts", p(f"{path}.{uuid.uuid4().hex}.new")
    df.select(row.alias("value")).write.option("lineSep", ",\n").text(folder)
    parts = [(f.getPath(), f.getLen()) for f in fs.listStatus(p(folder)) if f.getPath().getName().startswith("part-") and f.getLen()]
    out = fs.create(new)
    put = lambda text: out.write(bytearray(text.encode()))
    keep = _up_to_end(spark, fs, p(path), first, last) if append and fs.exists(p(path)) else None
    if keep is None:
        put(f"{first}\n")
    else:
        size, empty = keep
        source = fs.open(p(path))
        copy(source, out, 0, size)
        source.close()
        put("\n" if empty or not parts else ",\n")
    for k, (part, size) in enumerate(sorted(parts, key=lambda x: x[0].getName())):
        source = fs.open(part)
        copy(source, out, 0, size - (2 if k == len(parts) - 1 else 0))  # the last row has no separator
        source.close()
    put(f"\n{last}\n")
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(new, p(path), options)
    fs.delete(p(folder), True)
    return fs.getFileStatus(p(path)).getLen()


def _up_to_end(spark: SparkSession, fs, path, first: str, last: str) -> tuple[int, bool]:
    """How many bytes stand before a document's closing bracket and the white space around it, and whether nothing is in it."""
    end, tail = fs.getFileStatus(path).getLen(), b""
    source = fs.open(path)
    try:
        while end and len(tail.rstrip()) < 2 or tail.rstrip()[:-1].strip() == b"" and end:
            step = min(end, 4096)
            end -= step
            source.seek(end)
            tail = bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source, step)) + tail
    finally:
        source.close()
    body = tail.rstrip()
    if not body.endswith(last.encode()):
        raise ValueError(f"{path.toString()} does not end with {last}")
    body = body[:-1].rstrip()
    return end + len(body), body.endswith(first.encode()) and end + len(body) <= 4 + len(tail)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrites a table that df may itself read: written beside it, then exchanged by renames.

    If the second rename fails the old table comes back; if the driver dies between the two, it lies beside the path
    as `.old`, and restored() brings it back.
    """
    spark = df.sparkSession
    new, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}.old"
    df.write.parquet(new)
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(p(path))
    if had and not fs.rename(p(path), p(old)):
        fs.delete(p(new), True)
        raise OSError(f"{path} cannot be moved aside")
    if not fs.rename(p(new), p(path)):
        if had:
            fs.rename(p(old), p(path))
        raise OSError(f"the new table cannot be moved to {path}")
    fs.delete(p(old), True)


def restored(spark: SparkSession, path: str) -> bool:
    """Brings back what an exchange that broke off has left beside the path; False if nothing is to be done."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(path)):
        return False
    left = fs.globStatus(p(f"{path}.*.old"))
    return bool(left) and fs.rename(left[0].getPath(), p(path))


def write_metadata(spark: SparkSession, path: str, **versions: str) -> None:
    """When the artifacts were made, in UTC, and their versions."""
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    row = spark.range(1).select(stamp.alias("updated_at"), *[F.lit(v).alias(k) for k, v in versions.items()])
    row.coalesce(1).write.mode("overwrite").json(path)
