"""Scans of feeds and catalogues. Files are landed first; nothing here opens a network connection but land()."""

from __future__ import annotations

import re
import shutil
import urllib.request
import warnings
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bigjson, schemas

DOMAINS = ("enterprise", "mobile", "ics")


def land(url: str, path: str, timeout: float = 300) -> str:
    """Fetches a file, whole or not at all; any answer but 200 is an error."""
    part = Path(f"{path}.part")
    part.parent.mkdir(parents=True, exist_ok=True)
    with urllib.request.urlopen(url, timeout=timeout) as answer, part.open("wb") as out:
        if answer.status != 200:
            raise OSError(f"{url}: status {answer.status}")
        shutil.copyfileobj(answer, out)
    part.rename(path)
    return path


def land_first(urls: list[str], path: str) -> str:
    """The first of several addresses that answers."""
    for k, url in enumerate(urls):
        try:
            return land(url, path)
        except OSError:
            if k == len(urls) - 1:
                raise
    raise ValueError("no address")


def unzipped(archive: str, pattern: str, folder: str) -> str:
    """Extracts the first entry whose name matches; a missing one is an error."""
    with zipfile.ZipFile(archive) as z:
        name = next((n for n in z.namelist() if re.search(pattern, n)), None)
        if name is None:
            raise FileNotFoundError(f"no entry like {pattern} in {archive}")
        path = Path(folder, Path(name).name)
        path.parent.mkdir(parents=True, exist_ok=True)
        with z.open(name) as source, path.open("wb") as out:
            shutil.copyfileobj(source, out)
    return str(path)


def _json(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema).json(path)


def nvd(spark: SparkSession, path) -> DataFrame:
    """A row (cve) for each vulnerability of 2.0 feeds, gzipped or not; a file that is not gzipped is read by many tasks."""
    one = schemas.NVD_FEED.removeprefix("vulnerabilities array<").removesuffix(">")
    return bigjson.parsed(spark, path, one, "vulnerabilities").select("cve")


def nvd_v11(spark: SparkSession, path) -> DataFrame:
    """1.1 feeds in the shape of 2.0 ones, with the score of version 3."""
    rows = _json(spark, path, schemas.NVD_FEED_V11).select(F.explode("CVE_Items").alias("i"))
    cve = F.struct(
        F.col("i.cve.CVE_data_meta.ID").alias("id"), F.col("i.publishedDate").alias("published"), F.col("i.cve.description.description_data").alias("descriptions"),
        F.col("i.cve.problemtype.problemtype_data").alias("weaknesses"), F.col("i.impact.baseMetricV3.cvssV3.baseScore").alias("base_score"), _metrics(F.col("i.impact.baseMetricV3.cvssV3")).alias("metrics"),
    )
    return rows.select(cve.alias("cve"))


def _metrics(v3: Column) -> Column:
    """Version 3 of a 1.1 feed where 2.0 feeds have it."""
    one = F.array(F.struct(F.struct(v3["version"].alias("version"), v3["vectorString"].alias("vectorString"), v3["baseScore"].alias("baseScore"), v3["baseSeverity"].alias("baseSeverity")).alias("cvssData")))
    none = F.lit(None).cast("array<struct<cvssData: struct<version: string, vectorString: string, baseScore: double, baseSeverity: string>>>")
    newer = F.coalesce(v3["version"] == "3.1", F.lit(False))
    return F.struct(F.when(v3.isNotNull() & newer, one).alias("cvssMetricV31"), F.when(v3.isNotNull() & ~newer, one).alias("cvssMetricV30"), none.alias("cvssMetricV2"))


def nvd_any(spark: SparkSession, path) -> DataFrame:
    """Whichever of the two layouts a feed has: the columns that both give."""
    common = lambda df: df.select(F.struct("cve.id", "cve.published", "cve.descriptions", "cve.weaknesses", "cve.metrics").alias("cve"))
    return common(nvd(spark, path)).unionByName(common(nvd_v11(spark, path)))


def cwe_xml(spark: SparkSession, path) -> DataFrame:
    """A row for each weakness; the extended description comes as its inner XML."""
    return spark.read.format("xml").option("rowTag", "Weakness").schema(schemas.CWE_XML).load(path)


def capec_xml(spark: SparkSession, path) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "Attack_Pattern").schema(schemas.CAPEC_XML).load(path)


def stix(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Objects of the bundles of the domains, with domain_ord and their place in the bundle."""
    out = None
    for k, domain in enumerate(DOMAINS):
        if domain in paths:
            rows = _json(spark, paths[domain], schemas.STIX).select(F.lit(k).alias("domain_ord"), F.posexplode("objects").alias("pos", "o")).select("domain_ord", "pos", "o.*")
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no bundle")
    return out


def epss(spark: SparkSession, path) -> DataFrame:
    """cve, day, epss and percentile of each day of the series; numbers as doubles."""
    rows = _json(spark, path, schemas.EPSS).select(F.explode("data").alias("d"))
    return rows.select(F.col("d.cve").alias("cve"), F.explode("d.`time-series`").alias("s")).select("cve", F.col("s.date").alias("day"), F.col("s.epss").try_cast("double").alias("epss"), F.col("s.percentile").try_cast("double").alias("percentile"))


def atomic_tests(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Tests of techniques from YAML texts by technique; a text that cannot be read has no tests.

    Needs PyYAML; without it, there are no tests, and a warning says so.
    """
    try:
        import yaml
    except ImportError:
        if files:
            warnings.warn("PyYAML is not installed: no atomic tests are read", stacklevel=2)
        return spark.createDataFrame([], schemas.ATOMIC)
    rows = []
    for technique, text in files.items():
        try:
            tests = (yaml.safe_load(text) or {}).get("atomic_tests") or []
            rows += [(technique, t.get("name"), t.get("description"), t.get("supported_platforms") or [], (t.get("executor") or {}).get("name"), (t.get("executor") or {}).get("command")) for t in tests]
        except (yaml.YAMLError, AttributeError):
            continue
    return spark.createDataFrame(rows, schemas.ATOMIC)
