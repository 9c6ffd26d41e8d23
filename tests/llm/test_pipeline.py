from __future__ import annotations

import os

import pytest
from compare import assert_same, tables
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as groups
from test_suffix_dedup import brute as repeats

import corpus_pipeline
from garnetflow.llm import queries, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, SF).toPandas(), tables(SF).sql(queries.ORACLE_SQL[name]).df())


def test_every_query_is_named_for_its_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_stages(spark):
    """Each stage, on what the last one kept, against a plain version."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    step = dict(corpus_pipeline.STAGES)

    now = step["toxicity"](spark, docs, SF)
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["predicted"]}
    assert now.columns == docs.columns and {r["doc_id"] for r in now.collect()} == set(rows) - bad

    rows = {d: t for d, t in rows.items() if d not in bad}
    now = step["jaccard_join"](spark, now, SF)
    rows = {d: rows[d] for d in {c for *_, c in groups(sorted(rows.items()))}}
    assert {r["doc_id"]: r["text"] or "" for r in now.collect()} == rows

    now = step["suffix_dedup"](spark, now, SF)
    kept = {r["doc_id"]: r for r in now.collect()}
    order = sorted(rows)
    for d, (n, gone, _, _) in zip(order, repeats([rows[d] for d in order], corpus_pipeline.PASSAGE), strict=True):
        left = len(kept[d]["text"].encode())
        assert n - gone <= left <= n - gone + 8 * (gone > 0) + 64 * (gone > corpus_pipeline.PASSAGE) and kept[d]["n_chars"] == len(kept[d]["text"])
    assert suffix_dedup.LENGTH == 400 and corpus_pipeline.PASSAGE < 51 * 5

    rows = {d: r["text"] for d, r in kept.items()}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, w in leaks(sorted(rows.items()), bench).items() if w[4]}
    now = step["decontamination"](spark, now, SF)
    assert now.columns == docs.columns and {r["doc_id"] for r in now.collect()} == set(rows) - hit

    packed = step["packing"](spark, now, SF).collect()
    assert {r["doc_id"] for r in packed} == set(rows) - hit


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100 and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_entry_lists_them():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))


CASES = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "null id here " * 20), (4, " \n\t "), (6, "a" * 5000), (6, "other text, same id"), (7, "<|endoftext|> 漢字 \U0001f600 é İ")]


def through(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, docs, SF)
        assert now.columns == docs.columns
        docs = now
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, SF)


def test_stages_take_any_row(spark):
    """Nulls, empty and long texts, ties, repeated rows and columns that are named like the operators' own."""
    docs = spark.createDataFrame([(d, t, "en", "s", None, 1, "k", 2, 3) for d, t in CASES], "doc_id long, text string, lang string, source string, n_chars long, row int, key string, rank int, shape long").repartition(3)
    kept, packed = through(spark, docs)
    rows = {(r["doc_id"], r["text"] or "") for r in kept.collect()}
    # one of the equal rows stays; rows without words all do; the periodic texts repeat within themselves
    assert rows == {(1, ""), (2, ""), (3, "x"), (None, ""), (4, " \n\t "), (6, ""), (6, "other text, same id"), (7, "<|endoftext|> 漢字 \U0001f600 é İ")} and kept.count() == 8
    assert {r["doc_id"] for r in packed.collect()} == {d for d, _ in rows}


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    kept, packed = through(spark, docs)
    assert kept.count() == 0 and packed.count() == 0 and "sequence_id" in packed.columns
