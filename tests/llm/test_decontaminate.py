from __future__ import annotations

from helpers import digest, edge_table, empty_table, prose, words

from garnetflow.llm import decontaminate as op

BENCH = [(1, prose(1, 25)), (2, prose(2, 12)), (3, "tiny item"), (4, ""), (5, None), (6, prose(1, 25)), (7, "!!! ???"), (8, prose(8, 9))]


def brute(docs, bench, n=10):
    windows = {}
    for item, t in bench:
        w = words(t)
        m = min(len(w), n)
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(str(item))
    out = {}
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if found := windows.get(tuple(w[i : i + m])):
                    items |= found
                    hit |= set(range(i, i + m))
        out[d] = (len(w), len(hit), len(items), digest(",".join(sorted(items)).encode()), bool(hit))
    return out


DOCS = [(k, prose(100 + k, 40) + (" " + prose(1, 25) if k % 4 == 0 else "") + (" TINY... Item!" if k % 5 == 0 else "") + (prose(8, 9) if k % 7 == 0 else "")) for k in range(40)]


def frames(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3), spark.createDataFrame(BENCH, "item_id long, text string")


def test_against_brute_force(spark):
    docs, bench = frames(spark)
    want = brute(DOCS, BENCH)
    for most in (op.BLOCK, 7):  # one block, and several scans
        got = {r["doc_id"]: tuple(r)[1:] for r in op.find_leaks(docs, bench, most=most).collect()}
        assert got == want
    assert sum(w[4] for w in want.values()) > 10


def test_removal(spark):
    docs, bench = frames(spark)
    want = brute(DOCS, BENCH)
    kept = op.remove_leaks(docs, bench)
    assert {r["doc_id"] for r in kept.collect()} == {d for d, w in want.items() if not w[4]}
    for most in (op.BLOCK, 7):
        cut = {r["doc_id"]: r["text"] for r in op.remove_leaks(docs, bench, whole=False, most=most).collect()}
        for d, t in DOCS:
            assert len(words(cut[d])) == want[d][0] - want[d][1]
            assert want[d][4] or cut[d] == t


def test_edges(spark):
    _, bench = frames(spark)
    docs = edge_table(spark)
    assert op.find_leaks(docs, bench).count() == docs.count()
    assert op.remove_leaks(docs, bench).columns == docs.columns and op.remove_leaks(docs, bench).count() == docs.count()
    assert op.find_leaks(empty_table(spark), bench).count() == 0
    assert op.find_leaks(docs, bench.limit(0)).where("contaminated").count() == 0


def test_a_window_that_many_items_share_is_in_one_block_once(spark):
    """10,000 items with one text: its windows are broadcast once, and the items come from the join."""
    bench = spark.range(10_000).selectExpr("id AS item_id", f"'{prose(1, 12)}' AS text").union(spark.createDataFrame([(20_000 + k, prose(50 + k, 30)) for k in range(20)], "item_id long, text string"))
    windows = op.numbered(op.windows_of(bench), 50)
    sizes = [r["count"] for r in windows.groupBy("block").count().collect()]
    distinct = {tuple(w[i : i + 10]) for w in (words(prose(1, 12)), *(words(prose(50 + k, 30)) for k in range(20))) for i in range(len(w) - 9)}
    assert max(sizes) <= 50 and sum(sizes) == len(distinct) and windows.select("number").distinct().count() == sum(sizes)
    docs = spark.createDataFrame([(1, prose(1, 12)), (2, prose(53, 30)), (3, "clean"), (4, "x " + prose(1, 12))], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[2:] for r in op.find_leaks(docs, bench, most=50).collect()}
    every = digest(",".join(sorted(map(str, range(10_000)))).encode())
    n = len(words(prose(1, 12)))
    assert got == {1: (n, 10_000, every, True), 2: (len(words(prose(53, 30))), 1, digest(b"20003"), True), 3: (0, 0, digest(b""), False), 4: (n, 10_000, every, True)}


def test_blocks_are_bounded_by_bytes_too(spark):
    bench = spark.createDataFrame([(k, f"{'long' * 100}{k}") for k in range(9)] + [(99, "w" * 5000)], "item_id long, text string")
    windows = op.numbered(op.windows_of(bench), 1000, 1000)
    sizes = windows.groupBy("block").agg({"words": "count", "number": "count"}).count()
    assert sizes >= 5 and windows.count() == 10
