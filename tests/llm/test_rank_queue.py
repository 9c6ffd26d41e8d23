from __future__ import annotations

import base64
import hashlib
import random
from array import array

import public_tokenizers as P
import pytest
import tiktoken

from garnetflow.llm import rank_queue as Q
from helpers import digest, edge_table, empty_table

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(NAME), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return Q.opened(P.path(NAME), P.PATTERN)


def plain_merge(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The pair of least rank, leftmost, until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_ids_are_the_librarys_on_random_strings(coder, library):
    r = random.Random(2)
    pools = ["abcdefghij  \n", "'stremvd S", "0123456789²½ ,.!", "\t\r\n\x0b\x85  　 a1.", "éüñßİ漢字かな̀ ", "\U0001f600\U0001f468‍́ x", "".join(map(chr, range(0x20, 0x250)))]
    for k in range(6000):
        pool = r.choice(pools) if k % 3 else "".join(pools)
        text = "".join(r.choice(pool) for _ in range(r.randrange(40)))
        assert list(array("I", coder.encode(text))) == library.encode_ordinary(text), repr(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_every_code_point_is_in_the_librarys_class(coder, library):
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    for at in range(0, len(points), 500):
        text = "".join(f"a{chr(c)}1" for c in points[at : at + 500])
        assert list(array("I", coder.encode(text))) == library.encode_ordinary(text)


def test_the_queue_merges_as_the_plain_version(coder):
    r = random.Random(5)
    for _ in range(3000):
        data = bytes(r.choice(r.choice([b"ab", b"etaoin", bytes(range(256))])) for _ in range(r.randrange(1, 60)))
        assert coder.piece(data) == ([coder.ranks[data]] if data in coder.ranks else plain_merge(data, coder.ranks))
    assert coder.queue.top == 0 and not any(coder.queue.buckets + coder.queue.low + coder.queue.mid)  # nothing is left for the next piece


def test_ranks_that_fall_and_equal_ranks_in_two_ways():
    """Merges whose result pairs at a lower rank, and one token that two pairs make."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 301, b"abc": 257, b"aa": 302, b"aaa": 258, b"cab": 256}
    coder = object.__new__(Q.Bpe)
    coder.ranks, coder.queue = ranks, Q.RankQueue(303)
    r = random.Random(7)
    for _ in range(4000):
        data = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 30)))
        assert coder.piece(data) == ([ranks[data]] if data in ranks else plain_merge(data, ranks)), data


def test_ranks_come_in_order_from_the_queue():
    r, queue, held = random.Random(1), Q.RankQueue(200_000), []
    for _ in range(5000):
        if held and r.random() < 0.5:
            held.sort()
            assert (queue.pop(), queue.place) == held.pop(0)
        else:
            item = (r.choice([r.randrange(200_000), r.randrange(70)]), r.randrange(1000))
            queue.push(*item)
            held.append(item)
    assert [(queue.pop(), queue.place) for _ in range(len(held))] == sorted(held)
    assert queue.pop() == -1


@pytest.mark.parametrize("text", ["a" * 60_000, "漢字" * 20_000, "xyZ" * 30_000, "\n" * 40_000, "=-" * 40_000])
def test_very_long_pre_tokens(coder, library, text):
    assert list(array("I", coder.encode(text))) == library.encode_ordinary(text)


def test_table_and_edge_cases(spark, library):
    rows = Q.encode_decode(edge_table(spark)).collect()
    want = []
    for d, t in [(x["doc_id"], x["text"] or "") for x in edge_table(spark).collect()]:
        ids = library.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), digest(t.encode())))
    key = lambda x: (x[0] or -1, x[1:])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert Q.encode_decode(empty_table(spark)).count() == 0
