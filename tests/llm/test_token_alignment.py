from __future__ import annotations

import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from garnetflow.llm import token_alignment as A
from garnetflow.llm.rank_queue import SPACES
from garnetflow.llm.subwords import BYTE_TO_CHAR
from helpers import digest, edge_table, empty_table

BACK = {chr(c): b for b, c in BYTE_TO_CHAR.items()}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def groups_of(text, libraries):
    """The groups of a whole text, encoded at once."""
    a, b = libraries
    if not text:
        return []
    x, y = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    a_bytes = [bytes(BACK[c] for c in t) for t in x.tokens]
    b_bytes = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, b.id_to_piece(y), strict=True)]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return []

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    ends_a, ends_b = ({e: k + 1 for k, e in enumerate(ends(parts))} for parts in (a_bytes, b_bytes))
    out, i, j = [], 0, 0
    for e in sorted(ends_a.keys() & ends_b.keys()):
        to_a, to_b = ends_a[e], ends_b[e]
        out.append((x.ids[i:to_a], y[j:to_b]))
        i, j = to_a, to_b
    return out


def plain(docs, libraries):
    groups = [groups_of(t, libraries) for _, t in docs]
    pairs = Counter((x[-1], y[-1]) for g in groups for x, y in g)
    best = Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    rows = []
    for (d, _), g in zip(docs, groups, strict=True):
        links = [(x[-1], y[-1]) for x, y in g]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        rows.append((d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(pairs[k] == best[k[1]] for k in links), sum(pairs[k] for k in links), digest(text.encode()) if g else ""))
    return rows


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r))


def random_texts(seed, n):
    r = random.Random(seed)
    pools = ["abcdefghij     \n", "'stre vmd S", "0123456789²½ ,.!", "\t\r\n\x0b\x85 　 a1.);{}", "éüñßİ漢字かな̀ ", "\U0001f600\U0001f468‍ x", "<s></s><unk><0x41><|endoftext|> ", "▁ab ", SPACES.replace("-", "") + "ab"]
    return ["".join(r.choice(r.choice(pools) if k % 3 else pools[k % len(pools)]) for _ in range(r.randrange(50))) for k in range(n)]


def test_groups_by_chunks_are_those_of_whole_texts(libraries):
    both = A.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    texts = random_texts(4, 4000)
    for t, (n_a, n_b, sha, links) in zip(texts, both.align(texts), strict=True):
        g = groups_of(t, libraries)
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        assert (n_a, n_b, len(links) // 4, sha) == (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), digest(text.encode()) if g else ""), repr(t)


def test_rows_match_the_plain_version(spark, libraries):
    docs = list(enumerate(random_texts(5, 300) + ["the same text, twice"] * 2 + [" the  end", "a" * 3000, "the " * 2000]))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert order(A.align(table).collect()) == order(plain(docs, libraries))


def test_hot_ids_are_split_and_blocks_cut(spark, libraries, monkeypatch):
    r = random.Random(6)
    docs = [(d, " ".join(r.choice(["the", "of", "The", "theory", ",", "x1", "naïve"]) for _ in range(40))) for d in range(400)]
    monkeypatch.setattr(A, "BLOCK", 700)
    monkeypatch.setattr(A, "HOT", 30)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    A._open.clear()
    out = A.align(table)
    assert order(out.collect()) == order(plain(docs, libraries))


def test_edge_cases(spark, libraries):
    docs = [(x["doc_id"], x["text"]) for x in edge_table(spark).collect()]
    assert order(A.align(edge_table(spark)).collect()) == order(plain(docs, libraries))
    assert A.align(empty_table(spark)).count() == 0
