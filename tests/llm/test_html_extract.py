from __future__ import annotations

import collections
import html as ent
import random
import re
import time

import duckdb
import pytest

from garnetflow.llm import html_extract as op

P = "The first paragraph of the article is about the way in which the text of a page is found, and it is long enough to tell by the words."
Q = "Another long paragraph of the article with the words that the rules count: it is of use to the reader, and that is what we want."

PAGE = f"""<html><head><title>T</title><style>p{{}}</style></head><body class="page"><header><h1>Site</h1><a href=/>home</a></header>
<div id="cookie-notice">We use cookies to improve the site and for the ads that you see on it, as is the way of the web.</div>
<div class="sidebar">Popular in the week: a lot of the things that are here and there in the site, for you to read.</div>
<div class="content"><h2>Title &eacute;tude</h2><p>{P}</p><p>Short   one.</p><p class="ad">Buy it now in the shop!<p>{Q}</p><ul><li>item &amp; one</li><li>item two</li></ul>tail &lt;b&gt; with the end of it</div>
<ul class="x"><li><a href=1>One link</a><li><a href=2>Two link</a></ul><form>Name of the user and the password <input></form>
<section class="comments"><article class="comment">I like the article and the way it is written by the author of it, and so on and so on.</article></section><footer>(c)</footer></body></html>"""


def test_page_without_marked_article():
    assert op.main_text(PAGE).split("\n") == ["Title étude", P, "Short one.", Q, "item & one", "item two", "tail <b> with the end of it"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("<article>Hi <b>there</b><br><br>x &amp; y</article>", "Hi there\nx & y"),
        ("<article>a<br>b</article>", "a b"),
        ("<nav>menu <article><p>kept", "kept"),
        ("<article><p>one</p><aside>no</aside><script>var t='</p>'</script><p>two<!-- x --></article><p>outside", "one\ntwo"),
        ("<main><h1>Head</h1><p>Body text</p></main><footer>f</footer>", "Head\nBody text"),
        ("<article><div class='post-header'><h1>Own head</h1></div><p>Text</p><div class='share-buttons'>Share</div></article>", "Own head\nText"),
        ("<article><p hidden>secret</p><p style='display: none'>x</p><p>seen &#233; &nbsp; &lt;</p></article>", "seen é <"),
        ("<article><p>a<ul><li><a href=x>only link</a></ul><p>b</article>", "a\nb"),
        ("<body><nav><a>x</a></nav><script>unclosed", ""),
    ],
)
def test_small_pages(html, text):
    assert op.main_text(html) == text


def test_second_pass_takes_the_nearest():
    mk = lambda label, heading=False: op.Block(heading=heading, label=label, rule="words")
    blocks = [mk("good"), mk("unsure"), mk("unsure"), mk("unsure"), mk("bad"), mk("unsure", True), mk("good"), mk("unsure")]
    op.second_pass(blocks)
    assert [b.label for b in blocks] == ["good", "good", "good", "bad", "bad", "good", "good", "good"]


def by_paths(rows):
    """Blocks with the containers around each, outermost first."""
    out, was = [], ()
    for label, score, heading, path in rows:
        both = next((k for k, (a, b) in enumerate(zip(was, path, strict=False)) if a != b), min(len(was), len(path)))
        out.append(op.Block(place=path[-1] if path else 0, depth=len(path), low=both, label=label, score=score, heading=heading, rule="words" if label != "unsure" else ""))
        was = path
    return out


def test_own_container_comes_first():
    rows = [("good", 1), ("unsure", 1), ("unsure", 1), ("unsure", 1, 3), ("bad", 2), ("unsure", 2), ("unsure", 4), ("good", 5)]
    blocks = by_paths([(label, 0, False, path) for label, *path in rows])
    op.second_pass(blocks)
    # what only has its own kind around it goes by both sides of the page
    assert [b.label for b in blocks] == ["good", "good", "good", "good", "bad", "bad", "bad", "good"]


def plain_labels(rows):
    """The rule of the second pass read literally: look at every block of each container around."""
    out = []
    for k, (label, score, heading, path) in enumerate(rows):
        if label != "unsure":
            out.append(label)
            continue
        decided = [(i, r) for i, r in enumerate(rows) if r[0] != "unsure"]
        scopes = [[(i, r) for i, r in decided if (r[3][-1:] == path[-1:])]] + [[(i, r) for i, r in decided if c in r[3]] for c in reversed(path)]
        scope = next((s for s in scopes if s), [])
        before, after = [(i, r[0]) for i, r in scope if i < k], [(i, r[0]) for i, r in scope if i > k]
        sides = [*before[-1:], *after[:1]]
        if scope:
            out.append(after[0][1] if heading and after else min(sides, key=lambda x: (abs(x[0] - k), x[1] == "bad"))[1])
        else:
            before, after = [r[0] for i, r in decided if i < k], [r[0] for i, r in decided if i > k]
            out.append("good" if score >= 0 and before and after and before[-1] == after[0] == "good" else "bad")
    return out


@pytest.mark.parametrize("seed", range(5))
def test_second_pass_matches_the_plain_version_at_any_depth(seed):
    r, seen = random.Random(seed), 0
    for _ in range(300):
        rows, path = [], []
        for _ in range(r.randrange(1, 40)):
            for _ in range(r.choice([0, 0, 1, 2, 15])):
                if r.random() < 0.5 and path:
                    path = path[:-1]
                else:
                    seen += 1
                    path = [*path, seen]
            rows.append((r.choice(["good", "bad", *["unsure"] * 4]), r.choice([-1, 0, 1]), r.random() < 0.2, tuple(path)))
        rows.append(("good", 2, False, ()))
        blocks = by_paths(rows)
        op.second_pass(blocks)
        assert [b.label for b in blocks] == plain_labels(rows)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article><p>{P}</p><p>When x < 5 the rule holds, and 3 << 2 too", f"{P}\nWhen x < 5 the rule holds, and 3 << 2 too"),
        (f"<article><p>{P}</p><p>Cut off by the <a href='x", f"{P}\nCut off by the"),
        (f"<article><p>{P}</p><p><!-->Seen<!---> too<!-- not --><!--x--!> at all</p>", f"{P}\nSeen too at all"),
        (f"<article><p>{P}</p><p>a <b title=\"it's>bold</b> word</p></article>", f"{P}\na bold word"),
        *((f"<div><p>{P}{P}</p>{'<div>' * k}<p>Short but real.</p>{'</div>' * k}</div>", f"{P}{P}\nShort but real.") for k in (7, 8, 9, 20, 300)),
    ],
)
def test_no_text_is_lost(html, text):
    assert op.main_text(html) == text


def test_deep_and_long_pages_take_time_in_proportion():
    began = time.process_time()
    op.main_text("<div><p>x</p>" * 20_000 + f"<p>{P}{P}</p>" + "<p>y</p></div>" * 20_000)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("text", [None, "", "<", "<a", "&", "<p>" * 5])
def test_pages_without_text(text):
    assert op.main_text(text or "") in ("", "<", "&")


def test_columns_that_clash(spark):
    rows = [(1, "u", "<article>one</article>", 7, "k"), (1, "u", "<article>one</article>", 7, "k"), (None, None, None, 1, "x"), (2, "v", "", 1, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string")
    assert sorted(map(tuple, op.extract(pages).collect()), key=str) == sorted([(1, "u", "one", 3)] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert op.extract(pages.limit(0)).count() == 0


def test_names_and_links_tell_nothing_of_neighbours():
    blocks = [op.Block(label="bad", rule="names"), op.Block(label="unsure"), op.Block(label="bad", rule="links"), op.Block(label="unsure"), op.Block(label="good", rule="words")]
    op.second_pass(blocks)
    assert [b.label for b in blocks] == ["bad", "good", "bad", "good", "good"]


def rows_of_pages():
    return [h for (h,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()]


def test_each_rule_decides_blocks():
    rules = collections.Counter((b.rule, b.label) for h in rows_of_pages() for b in op.labelled(h))
    assert rules["words", "good"] > 1000 and rules["neighbours", "good"] > 500 and rules["links", "bad"] > 1000 and rules["names", "bad"] > 100
    assert rules["article", "good"] < 100  # what lies in a marked article isn't taken as it is


def test_pages_whose_names_say_nothing():
    """Densities and neighbours alone find nearly all blocks and hardly any other."""
    hit = got = want = same = 0
    for h in rows_of_pages():
        plain = re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(?:nav|article|footer)\b", r"<\1div", h))
        a, b = collections.Counter(op.main_text(plain).split("\n")), collections.Counter(op.main_text(h).split("\n"))
        hit, got, want, same = hit + sum((a & b).values()), got + sum(a.values()), want + sum(b.values()), same + (a == b)
    assert hit >= 0.98 * got and hit >= 0.98 * want and same >= 235


def test_pages_of_the_test_data():
    def marked(html):
        m = re.search(r"<article>(.*?)</article>", html, re.S)
        parts = [" ".join(ent.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", m[1])]
        return "\n".join(p for p in parts if p)

    assert all(op.main_text(h) == marked(h) for h in rows_of_pages())


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "x", "<article>" + "y " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = op.extract(df).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert sorted(r["n_chars"] for r in got)[0] == 0 and max(r["n_chars"] for r in got) == 399_999
    assert op.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("inner", ["<svg-icon name=x></svg-icon>", "<title-bar>", "<style-guide a='1'>", "<template-x></template-x>", "<svg viewBox='0 0 1 1' />", "<svg/>", '<math xmlns="a>b"/>', "<svg\n/>", "<SVG/>"])
def test_names_that_only_begin_like_raw_ones_and_empty_ones(inner):
    assert op.main_text(f"<article><p>one</p>{inner}<p>two</p></article><p>outside") == "one\ntwo"
    assert op.main_text(f"<article><p>one</p>{inner}<p>two</p><svg><text>no</text></svg><p>three</p></article>") == "one\ntwo\nthree"


@pytest.mark.parametrize("inner", ["<svg><text>no</text></svg>", "<svg a=1>no<g/></svg >", "<math>no</math>", "<script>no</script>", "<style\n>no</style>", "<script src=x />no</script>"])
def test_raw_elements_still_go(inner):
    assert op.main_text(f"<article><p>one</p>{inner}<p>two</p></article>") == "one\ntwo"
