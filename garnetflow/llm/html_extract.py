"""Main text of web pages by two passes over their blocks.

A scan of the tags yields every block of text outside scripts, styles, forms and hidden parts, with its link characters, the
containers around it, and what names say: that it lies in a marked article, outside the article of a page that
marks one, or in a part that names itself as something else (navigation, page header and footer, aside, or a class, id
or role from NOT_MAIN). The first pass scores blocks by link density, stop-word density and length; names only shift the
score. Blocks that stay between the thresholds are unsure, and the second pass gives them the label of the nearest block that
its words have decided: in their own container, else in the smallest container around it that has one; with none but the
page itself around, text on both sides must be good. Link lists and parts that name themselves tell nothing of their neighbours.

Cases: null html counts as empty; a page without main text gives an empty text; unclosed tags end with their
parents; repeated pages each give a row; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts_of, tidy

SCHEMA = "page_id long, url string, text string, n_chars long"

# What HTML says of its elements.
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|xmp|noembed|noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("form button select option datalist object canvas audio video map applet fieldset label head".split())
NAMED = set("nav footer aside dialog menu".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = set("article aside center dd div footer form header main nav section table td th".split())
SELF_CLOSING = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
NOT_MAIN = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner billboard sponsor sponsored sponsors promo promos promotion promoted outbrain taboola "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toc skip skiplink "
    "header masthead topbar toolbar footer foot footnav copyright colophon legal "
    "sidebar sidebars aside rail widget widgets related recommended recommendations recirc trending popular "
    "cookie cookies consent gdpr notice notices alert alerts popup modal overlay paywall disclaimer toast "
    "newsletter subscribe subscription signup login register search searchbox form share sharing social follow "
    "comment comments commentlist respond reply replies disqus discussion feedback".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
#: With these beside it, the word header names the article's own head.
OWN = set("article post entry content story main page".split())
STOP_WORDS = set(
    "the of and to in is it that for as with be on at by this not are was were or an from but have has had they you he she we his her its their which will would can all there been if more when who what so no "
    "le la les de des du et en un une que qui dans pour par sur pas au aux est sont avec ce ces cette il elle ils elles nous vous ne se plus mais ou son sa ses leur "
    "der die das und ist nicht ein eine einer eines einem einen zu den dem des mit von auf für im sich auch als an es er sie wir ihr bei aus nach wie oder wird war sind hat "
    "el los las y del una unos por con para su sus al lo como más pero o este esta estos entre cuando muy sin sobre también me hay donde quien desde todo nos "
    "il gli di che è non per una sono con del della da dei nel alla o e i os um uma não com em na no se het een van niet zijn op te dat voor met".split()
)
#: Characters, shares of characters and of words.
SHORT, LONG, LINKED, STOPPED = 70, 200, 0.33, 0.08

_tag = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?:svg|math)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*/>|<({RAW})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|<[!?/][^>]*>", re.S | re.I)
_unfinished = re.compile(r"<[a-zA-Z!?/]")
_attribute = re.compile(r"(class|id|role|itemtype|hidden|aria-label|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\s(hidden)(?=[\s/>]|\Z)", re.I)
_part = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_word = re.compile(r"\w+")
_space = re.compile(r"\s+")


@dataclass
class Block:
    own: bool = False  # within an article that the page marks
    other: bool = False  # within a part that names itself as something else
    heading: bool = False
    place: int = 0  # the smallest container around it; 0 is the page
    depth: int = 0  # how many containers are around it, without the page
    low: int = 0  # the least number of containers that were open since the block before it: those that hold both
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    text: str = ""
    score: int = 0
    label: str = ""
    rule: str = ""  # what decided: links, names, words, neighbours, article


def _says(name: str, attributes: str, in_article: bool) -> str:
    """What an element says of itself: "skip" for hidden parts and controls, "other" for what isn't main text, or nothing."""
    if name in SKIPPED:
        return "skip"
    said = "other" if name in NAMED or name == "header" and not in_article else ""
    for m in _attribute.finditer(attributes) if "=" in attributes or "hidden" in attributes else ():
        if m[5]:
            return "skip"
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "style" and re.search(r"display\s*:\s*none", value):
            return "skip"
        if key == "role" and value.strip().lower() in ROLES or key == "itemtype" and value.lower().endswith("/comment"):
            said = "other"
        if key in ("class", "id") and name not in ("html", "body", "main"):
            for one in value.split():
                parts = {p.lower() for p in _part.findall(one)}
                found = parts & NOT_MAIN
                if found and not (found <= {"header", "page", "legal"} and parts & OWN) and not (name == "article" and not found & {"comment", "comments", "reply", "ad", "ads", "advert", "related", "sponsored", "promo"}):
                    said = "other"
    return said


def blocks_of(html: str) -> list[Block]:
    """The page's blocks outside scripts, styles, forms and hidden parts."""
    out, stack, at = [], [], 0  # stack: name, skipped, other, article
    skipped = other = article = linked = 0
    places, seen, low = [0], 0, 0  # the containers that are open, how many there have been, the least since the last block
    block = Block()

    def close() -> None:
        nonlocal block, low
        block.text = _space.sub(" ", unescape("".join(block.parts))).strip()
        if block.text:
            block.low = min(low, block.depth)
            low = block.depth
            out.append(block)
        block = Block(article > 0, other > 0)

    def pop(k: int) -> None:
        nonlocal skipped, other, article, low
        for n, s, o, a in stack[k:]:
            skipped -= s
            other -= o
            article -= a
            if n in CONTAINERS:
                places.pop()
        low = min(low, len(places) - 1)
        del stack[k:]

    breaks = 0
    for m in _tag.finditer(html):
        if m.start() > at and not skipped:
            piece = html[at : m.start()]
            block.parts.append(piece)
            if linked:
                block.links.append(piece)
            if not piece.isspace():
                block.place, block.depth = places[-1], len(places) - 1
                breaks = 0
        at = m.end()
        if m[4] is None:
            if m[0].startswith("<![CDATA[") and not skipped:
                block.parts.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue  # comments, scripts, declarations
        name, end = m[4].lower(), bool(m[3])
        if name == "a":
            linked = 0 if end else 1
        if name == "br" and not skipped:
            breaks += 1
            block.parts.append(" ")
            if breaks == 2:
                close()
                breaks = 0
            continue
        if name in BLOCKS:
            if not skipped:
                close()
            breaks = 0
            if not end:
                while stack and name in SELF_CLOSING.get(stack[-1][0], ()):
                    pop(len(stack) - 1)
        if name in VOID:
            continue
        if end:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if k is not None:
                if stack[k][2] and not skipped and name not in BLOCKS:
                    close()  # an inline part that names itself ends
                pop(k)
                block.own, block.other = article > 0, other > 0
            continue
        main = name in ("article", "main")
        says = _says(name, m[5], article > 0 or main)
        if main and (skipped or other) and not says:
            # an article within navigation, a page header or footer that nothing has closed
            k = next((k for k, x in enumerate(stack) if x[1] or x[2]), 0)
            if stack[k][0] in ("nav", "header", "footer", "form", "menu"):
                pop(k)
        if says == "other" and not skipped and name not in BLOCKS:
            close()  # an inline part that names itself is a block of its own
        if name in BLOCKS or says or skipped or main:
            stack.append((name, int(says == "skip"), int(says == "other"), int(main and not says and not skipped and not other)))
            if name in CONTAINERS:
                seen += 1
                places.append(seen)
            _, s, o, a = stack[-1]
            skipped, other, article = skipped + s, other + o, article + a
        block.own, block.other = article > 0, other > 0
        block.heading = name in ("h1", "h2", "h3", "h4", "h5", "h6") or block.heading
    if not skipped:
        rest = _unfinished.split(html[at:], maxsplit=1)[0]  # a tag that the page's end cuts off is no text
        if rest and not rest.isspace():
            block.place, block.depth = places[-1], len(places) - 1
        block.parts.append(rest)
        if linked:
            block.links.append(rest)
    close()
    return out


def _links(block: Block) -> int:
    return len(_space.sub(" ", "".join(block.links)).strip())


def first_pass(block: Block, marked: bool) -> None:
    """Scores a block and labels it good from 2, bad to -2, else unsure. marked: the page marks an article."""
    text, n, links = block.text, len(block.text), _links(block)
    if links > LINKED * n and (links > 0.8 * n or n < LONG):
        words = -3
    elif n < SHORT or block.heading:
        words = 0
    else:
        found = _word.findall(text.lower())
        stopped = sum(w in STOP_WORDS for w in found) / max(1, len(found))
        if stopped >= STOPPED or len(found) < n / 30:  # writing without spaces has no stop words to count
            words = 2 if n >= LONG else 1
        else:
            words = -1
    named = -3 if block.other else 1 if block.own else -1 if marked else 0
    block.score = max(-3, min(3, words)) + named
    block.label = "good" if block.score >= 2 else "bad" if block.score <= -2 else "unsure"
    if block.label != "unsure":
        block.rule = "links" if words == -3 else "names" if block.other else "words"


def second_pass(blocks: list[Block]) -> None:
    """Blocks that are unsure take the label of the nearest block that its words have decided, those of their own container first.

    A heading takes the label of what follows it; of two that are equally near the good one wins. Without a decided
    block in the containers around it a block is good if the nearest on both sides of the page are, or if it lies in the
    marked article and has no links.
    """
    if not any(b.label == "good" for b in blocks):
        # no long block of prose: the container with the most text that may be some stands for it
        may = max((b.score for b in blocks if b.label == "unsure" and not b.heading), default=0)
        most: dict[int, int] = {}
        for b in blocks:
            if b.label == "unsure" and b.score == may and not _links(b):
                most[b.place] = most.get(b.place, 0) + len(b.text)
        best = max(most, key=lambda p: most[p], default=None)
        for b in blocks:
            if b.place == best and b.label == "unsure" and b.score == may and not _links(b):
                b.label, b.rule = "good", "words"
    sides = _nearest(blocks), _nearest(blocks, -1)
    for k, b in enumerate(blocks):
        if b.label != "unsure":
            continue
        b.rule = "neighbours"
        own, around = [side[k][0] for side in sides], [side[k][1] for side in sides]
        held = max((depth for depth, _, _ in filter(None, around)), default=0)
        # the blocks of its own container, else of the smallest container around it that has one
        ahead, behind = own if any(own) else [x[1:] if x and x[0] == held else None for x in around]
        found = [x for x in (ahead, behind) if x]
        if any(own) or held:
            b.label = behind[1] if b.heading and behind else min(found, key=lambda x: (abs(x[0] - k), x[1] == "bad"))[1]
        elif b.score >= 0 and len(found) == 2 and ahead[1] == behind[1] == "good":
            b.label = "good"
        else:
            b.label, b.rule = ("good", "article") if b.own and not _links(b) else ("bad", "neighbours")


def _nearest(blocks: list[Block], step: int = 1) -> list[tuple]:
    """For each block that is unsure, the last decided block of its own container (place, label), and the last of all with the
    number of containers that hold both (containers, place, label). A container is a stretch of the page, so if it holds any
    decided block on this side, it holds the last one.
    """
    out: list[tuple] = [()] * len(blocks)
    own: dict[int, tuple[int, str]] = {}
    last, shared = None, 0
    for k in range(len(blocks))[::step]:
        b = blocks[k]
        if step > 0:
            shared = min(shared, b.low)
        elif k + 1 < len(blocks):
            shared = min(shared, blocks[k + 1].low)
        if b.label == "unsure":
            out[k] = own.get(b.place), last and (min(shared, b.depth), *last)
        elif b.rule == "words":
            own[b.place] = last = k, b.label
            shared = b.depth
    return out


def labelled(html: str) -> list[Block]:
    """All blocks of a page with their labels and the rules that gave them."""
    blocks = blocks_of(html)
    marked = any(b.own for b in blocks)
    for b in blocks:
        first_pass(b, marked)
    second_pass(blocks)
    return blocks


def main_text(html: str) -> str:
    return "\n".join(b.text for b in labelled(html) if b.label == "good")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, main text and its number of code points of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [c.split()[0] for c in SCHEMA.split(", ")])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(tidy(run), SCHEMA)
