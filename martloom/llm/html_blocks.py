"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass decides the blocks it can: those
below an element that says by its tag, role, class or id what it is (menus, footers, adverts,
notices, comments and the like) are bad; others by length, share of stop words and share of linked
text. Headings, short blocks and blocks with a middling share of stop words stay undecided; the
second pass gives them the label of the nearest neighbour in page order that the rules on text
have decided, of the same part of the page. If a page marks its article, blocks outside are bad, and blocks inside are bad only
for what they are (a list of links, a box within it): an article's short paragraphs are text.

Kept blocks are whole: character references are decoded, white space runs become one space, and
blocks follow in page order with an empty line between them. A single ``br`` is white space, two
or more in a row end a block. Parsing is one pass over the page with a stack of open elements; it
takes any string, as unclosed or stray tags close where a browser closes them, or nowhere.

Defined cases: null or empty html gives an empty text, as does a page without any kept block; a
page of one block, as one without markup, keeps it unless an element says it is no text; an unfinished tag at the end is dropped, an
unfinished comment, script or style as well; rows that repeat are extracted row by row. Other
columns are not read.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import in_arrow, sliced

SHORT = 70  # code points below which a block is undecided
LONG = 200  # from here on a block needs fewer stop words to be good
# Shares of stop words from which a block is good, and below which it is bad. Prose has 0.3 and
# more; texts of several languages in one list of words, or with many invented names, have less.
STOPWORDS_HIGH, STOPWORDS_LOW = 0.15, 0.05
LINKED = 0.5  # share of a block's text that stands in links

EXTRACTED = "page_id bigint, url string, text string, n_chars bigint"

# Frequent function words of English, German, French and Spanish.
STOPWORDS = frozenset(
    """
    a about after all also an and are as at be been but by can for from had has have he her his
    i if in into is it its more no not of on one or our out she so some than that the their them
    there they this to up was we were what when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine
    einem einen einer er es für hat ich ihr im in ist ja kann mit nach nicht noch nur oder sich sie
    sind so über um und uns vom von vor war was wenn wie wir wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me
    ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre era es esta este ha hasta hay la las lo los más me mi muy
    ni no nos o para pero por que se ser si sin sobre son su sus también un una y ya
    """.split()
)

# Element names of the markup language by what they mean here.
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
    nav ol option p pre section summary table tbody td tfoot th thead title tr ul
    """.split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noframes noembed iframe xmp".split())  # no markup inside
DROPPED = frozenset(
    """
    script style textarea noframes noembed iframe xmp head title noscript template svg math canvas
    audio video object map nav footer aside form button select option datalist dialog menu
    """.split()
)
MAIN_ROLES = {"article": 2, "main": 1}
BAD_ROLES = frozenset(
    """
    alert alertdialog banner complementary contentinfo dialog directory form menu menubar navigation
    search status toolbar
    """.split()
)
BAD_NAMES = frozenset(
    """
    ad ads adbox advert adverts advertisement advertisements advertising adsense banner banners
    breadcrumb breadcrumbs byline captcha comment comments commentlist consent cookie cookies
    copyright dialog disclaimer disqus dropdown feedback footer footers form gdpr header headers
    login masthead menu menus modal nav navbar navigation newsletter notice notices notification
    notifications outbrain overlay pager pagination popup popups promo promos promoted promotion
    recommended recommendations related replies respond search share sharing sidebar sidebars signin
    signup skip social sponsor sponsored sponsors subscribe subscription taboola tagcloud toolbar
    topbar widget widgets
    """.split()
)
NEGATING = frozenset("has with without no hide hides show shows is".split())

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_EDITED = frozenset("body html article main pre code h1 h2 h3 h4 h5 h6".split())  # never bad by name
_P_STAYS = frozenset("body html head title option".split())

_TAG = re.compile(r"""</?([A-Za-z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    bad: bool = False  # below an element that is no main text
    part: int = 0  # 2 in an article, 1 in main, 0 elsewhere
    heading: bool = False
    listed: bool = False  # in a list or table
    text: str = ""


def _bad_names(value: str) -> bool:
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        for i, word in enumerate(words):
            if word in BAD_NAMES and not (i and words[i - 1] in NEGATING):
                return True
    return False


def _is_bad(name: str, attributes: str, part: int) -> tuple[bool, str]:
    """Whether the element holds no main text, and its role."""
    if name in DROPPED:
        return True, ""
    bad, role = name == "header" and part == 0, ""
    if attributes and name not in ("br", "img"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "role":
                role = value.strip().lower()
                bad = bad or (role in BAD_ROLES and name not in _EDITED)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                bad = bad or name not in ("body", "html")
            elif key == "style":
                bad = bad or bool(_HIDDEN.search(value))
            elif name not in _EDITED:
                bad = bad or _bad_names(value)
    return bad, role


class _Page:
    """Blocks of a page, from its tags and texts in order."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, bool, int, bool]] = []  # name, bad, part, a block's border
        self.open: Counter[str] = Counter()
        self.links = self.breaks = self.listed = self.code = 0
        self.bad, self.part = False, 0
        self.block: Block | None = None

    def text(self, raw: str) -> None:
        if not raw:
            return
        if self.block is None:
            if raw.isspace():
                return
            self.block = Block(
                bad=self.bad, part=self.part, listed=self.listed > 0,
                heading=any(self.open[h] for h in _HEADINGS),
            )
            self.blocks.append(self.block)
        if self.links:
            self.block.linked += len(raw.strip())
        if not raw.isspace():
            self.breaks = 0
        self.block.parts.append(raw)

    def border(self) -> None:
        self.block, self.breaks = None, 0

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.block = None
            elif self.block:
                self.block.parts.append(" ")
            return
        if name == "body" and self.open["head"]:
            self.end("head")  # an unclosed head does not hide the page
        bad, role = _is_bad(name, attributes, self.part) if not self.code else (name in DROPPED, "")
        block = name in BLOCKS or bad
        if block:
            self.border()
            if name in BLOCKS and name not in _P_STAYS and self.open["p"]:
                self.end("p")
        if name in ("li", "dd", "dt", "tr", "td", "th", "option") and self.stack and self.stack[-1][0] == name:
            self.end(name)
        if name in VOID or (attributes.endswith("/") and name not in BLOCKS and name != "a"):
            return
        self.stack.append((name, self.bad, self.part, block))
        self.open[name] += 1
        self._count(name, 1)
        self.bad = self.bad or bad
        self.part = max(self.part, MAIN_ROLES.get(name, 0), MAIN_ROLES.get(role, 0))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.border()
        if not self.open[name]:
            return
        # a stray inline end tag does not close the blocks around it
        while self.stack:
            top, bad, part, block = self.stack[-1]
            if top != name and name not in BLOCKS and top in BLOCKS:
                return
            self.stack.pop()
            self.open[top] -= 1
            self._count(top, -1)
            self.bad, self.part = bad, part
            if block:
                self.border()
            if top == name:
                return

    def _count(self, name: str, by: int) -> None:
        if name == "a":
            self.links += by
        elif name in ("ul", "ol", "table", "dl"):
            self.listed += by
        elif name in ("pre", "code"):
            self.code += by


def blocks(page: str) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    found, at, simple = _Page(), 0, False
    lowered: str | None = None
    while True:
        start = page.find("<", at)
        if start < 0:
            found.text(page[at:])
            break
        following = page[start + 1 : start + 2]
        if following in "!?" and following:
            found.text(page[at:start])
            comment = page.startswith("<!--", start)
            end = page.find("-->", start + 2) if comment else page.find(">", start)
            if end < 0:
                break
            at = end + (3 if comment else 1)
            continue
        closing = following == "/"
        letter = page[start + 2 : start + 3] if closing else following
        if not (letter.isascii() and letter.isalpha()):
            if closing and letter:  # a browser takes it for a comment
                found.text(page[at:start])
                end = page.find(">", start)
                if end < 0:
                    break
                at = end + 1
            else:
                found.text(page[at : start + 1])
                at = start + 1
            continue
        found.text(page[at:start])
        tag = None if simple else _TAG.match(page, start)
        if tag:
            name, attributes, at = tag[1].lower(), tag[2], tag.end()
        else:
            simple = True  # a quote without its partner: from here on each > ends a tag
            end = page.find(">", start)
            if end < 0:
                break
            words = page[start + 1 + closing : end].split(None, 1)
            name, attributes, at = words[0].rstrip("/").lower(), words[1] if len(words) > 1 else "", end + 1
        if closing:
            found.end(name)
            continue
        found.start(name, attributes)
        if name in RAW and found.stack and found.stack[-1][0] == name:
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == len(page) else page
            end = lowered.find(f"</{name}", at)
            if end < 0:
                break
            at = end
    kept = []
    for block in found.blocks:
        block.text = " ".join(references.unescape("".join(block.parts)).split())
        if block.text:
            kept.append(block)
    return kept


def first_pass(block: Block, marked: bool) -> bool | None:
    """True for main text, False for none, None where neighbours have to tell."""
    if block.bad or (marked and not block.part):
        return False
    n = len(block.text)
    linked = min(block.linked / n, 1.0)
    if block.part and not (block.listed and linked > LINKED):
        return True if n >= SHORT and not block.heading else None
    if linked > LINKED:
        return False
    if block.heading or n < SHORT:
        return False if "©" in block.text else None
    words = _WORD.findall(block.text.lower())
    share = sum(w in STOPWORDS for w in words) / max(len(words), 1)
    if share >= (STOPWORDS_LOW if n >= LONG else STOPWORDS_HIGH):
        return True
    return None if share >= STOPWORDS_LOW or not block.text.isascii() else False


def second_pass(labels: list[bool | None], page: list[Block]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one of their part of the page; of
    two at one distance the following one for a heading, else the one that is main text. Where
    the first pass found no main text at all, what it left undecided is all there is."""
    if True not in labels:
        return [label is None for label in labels]
    before, after = _decided(labels, page, 1), _decided(labels, page, -1)
    out = []
    for i, (label, block) in enumerate(zip(labels, page, strict=True)):
        if label is None:
            a, b = before[i], after[i]
            if a is None and b is None:
                label = True
            elif a is None or b is None:
                label = labels[b if a is None else a]
            elif i - a != b - i:
                label = labels[a if i - a < b - i else b]
            else:
                label = labels[b] if block.heading else labels[a] or labels[b]
        out.append(bool(label))
    return out


def _decided(labels: list[bool | None], page: list[Block], step: int) -> list[int | None]:
    """For each block the nearest decided one before it (step 1) or after it (-1) in its part. A
    box known by its element says nothing about the text around it, so it is not asked."""
    last: dict[bool, int] = {}
    out: list[int | None] = [None] * len(page)
    order = range(len(page)) if step == 1 else range(len(page) - 1, -1, -1)
    for i in order:
        inside = page[i].part > 0
        out[i] = last.get(inside)
        if labels[i] is not None and not page[i].bad:
            last[inside] = i
    return out


def main_text(page: str) -> str:
    """The main text of one page."""
    found = blocks(page)
    articles = any(b.part == 2 and not b.bad for b in found)
    marked = articles or any(b.part and not b.bad for b in found)
    labels = [first_pass(b, marked) for b in found]
    if len(found) == 1 and not found[0].bad:
        labels = [True]
    return "\n\n".join(b.text for b, good in zip(found, second_pass(labels, found), strict=True) if good)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            texts = [main_text(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    own = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return in_arrow(own, run, EXTRACTED)
