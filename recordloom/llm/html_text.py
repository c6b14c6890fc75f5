"""Main text of web pages by two passes of block rules.

The first pass labels each block from its length, its share of stop words and
its share of linked text, inside an article as well as outside; boxes that are
never main text (menus, forms, adverts, comments and so on) are bad as a whole,
and boxes whose names only hint at that must be dense prose to count.  The second
pass gives every block left undecided the label of its nearest decided
neighbours.  Where a page marks its article, blocks outside it are bad; where it
marks nothing, the two passes decide alone (a test takes all class names, ids and
article marks from the given pages and compares).

Every character of a page is looked at a bounded number of times, whatever is
left unclosed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of four languages.
STOP_WORDS = frozenset(
    "the of and to a in is that for on was with as by at from it be are this or an not his her they have which you were "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "le la les de des et en un une du que est pour qui dans par sur pas au plus ne se ce il sont avec elle "
    "el los las y del que se por con para una su al lo como más pero sus o este sí porque esta entre cuando".split()
)

#: Elements that end a block and start another.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p pre blockquote".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
#: Elements that never hold main text.
BOXES = frozenset("head nav aside footer form menu select option button template svg object canvas audio video datalist dialog fieldset".split())
#: Words of a class, id or role that mark such an element, alone or with :data:`PLAIN_WORDS`; beside other words ("social-history") they only hint at it.
BOX_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner sidebar aside widget menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead comment comments reply replies respond discussion disqus cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended recommendations "
    "pagination pager toolbar complementary contentinfo skip copyright disclaimer toc".split()
)
#: Words that say nothing about what is in a box.
PLAIN_WORDS = frozenset("box bar block body bottom btn button buttons col column container content feed form fixed group holder icon icons inner item items left link links list main mobile page panel right row section site sticky text title top wrap wrapper area".split())
#: Words of readers' comments; these mark a box wherever they stand.
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond responses discussion disqus feedback guestbook".split())
#: "header" marks a box only outside the article.
HEADERS = frozenset(["header", "banner", "masthead"])

_NAME = re.compile(r"/?[a-zA-Z][^\s/><]*")
_PLAIN = re.compile(r"""[^<>"']*""")
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: What stands between the entries of a menu or a list of catchwords.
_SEPARATOR = re.compile(r"(?:^|\s)[|·•»›/]+(?=\s|$)")
_MARKS = "#*$%&|<>!?.,;:()[]\"'«»„“”…-–"


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    heading: bool = False
    prose: bool = False  # a paragraph by its element
    article: int = 0  # number of the article it lies in, 0: none
    boxed: bool = False
    hinted: bool = False  # lies in something whose name hints at a box
    text: str = ""


@dataclass
class Marks:
    """What an element's attributes say of it."""

    box: bool = False
    hint: bool = False
    header: bool = False
    talk: bool = False
    hidden: bool = False


def _attributes(raw: str) -> Marks:
    out = Marks()
    for name, value in _ATTR.findall(raw):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            out.hidden = True
        elif name == "aria-hidden":
            out.hidden |= value.lower() == "true"
        elif name == "style":
            out.hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        else:
            for token in value.split():
                words = set(_WORD.findall(_CAMEL.sub(" ", token).lower()))
                found = words & BOX_WORDS
                out.talk |= bool(words & COMMENT_WORDS)
                out.header |= bool(words & HEADERS)
                if found - HEADERS:
                    if words <= BOX_WORDS | PLAIN_WORDS | COMMENT_WORDS or all(w.isdigit() for w in words - BOX_WORDS - PLAIN_WORDS):
                        out.box = True
                    else:
                        out.hint = True
    out.box |= out.talk
    return out


class _Page:
    """Finds tags from left to right.  What it finds out about the rest of the page (no more quotes, no end of a raw element) it keeps."""

    def __init__(self, html: str):
        self.html = html
        self.last = {q: html.rfind(q) for q in "\"'"}
        self.endless: set[str] = set()

    def tag_end(self, at: int) -> tuple[int, int]:
        """Where the attributes from ``at`` on end, and where the page goes on: behind ``>``, or at the next ``<`` that is not in quotes."""
        html = self.html
        while True:
            at = _PLAIN.match(html, at).end()
            if at >= len(html) or html[at] == "<":
                return at, at
            if html[at] == ">":
                return at, at + 1
            # A quote counts behind an equals sign, if it is closed.
            if at < self.last[html[at]] and html[max(0, at - 8) : at].rstrip().endswith("="):
                at = html.find(html[at], at + 1)
            at += 1

    def raw_end(self, name: str, at: int) -> int | None:
        """Behind the end tag of a raw element, None if the page has none."""
        if name in self.endless:
            return None
        end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(self.html, at)
        if not end:
            self.endless.add(name)
            return None
        return self.tag_end(end.end())[1]


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order, with their text decoded and its white space folded.

    A box inside a line (an icon, a button) cuts out its own text; only elements
    that stand as blocks end a block.
    """
    out: list[Block] = []
    now = Block()
    stack: list[tuple[str, bool, int, bool, bool]] = []  # element, whether inside a box, article number, whether an article may not end the box, whether hinted
    open_names: dict[str, int] = {}  # how often each element stands in the stack, so that a stray end tag costs no walk through it
    links = breaks = articles = 0
    at = 0
    page = _Page(html)

    def leave(depth: int) -> None:
        for name, *_ in stack[depth:]:
            open_names[name] -= 1
        del stack[depth:]

    def close(name: str = "") -> None:
        nonlocal now
        now.text = " ".join("".join(now.parts).split())
        if now.text:
            out.append(now)
        _, boxed, article, _, hinted = stack[-1] if stack else ("", False, 0, False, False)
        now = Block(heading=name in HEADINGS, prose=name in PROSE, boxed=boxed, article=article, hinted=hinted)

    def say(raw: str) -> None:
        nonlocal breaks
        if raw.strip():
            breaks = 0
        if stack and stack[-1][1] and not now.boxed:
            now.parts.append(" ")  # a box inside a line
            return
        text = unescape(raw) if "&" in raw else raw
        now.parts.append(text)
        if links:
            now.linked += len("".join(text.split()))

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            say(html[at:])
            break
        if html.startswith("<!--", start):
            behind = html.find("-->", start + 4) + 3 if html.find("-->", start + 4) >= 0 else len(html)
            tag = None
        elif html.startswith(("<!", "<?"), start):
            behind = html.find(">", start) + 1 or len(html)
            tag = None
        else:
            tag = _NAME.match(html, start + 1)
            if not tag:
                say(html[at : start + 1])
                at = start + 1
                continue
        if start > at:
            say(html[at:start])
        if not tag:
            at = behind
            continue
        stop, at = page.tag_end(tag.end())
        attributes = html[tag.end() : stop]
        ends = tag[0].startswith("/")
        name = tag[0].lstrip("/").lower()
        if name == "br":
            now.parts.append(" ")
            breaks += 1
            if breaks > 1:
                close("h1" if now.heading else "p" if now.prose else "")
            continue
        if ends:
            if name == "a":
                links = max(0, links - 1)
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1) if open_names.get(name) else -1
            if name in BLOCKS:
                if depth >= 0:
                    leave(depth)
                close()
            elif depth >= 0 and (depth == len(stack) - 1 or all(x[0] not in BLOCKS for x in stack[depth:])):
                leave(depth)
                if now.boxed and not (stack and stack[-1][1]):
                    close()  # a block inside the box had made it the box's
            continue
        if name in RAW:
            end = page.raw_end(name, at)
            at = end if end is not None else len(html) if name in ("script", "style") else at
            now.parts.append(" " if name in ("textarea", "iframe") else "")
            continue
        if name in VOID:
            if name in BLOCKS:
                close()
            continue
        if name == "a":
            links += 1
            continue
        _, boxed, article, sealed, hinted = stack[-1] if stack else ("", False, 0, False, False)
        marks = _attributes(attributes) if attributes.strip() else Marks()
        outer = boxed
        if name in ("article", "main") and not marks.talk and not marks.hidden and not sealed:
            boxed = False  # the box before it was never closed
            if not article:
                articles += 1
                article = articles
        elif name not in ("html", "body"):
            boxed = boxed or marks.hidden or name in BOXES or marks.box or ((name == "header" or marks.header) and not article)
            hinted = hinted or marks.hint
        if name == "p" and stack and stack[-1][0] == "p":
            leave(len(stack) - 1)
        if name in BLOCKS or boxed != outer:
            stack.append((name, boxed, article, sealed or marks.talk or name in ("aside", "footer", "nav", "form"), hinted))
            open_names[name] = open_names.get(name, 0) + 1
            if name in BLOCKS:
                links = 0
                close(name)
    close()
    return out


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(_MARKS) in STOP_WORDS for w in words) / len(words) if words else 0.0


def labels(blocks: list[Block], short: int = 70, long: int = 200, stop_low: float = 0.05, stop_high: float = 0.12, most_linked: float = 0.33) -> list[bool]:
    """Which blocks are main text."""
    sizes = [len(b.text) for b in blocks]
    shares = [stop_share(b.text) for b in blocks]
    inside = sum(n for n, b in zip(sizes, blocks, strict=True) if b.article and not b.boxed)
    only_inside = inside > 0
    # Stop words tell something about an article only if its text as a whole has them: it may be in another language.
    known = sum(n * s for n, s, b in zip(sizes, shares, blocks, strict=True) if b.article and not b.boxed) >= stop_low * inside
    first: list[bool | None] = []
    for n, stops, b in zip(sizes, shares, blocks, strict=True):
        linked = b.linked / max(1, len(b.text.replace(" ", "")))
        if b.boxed or (only_inside and not b.article) or (linked > most_linked and not (b.heading and b.article)):
            first.append(False)
        elif b.hinted and not (n >= short and stops >= stop_high):
            first.append(False)
        elif b.article:
            # A list of catchwords that is no paragraph: no stop words, and a separator for every four words or fewer.
            if known and stops < stop_low and n >= short and not (b.heading or b.prose) and 4 * len(_SEPARATOR.findall(b.text)) >= len(b.text.split()):
                first.append(False)
            else:
                first.append(True if stops >= stop_low or (n >= short and not known) else None)
        elif n < short:
            first.append(False if linked > 0 and not b.heading else None)
        elif stops >= stop_high:
            first.append(True if n >= long else None if stops < 2 * stop_high else True)
        else:
            first.append(None if stops >= stop_low or n >= long else False)
    # The nearest decided neighbour on each side, not looking into boxes.
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    last = None
    for k in range(n):
        before[k] = last
        if first[k] is not None and not blocks[k].boxed:
            last = (k, first[k])
    last = None
    for k in range(n - 1, -1, -1):
        after[k] = last
        if first[k] is not None and not blocks[k].boxed:
            last = (k, first[k])
    out = []
    for k, b in enumerate(blocks):
        if first[k] is not None:
            out.append(first[k])
            continue
        near = [x for x in (before[k], after[k]) if x]
        if b.article:
            same = [x for x in near if blocks[x[0]].article == b.article] or [(k, True)]
            out.append(any(good for _, good in same))
        elif not near:
            out.append(sizes[k] >= short)
        elif b.heading and after[k]:
            out.append(after[k][1])
        else:
            least = min(abs(x[0] - k) for x in near)
            out.append(all(good for at, good in near if abs(at - k) == least))
    return out


def main_text(html: str) -> tuple[str, int, int]:
    """The main text, how many blocks the page has, and how many of them are kept."""
    blocks = blocks_of(html)
    kept = [b.text for b, good in zip(blocks, labels(blocks), strict=True) if good]
    return "\n".join(kept), len(blocks), len(kept)


def extract(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept``: one row per row of ``pages``.

    Null and empty pages have the empty text.  Pages are read whole, however
    long; repeated rows stay; an empty table gives no rows; other columns are
    ignored.  One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(2).cast(pa.large_string())
            found = [main_text(pages[k].as_py() or "") for k in range(len(pages))]
            columns = [batch.column(0), batch.column(1), pa.array([t for t, _, _ in found], pa.string())]
            columns += [pa.array([len(t) for t, _, _ in found], pa.int64()), pa.array([a for _, a, _ in found], pa.int64()), pa.array([b for _, _, b in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
