"""Main text of web pages by scoring the tree of elements (operator 3).

Every block of text (paragraph, heading, list item, ...) earns points for
being there, for its length and for its commas, less the share of it that is in
links. Its container receives the points, each further ancestor half of what
the one below received. An element's score is discounted by the share of its
text that is in links and counts more if it is called article or main. From the
best element the choice climbs while an ancestor adds text of the same article.
The chosen one is kept with those of its siblings that score well themselves or
are plain paragraphs and headings. Elements whose role is not text (menus,
headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles)
neither score nor come along; a form that holds the article, or of which most is
paragraphs of it, is no such form. Words that a heading, paragraph or section of an
article may well be about count there only if its structure bears them out.

Both passes, over the page and over the tree, take linear time: a quoted value
starts only after `=`, an unclosed tag ends at the next `<`, and what is open
is looked up, not searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import mapped, slices

NAME = re.compile(r"[a-zA-Z][^\s/<>]*")
ATTRIBUTE = re.compile(r"[^\s/<>=][^\s/<>=]*")
GAP = re.compile(r"[\s/]*")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s<>]*")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dd dt td th figcaption caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = frozenset("article section div ul ol table dl header".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag ends open elements of these names, up to the nearest of the second.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
FIELDS = frozenset("form input textarea select button".split())
DROPPED = frozenset("nav footer aside form button dialog menu head noscript template svg math select object".split())
#: Words of class, id or role whose element isn't text, wherever it stands ...
PLAIN_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup disqus breadcrumb breadcrumbs pagination pager subscribe newsletter comment comments".split())
#: ... and those that a heading, paragraph or section may be about or that may name a part of its layout.
LOOSE_WORDS = frozenset("banner alert modal overlay nav navbar navigation menu sidebar rail footer header masthead toolbar reply replies respond related recommended share sharing social subscription signup login search widget complementary contentinfo".split())
#: "with-sidebar" and "comments-open" say something of a layout, not what the element is.
MODIFIERS = frozenset("has with no without not is free open opened closed enabled disabled off".split())
#: Words that tell nothing beside one of the above; a name with another one, as "related-work", may be what an article is about.
GENERIC = frozenset("this that now all more top bottom left right main inner outer wrap wrapper box container block area holder slot unit inline list lists item items bar row col column panel section site page pages post posts entry article articles stories news text content contents body title link links button buttons icon icons form thread module component group js css ui".split())
#: Elements within a line that aren't text: what stands around them is one block.
MUTED = frozenset("svg math button select object".split())
LAYOUT = frozenset("sidebar rail nav navbar navigation menu header footer banner masthead toolbar widget".split())
ABOUT = HEADINGS | {"section", "p"}
SINGLE = frozenset("allowfullscreen async autofocus autoplay checked controls default defer disabled formnovalidate hidden inert ismap itemscope loop multiple muted nomodule novalidate open playsinline readonly required reversed selected".split())
KNOWN = INLINE | VOID | RAW | TEXT_BLOCKS | GROUPS | CLOSES_P | FIELDS | DROPPED | {"html", "body", "tr", "tbody", "thead", "tfoot", "option", "audio", "video", "canvas", "picture", "map", "colgroup", "optgroup", "legend", "meter", "output", "progress", "summary", "hgroup", "slot", "search"}


class Element:
    __slots__ = ("name", "parent", "block", "unwanted", "doubtful", "layout", "holds_main", "fields", "dropped", "points", "received", "length", "linked", "articles", "kept")

    def __init__(self, name: str, parent: Element | None, unwanted: bool = False, doubtful: bool = False, layout: bool = False):
        self.name, self.parent, self.unwanted, self.doubtful, self.layout = name, parent, unwanted, doubtful, layout
        self.block: Element = parent.block if parent is not None and name in INLINE else self
        self.holds_main = self.fields = self.dropped = self.kept = False
        self.points = self.received = 0.0
        self.length = self.linked = self.articles = 0

    @property
    def value(self) -> float:
        bonus = {"article": 2.5, "main": 1.5}.get(self.name, 1.0)
        return self.received * (1 - self.linked / max(self.length, 1)) * bonus


def tags(html: str) -> Iterator[tuple[int, int, str, bool, dict[str, str]]]:
    """Start, end, name, whether it closes and attributes of every tag; comments and raw contents come under the name ''."""
    last = {'"': html.rfind('"'), "'": html.rfind("'")}
    unended: set[str] = set()  # raw elements that don't end from here on
    lowered = html.lower() if html.isascii() else re.sub(r"[A-Z]+", lambda m: m[0].lower(), html)  # offsets stay
    at = html.find("<")
    while at >= 0:
        c = html[at + 1 : at + 2]
        if c in ("!", "?"):
            if html.startswith("<!--", at):
                end = at + 5 if html.startswith("<!-->", at) else html.find("-->", at + 4) + 3
                end = end if end > at + 4 else len(html)
            else:
                end = (html.find("]]>", at) + 3) if html.startswith("<![CDATA[", at) else html.find(">", at) + 1
                end = end if end > at + 2 else len(html)
            yield at, end, "", False, {}
            at = html.find("<", end)
            continue
        closes = c == "/"
        m = NAME.match(html, at + 1 + closes)
        if not m:
            at = html.find("<", at + 1)
            continue
        name, attributes, at_end = m[0].lower(), {}, m.end()
        bare: list[str] = []
        while True:
            at_end = GAP.match(html, at_end).end()
            if at_end >= len(html) or html[at_end] in "<>":
                break
            m = ATTRIBUTE.match(html, at_end)
            if not m:  # a lone =
                at_end += 1
                continue
            key, at_end = m[0].lower(), m.end()
            if e := EQUALS.match(html, at_end):
                at_end = e.end()
                quote = html[at_end : at_end + 1]
                if quote in last and quote and last[quote] > at_end:
                    close = html.find(quote, at_end + 1)
                    value, at_end = html[at_end + 1 : close], close + 1
                else:
                    m = BARE.match(html, at_end)
                    value, at_end = m[0], m.end()
                attributes.setdefault(key, value)
            else:
                bare.append(key)
                attributes.setdefault(key, "")
        # "if a <b and c > d": words, not a tag
        if not closes and len(bare) == len(attributes) and at and html[at - 1].isspace() and (len(name) == 1 or name not in KNOWN) and any(k not in SINGLE and k.isalpha() for k in bare):
            at = html.find("<", at + 1)
            continue
        end = at_end + 1 if html[at_end : at_end + 1] == ">" else at_end
        yield at, end, name, closes, attributes
        if not closes and name in RAW and name not in unended:
            stop = lowered.find(f"</{name}", end)
            if stop < 0:
                unended.add(name)
                if name in ("script", "style"):
                    stop = len(html)
            if stop >= 0:
                yield end, stop, "", False, {}
                end = stop
        at = html.find("<", end)


def words_of(attributes: dict[str, str], of: tuple[str, ...] = ("class", "id", "role")) -> list[list[str]]:
    """The words of each name that an element has there."""
    found = [WORDS.findall(CAMEL.sub(" ", name).lower()) for key in of if attributes.get(key) for name in attributes[key].split()]
    return [ws for ws in found if ws and not MODIFIERS.intersection(ws)]


def judged(name: str, attributes: dict[str, str], inside: bool) -> tuple[bool, bool, bool]:
    """Whether an element isn't text by its name or attributes; whether that is so only if its structure bears it out; whether only by words of layout."""
    if name in ("html", "body", "main"):
        return False, False, False
    if name == "form":
        return True, False, True
    if name in DROPPED or (name == "header" and not inside):
        return True, False, False
    if not attributes:
        return False, False, False
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true" or INVISIBLE.search(attributes.get("style", "")):
        return True, False, False
    if inside and name in ABOUT:
        named = [w for ws in words_of(attributes, ("class", "role")) for w in ws]
        if PLAIN_WORDS.intersection(named):
            return True, False, False
        ids = [w for ws in words_of(attributes, ("id",)) for w in ws]
        if name in HEADINGS:
            return False, False, False
        if name == "section" and ids and all(w in PLAIN_WORDS or w in LOOSE_WORDS for w in ids):
            return True, False, False
        return False, any(w in PLAIN_WORDS or w in LOOSE_WORDS for w in named + ids), False
    names = words_of(attributes)
    found = {w for ws in names for w in ws if w in PLAIN_WORDS or w in LOOSE_WORDS}
    if inside:
        found.discard("header")
        if found and not PLAIN_WORDS.intersection(found) and any(found.intersection(ws) and not all(w in found or w in GENERIC for w in ws) for ws in names):
            return False, True, False
    return bool(found), False, bool(found) and found <= LAYOUT


def blocks_of(html: str) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """All elements, and blocks of text in page order: element, text, and how much of it is in links."""
    root = Element("html", None)
    elements, stack = [root], [root]
    where: dict[str, list[int]] = {}  # of each name, where it is open in the stack
    blocks: list[tuple[Element, str, int]] = []
    held: list[str] = []
    in_links = 0

    def top(*names: str) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=0)

    def flush() -> None:
        nonlocal in_links
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                blocks.append((stack[-1].block, text, min(in_links, len(text))))
        in_links = 0

    def say(text: str) -> None:
        nonlocal in_links
        if text and not top(*MUTED):
            held.append(unescape(text) if "&" in text else text)
            if 0 < len(stack) - top("a") <= 4 and where.get("a"):
                in_links += len(" ".join(held[-1].split()))

    def close(at: int) -> None:
        if not 0 < top(*MUTED) <= at and any(e.name not in INLINE for e in stack[at:]):
            flush()
        for e in stack[at:]:
            where[e.name].pop()
        del stack[at:]

    done = 0
    for start, end, name, closes, attributes in tags(html):
        say(html[done:start])
        done = end
        if not name:
            continue
        if closes:
            if at := top(name):
                close(at)
            continue
        if name in FIELDS:
            stack[-1].fields = True
        if name == "br":
            say(" ")
            continue
        if name in VOID and name in INLINE:
            continue
        if name in ("html", "body"):
            flush()
            if name == "body" and (at := top("head")):
                close(at)
            continue
        muted = top(*MUTED)
        if not muted and name in CLOSES_P and (at := top("p")):
            close(at)
        if not muted and name in IMPLIED:
            ends, until = IMPLIED[name]
            if (at := top(*ends)) > top(*until):
                close(at)
        if not muted and name not in INLINE and name not in MUTED:
            flush()
        if name in VOID or name in RAW:
            continue
        unwanted, doubtful, layout = judged(name, attributes, bool(top("article", "main")))
        element = Element(name, stack[-1], unwanted, doubtful, layout)
        elements.append(element)
        where.setdefault(name, []).append(len(stack))
        stack.append(element)
        if name in ("article", "main") and not unwanted:
            up = element.parent
            while up is not None and not up.holds_main:
                up.holds_main, up = True, up.parent
    say(html[done:])
    flush()
    return elements, blocks


def weighed(elements: list[Element], blocks: list[tuple[Element, str, int]]) -> list[tuple[Element, str, int]]:
    """The blocks that may be text; sums of all elements over them. Children come after their parents in elements."""
    for e in reversed(elements[1:]):
        e.parent.fields = e.parent.fields or e.fields
    for element, text, linked in blocks:
        element.length += len(text)
        element.linked += linked
    for e in reversed(elements[1:]):
        e.parent.length += e.length
        e.parent.linked += e.linked
    prose: dict[int, int] = {}  # of forms, how much of their text is in long paragraphs
    for element, text, linked in blocks:
        if element.name == "p" and len(text) >= 80 and 2 * linked < len(text):
            up = element.parent
            while up is not None:
                if up.name == "form":
                    prose[id(up)] = prose.get(id(up), 0) + len(text)
                    break
                up = up.parent
    for e in elements:
        if e.name == "form" and 2 * prose.get(id(e), 0) > max(e.length, elements[0].length // 2):
            e.unwanted = False  # a page within a form
        out = (e.unwanted and not (e.layout and e.holds_main)) or (e.doubtful and (e.fields or 2 * e.linked >= e.length))
        e.dropped = out or (e.parent is not None and e.parent.dropped)
    for e in elements:
        e.length = e.linked = 0
    blocks = [b for b in blocks if not b[0].dropped]
    for element, text, linked in blocks:
        element.length += len(text)
        element.linked += linked
        points = (1 + min(text.count(","), 10) + min(len(text) / 100, 3)) * (1 - linked / len(text))
        up = element.parent if element.name in TEXT_BLOCKS and element.parent is not None else element
        up.points += points
    for e in reversed(elements):
        e.received += e.points
        if e.parent is not None:
            e.parent.length += e.length
            e.parent.linked += e.linked
            e.parent.articles += 1 if e.name == "article" and e.length and not e.dropped else e.articles
            e.parent.received += e.received / 2
    return blocks


def climbed(best: Element) -> Element:
    """The ancestor whose text belongs to the same article: the article or main around it, unless that holds several articles, or one that adds nothing."""
    chosen, up = best, best.parent
    while up is not None and up.parent is not None:
        if (up.name in ("article", "main") and up.articles <= 1 and 2 * up.linked < max(up.length, 1)) or up.length == chosen.length:
            chosen = up
            if up.name == "article":
                break
        up = up.parent
    return chosen


def main_text(html: str) -> str:
    """The main text of a page; blocks joined by a blank line."""
    elements, blocks = blocks_of(html)
    blocks = weighed(elements, blocks)
    if not blocks:
        return ""
    best = climbed(max((e for e in elements if e.received), key=lambda e: e.value, default=blocks[0][0]))
    floor = 0.2 * best.value
    best.kept = True
    for e in elements:
        if e.parent is best.parent is not None and e is not best and not e.dropped and 4 * e.linked < e.length and not (best.name == e.name == "article"):
            e.kept = e.name in TEXT_BLOCKS or e.name == "header" or (e.name in GROUPS and e.value >= floor)
    for e in elements:
        e.kept = e.kept or (e.parent is not None and e.parent.kept)
    return "\n\n".join(text for element, text, _ in blocks if element.kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text, n_chars), one for each page.

    The whole page is read. A null or empty page, and one without text, has
    the empty string and 0. Repeated rows stay repeated; other columns don't
    come along. An empty table gives no rows. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = narrow.schema["id"].dataType.simpleString()
    return mapped(narrow, run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})
