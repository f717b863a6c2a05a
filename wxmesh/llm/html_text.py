"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. Pass one decides each block
from its own text: the density of stop words, its length and the share of
its text inside links make it good, bad, or leave it open. What encloses a block
(a menu, footer, form, advert, comment list and the like, or the article; by
element, or by a class or id all of whose words say so) only tips: an open block
follows it, and prose in such a place is set aside. It goes if the page has
its prose elsewhere, and stays if it has none, so no name empties an article.
In pass two an open block inherits the label of its nearest decided neighbours:
the one they agree on, else the nearer one's. A block that reads as a sentence goes on
with the good text before it; the page's title, where it is repeated, counts as decided;
in a tie a heading goes with good text after it, and anything else is dropped. If the page
has no decided block, its open blocks are kept.

Defined results: null or empty html gives an empty text. Rows repeated in the
input are extracted each. Only ``page_id``, ``url`` and ``html`` are read. The time for
a page is in proportion to its length, however its tags are nested.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from wxmesh.llm.common import as_texts, column_of, record, slices

#: Frequent function words of English, German, French, Spanish, Italian, Portuguese and Dutch.
STOP_WORDS = frozenset("""
the of and to in a is that it was for on are as with his they at be this have from or had by but not what all were when
we there can an your which their if will each about how up out them then she many some so these would her him has more
der die das und ist nicht ein eine den dem des von zu mit auf für sich im als auch es an werden aus er hat dass sie nach
le la les un une de du et est en que qui dans pour sur pas par au aux avec ce se il ne plus sont mais ou nous vous
el los las una y del al no por con para su lo como más o pero sus este ha si porque esta entre cuando
il di che è per non gli sono della nel um uma não do da os ao het een van dat niet op zijn voor
""".split())
#: HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter
    nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
UNSEEN = frozenset("""script style noscript template head title textarea select option button svg math iframe object
    canvas video audio map datalist""".split())
RAW = frozenset("script style textarea title noscript iframe".split())
FURNITURE = frozenset("nav footer aside menu dialog".split())
#: Words in class, id and role values that name page furniture, and those that name the article.
BAD_WORDS = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs masthead topbar footer colophon copyright
    sidebar aside rail widget widgets ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion
    banner cookie cookies consent gdpr notice popup modal overlay alert subscribe subscription newsletter signup login
    search share sharing social related recommended recommendations trending popular comment comments commentlist respond
    reply replies disqus discussion feedback pagination pager skip tagcloud legal disclaimer contentinfo complementary
    dialog form""".split())
WEAK_WORDS = frozenset("header head top meta byline tags".split())
GOOD_WORDS = frozenset("article main content post entry story body text prose".split())
#: Words that say where or in what shape something stands, not what it is.
PLACE_WORDS = frozenset("""slot box block wrap wrapper container inner outer top bottom left right center list item items section area
    bar button buttons link links col column row cell panel pane group site page global primary secondary main header head
    area zone region unit module text content small large sticky fixed js id""".split())

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
SCOPE = frozenset("div section article main nav header footer aside form ul ol dl table body blockquote".split())
WORD = re.compile(r"[^\W\d_]+")
SENTENCE_END = re.compile(r"[.!?…。]['\")\]’”»]*$")
GOOD, BAD, OPEN = 1, -1, 0
#: Fixed thresholds of pass one: link shares, lengths in characters, shares of stop words.
MANY_LINKS, SOME_LINKS, SHORT, MEDIUM, LONG, PROSE, SPARSE = 0.5, 0.2, 120, 70, 200, 0.2, 0.1


def hint(name: str, attributes: str) -> tuple[int | None, bool]:
    """What the element itself says of its content (None: nothing), and whether it hides it."""
    found, hidden = BAD if name in FURNITURE or name == "form" else GOOD if name in ("article", "main") else None, False
    if "=" in attributes or "hidden" in attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key == "style":
                hidden |= UNSEEN_STYLE.search(value) is not None
                continue
            if key == "hidden" or key == "aria-hidden":
                hidden |= key == "hidden" or value == "true"
                continue
            for token in value.split():
                words = {w for w in re.split(r"[-_:\d]+", token) if w}
                if words & BAD_WORDS:
                    if words <= BAD_WORDS | PLACE_WORDS:
                        found = BAD
                elif words and words <= WEAK_WORDS | PLACE_WORDS and words & WEAK_WORDS and name != "h1":
                    found = BAD if found is None else found
                elif words & GOOD_WORDS and not words & WEAK_WORDS:
                    found = GOOD if found is None else found
    return found, hidden


class Block:
    __slots__ = ("text", "linked", "where", "heading")

    def __init__(self, text: str, linked: int, where: int, heading: bool):
        self.text, self.linked, self.where, self.heading = text, linked, where, heading


class Inside:
    """The open elements. Every step takes constant time on average, whatever their number."""

    def __init__(self):
        #: name, what it says of its content, whether out of sight, within an article, furniture only by a form
        self.stack: list[tuple[str, int, bool, bool, bool]] = [("", OPEN, False, False, True)]
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = [0]

    def push(self, name: str, *state) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if name in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append((name, *state))

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            name = self.stack.pop()[0]
            self.at[name].pop()
        while self.scopes[-1] >= depth:
            self.scopes.pop()

    def last(self, name: str) -> int:
        held = self.at.get(name)
        return held[-1] if held else 0


def blocks(page: str) -> tuple[list[Block], str]:
    """The visible text blocks of a page in order, with what encloses them, and the page's title."""
    out: list[Block] = []
    inside = Inside()
    parts: list[str] = []
    linked, in_link, heading, title = 0, False, False, ""
    at, size = 0, len(page)

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, inside.stack[-1][1], heading))
            parts.clear()
        linked = 0

    def say(raw: str):
        nonlocal linked
        if raw and not inside.stack[-1][2]:
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    while at < size:
        m = MARKUP.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
            in_link = False
        if name == "br":
            parts.append(" ")
        if m[1]:
            if name == "a":
                in_link = False
            depth = inside.last(name)
            if depth and not (name in INLINE and inside.scopes[-1] > depth):
                inside.cut(depth)
            if name not in INLINE:
                heading = False
            continue
        if name in VOID or m[3].endswith("/") and name in UNSEEN:
            continue
        if name in CLOSED_BY_SAME or name not in INLINE:
            # An unclosed p (or li, td, ...) ends where its next sibling, or for p any block, begins.
            depth = inside.last(name if name in CLOSED_BY_SAME else "p")
            if depth > inside.scopes[-1]:
                inside.cut(depth)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if name == "title" and not title:
                title = " ".join(html.unescape(page[at:end.start() if end else size]).split())
            at = end.end() if end else size
            continue
        _, above, unseen, in_article, by_form = inside.stack[-1]
        own, hidden = hint(name, m[3]) if name not in ("body", "html") else (None, False)
        if name == "header" and own is None and not in_article:
            own = BAD
        if name in INLINE and own != BAD and not hidden:
            in_link |= name == "a"
            continue  # nothing depends on it
        if above == BAD and not (by_form and own == GOOD and name in ("article", "main")):
            own, by_form = BAD, by_form and (own != BAD or name == "form")
        elif own == BAD:
            by_form = name == "form"
        inside.push(name, above if own is None else own, unseen or hidden or name in UNSEEN,
                    in_article or name in ("article", "main"), by_form)
        if name == "a":
            in_link = True
        elif name not in INLINE:
            heading = len(name) == 2 and name[0] == "h" and name[1].isdigit()
    flush()
    return out, title


def density(block: Block) -> int:
    """What a block's own text says: its length, its share of links and of stop words."""
    text, n = block.text, len(block.text)
    if text.startswith(("©", "(c) ", "Copyright ")):
        return BAD
    links = block.linked / n
    if links > MANY_LINKS or links > SOME_LINKS and n < SHORT:
        return BAD
    words = [w.lower() for w in WORD.findall(text)]
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if links <= SOME_LINKS and (n >= MEDIUM and stops >= PROSE or n >= LONG and stops >= SPARSE):
        return GOOD
    return OPEN


def decide(found: list[Block], title: str = "") -> list[int]:
    """Pass one: the label of each block by its text, tipped by what encloses it."""
    own = [density(b) for b in found]
    outside = any(b.where == GOOD and label != BAD or b.where == OPEN and label == GOOD for b, label in zip(found, own))
    misnamed = not outside and any(b.where == BAD and label == GOOD for b, label in zip(found, own))
    labels = []
    for block, label in zip(found, own):
        if block.where == BAD:
            label = label if misnamed else BAD
        elif block.where == GOOD and not block.text.startswith("©"):
            label = BAD if block.linked > 0.8 * len(block.text) and len(block.text) < 80 else GOOD
        elif label == OPEN and title and block.text.casefold() == title.casefold():
            label = GOOD
        labels.append(label)
    return labels


def reads_on(block: Block) -> bool:
    """Whether a block reads as a sentence without links."""
    return not block.linked and len(block.text.split()) > 1 and SENTENCE_END.search(block.text) is not None


def inherit(found: list[Block], labels: list[int]) -> list[int]:
    """Pass two: open blocks take the label of their nearest decided neighbours."""
    n, out = len(labels), list(labels)
    before, after, last = [None] * n, [None] * n, None
    for k in range(n):
        before[k] = last
        last = k if labels[k] != OPEN else last
    last = None
    for k in range(n - 1, -1, -1):
        after[k] = last
        last = k if labels[k] != OPEN else last
    for k in range(n):
        if labels[k] == OPEN:
            b, a = before[k], after[k]
            if b is None or a is None:
                out[k] = GOOD if a == b else labels[a if b is None else b]
            elif labels[b] == labels[a]:
                out[k] = labels[a]
            elif labels[b] == GOOD and reads_on(found[k]):
                out[k] = GOOD
            elif a - k == k - b:
                out[k] = labels[a] if found[k].heading else BAD
            else:
                out[k] = labels[a if a - k < k - b else b]
    return out


def main_text(page: str) -> str:
    found, title = blocks(page)
    labels = inherit(found, decide(found, title))
    return " ".join(b.text for b, label in zip(found, labels) if label == GOOD)


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``."""
    def rows(batches):
        for batch in slices(batches, 256):
            texts = [main_text(p) for p in as_texts(column_of(batch, "html"))]
            yield record(OUT, column_of(batch, "page_id"), column_of(batch, "url").cast(pa.string()), texts, list(map(len, texts)))

    return pages.select("page_id", "url", "html").mapInArrow(rows, "page_id long, url string, text string, n_chars long")
