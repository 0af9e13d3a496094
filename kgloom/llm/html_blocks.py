"""Leaf blocks of a page: runs of text between block-level tags, with the tags around them.

Open elements are a tree of shared nodes: a block points to its innermost one, and
a node adds to what its parent says only where it says something new.  So a page of
very many unclosed tags costs no more than its length.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

FEATURES = 1 << 12
#: Elements that start a block, that hold no content, that are never shown.
BLOCKS = frozenset("address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template head title iframe object svg math".split())
RAW = frozenset("script style title iframe".split())
#: Elements inside a line of text; words of classes and ids in their general sense.
INLINE = frozenset("b i em strong a span u small font".split())
SENSES = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs toolbar", "head": "header masthead logo branding topbar", "foot": "footer copyright colophon legal imprint bottom",
    "side": "sidebar aside related recommended widget rail teaser teasers trending popular more", "ad": "ad ads advert advertisement sponsored promo promotion banner adsense commercial",
    "notice": "notice cookie consent alert popup modal overlay gdpr newsletter subscribe signup paywall warning toast", "form": "form login search register contact", "comment": "comment comments commentlist discussion replies reply disqus respond reader feedback",
    "share": "share social follow tags tag meta byline", "main": "article content main post entry story body text page-content",
}
_SENSE = {w: s for s, words in SENSES.items() for w in words.split()}
#: An open element of the first kind ends where one of the second starts.
ENDS = {
    "p": BLOCKS - frozenset("button body html head title option".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "option": frozenset(["option"]), "head": frozenset(["body"]),
}
#: A quote opens a value right after = only; elsewhere in a tag it is a character like others.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_WHITE = re.compile(r"\s+")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


@lru_cache(maxsize=1 << 16)
def slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % FEATURES


@lru_cache(maxsize=1 << 16)
def _bits(tag: str, names: frozenset[str]) -> int:
    """Features of one element as a bit set."""
    out = 0 if tag in ("html", "body") else 1 << slot(f"in:{tag}")
    for n in names:
        out |= 1 << slot(f"name:{n}")
        if n in _SENSE:
            out |= 1 << slot(f"sense:{_SENSE[n]}")
    return out


@dataclass(slots=True)
class Node:
    tag: str = ""
    bits: int = 0  # features of this element and those around it
    leaf: str = ""  # innermost element that is not inline
    unseen: bool = False
    linked: bool = False

    def inside(self, tag: str, names: frozenset[str]) -> "Node":
        """A node of this one's; it shares the parent's features where it adds none."""
        own = _bits(tag, names)
        bits = self.bits if own | self.bits == self.bits else own | self.bits
        return Node(tag, bits, self.leaf if tag in INLINE else tag, self.unseen or tag in UNSEEN, self.linked or tag == "a")


@dataclass(slots=True)
class Block:
    text: str
    around: Node  # innermost open element
    linked: int  # characters inside links


@dataclass(slots=True)
class _Open:
    """Open elements, with the places of each tag and of all blocks among them."""

    stack: list[Node] = field(default_factory=lambda: [Node()])
    places: dict[str, list[int]] = field(default_factory=dict)
    blocks: list[int] = field(default_factory=list)

    def push(self, tag: str, names: frozenset[str]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS:
            self.blocks.append(len(self.stack))
        self.stack.append(self.stack[-1].inside(tag, names))

    def cut(self, place: int) -> None:
        """Close all elements from this place on."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def last_block(self) -> int:
        return self.blocks[-1] if self.blocks else 0


def blocks(page: str | None) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    now = _Open()
    held: list[str] = []
    linked = 0
    page = page or ""
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked
        if held:
            text = _WHITE.sub(" ", unescape("".join(held))).strip()
            if text and not now.stack[-1].unseen:
                out.append(Block(text, now.stack[-1], linked))
            held.clear()
        linked = 0

    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            held.append(page[at:stop])
            if now.stack[-1].linked:
                linked += stop - at
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag in BLOCKS or tag in UNSEEN:
            close()
        if m[1]:
            place = now.places.get(tag, ())[-1:]
            if place and (tag in BLOCKS or place[0] > now.last_block()):  # an inline end tag closes no block
                now.cut(place[0])
            continue
        if tag == "br":
            held.append(" ")
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        while tag in ENDS.get(now.stack[-1].tag, ()):
            now.cut(len(now.stack) - 1)
        if tag in ENDS["p"] and now.stack[now.last_block()].tag == "p":  # an open paragraph ends even below open inline elements
            now.cut(now.last_block())
        names = frozenset(w for n in _NAMES.findall(m[3]) for w in _SPLIT.split(n.lower()) if w) if m[3].strip() else frozenset()
        now.push(tag, names)
        if tag in RAW:  # up to the end tag nothing is markup
            over = _RAW_END[tag].search(page, at)
            at = over.start() if over else end
    close()
    return out
