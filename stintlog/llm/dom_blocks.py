"""Leaf blocks of an HTML page: runs of text between block-level tags, with what encloses them."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import cache

# Tags that end a block of text where they start or end; fixed by the HTML standard's default styles.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is text up to their end tag, and is never shown as part of a page.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg".split())
# What an opening tag closes without an end tag, and what such closing never leaves.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}), "body": ({"head"}, {"html"}),
}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role|hidden|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[0-9]+")


@dataclass(frozen=True)
class Block:
    """A block's text, white space made single and trimmed; the tag it lies in, all tags and names around
    it, and its characters in links."""

    text: str
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    linked: int


class _Open:
    """The open elements. Places are kept by tag, and sets of tags and names are shared with the parent
    where an element adds none, so that broken or deep pages take no longer than others."""

    def __init__(self):
        self.tags: list[str] = []
        self.around: list[tuple[frozenset[str], frozenset[str]]] = [(frozenset(), frozenset())]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of block elements other than paragraphs

    def last(self, tag: str) -> int:
        """The place of the innermost element of a tag, -1 without one."""
        places = self.places.get(tag)
        return places[-1] if places else -1

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        tags, known = self.around[-1]
        if tag not in tags:
            tags = tags | {tag}
        if not known.issuperset(names):
            known = known.union(names)
        place = len(self.tags)
        self.tags.append(tag)
        self.around.append((tags, known))
        self.places.setdefault(tag, []).append(place)
        if tag in BLOCK and tag != "p":
            self.blocks.append(place)

    def close(self, upto: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.tags) > upto:
            tag = self.tags.pop()
            self.around.pop()
            self.places[tag].pop()
            if self.blocks and self.blocks[-1] == len(self.tags):
                self.blocks.pop()

    def make_room(self, tag: str) -> None:
        """Close what the start of a block element ends: a paragraph, or an item of the same list or table."""
        if tag not in _CLOSES:
            place = self.last("p")
            if place > (self.blocks[-1] if self.blocks else -1):
                self.close(place)
            return
        closes, within = _CLOSES[tag]
        wall = max((self.last(t) for t in within), default=-1)
        ended = []
        for t in {"p", *closes}:
            places = self.places.get(t, [])
            i = bisect_right(places, wall)
            if i < len(places):
                ended.append(places[i])
        if ended:
            self.close(min(ended))


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = ["".join(m.groups("")) for m in _NAMES.finditer(attributes)]
    return tuple(w for f in found for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", f).lower()))


def leaf_blocks(page: str) -> list[Block]:
    """The blocks of a whole page that hold any text, in page order; character references are decoded.

    Comments, scripts, styles and other text that is not shown are left out. Tags may be
    unbalanced: an end tag without a start is ignored, and paragraphs and list items end where
    the next begins.
    """
    out: list[Block] = []
    held = _Open()
    parts: list[str] = []
    linked = 0
    around: tuple[str, frozenset[str], frozenset[str]] | None = None

    def flush() -> None:
        nonlocal parts, linked, around
        if parts:
            text = " ".join("".join(parts).split())
            if text and around is not None:
                out.append(Block(text, *around, linked))
            parts, linked, around = [], 0, None

    def add(raw: str) -> None:
        nonlocal linked, around
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if text and not text.isspace():
            if around is None:
                around = (held.tags[-1] if held.tags else "", *held.around[-1])
            if held.last("a") >= 0:
                linked += len(text.strip())

    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        token = _TOKEN.search(page, at) if at <= last else None
        if token is None:
            # No tag can end any more; only a comment without an end still hides what follows.
            stop = page.find("<!--", at)
            add(page[at : stop if stop >= 0 else end])
            break
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        ending, tag, attributes = token.group(1, 2, 3) if token.group(2) else token.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if ending:
            if (place := held.last(tag)) >= 0:
                held.close(place)
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                stop = _end_of(tag).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            held.make_room(tag)
        held.push(tag, _names(attributes))
    flush()
    return out


@cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I)
