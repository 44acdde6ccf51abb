"""Leaf blocks of a web page: runs of text between block tags, with their ancestors.

Every step takes time in proportion to what it reads, however the page is broken: a tag that
never ends is looked at once, open elements are found by their names, and blocks share the chains
of their ancestors.

A small reader of HTML as it is found: a stack of open elements, void and raw-text elements,
and end tags that may be missing (a new paragraph, item, row or cell closes the open one; an
end tag closes what is still open inside).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>", re.S)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set()),
}
CLOSE_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())


class Element(NamedTuple):
    tag: str
    marks: tuple[str, ...]


class Chain:
    """An element and the chain of its ancestors; equal chains are one and the same object.

    ``cached`` is free for what a reader of chains works out.
    """

    __slots__ = ("element", "above", "cached")

    def __init__(self, element: Element, above: Chain | None):
        self.element, self.above, self.cached = element, above, None

    def __iter__(self) -> Iterator[Element]:
        """From the innermost element outwards."""
        at = self
        while at is not None:
            yield at.element
            at = at.above


#: Chains by what they add to which; beyond ``CHAINS`` the next page starts anew.
CHAINS = 1 << 16
_chains: dict[tuple[Chain | None, Element], Chain] = {}


def _chain(element: Element, above: Chain | None) -> Chain:
    found = _chains.get((above, element))
    if found is None:
        found = _chains[above, element] = Chain(element, above)
    return found


class TextBlock(NamedTuple):
    """Text of a leaf block, the chain of its ancestors, and how much of it is link text."""

    text: str
    chain: Chain | None
    link_chars: int

    @property
    def path(self) -> tuple[Element, ...]:
        """The ancestors from the root."""
        return tuple(self.chain)[::-1] if self.chain else ()


def _marks(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role, and whether the element is hidden."""
    found: list[str] = []
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (double or single or bare).lower()
        if name in ("class", "id", "role", "itemprop"):
            found += [w for w in re.split(r"[^a-z]+", value) if w]
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*:\s*none", value)):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


class _Open:
    """The open elements, found by their tags."""

    def __init__(self):
        self.elements: list[Element] = []
        # Chains of the elements that count as ancestors, up to each open element.
        self.chains: list[Chain | None] = []
        self.places: dict[str, list[int]] = {}

    def push(self, element: Element) -> None:
        self.places.setdefault(element.tag, []).append(len(self.elements))
        self.elements.append(element)
        above = self.chain()
        counts = element.tag not in INLINE or element.marks
        self.chains.append(_chain(element, above) if counts else above)

    def chain(self) -> Chain | None:
        return self.chains[-1] if self.chains else None

    def last(self, tags) -> int:
        """The place of the innermost element with one of some tags; -1 for none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def close(self, tags, barriers=()) -> None:
        """Close the nearest element of ``tags`` with all inside it, unless a barrier is nearer."""
        place = self.last(tags)
        if place < 0 or place < self.last(barriers):
            return
        for element in self.elements[place:]:
            self.places[element.tag].pop()
        del self.elements[place:], self.chains[place:]


class _Tags:
    """Markup of a page from left to right."""

    def __init__(self, page: str):
        self.page = page
        # Set when a quote runs to the end of the page: from then on quotes mean nothing.
        self.unquoted = False
        # Set when no tag can end any more.
        self.ended = False

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, closing, tag, attributes) of the next markup; no tag for comments."""
        page = self.page
        while not self.ended:
            start = page.find("<", at)
            if start < 0:
                return None
            following = page[start + 1:start + 2]
            if following in ("!", "?"):
                found = _COMMENT.match(page, start)
                end = found.end() if found else page.find(">", start) + 1
                if not end:
                    self.ended = True
                    return None
                return start, end, False, "", ""
            found = _TAG.match(page, start)
            if not found:
                at = start + 1
                continue
            quoted = None if self.unquoted else _QUOTED.match(page, found.end())
            if quoted:
                end = quoted.end()
            else:
                end = page.find(">", found.end()) + 1
                if not end:
                    self.ended = True
                    return None
                self.unquoted = True
            return start, end, bool(found[1]), found[2].lower(), page[found.end():end - 1]
        return None


class _Raw:
    """Ends of raw-text elements; a tag that does not end any more is looked for once."""

    def __init__(self, page: str):
        self.page, self.missing = page, set()

    def end(self, tag: str, at: int) -> re.Match | None:
        if tag in self.missing:
            return None
        found = re.compile(rf"</{tag}\s*>", re.I).search(self.page, at)
        if not found:
            self.missing.add(tag)
        return found


def text_blocks(page: str) -> Iterator[TextBlock]:
    """The non-empty leaf blocks of a page in order, character references decoded."""
    if len(_chains) > CHAINS:
        _chains.clear()
    stack, tags, raw = _Open(), _Tags(page), _Raw(page)
    parts: list[str] = []
    linked = 0
    chain: Chain | None = None
    at, size = 0, len(page)

    def flush() -> TextBlock | None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        block = TextBlock(text, chain, linked) if text else None
        parts.clear()
        linked = 0
        return block

    def add(text: str) -> None:
        nonlocal linked, chain
        if not text:
            return
        if not parts or chain is None:
            chain = stack.chain()
        parts.append(text)
        if stack.places.get("a"):
            linked += len(text.strip())

    while at < size:
        found = tags.next(at)
        if not found:
            break
        start, end, closing, tag, attributes = found
        add(page[at:start])
        at = end
        if not tag:
            if page.startswith("<![CDATA[", start):
                add(html.escape(page[start + 9:end].removesuffix("]]>")))
            continue
        if tag in INLINE:
            if tag in ("img", "wbr"):
                continue
            if closing:
                stack.close({tag}, CLOSE_PARAGRAPH)
            else:
                stack.push(Element(tag, _marks(attributes)))
            continue
        if tag == "br":
            add(" ")
            continue
        if (block := flush()) is not None:
            yield block
        if closing:
            stack.close({tag})
            continue
        if tag in CLOSE_PARAGRAPH:
            stack.close({"p"}, {"table", "td", "th", "button", "article", "div"})
        if tag in CLOSES:
            stack.close(*CLOSES[tag])
        if tag in VOID or attributes.rstrip().endswith("/") and tag in RAW:
            continue
        if tag in RAW:
            close = raw.end(tag, at)
            at = close.end() if close else size
            continue
        if tag in ("title", "textarea"):
            close = raw.end(tag, at)
            stop = close.start() if close else size
            stack.push(Element(tag, _marks(attributes)))
            add(page[at:stop])
            if (block := flush()) is not None:
                yield block
            stack.close({tag})
            at = close.end() if close else size
            continue
        stack.push(Element(tag, _marks(attributes)))
    add(page[at:])
    if (block := flush()) is not None:
        yield block
