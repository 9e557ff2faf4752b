"""A small element tree over the standard library's tolerant HTML tokenizer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Open elements that a start tag closes, up to the nearest of the scope elements.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_PARAGRAPH = frozenset("address article aside blockquote dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_PARAGRAPH, _PARAGRAPH_SCOPE = frozenset({"p"}), frozenset({"td", "th", "li", "table", "button", "object"})
_ONCE = frozenset({"html", "body", "head"})
#: Tags without attributes, other than those whose content some tokenizers read as text.
_PLAIN_START = re.compile(r"<(?!(?:iframe|no(?:embed|frames|script)|plaintext|script|style|textarea|title|xmp)>)([a-z][a-z0-9]*)>", re.I | re.A)
_TAG = re.compile("</?[a-z]|<!doctype", re.I | re.A)
_PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>", re.I | re.A)


class Element:
    """A tag with its attributes and children (elements and strings)."""

    __slots__ = ("tag", "attributes", "children", "parent", "words")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Element | str] = []
        self.words: frozenset[str] | None = None  # those of its markers, once somebody has asked for them

    def get(self, name: str) -> str:
        return self.attributes.get(name) or ""

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Element)]
        while todo:
            e = todo.pop()
            yield e
            if e.children:
                todo += [c for c in reversed(e.children) if isinstance(c, Element)]

    def first(self, tag: str) -> Element | None:
        return next((e for e in self.walk() if e.tag == tag), None)

    def release(self) -> None:
        """Take the links to parents off everything below, so that the tree goes with its last user and does not wait for the cycle collector."""
        for e in self.walk():
            e.parent = None

    def above(self) -> Iterator[Element]:
        e = self.parent
        while e is not None:
            yield e
            e = e.parent


class Root(Element):
    """The top of a tree, with all elements in the order in which they began, which is document order."""

    __slots__ = ("order",)

    def __init__(self) -> None:
        super().__init__("", {}, None)
        self.order: list[Element] = []

    def walk(self) -> Iterator[Element]:
        return iter(self.order)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Root()

    def goahead(self, end: bool) -> None:
        """The document type, texts and tags up to the first thing that is none of these; the tokenizer does the rest."""
        page, at = self.rawdata, 0
        while self.cdata_elem is None and (to := page.find("<", at)) >= 0 and _TAG.match(page, to):
            if at < to:
                self.handle_data(unescape(page[at:to]))
            at = to
            kind = page[to + 1]
            past = self.parse_endtag(to) if kind == "/" else self.parse_html_declaration(to) if kind == "!" else self.parse_starttag(to)
            if past < 0:
                break
            at = past
        self.rawdata = page[at:]
        super().goahead(end)

    def updatepos(self, i: int, j: int) -> int:
        """Lines are not counted: nothing asks for a position."""
        return j

    def parse_starttag(self, i: int) -> int:
        """As the tokenizer does it, with a short way for a tag that has no attributes."""
        m = _PLAIN_START.match(self.rawdata, i)
        if m is None:
            return super().parse_starttag(i)
        self.lasttag = tag = m[1].lower()
        self.handle_starttag(tag, [])
        return m.end()

    def parse_endtag(self, i: int) -> int:
        m = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if m is None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given: dict[str, str] = {}
        for k, v in attrs:
            given.setdefault(k, v or "")
        if tag in _ONCE and (old := next((e for e in (self.root, *self.root.walk()) if e.tag == tag), None)) is not None:
            for k, v in given.items():
                old.attributes.setdefault(k, v)
            return
        if tag in ENDS_PARAGRAPH:
            self._close(_PARAGRAPH, _PARAGRAPH_SCOPE)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        e = Element(tag, given, self.at)
        self.at.children.append(e)
        self.root.order.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def _close(self, tags: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        e, found = self.at, None
        while e.parent is not None and e.tag not in scope:
            if e.tag in tags:
                found = e
            e = e.parent
        if found is not None:
            self.at = found.parent

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e.parent is not None:
            if e.tag == tag:
                self.at = e.parent
                return
            e = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(page: str) -> Root:
    """The tree of a page; whatever the page, there is one."""
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root
