"""HTML pages as streams of regions: what wrapper inference aligns.

A tolerant tag scanner (unclosed and wrongly nested tags, any attribute spelling) finds the page's text
blocks, the elements with an integer data-n, and the container each stands in. Lists, tables of data,
quotes and figures belong to the container around them. A region is a container with blocks of its own.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z][-\w]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[^\W\d_]+|\d")
HOST = re.compile(r"href\s*=\s*[\"']?https?://([^/\"'\s>:]+)", re.I)

INLINE = frozenset("a abbr b big br cite code em font hr i img input link meta small source strong sub sup u wbr".split())
NONE: dict[str, str] = {}
HIDING = frozenset(["hidden", "aria-hidden", "style"])
#: Elements that end an open paragraph.
BLOCK = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table tbody td th thead tr ul span figcaption".split())
#: Elements that are no containers of their own.
WITHIN = frozenset("ul ol dl tbody thead blockquote figure p pre h1 h2 h3 h4 h5 h6 span li figcaption".split())


@dataclass
class Block:
    number: int
    tag: str
    classes: list[str]
    hidden: bool
    container: int
    depth: int
    text: list[str] = field(default_factory=list)
    linked: int = 0


@dataclass
class Region:
    """A container's own blocks and the features that alignment compares."""

    tag: str
    classes: set[str]
    first: str = ""
    words: set[str] = field(default_factory=set)
    blocks: list[int] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)
    own: int = 0
    linked: int = 0
    prose: int = 0

    def packed(self) -> list:
        return [self.tag, sorted(self.classes), self.first, sorted(self.words), self.blocks, self.texts, self.own, self.linked, self.prose]

    @classmethod
    def of(cls, p: list) -> Region:
        return cls(p[0], set(p[1]), p[2], set(p[3]), p[4], p[5], p[6], p[7], p[8])


def _hidden(attributes: dict[str, str]) -> bool:
    style = attributes.get("style", "").replace(" ", "").lower()
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


def blocks_of(page: str) -> tuple[list[Block], list[tuple[str, list[str]]]]:
    """The text blocks of a page and its containers as (tag, classes)."""
    blocks: list[Block] = []
    containers: list[tuple[str, list[str]]] = [("", [])]
    stack: list[tuple[str, bool, int]] = []  # tag, hidden, container that blocks within belong to
    current: Block | None = None
    links = at = 0
    for m in TOKEN.finditer(page):
        begin, end = m.span()
        if current is not None and begin > at:
            s = page[at:begin]
            current.text.append(s)
            if links:
                current.linked += len(s.strip())
        at = end
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if m.group(2):
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                if current is not None and len(stack) < current.depth:
                    current = None
            continue
        if tag == "a":
            links += 1
        if tag in INLINE:
            continue
        if tag in BLOCK:
            while stack and stack[-1][0] == "p":
                stack.pop()
            if tag == "li":
                while stack and stack[-1][0] == "li":
                    stack.pop()
            if current is not None and len(stack) < current.depth:
                current = None
        raw = m.group(4)
        attributes = {a.lower(): v.strip("\"'") for a, v in ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else NONE
        hidden = (bool(stack) and stack[-1][1]) or (not HIDING.isdisjoint(attributes) and _hidden(attributes))
        inherited = stack[-1][2] if stack else 0
        classes = attributes.get("class", "").split()
        number = attributes.get("data-n", "")
        if number.isdecimal():
            links = 0
            owner = inherited
            if tag == "tr" and stack and stack[-1][0] in ("table", "tbody", "thead"):  # a table of data
                k = len(stack) - 1
                while k >= 0 and stack[k][0] in ("table", "tbody", "thead"):
                    k -= 1
                owner = stack[k][2] if k >= 0 else 0
            current = Block(int(number), tag, classes, hidden, owner, len(stack) + 1)
            blocks.append(current)
            stack.append((tag, hidden, inherited))
        elif tag in WITHIN or current is not None:
            stack.append((tag, hidden, inherited))
        else:
            containers.append((tag, classes))
            stack.append((tag, hidden, len(containers) - 1))
    return blocks, containers


def regions_of(page: str) -> tuple[str, list[Region]]:
    """The host that the page links to most, and its regions in order."""
    blocks, containers = blocks_of(page)
    regions: dict[int, Region] = {}
    for b in blocks:
        if b.hidden:
            continue
        joined = "".join(b.text)
        text = (entities.unescape(joined) if "&" in joined else joined).split()
        size = sum(map(len, text)) + max(0, len(text) - 1)
        r = regions.get(b.container)
        if r is None:
            tag, classes = containers[b.container]
            r = regions[b.container] = Region(tag, set(classes), b.tag)
        r.classes.update(b.classes)
        for e in (*text[:2], *text[-1:]):
            if e.isalpha():
                r.words.add(e.lower())
            else:
                r.words.update(w.lower() if not w.isdigit() else "0" for w in WORD.findall(e)[:2])
        r.blocks.append(b.number)
        r.texts.append(hash_text(text))
        r.own += max(0, size - b.linked)
        r.linked += b.linked
        r.prose += size - b.linked >= 60
    hosts = HOST.findall(page)
    host = max(sorted((c := Counter(h.lower() for h in hosts))), key=c.__getitem__) if hosts else ""
    return host, list(regions.values())


def hash_text(words: list[str]) -> int:
    """A stable 40-bit hash of a block's text."""
    s = " ".join(words).encode()
    return zlib.crc32(s) | (zlib.adler32(s) & 0xFF) << 32
