"""Main content of pages by wrapper inference: union-free regular expressions over region streams.

Pages of one host are aligned one after the other with the wrapper that the pages before them gave, as
streams of regions (a container's open tag, the text tokens of its own blocks, and its close tag). Where stream and wrapper agree, the
node takes the region in: its constant words and classes are confirmed, text tokens that are the same on
pages of different articles become constants of the expression, and the others slots.
Mismatches are resolved in a way that keeps the expression free of unions: what the page lacks becomes
optional, what it has beyond the wrapper is inserted as optional, and what comes again out of order
makes its node repeated. Wrappers of different pages align with each other by the same rule, so each
task folds its pages into one wrapper per host, and wrappers (of bounded size) are merged in rounds.

The body of a host is the slot whose text is new on every page and is not linked. Each page is
aligned once more with the finished wrapper and yields the blocks of its region in a body slot.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.pages import Region, regions_of
from foliospark.sources.tables import broadcast_if_small, stage

#: Alignment: least likeness of a region and a node, and how classes, words and shape weigh.
LIKE, CLASSES, WORDS, SHAPE = 0.42, 0.4, 0.35, 0.25
#: By how much a region aligned with a body slot may be more like another node.
NEARLY = 0.1
#: Nodes below which no feature is discounted for being common, and the weight of knowing nothing.
FEW, PRIOR = 8, 0.5
#: A word or class is part of a node from this share of its pages on; it is on two pages at least.
CONSTANT_WORD, CONSTANT_CLASS = 0.04, 0.004
#: Text hashes of a node's distinct-count sketch.
SKETCH = 256
#: A body slot has at least this share of the mean unlinked text of the slot with most of it, at most this share of
#: linked text, and at least this share of blocks whose text is no repetition. Copies of an article count once.
BODY_SHARE, BODY_LINKED, BODY_NEW = 0.12, 0.35, 0.6
#: For these means a region counts as at most so many times the length that this share of the regions does not exceed.
LONG, LONGER = 3.0, 0.9
#: A text token is a constant from this many articles on, and this share of a part's pages; of a region in a body slot at least this share of tokens are slots.
LEAST_PAGES, CONSTANT_TEXT, SLOTS = 3, 0.004, 0.5
#: Body slots that share so much of the rarer one's pages, of the other one's pages, and so many pages, hold one article together.
TOGETHER, OFTEN, SEVERAL = 0.7, 0.25, 12
#: Pages of a host that one task aligns, parts of wrappers that one task merges, and half of the nodes whose features stand in a matrix; those of the others are listed.
PAGES_A_TASK, MERGED, NODES = 4096, 64, 512
#: Likeness values computed at once, and the steps of a feature's weight, so that sums are the same in any order.
CELLS, STEPS = 1 << 22, 1024


@dataclass
class Node:
    """A slot of a wrapper; `pages` counts the regions it has taken in."""

    pages: int = 0
    tags: Counter = field(default_factory=Counter)
    classes: Counter = field(default_factory=Counter)
    words: Counter = field(default_factory=Counter)
    shapes: Counter = field(default_factory=Counter)
    blocks: int = 0
    own: int = 0
    linked: int = 0
    least: list[int] = field(default_factory=list)
    once: dict[int, tuple[int, int]] = field(default_factory=dict)
    optional: bool = False
    repeated: bool = False
    common: tuple = (0, frozenset(), frozenset(), {})
    column: int = -1

    def known(self) -> tuple[frozenset, frozenset]:
        """The constant classes and words, renewed as the node grows, together with the shares of its shapes."""
        seen, c, w, _ = self.common
        if self.pages > seen * 1.2:
            c, w = map(frozenset, self.constants())
            self.common = (self.pages, c, w, {f: n / self.pages for f, n in self.shapes.items()})
        return c, w

    def constants(self) -> tuple[dict[str, int], dict[str, int]]:
        """The classes and words that are constant by now, with their counts."""
        least = 2 if self.pages > 2 else 1
        return tuple({k: n for k, n in f.items() if n >= max(least, share * self.pages)} for f, share in ((self.classes, CONSTANT_CLASS), (self.words, CONSTANT_WORD)))

    def new_share(self) -> float:
        """The estimated share of blocks whose text is not a repetition, from the least hashes."""
        return min(1.0, _distinct(self.least) / self.blocks) if self.blocks else 0.0

    def new_once(self) -> float:
        """`new_share` where a region that comes with the same article under several paths counts once."""
        kept = sorted(self.once)[:SKETCH]
        blocks = _distinct(kept) * sum(self.once[k][0] for k in kept) / max(1, len(kept))
        return max(self.new_share(), min(1.0, _distinct(self.least) / blocks) if blocks else 0.0)

    def sizes(self) -> tuple[np.ndarray, float]:
        """The unlinked text of a sample of the slot's regions, copies counted once, and how many regions one of them stands for."""
        kept = sorted(self.once)[:SKETCH]
        return np.array([self.once[k][1] for k in kept], float), _distinct(kept) / max(1, len(kept))


def shape(r: Region) -> str:
    """First tag, size class of the unlinked text and share of linked text."""
    total = r.own + r.linked
    link = 0 if not total or r.linked < 0.2 * total else 1 if r.linked < 0.8 * total else 2
    return f"{r.first if r.first == 'h1' else '-'}{link}{min(2, r.prose)}"


def _distinct(least: list[int]) -> float:
    """How many distinct hashes there are, estimated from the least ones."""
    return len(least) if len(least) < SKETCH else (SKETCH - 1) / ((least[-1] + 1) / 2**40)


def article_of(regions: list[Region]) -> int:
    """What tells copies of a page's article: the hash of the region with most unlinked text."""
    return hash_region(max(regions, key=lambda r: r.own)) if regions else 0


def hash_region(r: Region) -> int:
    h = 0
    for t in r.texts:
        h = (h ^ t) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)
        h ^= h >> 29
    return h


def node_of(r: Region, article: int = 0) -> Node:
    """A region as a wrapper node of one page; `article` is the page's article."""
    n = Node(1, Counter([r.tag]), Counter(r.classes), Counter(r.words), Counter([shape(r)]), len(r.blocks), r.own, r.linked)
    n.least = _mixed(r.texts)
    n.once = _once(r, article)
    return n


def _once(r: Region, article: int) -> dict[int, tuple[int, int]]:
    h = hash_region(r) ^ article * 0xC2B2AE3D27D4EB4F & ((1 << 64) - 1)
    h = (h ^ h >> 31) * 0xD6E8FEB86659FD93 & ((1 << 64) - 1)
    return {h >> 24: (len(r.blocks), r.own)}


def _mixed(texts: list[int]) -> list[int]:
    return sorted({(t * 0x9E3779B97F4A7C15 >> 7) & ((1 << 40) - 1) for t in texts})[:SKETCH]


class Item:
    """What is aligned with a wrapper: a region of a page, or a node of another wrapper."""

    def __init__(self, source: Region | Node, article: int = 0) -> None:
        self.source, self.article = source, article
        if isinstance(source, Node):
            self.classes, self.words = source.known()
            total = max(1, sum(source.shapes.values()))
            self.shapes = {k: n / total for k, n in source.shapes.items()}
        else:
            self.classes, self.words, self.shapes = source.classes, source.words, {shape(source): 1.0}

    def node(self) -> Node:
        return self.source if isinstance(self.source, Node) else node_of(self.source, self.article)


class Index:
    """The constants of a wrapper's nodes, so that an item meets all nodes at once.

    Up to 2 * NODES nodes are columns of a matrix (feature, node); beyond that, the most frequent are, and
    the others are listed by feature. Likeness is the same either way, and no node is left out.
    """

    def __init__(self, nodes: list[Node], forget: bool = False) -> None:
        self.forget = forget  # a feature that no node has any more is a strange one again
        self.ids: dict[str, int] = {"": 0}
        self.top = 1
        self.counts = np.zeros(256, np.float32)
        self.rows = np.zeros(256, np.int64)
        self.wide, self.grouped = 2 * NODES, NODES
        self.columns = self.codes = np.zeros(0, np.int64)
        self.telling: np.ndarray | None = None
        self._clear()
        self.sync(nodes, nodes)

    def _clear(self) -> None:
        self.table = np.zeros((256, 16), np.float32)
        self.used, self.dense, self.rest = 1, 0, 0
        self.seen: dict[int, int] = {}
        self.own: dict[int, list[str]] = {}
        self.lists: dict[int, list[int]] = {}
        self.shapes: dict[str, np.ndarray] = {}
        self.ordered: dict[str, np.ndarray] = {}
        self.counts[:] = 0
        self.rows[:] = 0

    def _id(self, feature: str) -> int:
        k = self.ids.get(feature)
        if k is None:
            k = self.ids[feature] = self.top
            self.top += 1
            if k >= len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        return k

    def _row(self, k: int) -> int:
        if not self.rows[k]:
            self.rows[k] = self.used
            self.used += 1
            if self.used > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        return self.rows[k]

    def sync(self, nodes: list[Node], changed: list[Node]) -> None:
        """Take in new nodes and renewed constants; `nodes` are all of them in order."""
        most = self.wide
        if len(nodes) > 2 * self.grouped:
            most, self.grouped = NODES, len(nodes)
            self._clear()
            for n in nodes:
                n.column = -1
            changed = sorted(nodes, key=lambda n: -n.pages)
        for n in changed:
            if n.column < 0:
                if self.dense < most:
                    n.column = self.dense
                    self.dense += 1
                    if self.dense > self.table.shape[1]:
                        self.table = np.concatenate([self.table, np.zeros_like(self.table)], 1)
                else:
                    n.column = self.wide + self.rest
                    self.rest += 1
            self.refresh(n)
        self.codes = np.array([n.column for n in nodes], np.int64)
        self.columns = np.where(self.codes < self.wide, self.codes, self.codes - self.wide + self.dense)
        self.telling = None

    def refresh(self, n: Node) -> None:
        classes, words = n.known()
        c = n.column
        if self.seen.get(c) == n.common[0]:
            return
        self.seen[c], self.telling = n.common[0], None
        for f in self.own.get(c, ()):
            k = self.ids[f]
            self.counts[k] -= 1
            if c < self.wide:
                self.table[self.rows[k], c] = 0
            else:
                self.lists[k].remove(c - self.wide)
            if self.forget and not self.counts[k]:
                del self.ids[f]
        self.own[c] = ["c" + f for f in classes] + ["w" + f for f in words]
        for f in self.own[c]:
            k = self._id(f)
            self.counts[k] += 1
            if c < self.wide:
                row = self._row(k)
                self.table[row, c] = 1
            else:
                self.lists.setdefault(k, []).append(c - self.wide)
        for f in {*self.shapes, *n.common[3]}:
            shares = self.shapes.get(f)
            if shares is None or c >= len(shares):
                shares = self.shapes[f] = np.concatenate([np.zeros(0, np.float32) if shares is None else shares, np.zeros(c + 16, np.float32)])
            shares[c] = n.common[3].get(f, 0)

    def batches(self, items: list[Item]) -> Iterator[np.ndarray]:
        """`likeness` of some items after the other, so that it stays small."""
        size = max(1, CELLS // max(1, len(self.codes)))
        for i in range(0, len(items), size):
            yield self.likeness(items[i : i + size])

    def likeness(self, items: list[Item]) -> np.ndarray:
        """How well each item fits each node, from 0 to 1."""
        if self.telling is None:
            # A feature that most nodes have tells little, such as class names that sites hand out at random.
            self.telling = np.round((1 - self.counts / max(FEW, len(self.codes))) * STEPS) / STEPS
            self.telling[0] = 0
            self.ordered = {f: np.where(self.codes < len(x), x[np.minimum(self.codes, len(x) - 1)], np.float32(0)) for f, x in self.shapes.items()}
        get = self.ids.get
        out = np.zeros((len(items), self.dense + self.rest), np.float32)
        for prefix, weight, unknown in (("c", CLASSES, 1.0), ("w", WORDS, 0.3)):
            flat, starts, strange = [], [], []
            for i in items:
                features = i.classes if prefix == "c" else i.words
                starts.append(len(flat))
                flat.append(0)  # a feature that no node has: no item is without one
                flat += [k for f in features if (k := get(prefix + f)) is not None]
                strange.append(len(features) - (len(flat) - starts[-1] - 1))
            tells = self.telling[flat]
            hits = np.add.reduceat(self.table[self.rows[flat], : self.dense] * tells[:, None], starts, axis=0)
            if self.rest:
                listed = np.zeros((len(items), self.rest), np.float32)
                for row, start, end in zip(listed, starts, [*starts[1:], len(flat)]):
                    for k, tell in zip(flat[start:end], tells[start:end]):
                        if found := self.lists.get(k):
                            row[found] += tell
                hits = np.concatenate([hits, listed], 1)
            total = np.add.reduceat(tells, starts) + np.array(strange, np.float32) * unknown
            out += weight * (hits + PRIOR * 0.5) / (total + PRIOR)[:, None]
        out = out[:, self.columns]
        for row, i in zip(out, items):
            shapes = sum(np.minimum(x, self.ordered[f]) for f, x in i.shapes.items() if f in self.ordered)
            row += SHAPE * np.minimum(1, (3 if len(i.shapes) == 1 else 1.2) * shapes)
        return out


def absorb(node: Node, item: Item) -> None:
    """Merge an item into the node; every word and class stays counted, since a rare one may become a constant later."""
    o = item.source
    if isinstance(o, Node):
        node.pages += o.pages
        node.blocks += o.blocks
        mine = ((node.tags, o.tags), (node.classes, o.classes), (node.words, o.words), (node.shapes, o.shapes))
        new, once = o.least, o.once
        node.optional |= o.optional
        node.repeated |= o.repeated
    else:
        node.pages += 1
        node.blocks += len(o.blocks)
        node.tags[o.tag] += 1
        mine = ((node.classes, o.classes), (node.words, o.words), (node.shapes, item.shapes.keys()))
        new, once = _mixed(o.texts), _once(o, item.article)
    node.own += o.own
    node.linked += o.linked
    for counter, more in mine:
        counter.update(more)
    if new and (len(node.least) < SKETCH or new[0] < node.least[-1]):
        node.least = sorted({*node.least, *new})[:SKETCH]
    node.once.update(once)
    if len(node.once) > 3 * SKETCH:
        node.once = {k: node.once[k] for k in sorted(node.once)[:SKETCH]}


def align(batches: Iterable[np.ndarray]) -> list[int]:
    """For each item the node it fits, in order, such that the likeness adds up to most.

    `batches` are the rows of the likeness. What is left over may repeat a node out of order: -2 - node.
    -1 where nothing fits. Only pairs that are alike enough are chained, through a tree of the best
    chain up to each node, so the work follows their number.
    """
    out: list[int] = []
    rows, cols, gains = [], [], []
    for like in batches:
        i, j = np.nonzero(like >= LIKE)
        rows += (i + len(out)).tolist()
        cols += j.tolist()
        gains += (like[i, j] - LIKE + 1e-3).tolist()
        most = like.argmax(1).tolist() if like.shape[1] else []
        fit = set(i.tolist())
        out += [-2 - most[k] if k in fit else -1 for k in range(len(like))]
    places = {j: p for p, j in enumerate(sorted(set(cols)), 1)}
    tree = [(0.0, 1)] * (len(places) + 1)  # best sum, and 1 or minus the pair it ends with: among equals the first pair
    best: list[float] = []
    back: list[int] = []
    done = 0
    for k, (i, j, gain) in enumerate(zip(rows, cols, gains)):
        while rows[done] < i:  # pairs of one item do not follow each other
            mine, p = (best[done], -done), places[cols[done]]
            while p < len(tree):
                if mine > tree[p]:
                    tree[p] = mine
                p += p & -p
            done += 1
        top, p = tree[0], places[j] - 1
        while p:
            if tree[p] > top:
                top = tree[p]
            p &= p - 1
        best.append(top[0] + gain)
        back.append(-top[1])
    k = max(range(len(best)), key=best.__getitem__) if best else -1
    while k >= 0:
        out[rows[k]] = cols[k]
        k = back[k]
    return out


class Wrapper:
    """A union-free expression: nodes in order, each optional or repeated or neither; and its text tokens.

    A text token that comes with many different articles is a constant of the expression; where pages
    disagree on the text it is a slot. `texts` counts, for each text token, the different articles it came with.
    """

    def __init__(self, nodes: list[Node] | None = None, constants: set[int] | None = None) -> None:
        self.whole = nodes or []
        self.index = Index(self.whole)
        self.constants = constants or set()
        self.pages = 0
        self.texts: dict[int, tuple[int, int]] = {}

    @property
    def nodes(self) -> list[Node]:
        """The nodes whose features stand in the index's matrix: all of them, or the most frequent of many."""
        return [n for n in self.whole if n.column < self.index.wide]

    def note(self, stream: list[Region], article: int) -> None:
        """Count the text tokens of a page; copies of an article count once."""
        self.pages += 1
        for r in stream:
            for t in r.texts:
                n, last = self.texts.get(t, (0, 0))
                if n == 0 or last != article:
                    self.texts[t] = (n + 1, article)

    def settle(self) -> None:
        """Tell constants from slots, once all pages of a part are in; what is no constant is forgotten."""
        least = max(LEAST_PAGES, CONSTANT_TEXT * self.pages)
        self.constants = {t for t, (n, _) in self.texts.items() if n >= least}
        self.texts = {}

    def slots(self, r: Region) -> int:
        """How many of a region's text tokens fill slots."""
        return sum(t not in self.constants for t in r.texts)

    def fold(self, stream: list[Region] | list[Node]) -> None:
        """Generalise the wrapper so that it accepts the stream as well."""
        article = article_of([x for x in stream if isinstance(x, Region)])
        if stream and isinstance(stream[0], Region):
            self.note(stream, article)
        items = [Item(x, article) for x in stream]
        if not self.whole:
            self.whole = [i.node() for i in items]
            for n in self.whole:
                n.column = -1
            self.index.sync(self.whole, self.whole)
            return
        fits = align(self.index.batches(items))
        matched = {f for f in fits if f >= 0}
        for j, node in enumerate(self.whole):
            if j not in matched:
                node.optional = True
        at, inserted = 0, []
        twins = Index([], forget=True)
        for item, f in zip(items, fits):
            if f >= 0:
                absorb(self.whole[f], item)
                at = f + 1
            elif f < -1:
                self.whole[-2 - f].repeated = True
                absorb(self.whole[-2 - f], item)
            else:
                node = item.node()
                node.optional, node.column = True, -1
                scores = twins.likeness([item])[0] if inserted else np.zeros(1)
                if scores.max() >= LIKE:
                    twin = inserted[int(scores.argmax())][1]
                    twin.repeated = True
                    absorb(twin, item)
                    twins.refresh(twin)
                else:
                    inserted.append((at, node))
                    twins.sync([x for _, x in inserted], [node])
        changed = [self.whole[f if f >= 0 else -2 - f] for f in fits if f != -1]
        if inserted:
            for _, node in inserted:
                node.column = -1
            grown, k = [], 0
            for j in range(len(self.whole) + 1):
                while k < len(inserted) and inserted[k][0] <= j:
                    grown.append(inserted[k][1])
                    k += 1
                grown += self.whole[j : j + 1]
            self.whole = grown
            self.index.sync(self.whole, changed + [node for _, node in inserted])
        else:
            for node in changed:
                self.index.refresh(node)

    def bodies(self) -> tuple[set[int], float]:
        """The nodes that hold main content, and the unlinked text that a page's region needs at least: none."""
        fit = [n.linked <= BODY_LINKED * max(1, n.own + n.linked) and n.new_once() >= BODY_NEW for n in self.whole]
        sizes = [n.sizes() for n in self.whole]
        pooled = sorted((x, each) for (own, each), good in zip(sizes, fit) if good for x in own)
        if not pooled:
            return set(), 0.0
        reached = np.cumsum([each for _, each in pooled])
        most = LONG * pooled[int(np.searchsorted(reached, LONGER * reached[-1]))][0]
        usual = [float(np.minimum(own, most).mean()) if good and len(own) else 0.0 for (own, _), good in zip(sizes, fit)]
        top = max((len(own) * each * x, x) for (own, each), x in zip(sizes, usual))[1]
        return {i for i, x in enumerate(usual) if x > 0 and x >= BODY_SHARE * top}, 0.0

    def body_regions(self, regions: list[Region], bodies: set[int], least: float) -> list[tuple[float, int, Region]]:
        """(weight, slot, region) of a page's regions that fill body slots, the one with most unlinked text first, as far as the slot's text is new.

        A region fills a body slot if the alignment put it there, or if no other node is clearly more
        like it: regions may stand out of order, and the alignment must leave some of those out.
        """
        inside = np.zeros(len(self.whole), bool)
        inside[list(bodies)] = True
        if not inside.any():
            return []
        body, rest, slots = [], [], []

        def seen() -> Iterator[np.ndarray]:
            for like in self.index.batches([Item(r) for r in regions]):
                body.extend(like[:, inside].max(1))
                rest.extend(like[:, ~inside].max(1) if not inside.all() else np.zeros(len(like)))
                slots.extend(np.where(inside, like, -1).argmax(1))
                yield like

        fits = align(seen())
        new = {i: self.whole[i].new_share() for i in bodies}
        found = []
        for r, b, x, f, k in zip(regions, body, rest, fits, slots):
            aligned = f != -1 and (f if f >= 0 else -2 - f) in bodies
            if r.own >= least and self.slots(r) >= SLOTS * len(r.texts) and b >= LIKE and b >= x - (NEARLY if aligned else 0.0):
                slot = (f if f >= 0 else -2 - f) if aligned else int(k)
                found.append((r.own * new[slot], slot, r))
        return sorted(found, key=lambda x: -x[0])

    def main_region(self, regions: list[Region], bodies: set[int], least: float) -> Region | None:
        """The first of the page's body regions."""
        found = self.body_regions(regions, bodies, least)
        return found[0][2] if found else None

    def expression(self) -> str:
        """The wrapper as a readable regular expression."""
        one = lambda n: "<" + n.tags.most_common(1)[0][0] + " " + " ".join(sorted(n.known()[1])[:6]) + ">"
        return " ".join(f"({one(n)}){'*' if n.optional and n.repeated else '+' if n.repeated else '?' if n.optional else ''}" for n in self.whole)

    def packed(self, finished: bool = False) -> str:
        """The wrapper as text; of a finished one, which takes in no more, without the words and classes that are no constants."""
        counts = [n.constants() if finished else (n.classes, n.words) for n in self.whole]
        return json.dumps([sorted(self.constants), [[n.pages, n.tags, c, w, n.shapes, n.blocks, n.own, n.linked, n.least, list(n.once.items()), n.optional, n.repeated] for n, (c, w) in zip(self.whole, counts)]])

    @classmethod
    def of(cls, packed: str) -> Wrapper:
        constants, nodes = json.loads(packed)
        return cls([Node(p, Counter(t), Counter(c), Counter(w), Counter(s), b, o, k, x, {h: tuple(v) for h, v in once}, opt, rep) for p, t, c, w, s, b, o, k, x, once, opt, rep in nodes], set(constants))


def parse_pages(pages: DataFrame) -> DataFrame:
    """(path, key, regions) of each page, the latest delivery of each path; pages without html are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, page, at in zip(pdf["path"], pdf["html"], pdf["at"]):
                key, regions = regions_of(page)
                if regions:
                    rows.append((path, at, key, json.dumps([r.packed() for r in regions])))
            yield pd.DataFrame(rows, columns=["path", "at", "key", "regions"])

    given = pages.filter("source_html_path is not null and html is not null and html <> ''").select(F.col("source_html_path").alias("path"), "html", F.coalesce(F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit(-(2**62))).alias("at"))
    parsed = given.mapInPandas(run, "path string, at long, key string, regions string")
    return parsed.groupBy("path").agg(F.max(F.struct("at", "regions", "key")).alias("p")).select("path", "p.key", "p.regions")


def together(pages: list[list[int]]) -> set[tuple[int, int]]:
    """Pairs of body slots that hold one article between them, from the slots found on each page."""
    alone: Counter = Counter()
    both: Counter = Counter()
    for slots in pages:
        own = sorted(set(slots))
        alone.update(own)
        both.update((a, b) for i, a in enumerate(own) for b in own[i + 1 :])
    return {p for (a, b), n in both.items() if n >= max(SEVERAL, TOGETHER * min(alone[a], alone[b]), OFTEN * max(alone[a], alone[b])) for p in ((a, b), (b, a))}


def infer(spread: DataFrame, parts: int) -> DataFrame:
    """(key, wrapper) of each host, over all of its pages: one wrapper per part, merged in rounds of a bounded number of parts; `parts` is the most that a host has."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        wrapper = Wrapper()
        for packed in pdf.sort_values("path")["regions"]:
            wrapper.fold([Region.of(p) for p in json.loads(packed)])
        wrapper.settle()
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "part": [pdf["part"].iloc[0]], "wrapper": [wrapper.packed(finished=alone)]})

    def merge(pdf: pd.DataFrame, finished: bool) -> pd.DataFrame:
        whole = Wrapper()
        for packed in sorted(pdf["wrapper"], key=lambda w: (-len(w), w)):
            part = Wrapper.of(packed)
            whole.fold(part.whole)
            whole.constants |= part.constants
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "part": [pdf["part"].iloc[0]], "wrapper": [whole.packed(finished)]})

    alone = parts == 1
    found = spread.groupBy("key", "part").applyInPandas(fold, "key string, part int, wrapper string")
    while parts > 1:
        parts = -(-parts // MERGED)
        found = found.withColumn("part", F.floor(F.col("part") / MERGED).cast("int")).groupBy("key", "part").applyInPandas(partial(merge, finished=parts == 1), "key string, part int, wrapper string")
    return found.select("key", "wrapper")


def main_blocks(pages: DataFrame) -> DataFrame:
    """(source_html_path, block_no): the blocks of each page that belong to its main content.

    A path that is delivered several times counts once, as it was fetched last (ties: the greater parse);
    rows without path or html, and pages without a body region, give no row. An article that stands in
    several containers comes out whole if its host's pages show that these go together. Blocks without an integer
    number and hidden blocks are not seen. Extra columns are not read.
    """
    parsed = stage(parse_pages(pages), "pages")
    sizes = parsed.groupBy("key").agg(F.ceil(F.count("*") / PAGES_A_TASK).cast("int").alias("parts"))
    most = sizes.agg(F.max("parts")).first()[0] or 1
    spread = parsed.join(broadcast_if_small(sizes.withColumnRenamed("key", "size_key")), F.col("key") == F.col("size_key")).select("key", F.pmod(F.xxhash64("path"), F.col("parts")).cast("int").alias("part"), "path", "regions")
    wrappers = stage(infer(spread, most).join(sizes, "key"), "wrappers").select("key", "wrapper", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def read(pdf: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(pdf) and len(own):
            wrapper = Wrapper.of(own["wrapper"].iloc[0])
            bodies, least = wrapper.bodies()
            found = [(path, f) for path, packed in zip(pdf["path"], pdf["regions"]) if (f := wrapper.body_regions([Region.of(p) for p in json.loads(packed)], bodies, least))]
            pairs = together([[slot for _, slot, _ in f] for _, f in found])
            for path, f in found:
                own = [r for _, slot, r in f if r is f[0][2] or (f[0][1], slot) in pairs]
                rows += [(path, b) for b in dict.fromkeys(b for r in own for b in r.blocks)]
        return pd.DataFrame(rows, columns=["source_html_path", "block_no"])

    return spread.groupBy("key", "part").cogroup(wrappers.groupBy("key", "part")).applyInPandas(read, "source_html_path string, block_no long")
