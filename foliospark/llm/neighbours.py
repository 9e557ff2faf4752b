"""The most similar vectors of every vector, by hierarchical k-means trees searched best bin first.

Vectors are compared within groups (same configuration and modality). Exact copies are reduced to one
representative with its six least article ids, which decides all ties, so a vector that a third of
all rows share costs one search. Per group a tree of k-means splits is fitted on a bounded sample;
every vector is then placed in a leaf. Where the sample was too small for the group, leaves that hold
too many vectors are split again on members of their own, one task per leaf, until none does, so the
leaves stay small as the data grow. A search pops tree nodes from a priority queue, most similar
centroid first, and visits leaves in the order in which they come out. How many leaves are visited is
calibrated per group: a bounded set of queries is compared with all rows, block by block, and the
visits are widened until the leaves seen hold `recall` of their true neighbours. Groups whose queries
have too few neighbours to tell get more queries, and if that does not help, all leaves are visited.

Searches meet leaves in blocks: leaves larger than a block (vectors that no split can tell apart) are
cut up, and so are the queries that visit one, so no task grows with the crowd of a region. A block
yields at most six entries per query and per member (what a query finds is also news to the member found).
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.tables import broadcast_if_small, stage


@dataclass(frozen=True)
class Settings:
    """`sample` bounds what one fit sees (a group's tree, a leaf's split), `queries` and `more_queries` what a group is calibrated on.

    A tree has up to about `leaves` leaves, of `leaf` vectors or, beyond leaf * leaves vectors, as many more;
    that bounds its size in the broadcast. `ranked` is how far calibration looks along a search before it
    gives up and has all leaves visited; `evidence` is how many true pairs it needs, `fair` how many it wants.
    """

    neighbours: int = 5
    least: float = 0.8
    recall: float = 0.998
    sample: int = 20_000
    queries: int = 200
    leaf: int = 256
    branches: int = 16
    least_in_leaf: int = 16
    block: int = 2048
    tree_bytes: int = 64 << 20
    leaves: int = 1 << 16
    more_queries: int = 3200
    ranked: int = 2048
    evidence: int = 20
    fair: int = 200

    def leaf_of(self, total: int) -> int:
        return max(self.leaf, -(-total // self.leaves))


#: Nodes of a tree up to which a vector is compared with all of them at once.
DENSE = 2048
#: Digits to which similarities count as equal.
DIGITS = 12


def usable(vectors: DataFrame, configurations: DataFrame) -> DataFrame:
    """(g, article_id, v): vectors that take part.

    A vector takes part if its article_id, modality and configuration are known, it has the length the
    configuration gives, and its values are all there, finite and not all zero. The stored `dimensions`
    of a vector's row are not consulted.
    """
    sizes = configurations.select(F.col("configuration_id").alias("c_id"), F.col("dimensions").alias("c_dim")).filter("c_id is not null").dropDuplicates(["c_id"])
    v = vectors.select("configuration_id", "modality", "article_id", F.col("vector").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    joined = v.join(broadcast_if_small(sizes), F.col("configuration_id") == F.col("c_id")).filter(F.col("modality").isNotNull() & F.col("article_id").isNotNull() & (F.size("v") == F.col("c_dim")) & fine)
    return joined.select(F.concat_ws("\x1f", "configuration_id", "modality").alias("g"), "article_id", "v")


def unit(rows: list) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors in double precision from a list column of one length, without a Python object per vector."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(c), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each value of the column g."""
    for g in pc.unique(batch.column("g")).to_pylist():
        yield g, batch.filter(pc.equal(batch.column("g"), g))


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of spherical k-means and the cluster of each row; empty clusters are left out."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        kept, own = np.unique(own, return_inverse=True)
        sums = np.zeros((len(kept), x.shape[1]), x.dtype)
        np.add.at(sums, own, x)
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    own = (x @ c.T).argmax(1)
    kept, own = np.unique(own, return_inverse=True)
    return c[kept], own


@dataclass
class Tree:
    """Nodes of a k-means tree: centroids, children, and the leaf number of nodes without children."""

    centroids: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    visits: int = 1

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def order(self, similarities: Callable[[int], list[float]], visits: int) -> list[int]:
        """The first leaves of a best-bin-first search; `similarities` gives those of the query to a node's children."""
        heap, out = [(-0.0, 0)], []
        while heap and len(out) < visits:
            _, node = heapq.heappop(heap)
            while kids := self.children[node]:
                known = similarities(node)
                best = max(range(len(kids)), key=known.__getitem__)
                for k, (kid, x) in enumerate(zip(kids, known)):
                    if k != best:
                        heapq.heappush(heap, (-x, kid))
                node = kids[best]
            out.append(self.leaf[node])
        return out

    def orders(self, x: np.ndarray, visits: int) -> list[list[int]]:
        """`order` of each row of x. In a small tree the similarities to all nodes come from one product."""
        x = x.astype(np.float32)
        out: list[list[int]] = []
        if len(self.leaf) > DENSE:
            kids = [np.array(k) for k in self.children]
            for row in x:
                out.append(self.order(lambda n: (self.centroids[kids[n]] @ row).tolist(), visits))  # noqa: B023
            return out
        for at in range(0, len(x), 1024):
            for row in (x[at : at + 1024] @ self.centroids.T).tolist():
                out.append(self.order(lambda n: [row[k] for k in self.children[n]], visits))  # noqa: B023
        return out

    def places(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x."""
        return np.array([o[0] for o in self.orders(x, 1)], np.int64)

    def graft(self, leaf: int, below: Tree) -> None:
        """Put a tree in the place of a leaf; its first leaf keeps the number, the others get new ones."""
        root, base, new = self.leaf.index(leaf), len(self.leaf), self.leaves
        at = lambda k: root if k == 0 else base + k - 1
        number = lambda n: n if n < 0 else leaf if n == 0 else new + n - 1
        self.children += [[] for _ in below.leaf[1:]]
        self.leaf += [-1] * (len(below.leaf) - 1)
        for k, (kids, n) in enumerate(zip(below.children, below.leaf)):
            self.children[at(k)], self.leaf[at(k)] = [at(c) for c in kids], number(n)
        self.centroids = np.concatenate([self.centroids, below.centroids[1:]])


def grow(x: np.ndarray, total: int, s: Settings, leaf: int | None = None) -> Tree:
    """A tree over a sample `x` of `total` unit vectors, with leaves of about `leaf` of all vectors."""
    x = x.astype(np.float32)
    leaf = leaf or s.leaf_of(total)
    tree, todo = Tree(np.zeros((0, x.shape[1])), [[]], [-1]), [(0, np.arange(len(x)))]
    centroids, leaves = [x.mean(0)], 0
    share = total / max(1, len(x))
    while todo:
        node, rows = todo.pop()
        k = min(s.branches, int(np.ceil(len(rows) * share / leaf)), len(rows) // s.least_in_leaf)
        own = None
        if k > 1:
            c, own = kmeans(x[rows], k)
        if own is None or len(c) < 2:
            tree.leaf[node], leaves = leaves, leaves + 1
            continue
        for j in range(len(c)):
            tree.children.append([]), tree.leaf.append(-1), centroids.append(c[j])
            tree.children[node].append(len(centroids) - 1)
            todo.append((len(centroids) - 1, rows[own == j]))
    tree.centroids = np.stack(centroids).astype(np.float32)
    return tree


def best_entries(sim: np.ndarray, query: np.ndarray, aid: np.ndarray, keep: int) -> np.ndarray:
    """Indices of the first `keep` entries of each query by similarity, then article id."""
    at = np.lexsort((aid, -sim, query))
    q = query[at]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.zeros(0, bool)
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0)) if len(q) else q
    return at[rank < keep]


def pairs_above(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, similarity) of all pairs at `least` or more, exact in double precision."""
    i, j = np.nonzero(a.astype(np.float32) @ b.astype(np.float32).T >= least - 1e-4)
    sim = np.round(np.einsum("ij,ij->i", a[i], b[j]), DIGITS)
    fits = sim >= least
    return i[fits], j[fits], sim[fits]


def _spread(of: np.ndarray, other: np.ndarray, sim: np.ndarray, aids: list, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries (of, article id, similarity), each partner spread over its article ids, the first `keep` per `of`."""
    counts = np.array([len(aids[k]) for k in other], np.int64) if len(other) else np.zeros(0, np.int64)
    of, sim = np.repeat(of, counts), np.repeat(sim, counts)
    aid = np.array([x for k in other for x in aids[k]], object)
    if not len(of):
        return of, aid, sim
    codes = np.unique(aid.astype(str), return_inverse=True)[1]
    at = best_entries(sim, of, codes, keep)
    return of[at], aid[at], sim[at]


def representatives(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (g, rep, v, aids) with their `keep` least article ids, and members (g, rep, article_id)."""
    keyed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit("second"), "v")})
    same = Window.partitionBy("g", "h1", "h2")
    ranked = keyed.withColumn("rn", F.dense_rank().over(same.orderBy("article_id"))).filter(F.col("rn") <= keep)
    distinct = ranked.groupBy("g", "h1", "h2").agg(F.min("article_id").alias("rep"), F.min(F.when(F.col("rn") == 1, F.col("v"))).alias("v"), F.array_sort(F.collect_set("article_id")).alias("aids"))
    members = keyed.select("g", "h1", "h2", "article_id").distinct()
    return distinct, members


NODES = "g string, top int, node int, leaf int, children array<int>, centroid array<float>"


def _nodes(g: str, top: int, t: Tree) -> pd.DataFrame:
    return pd.DataFrame({"g": g, "top": top, "node": range(len(t.leaf)), "leaf": t.leaf, "children": t.children, "centroid": [c.tolist() for c in t.centroids]})


def _trees(nodes: DataFrame) -> dict[tuple[str, int], Tree]:
    """The trees of a frame of nodes; only centroids reach the driver, within the bound of a tree's leaves."""
    by: dict[tuple[str, int], list] = {}
    for r in nodes.collect():
        by.setdefault((r.g, r.top), []).append(r)
    out = {}
    for key, rs in by.items():
        rs.sort(key=lambda r: r.node)
        out[key] = Tree(np.array([r.centroid for r in rs], np.float32), [list(r.children) for r in rs], [r.leaf for r in rs])
    return out


def _sampled(rows: DataFrame, rate: DataFrame, keys: list[str], salt: int) -> DataFrame:
    """Of each key about `rate` of its rows, the same ones in every run."""
    chance = F.pmod(F.xxhash64(F.lit(salt), "h1", "h2"), F.lit(1_000_000)) / 1_000_000
    return rows.join(broadcast_if_small(rate), keys).filter(chance < F.col("rate"))


def fit(distinct: DataFrame, s: Settings) -> tuple[dict[str, Tree], dict[str, int]]:
    """A tree per group, fitted on at most about s.sample of its vectors, and the groups' sizes."""
    counts = distinct.groupBy("g").agg(F.count("*").alias("n"))
    sizes = {r.g: r["n"] for r in counts.collect()}  # one row per group
    if not sizes:
        return {}, {}
    rate = counts.select("g", "n", (F.lit(float(s.sample)) / F.col("n")).alias("rate"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return _nodes(pdf["g"].iloc[0], 0, grow(unit(list(pdf["v"])), int(pdf["n"].iloc[0]), s))

    found = _trees(_sampled(distinct, rate, ["g"], 0).select("g", "n", "v").groupBy("g").applyInPandas(one, NODES))
    return {g: t for (g, _), t in found.items()}, sizes


def refine(distinct: DataFrame, trees: dict[str, Tree], sizes: dict[str, int], s: Settings, rounds: int = 8) -> None:
    """Split the leaves of these trees that hold more than twice what they should, on members of their own, until none is left.

    Only groups beyond the sample can have such leaves. A leaf that k-means cannot split stays as it is;
    the search cuts it into blocks. Each round is two passes over the vectors of the groups concerned.
    """
    spark, whole = distinct.sparkSession, set()
    for n in range(1, rounds + 1):
        large = {g: t for g, t in trees.items() if sizes[g] > s.sample}
        if not large:
            return
        shared = spark.sparkContext.broadcast(large)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g, part in by_group(batch):
                    leaf, many = np.unique(shared.value[g].places(matrix(part.column("v"))), return_counts=True)  # noqa: B023
                    yield pa.RecordBatch.from_arrays([pa.array([g] * len(leaf), pa.string()), pa.array(leaf, pa.int32()), pa.array(many, pa.int64())], names=["g", "top", "n"])

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for g, part in by_group(batch):
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value[g].places(matrix(part.column("v"))), pa.int32())], names=[*part.schema.names, "top"])  # noqa: B023

        rows = distinct.filter(F.col("g").isin(list(large))).select("g", "h1", "h2", "v")
        held = rows.select("g", "v").mapInArrow(count, "g string, top int, n long").groupBy("g", "top").agg(F.sum("n").alias("n"))
        full = [(r.g, r.top, r["n"], min(1.0, s.sample / r["n"])) for r in held.collect() if r["n"] > 2 * s.leaf_of(sizes[r.g]) and (r.g, r.top) not in whole]  # one row per leaf
        if full:
            rate = spark.createDataFrame(full, "g string, top int, n long, rate double")
            leaf_of = {g: s.leaf_of(sizes[g]) for g in large}

            def split(pdf: pd.DataFrame) -> pd.DataFrame:
                g = pdf["g"].iloc[0]
                return _nodes(g, int(pdf["top"].iloc[0]), grow(unit(list(pdf["v"])), int(pdf["n"].iloc[0]), s, leaf_of[g]))  # noqa: B023

            own = _sampled(rows.mapInArrow(members, "g string, h1 long, h2 long, v array<float>, top int"), rate, ["g", "top"], n)
            below = _trees(own.select("g", "top", "n", "v").groupBy("g", "top").applyInPandas(split, NODES))
            for (g, top), t in sorted(below.items()):
                if t.leaves > 1:
                    trees[g].graft(top, t)
                else:
                    whole.add((g, top))
        shared.unpersist()
        if not full:
            return


def _true_pairs(distinct: DataFrame, picked: list, s: Settings) -> DataFrame:
    """(g, q, h1, h2): of each picked vector (g, rep, v) its true neighbours, among all rows, block by block."""
    spark = distinct.sparkSession
    asked: dict[str, tuple[list[int], list[str], np.ndarray]] = {}
    for g in {r.g for r in picked}:
        own = [r for r in picked if r.g == g]
        asked[g] = ([r.rn for r in own], [r.rep for r in own], unit([r.v for r in own]))
    shared = spark.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, part in by_group(batch):
                if g not in shared.value:
                    continue
                numbers, names, q = shared.value[g]
                x, reps = matrix(part.column("v")), np.array(part.column("rep").to_pylist(), object)
                for low in range(0, len(q), 400):
                    i, j, sim = pairs_above(q[low : low + 400], x, s.least)
                    other = np.array([names[low + a] != reps[b] for a, b in zip(i, j)], bool)
                    i, j, sim = i[other], j[other], sim[other]
                    at = best_entries(sim, i, np.unique(reps, return_inverse=True)[1][j], s.neighbours)
                    i, j = i[at], j[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g] * len(at), pa.string()), pa.array([numbers[low + a] for a in i], pa.int32()), part.column("h1").take(pa.array(j)), part.column("h2").take(pa.array(j)), pa.array(reps[j], pa.string()), pa.array(sim[at], pa.float64())],
                        names=["g", "q", "h1", "h2", "rep", "sim"],
                    )

    found = distinct.select("g", "h1", "h2", "rep", "v").mapInArrow(compare, "g string, q int, h1 long, h2 long, rep string, sim double")
    true = found.withColumn("k", F.row_number().over(Window.partitionBy("g", "q").orderBy(F.desc("sim"), "rep"))).filter(F.col("k") <= s.neighbours)
    return stage(true.select("g", "q", "h1", "h2"), "true-pairs")


def calibrate(distinct: DataFrame, trees: dict[str, Tree], sizes: dict[str, int], s: Settings) -> None:
    """Set each tree's visits: the least number of leaves in which s.recall of true neighbours lie.

    The queries are the vectors of the least hash of each group. A pair is seen if either of the two visits
    the leaf of the other, so the lesser of both ranks counts. Visits that rest on few pairs are widened by
    half; where there are next to no pairs, or they lie too far along a search, all leaves are visited.
    """
    spark = distinct.sparkSession
    first = Window.partitionBy("g").orderBy("h2", "h1")
    numbered = distinct.select("g", "h1", "h2", "rep", "v").withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= s.more_queries)
    ranks: dict[str, dict[int, int]] = {g: {} for g in trees}
    shared = spark.sparkContext.broadcast(trees)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, part in by_group(batch):
                tree = shared.value[g]
                a, b = matrix(part.column("v")), matrix(part.column("w"))
                (a_orders, b_orders), far = (tree.orders(x, s.ranked) for x in (a, b)), tree.leaves
                at = lambda order, leaf: order.index(leaf) if leaf in order else far  # noqa: B023, E731
                found = [min(at(x, y[0]), at(y, x[0])) for x, y in zip(a_orders, b_orders)]
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(found), pa.string()), pa.array(found, pa.int32())], names=["g", "rank"])

    todo, low = list(trees), 0
    for high in (s.queries, s.more_queries):
        queries = numbered.filter(F.col("g").isin(todo) & (F.col("rn") > low) & (F.col("rn") <= high)).collect()
        if queries:
            pairs = _true_pairs(distinct.filter(F.col("g").isin(todo)), queries, s)
            asked = spark.createDataFrame([(r.g, r.rn, r.v) for r in queries], "g string, q int, w array<float>")
            both = distinct.select("g", "h1", "h2", "v").join(F.broadcast(pairs), ["g", "h1", "h2"]).join(F.broadcast(asked), ["g", "q"])  # s.neighbours rows per query at most
            for r in both.select("g", "v", "w").mapInArrow(rank, "g string, rank int").groupBy("g", "rank").count().collect():  # one row per group and visited leaf
                ranks[r.g][r["rank"]] = ranks[r.g].get(r["rank"], 0) + r["count"]
        todo, low = [g for g in todo if sum(ranks[g].values()) < s.fair and sizes[g] > high], high
        if not todo:
            break
    shared.unpersist()
    for g, tree in trees.items():
        total, seen = sum(ranks[g].values()), 0
        tree.visits = tree.leaves
        if total < min(s.evidence, sizes[g]):
            continue
        for at, n in sorted(ranks[g].items()):
            seen += n
            if seen >= s.recall * total:
                wide = at + 1 if total >= s.fair else -(-3 * (at + 1) // 2)
                tree.visits = min(tree.leaves, max(2, wide))
                break


def neighbours(vectors: DataFrame, configurations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(configuration_id, modality, article_id, neighbour_id, similarity): the most similar other articles of each.

    At most s.neighbours each, at a cosine of s.least or more, equal ones (to 12 digits) by article_id.
    An article that comes with several vectors under one configuration and modality is found by any of
    them. Empty tables and groups of one vector give no row; extra columns are not read.
    """
    keep = s.neighbours + 1  # an article is its own nearest
    distinct, members = representatives(usable(vectors, configurations), keep)
    distinct = stage(distinct, "vectors")
    trees, sizes = fit(distinct, s)
    parts = []
    for some in _batches(trees, sizes, s):
        rows = distinct if len(some) == len(trees) else distinct.filter(F.col("g").isin(list(some)))
        refine(rows, some, sizes, s)
        calibrate(rows, some, sizes, s)
        parts.append(_search(rows, some, s, keep))
    entries = parts[0] if parts else distinct.select("g", "h1", "h2", F.col("rep").alias("aid"), F.lit(0.0).alias("sim")).limit(0)
    for p in parts[1:]:
        entries = entries.unionByName(p)
    merged = entries.groupBy("g", "h1", "h2", "aid").agg(F.max("sim").alias("sim"))
    top = merged.withColumn("rn", F.row_number().over(Window.partitionBy("g", "h1", "h2").orderBy(F.desc("sim"), "aid"))).filter(F.col("rn") <= keep)
    lists = top.groupBy("g", "h1", "h2").agg(F.array_sort(F.collect_list(F.struct("rn", "aid", "sim"))).alias("near"))
    own = members.join(lists, ["g", "h1", "h2"])
    nearest = F.slice(F.filter("near", lambda x: x["aid"] != F.col("article_id")), 1, s.neighbours)
    out = own.select("g", "article_id", F.explode(nearest).alias("n"))
    key = F.split("g", "\x1f")
    return out.select(key[0].alias("configuration_id"), key[1].alias("modality"), "article_id", F.col("n.aid").alias("neighbour_id"), F.col("n.sim").alias("similarity"))


def _batches(trees: dict[str, Tree], sizes: dict[str, int], s: Settings) -> list[dict[str, Tree]]:
    """Groups whose trees, as large as they can become, and queries stay within the broadcast limit together; one batch in all but extreme cases."""
    out: list[dict[str, Tree]] = []
    used = s.tree_bytes + 1
    for g in sorted(trees):
        nodes = max(len(trees[g].leaf), 2 * sizes[g] // s.leaf_of(sizes[g]) if sizes[g] > s.sample else 0)
        n = (4 * nodes + 8 * min(s.more_queries, sizes[g])) * trees[g].centroids.shape[1]
        if used + n > s.tree_bytes:
            out.append({})
            used = 0
        out[-1][g], used = trees[g], used + n
    return out


def _search(distinct: DataFrame, trees: dict[str, Tree], s: Settings, keep: int) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(trees)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, part in by_group(batch):
                tree = shared.value[g]
                leaves = pa.array(tree.orders(matrix(part.column("v")), tree.visits), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, leaves], names=[*part.schema.names, "leaves"])

    kinds = "g string, h1 long, h2 long, rep string, v array<float>, aids array<string>"
    placed = stage(distinct.select("g", "h1", "h2", "rep", "v", "aids").mapInArrow(place, f"{kinds}, leaves array<int>"), "placed")
    fresh = [F.col(c).alias(c) for c in ("g", "h1", "h2", "v", "aids")]  # the two sides of the join need columns of their own
    index = placed.select(*fresh, F.col("leaves")[0].alias("leaf"))
    query = placed.select(*fresh, F.explode("leaves").alias("leaf"))
    # Leaves and their visitors in blocks: as many as their counts call for.
    split = lambda n: F.ceil(n / s.block).cast("int")
    sizes = index.groupBy("g", "leaf").agg(split(F.count("*")).alias("ni")).join(placed.select("g", F.explode("leaves").alias("leaf")).groupBy("g", "leaf").agg(split(F.count("*")).alias("nq")), ["g", "leaf"])
    sizes = broadcast_if_small(stage(sizes, "leaf-sizes"))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    index = index.join(sizes, ["g", "leaf"]).withColumn("ib", F.pmod("h1", "ni").cast("int")).withColumn("qb", every(F.col("nq"))).drop("ni", "nq")
    query = query.join(sizes, ["g", "leaf"]).withColumn("qb", F.pmod("h1", "nq").cast("int")).withColumn("ib", every(F.col("ni"))).drop("ni", "nq")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["g", "h1", "h2", "aid", "sim"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
        if not len(a) or not len(b):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        i, j, sim = pairs_above(matrix(a["v"]), matrix(b["v"]), s.least)
        keys_of = lambda t: (t["h1"].to_numpy(), t["h2"].to_numpy())
        (a1, a2), (b1, b2) = keys_of(a), keys_of(b)
        same = (a1[i] == b1[j]) & (a2[i] == b2[j])
        sim = np.where(same, 1.0, sim)
        q, aid, qs = _spread(i, j, sim, b["aids"].to_pylist(), keep)
        m, mid, ms = _spread(j[~same], i[~same], sim[~same], a["aids"].to_pylist(), keep)
        both = lambda x, y: np.concatenate([x[q], y[m]])
        columns = [[a["g"][0].as_py()] * (len(q) + len(m)), both(a1, b1), both(a2, b2), np.concatenate([aid, mid]), np.concatenate([qs, ms])]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    keys = ["g", "leaf", "ib", "qb"]
    return query.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(meet, "g string, h1 long, h2 long, aid string, sim double")


def neighbour_pairs(vectors: DataFrame, configurations: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(configuration_id, modality, article_id_a, article_id_b), a < b: pairs of which one is among the other's most similar."""
    n = neighbours(vectors, configurations, s)
    return n.select("configuration_id", "modality", F.least("article_id", "neighbour_id").alias("article_id_a"), F.greatest("article_id", "neighbour_id").alias("article_id_b")).distinct()
