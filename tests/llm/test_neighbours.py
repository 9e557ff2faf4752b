"""Neighbour search against brute force."""

import numpy as np
import pytest

from foliospark.llm import neighbours as nb

SCHEMA = "configuration_id string, modality string, article_id string, vector array<float>, dimensions int, g string, leaf int"


def brute(rows, dims, k=5, least=0.8):
    by = {}
    for c, m, a, v, *_ in rows:
        if c in dims and m and a and v is not None and len(v) == dims[c] and None not in v:
            x = np.array(v, np.float32).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                by.setdefault((c, m), {})[a] = x / np.linalg.norm(x)
    out = set()
    for (c, m), items in by.items():
        for a, x in items.items():
            near = sorted((-round(float(x @ y), 12), b) for b, y in items.items() if b != a)
            out.update((c, m, *sorted((a, b))) for s, b in near[:k] if -s >= least)
    return out


def data(n=900, dim=16, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n // 6, dim))
    rows = []
    for i in range(n):
        v = centres[r.integers(len(centres))] + 0.25 * r.normal(size=dim)
        rows.append(("c1", "text" if i % 3 else "image", f"a{i:05d}", (v * r.uniform(0.3, 8)).astype(np.float32).tolist(), 7, "x", 1))
    return rows


@pytest.fixture(scope="module")
def configurations(spark):
    return spark.createDataFrame([("c1", 16, "z"), ("c2", 3, "z"), (None, 3, "z")], "configuration_id string, dimensions int, vector string")


def test_recall_against_brute_force(spark, configurations):
    rows = data()
    s = nb.Settings(leaf=32, least_in_leaf=4, block=50, queries=100)
    got = {tuple(x) for x in nb.neighbour_pairs(spark.createDataFrame(rows, SCHEMA), configurations, s).collect()}
    expect = brute(rows, {"c1": 16, "c2": 3})
    assert len(expect) > 500 and len(got & expect) >= 0.97 * len(expect) and len(got - expect) <= 0.03 * len(expect)


def test_blocks_and_batches_change_nothing(spark, configurations):
    rows, expect = data(200), brute(data(200), {"c1": 16})
    for s in (nb.Settings(leaf=10_000), nb.Settings(leaf=10_000, block=7), nb.Settings(leaf=10_000, tree_bytes=1)):
        assert {tuple(x) for x in nb.neighbour_pairs(spark.createDataFrame(rows, SCHEMA), configurations, s).collect()} == expect


def test_unusable_vectors_copies_and_ties(spark, configurations):
    nan, inf = float("nan"), float("inf")
    same = [("c2", "text", f"s{i:03d}", [1.0, 2.0, 3.0], 3, "", 0) for i in range(60)] + [("c2", "text", f"t{i:03d}", [2.0, 4.0, 6.0], 3, "", 0) for i in range(5)]
    bad = [("c2", "text", f"b{i}", v, 3, "", 0) for i, v in enumerate([None, [], [0.0, 0.0, 0.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0, 2.0], [1.0, None, 3.0], [1.0, 2.0, 3.0, 4.0]])]
    other = [("c9", "text", "u1", [1.0, 2.0, 3.0], 3, "", 0), ("c2", None, "u2", [1.0, 2.0, 3.0], 3, "", 0), ("c2", "text", None, [1.0, 2.0, 3.0], 3, "", 0), (None, "text", "u3", [1.0, 2.0, 3.0], 3, "", 0)]
    rows = same + bad + other
    got = [tuple(x) for x in nb.neighbour_pairs(spark.createDataFrame(rows + same[:3], SCHEMA), configurations).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, {"c1": 16, "c2": 3})
    near = nb.neighbours(spark.createDataFrame(rows, SCHEMA), configurations).filter("article_id = 's001'").orderBy("neighbour_id").collect()
    assert [r.neighbour_id for r in near] == ["s000", "s002", "s003", "s004", "s005"] and all(r.similarity == 1.0 for r in near)


def test_empty(spark, configurations):
    assert nb.neighbour_pairs(spark.createDataFrame([], SCHEMA), configurations).count() == 0
    assert nb.neighbour_pairs(spark.createDataFrame([("c1", "text", "a", [1.0] * 16, 1, "", 0)], SCHEMA), configurations).count() == 0


def test_search_visits_the_best_leaves_first():
    x = nb.unit(list(np.random.default_rng(5).normal(size=(2000, 8))))
    tree = nb.grow(x, len(x), nb.Settings(leaf=50))
    orders = tree.orders(x[:50], tree.leaves)
    assert all(sorted(o) == list(range(tree.leaves)) for o in orders)
    assert [o[:3] for o in orders] == tree.orders(x[:50], 3)


def test_leaves_beyond_the_sample_are_split_on_their_own_members(spark, configurations):
    rows = data(3000)
    s = nb.Settings(leaf=30, least_in_leaf=4, sample=200, block=50, queries=100)
    frame = spark.createDataFrame(rows, SCHEMA)
    distinct = nb.representatives(nb.usable(frame, configurations), 6)[0]
    trees, sizes = nb.fit(distinct, s)
    before = {g: t.leaves for g, t in trees.items()}
    nb.refine(distinct, trees, sizes, s)
    vectors = {g: nb.unit([r.v for r in distinct.filter(distinct.g == g).collect()]) for g in trees}
    for g, t in trees.items():
        held = np.bincount(t.places(vectors[g]), minlength=t.leaves)
        assert held.max() <= 60 and sorted(n for n in t.leaf if n >= 0) == list(range(t.leaves))
        assert all(sorted(o) == list(range(t.leaves)) for o in t.orders(vectors[g][:20], t.leaves))
    assert any(t.leaves > before[g] for g, t in trees.items())
    got = {tuple(x) for x in nb.neighbour_pairs(frame, configurations, s).collect()}
    expect = brute(rows, {"c1": 16, "c2": 3})
    assert len(got & expect) >= 0.97 * len(expect) and len(got - expect) <= 0.03 * len(expect)


def test_a_few_crowded_vectors_in_sparse_surroundings(spark, configurations):
    r = np.random.default_rng(8)
    rows = [("c1", "text", f"a{i:05d}", r.normal(size=16).astype(np.float32).tolist(), 16, "", 0) for i in range(1500)]
    centre = r.normal(size=16)
    rows += [("c1", "text", f"z{i:05d}", (centre + 0.1 * r.normal(size=16)).astype(np.float32).tolist(), 16, "", 0) for i in range(25)]
    s = nb.Settings(leaf=30, least_in_leaf=4, queries=10, more_queries=20)
    got = {tuple(x) for x in nb.neighbour_pairs(spark.createDataFrame(rows, SCHEMA), configurations, s).collect()}
    assert got == brute(rows, {"c1": 16})


def test_large_and_small_trees_search_alike(monkeypatch):
    x = nb.unit(list(np.random.default_rng(6).normal(size=(3000, 8))))
    tree = nb.grow(x, len(x), nb.Settings(leaf=40))
    whole = tree.orders(x[:100], 20)
    monkeypatch.setattr(nb, "DENSE", 1)
    assert sum(a == b for a, b in zip(tree.orders(x[:100], 20), whole)) >= 98
