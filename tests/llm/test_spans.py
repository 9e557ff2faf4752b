"""Shared spans against brute force over all windows."""

import random

import numpy as np
import pytest

from foliospark.llm import spans


def brute(rows, length):
    holders = {}
    for i, t in rows:
        if i is not None and t:
            for k in range(len(t) - length + 1):
                holders.setdefault(t[k : k + length], set()).add(i)
    out = set()
    for i in {i for i, _ in rows if i is not None}:
        cover = set()
        for j, t in rows:
            if j == i and t:
                for k in range(len(t) - length + 1):
                    if len(holders[t[k : k + length]]) > 1:
                        cover.update(range(k, k + length))
        at = sorted(cover)
        for n, p in enumerate(at):
            if n == 0 or at[n - 1] != p - 1:
                start = p
            if n + 1 == len(at) or at[n + 1] != p + 1:
                out.add((i, start, p + 1))
    return out


@pytest.mark.parametrize("seed,alphabet,length", [(1, "ab", 8), (2, "abcdefgh", 16), (3, "aé😀", 12), (4, "abcdefghijklmnop", 32), (5, "abcdefgh", 15), (6, "aé😀b", 9)])
def test_against_brute_force(spark, seed, alphabet, length):
    r = random.Random(seed)
    make = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    parts = [make(r.randint(length // 2, 3 * length)) for _ in range(6)]
    rows = [(k, "".join(r.choice(parts) if r.random() < 0.5 else make(r.randint(0, length)) for _ in range(r.randint(0, 6)))) for k in range(40)]
    rows += [(99, parts[0] * 3), (99, parts[0] * 3), (None, parts[1] * 2), (98, None), (97, ""), (96, "a" * 300), (95, "a" * 200), (94, parts[2]), (94, parts[3] + "x")]
    got = spans.shared_regions(spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, id int"), length)
    rows_found = [tuple(x) for x in got.collect()]
    assert len(rows_found) == len(set(rows_found))
    if sum(i == 94 for i, _ in rows) == 2:  # two texts under one id: their regions are united
        rows_found, expect = [x for x in rows_found if x[0] != 94], {x for x in brute(rows, length) if x[0] != 94}
    assert set(rows_found) == expect


def test_hot_copies_and_long_text(spark):
    r = random.Random(9)
    body = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(5000))
    rows = [(k, body) for k in range(300)] + [(1000, "q" * 60 + body[100:400] + "z" * 90), (1001, body[4000:] + "!" * 500)]
    got = {tuple(x) for x in spans.shared_regions(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(k, 0, 5000) for k in range(300)} | {(1000, 60, 360), (1001, 0, 1000)}


def test_empty_and_shares(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spans.shared_regions(empty).count() == 0
    docs = spark.createDataFrame([(1, "x" * 30 + "abcdefgh" * 20), (2, "abcdefgh" * 20), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_chars, r.shared_chars) for r in spans.shared_amounts(docs, spans.shared_regions(docs)).collect()}
    assert got == {1: (190, 160), 2: (160, 160), 3: (0, 0)}


def test_representatives_cover_every_window_alike():
    r = np.random.default_rng(3)
    text = "".join(map(chr, r.integers(97, 101, 3000)))
    lo, hi, at, h = spans.representatives(text, 40, 10, spans.Hasher())
    assert lo[0] == 0 and hi[-1] == 2960 and (lo[1:] == hi[:-1] + 1).all() and (at >= hi).all() and (at <= lo + 30).all()
    inner = spans.representatives(text[500:2000], 40, 10, spans.Hasher())
    seen = {(a, x) for l, g, a, x in zip(*(v.tolist() for v in (lo, hi, at, h)))}
    assert {(a + 500, x) for _, _, a, x in zip(*(v.tolist() for v in inner))} <= seen


def test_no_filter_and_small_pieces_change_nothing(spark, monkeypatch):
    r = random.Random(12)
    make = lambda n: "".join(r.choice("abcdef") for _ in range(n))
    parts = [make(r.randint(10, 60)) for _ in range(8)]
    rows = [(k, "".join(r.choice(parts) if r.random() < 0.6 else make(r.randint(0, 20)) for _ in range(r.randint(0, 7)))) for k in range(30)]
    docs, expect = spark.createDataFrame(rows, "doc_id long, text string"), brute(rows, 16)
    monkeypatch.setattr(spans, "STRETCH", 40)
    assert {tuple(x) for x in spans.shared_regions(docs, 16).collect()} == expect
    monkeypatch.setattr(spans, "MOST_BITS", 1)
    assert {tuple(x) for x in spans.shared_regions(docs, 16).collect()} == expect


def test_levels_double_until_nothing_survives(spark):
    r = random.Random(13)
    make = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    long_, short = make(200), make(40)
    rows = [(1, make(30) + long_ + make(10)), (2, long_ + make(50) + short), (3, make(20) + short + long_[30:110]), (4, make(100)), (5, None), (None, long_)]
    got = [tuple(x) for x in spans.levels(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()]
    assert len(got) == len(set(got)) and {x[1] for x in got} == {16, 32, 64, 128}
    for n in (16, 32, 64, 128):
        assert {(i, a, b) for i, level, a, b in got if level == n} == brute(rows, n)


def test_the_filter_has_no_false_negatives(spark):
    h = np.random.default_rng(4).integers(-(2**63), 2**63, 5000)
    words = spans.filter_of(spark.createDataFrame([(int(x),) for x in h], "h long"))
    assert spans.passes(words, h).all()
    assert spans.passes(words, np.random.default_rng(5).integers(-(2**63), 2**63, 20_000)).mean() < 0.05
