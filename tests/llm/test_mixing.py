"""Mixtures: shares, caps, curriculum."""

import pytest

from foliospark.llm import mixing as mx

TARGETS = "source string, target_share double, max_repeats int"


def test_supplies_fill_up_to_the_caps():
    got = mx.supplies({"a": 1000, "b": 10, "c": 500}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 3), "d": (0.1, 4)}, 600)
    assert got["b"] == 20 and got["d"] == 0
    assert abs(sum(got.values()) - 600) < 1e-6 and abs(got["a"] / got["c"] - 2.5) < 1e-9
    assert mx.supplies({"a": 5}, {"a": (1.0, 2)}, 1e9) == {"a": 10.0}
    assert mx.supplies({}, {}, 10) == {}


def test_bad_schedules_are_refused():
    for bad in ([(0, 1)], [(0, 1), (0.5, 1)], [(0, 0), (1, 0)], [(0, -1), (1, 1)], [(0, 1), (0.6, 1), (0.6, 2), (1, 1)]):
        with pytest.raises(ValueError):
            mx.check_schedule(bad)


def counts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def test_mixture_meets_shares_and_repeats(spark):
    rows = [(i, "big", 50 + i % 7) for i in range(3000)] + [(10_000 + i, "small", 20) for i in range(50)] + [(20_000, None, 5), (20_001, "other", 5), (20_002, "big", 0)]
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.2, 3), ("none", 0.1, 9)], TARGETS)
    mixed = mx.mixture(counts(spark, rows), targets, {"big": [(0.0, 2.0), (1.0, 0.0)]}, total=20_000).collect()
    by = {s: sum(r.n_tokens for r in mixed if r.source == s) for s in ("big", "small")}
    assert by["small"] == 3000 and abs(by["big"] - 17_000) <= 60  # small is at its cap of three copies
    assert {r.copy for r in mixed if r.source == "big"} == {0} and {r.copy for r in mixed if r.source == "small"} == {0, 1, 2}
    at = [r.position for r in mixed]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    early = sum(r.n_tokens for r in mixed if r.source == "big" and r.position <= 0.5)
    assert abs(early / by["big"] - 0.75) < 0.02  # the integral of 2 - 2t up to a half
    flat = sum(r.n_tokens for r in mixed if r.source == "small" and r.position <= 0.5)
    assert abs(flat / by["small"] - 0.5) < 0.02
    shares = {r.source: r for r in mx.reached_shares(mx.mixture(counts(spark, rows), targets, total=20_000), targets).collect()}
    assert shares["none"].tokens == 0 and abs(sum(r.reached_share for r in shares.values()) - 1) < 1e-9 and shares["small"].most_copies == 3


def test_prefix_sums_of_buckets_are_those_of_the_whole(spark, monkeypatch):
    rows = [(i, "s", 1 + i % 9) for i in range(2000)]
    targets = spark.createDataFrame([("s", 1.0, 2)], TARGETS)
    run = lambda: [tuple(r) for r in mx.mixture(counts(spark, rows), targets, total=15_000).collect()]
    whole = run()
    monkeypatch.setattr(mx, "BUCKET", 40)
    assert [(a[1:], round(a[0], 9)) for a in run()] == [(a[1:], round(a[0], 9)) for a in whole]


def test_edges(spark):
    targets = spark.createDataFrame([("s", 1.0, 2), (None, 0.5, 1), ("s", 2.0, 9), ("t", None, 1)], TARGETS)
    assert mx.mixture(counts(spark, []), targets).count() == 0
    assert mx.mixture(counts(spark, [(1, "s", 4)]), targets.limit(0)).count() == 0
    got = mx.mixture(counts(spark, [(1, "s", 4), (1, "s", 4), (None, "s", 2)]), targets, total=100).collect()
    assert sum(r.n_tokens for r in got) == 20
