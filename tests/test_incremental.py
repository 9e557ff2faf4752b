"""Change capture: offsets, replay, deduplication; and the decision what to process."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from foliospark.operators import incremental as inc


def write(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, "key string, at long, value string").coalesce(1).write.mode(mode).parquet(path)


def capture(spark, tmp_path):
    return inc.ChangeCapture(spark, str(tmp_path / "state"), "key", ("at",))


def state(df):
    return sorted(((r.key, r.at, r.value) for r in df.collect()), key=str)


def test_batches_take_only_new_rows_and_keep_the_newest(spark, tmp_path):
    log, c = str(tmp_path / "log"), capture(spark, tmp_path)
    write(spark, log, [("a", 1, "x"), ("b", 5, "x"), ("a", 2, "y"), ("a", 2, "y"), (None, 9, "z"), ("n", None, "x")])
    assert sorted(map(str, state(c.run(log)))) == sorted(map(str, [("a", 2, "y"), ("b", 5, "x"), ("n", None, "x")]))
    seen = []
    write(spark, log, [("b", 4, "late"), ("c", 1, "x"), ("a", 3, "z")])
    out = c.run(log, lambda df: seen.append(df.count()) or df)
    assert seen == [3] and sorted(map(str, state(out))) == sorted(map(str, [("a", 3, "z"), ("b", 5, "x"), ("c", 1, "x"), ("n", None, "x")]))
    before = c.plans.names()
    assert sorted(map(str, state(c.run(log)))) == sorted(map(str, state(out))) and c.plans.names() == before


def test_a_failed_batch_is_replayed_as_planned(spark, tmp_path):
    log, c = str(tmp_path / "log"), capture(spark, tmp_path)
    write(spark, log, [("a", 1, "x")])
    with pytest.raises(RuntimeError):
        c.run(log, fail_before_commit=True)
    assert c.sink() is None
    write(spark, log, [("a", 2, "y")])  # arrives after the plan was written
    planned = json.loads(c.plans.read(c.plans.names()[0]))
    assert [r[:2] for r in planned["ranges"].values()] == [[0, 1]]
    assert c.plan(log) == planned and len(planned["ranges"]) == 1
    assert state(c.run(log)) == [("a", 1, "x")]
    assert state(c.run(log)) == [("a", 2, "y")]
    assert len(c.commits.names()) == len(c.plans.names()) == 2


def test_replaying_a_committed_range_changes_nothing(spark, tmp_path):
    log, c = str(tmp_path / "log"), capture(spark, tmp_path)
    write(spark, log, [("a", 1, "x"), ("b", 1, "x")])
    first = state(c.run(log))
    plan = json.loads(c.plans.read(c.plans.names()[0]))
    again = c.latest(c.sink().unionByName(c.latest(c.rows(log, plan))))
    assert state(again) == first


@pytest.mark.parametrize("given,plain", [("./a//b/./c.html", "a/b/c.html"), (".//a.html", "a.html"), ("a/./././b", "a/b"), ("a.b/c.", "a.b/c."), ("/a/b", "a/b"), ("a/.", "a"), ("..a/b", "..a/b")])
def test_plain_path(spark, given, plain):
    assert spark.range(1).select(inc.plain_path(F.lit(given)).alias("p")).first().p == plain


def test_reasons(spark):
    obs = spark.createDataFrame(
        [("new", 1, 1, "h"), ("failed", 1, 1, "h"), ("norun", 1, 1, "h"), ("stale", 1, 1, "h"), ("hash", 1, 1, "h2"), ("case", 9, 9, "H"), ("stat", 2, 1, None), ("same", 1, 1, None), ("null", 1, None, None)], "source_html_path string, html_size long, html_mtime_ns long, source_html_sha256 string"
    )
    row = lambda p, status="succeeded", run="r1", version="7", mtime=1: (p, 1, mtime, "h", version, status, run)
    man = spark.createDataFrame([row("failed", "failed"), row("norun", run="r2"), row("stale", version="6"), row("hash"), row("case"), row("stat"), row("same"), row("unseen", "failed"), row("null", mtime=None)], "source_html_path string, html_size long, html_mtime_ns long, source_html_sha256 string, extractor_version string, status string, last_run_id string")
    runs = spark.createDataFrame([("r1", "succeeded"), ("r2", "failed"), ("r1", "succeeded")], "run_id string, status string")
    got = {r.source_html_path: r.reason for r in inc.to_process(obs, man, runs).collect()}
    assert got == {"new": "new", "failed": "not_succeeded", "norun": "unfinished_run", "stale": "stale_extractor", "hash": "changed", "stat": "changed"}
    clash = obs.withColumns({c: F.lit("x") for c in ("m_path", "r_id", "status", "reason")})
    assert inc.to_process(clash, man.withColumn("r_id", F.lit(1)), runs).count() == 6
    assert inc.to_process(obs.limit(0), man, runs).count() == 0 and inc.to_process(obs, man.limit(0), runs.limit(0)).count() == 9


def test_a_log_with_columns_of_the_same_names(spark, tmp_path):
    log, c = str(tmp_path / "log"), capture(spark, tmp_path)
    spark.createDataFrame([("a", 1, "x", 7, 8)], "key string, at long, value string, log_partition int, log_offset int").write.parquet(log)
    assert state(c.run(log)) == [("a", 1, "x")]


def test_equal_file_names_in_several_folders(spark, tmp_path):
    log, c = tmp_path / "a log", capture(spark, tmp_path)

    def add(day, rows):
        write(spark, str(tmp_path / f"made{day}"), rows)
        (log / f"day={day}").mkdir(parents=True)
        next((tmp_path / f"made{day}").glob("*.parquet")).rename(log / f"day={day}" / "data.parquet")

    add(1, [("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")])
    assert len(state(c.run(str(log)))) == 3
    add(2, [("d", 2, "y"), ("a", 2, "y")])
    assert state(c.run(str(log))) == [("a", 2, "y"), ("b", 1, "x"), ("c", 1, "x"), ("d", 2, "y")]
    assert sorted(c.offsets()) == ["day=1/data.parquet", "day=2/data.parquet"]


def test_levels_merge_by_size_and_outlive_one_commit(spark, tmp_path):
    log, c = str(tmp_path / "log"), capture(spark, tmp_path)
    write(spark, log, [(f"k{i:03d}", 1, "x") for i in range(100)])
    c.run(log)
    for n in range(2, 9):
        write(spark, log, [(f"k{n:03d}", n, "y"), ("k000", n, "z"), (f"late{n}", 0, "x")])
        before = c.committed()
        c.run(log)
        after = c.committed()
        assert after["levels"][0] == before["levels"][0] or len(after["levels"]) == 1  # the large level is not rewritten
        assert all((tmp_path / "state" / "sink" / f.rsplit("/", 1)[1]).exists() for f, _ in before["levels"])
        assert {r.key for r in c.delta().collect()} == {f"k{n:03d}", "k000", f"late{n}"}
        sizes = [n for _, n in after["levels"]]
        assert all(a > 2 * b for a, b in zip(sizes, sizes[1:]))
    got = {r.key: (r.at, r.value) for r in c.sink().collect()}
    assert len(got) == 107 and got["k000"] == (8, "z") and got["k005"] == (5, "y") and got["k050"] == (1, "x")
    assert {(r.key, r.at) for r in c.current(spark.createDataFrame([("k000",), ("none",)], "key string")).collect()} == {("k000", 8)}


def test_a_file_that_is_as_it_was_is_not_opened_and_one_that_shrinks_is_refused(spark, tmp_path):
    log, c = tmp_path / "log", capture(spark, tmp_path)
    write(spark, str(log), [("a", 1, "x"), ("b", 1, "x")])
    c.run(str(log))
    file = next(log.glob("*.parquet"))
    stat = file.stat()
    raw = file.read_bytes()
    file.write_bytes(b"x" * len(raw))  # unreadable, but of the same size and time
    os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert inc.log_files(spark, str(log))[file.name][1:] == tuple(c.offsets()[file.name][1:])
    file.write_bytes(raw)
    write(spark, str(tmp_path / "other"), [("a", 1, "x")])
    file.write_bytes(next((tmp_path / "other").glob("*.parquet")).read_bytes())
    for crc in log.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(RuntimeError, match="append-only"):
        c.plan(str(log))


def test_decisions_of_a_batch(spark, tmp_path):
    schema = "source_html_path string, html_size long, html_mtime_ns long, source_html_sha256 string, observed_at timestamp, arrived_at timestamp"
    log, c = str(tmp_path / "log"), inc.ChangeCapture(spark, str(tmp_path / "state"), "source_html_path", ("observed_at", "arrived_at"))
    put = lambda *rows: spark.createDataFrame([(p, 1, 1, h, datetime(2024, 1, d), datetime(2024, 1, d)) for p, h, d in rows], schema).coalesce(1).write.mode("append").parquet(log)
    man = spark.createDataFrame([(p, 1, 1, "h", "7", "succeeded", r) for p, r in (("a", "r1"), ("b", "r1"), ("c", "r2"))], "source_html_path string, html_size long, html_mtime_ns long, source_html_sha256 string, extractor_version string, status string, last_run_id string")
    runs = spark.createDataFrame([("r1", "succeeded"), ("r2", "succeeded")], "run_id string, status string")
    put(("a", "h", 5), ("b", "x", 5), ("c", "h", 5))
    c.run(log, inc.observations_of)
    assert {tuple(r) for r in inc.decide(c, man, runs).collect()} == {("a", None), ("b", "changed"), ("c", None)}
    put(("./b", "h", 6), ("a", "x", 4))  # b is as it was again; a's row is late
    c.run(log, inc.observations_of)
    assert {tuple(r) for r in inc.decide(c, man, runs).collect()} == {("a", None), ("b", None)}
    touched, failed = spark.createDataFrame([("r2",)], "run_id string"), runs.replace("succeeded", "failed", "status")
    assert {tuple(r) for r in inc.decide(c, man, failed, touched).collect()} == {("a", "unfinished_run"), ("b", "unfinished_run"), ("c", "unfinished_run")}
