"""Whole runs: preprocessing over an archive, embedding with the synthetic provider, the command line, streaming."""

import argparse
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from foliospark import cli, config, embed_cli
from foliospark.functions import vectors as vec
from foliospark.operators import batching, embed, preprocess
from foliospark.sources.store import Store

PAGE = '<html><head><meta name="article.id" content="{i}"><meta name="article.published" content="{d}"></head><body><article><h1>T</h1>{p}</article></body></html>'


def put(root, path, i="A", p="<p>x</p>", d="2024-01-02T12:00:00Z"):
    f = root / path
    f.parent.mkdir(parents=True, exist_ok=True)
    f.write_text(PAGE.format(i=i, p=p, d=d))


def test_preprocessing_runs(spark, tmp_path):
    root, store = tmp_path / "in", Store(spark, str(tmp_path / "out"))
    put(root, "a/1.html")
    put(root, "a/2.html", p="<p>x</p><p>longer</p>")
    put(root, "b/3.html", "B")
    put(root, "b/4.html", "C", d="nonsense")
    go = lambda **o: preprocess.run(store, str(root), preprocess.Options(**o))
    first = go()
    assert (first["new"], first["articles"], first["duplicates"], first["failed"], first["status"]) == (4, 2, 1, 1, "succeeded"), first
    assert {r.source_html_path: r.reason for r in store.read("duplicates").collect()} == {"a/1.html": "lower_editorial_character_count"}
    assert {r.status for r in store.read("source_manifest").filter("source_html_path = 'b/4.html'").collect()} == {"failed"}
    assert store.read("failures").first().error_code == "invalid_timestamp"
    again = go()
    assert (again["unchanged"], again["articles"], again["pages_read"]) == (4, 2, 0) and again["validation_ok"]
    assert [r.status for r in store.read("runs").collect()] == ["succeeded", "succeeded"]
    # The winner changes its identity, a page vanishes: the duplicate is promoted.
    put(root, "a/2.html", "D", p="<p>x</p><p>much longer</p>")
    (root / "b/3.html").unlink()
    third = go()
    assert (third["changed"], third["removed"], third["articles"], third["duplicates"]) == (1, 1, 2, 0) and third["validation_ok"], third
    assert {(r.article_id, r.source_html_path) for r in store.read("articles").collect()} == {("id:A", "a/1.html"), ("id:D", "a/2.html")}
    limited = go(limit=1)
    assert limited["removed"] == 0 and limited["discovered"] == 1 and store.read("runs").count() == 4
    # A touched page is read but not extracted; of two promoted in turn, the one that cannot be read any more fails.
    os.utime(root / "a/1.html")
    assert (fourth := go())["metadata_only"] == 1 and fourth["pages_read"] == 1
    put(root, "c/1.html", "E", p="<p>first of all</p>")
    put(root, "c/2.html", "E", p="<p>second</p>")
    put(root, "c/3.html", "E", p="<p>3</p>")
    go(markdown_root=str(tmp_path / "texts"))
    (root / "c/1.html").unlink()
    (root / "c/2.html").write_text(PAGE.format(i="E", p="<p>second</p>", d="2024-01-02T12:00:00Z").replace("second", "secund"))
    stat = (root / "c/2.html").stat()
    m = store.read("source_manifest").filter("source_html_path = 'c/2.html'").first()
    os.utime(root / "c/2.html", ns=(stat.st_atime_ns, m.html_mtime_ns))
    os.link(root / "c/2.html", root / "c/2.copy")  # a second link makes it unsafe to read
    last = go(markdown_root=str(tmp_path / "texts"))
    assert last["validation_ok"] and last["removed"] == 1 and {r.source_html_path for r in store.read("articles").filter("article_id = 'id:E'").collect()} == {"c/3.html"}
    assert store.read("failures").filter("error_code = 'unreadable_source'").count() == 1
    e = store.read("articles").filter("article_id = 'id:E'").first()
    assert hashlib.sha256((tmp_path / "texts" / e.cleaned_markdown_path).read_bytes()).hexdigest() == e.markdown_sha256
    texts = spark.createDataFrame([("a/1.html", "T1")], "source_html_path string, markdown_text string")
    arts = store.read("articles").filter("source_html_path = 'a/1.html'").withColumn("markdown_sha256", F.sha2(F.lit("T1"), 256))
    out = preprocess.export_markdown(arts, texts, str(tmp_path / "md")).collect()
    assert out[0].outcome == "written" and (tmp_path / "md" / out[0].path).read_text() == "T1" and preprocess.export_markdown(arts, texts, str(tmp_path / "md")).collect()[0].outcome == "present"


def test_a_run_that_breaks_leaves_its_record_only(spark, tmp_path, monkeypatch):
    root, store = tmp_path / "in", Store(spark, str(tmp_path / "out"))
    put(root, "a/1.html")
    monkeypatch.setattr(preprocess.ranking, "winners", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        preprocess.run(store, str(root))
    assert [r.status for r in store.read("runs").collect()] == ["failed"] and store.read("candidates").count() == 0


def test_embedding_long_texts_failures_and_composites(spark):
    long_ = "para one.\n\n" * 5
    texts = spark.createDataFrame([("short", "hello"), ("long", long_), ("dead", "fatal"), ("flaky", "again"), ("half", "fine text\n\nfatal text"), (None, "x"), ("empty", "")], "article_id string, text string")
    provider = embed.SyntheticProvider(8, (("fatal", "deterministic_request", False), ("again", "rate_limit", True)))
    arts, parts_ = embed.embed_texts(texts, provider, 12, batching.Policy(max_items=2))
    got = {r.article_id: r for r in arts.collect()}
    assert {k: r.state for k, r in got.items()} == {"short": "succeeded", "long": "succeeded", "dead": "terminal", "flaky": "retryable", "half": "terminal"}
    assert got["flaky"].attempt_count == 3 and got["half"].vector is None and got["long"].derivation_kind == "long_text_aggregate"
    assert parts_.filter("article_id = 'long'").count() == 5 and abs(sum(x * x for x in got["long"].vector) - 1) < 1e-5
    one = arts.filter("article_id = 'short'").withColumn("generation_run_id", F.lit("r"))
    c = embed.composites(one, one, "f").first()
    assert c.vector == pytest.approx(got["short"].vector, abs=1e-6) and len(c.input_sha256) == 64
    assert arts.filter(vec.is_unit(F.col("vector"))).count() == 2


def test_outcomes_settle_and_pilot():
    items = [embed.Item(k, "h", k) for k in "abc"]
    outcomes = [embed.Outcome("a", [1.0]), embed.Outcome("b", [1.0]), embed.Outcome("b", [2.0])]
    assert [(o.error_code, o.retryable) for o in embed.settle(items, outcomes)] == [(None, False), ("invalid_response", False), ("missing_response_item", True)]
    assert embed.is_vector([1, 2.5], 2) and not any(embed.is_vector(v, 2) for v in ([1.0], [1.0, True], [1.0, "2"], [1.0, float("nan")], "ab", None))

    class Odd(embed.SyntheticProvider):
        def embed(self, items):
            return [embed.Outcome(i.key, [True] * 8) for i in items]

    assert embed.Stream(Odd(8), batching.Policy()).run([embed.Item("a", "h", "x")])["a"][0].error_code == "invalid_response"
    assert embed.pilot(embed.SyntheticProvider(8), batching.Policy(), ["x"])["ready"]
    bad = embed.pilot(embed.SyntheticProvider(8, (("x", "authentication", False),)), batching.Policy(), ["x"])
    assert not bad["ready"] and bad["probe_errors"] == ["authentication"]


def test_command_line(spark, tmp_path):
    put(tmp_path / "in", "1.html")
    (tmp_path / "c.toml").write_text('source_root = "in"\noutput_root = "out"\n')
    run = lambda *a: cli.execute(cli.parser().parse_args([*a, "--config", str(tmp_path / "c.toml")]), spark)
    assert run("inventory") == ({"discovered": 1, "with_image": 0, "missing_image": 1}, True)
    assert not run("validate")[1]
    summary, ok = run("run", "--full")
    assert ok and json.loads(json.dumps(summary, sort_keys=True))["articles"] == 1
    assert run("validate") == ({"issues": []}, True)
    assert cli.smoke(spark)[1]
    with pytest.raises(argparse.ArgumentTypeError):
        cli.positive("0")
    for text in ("x = 1", 'source_root = "a"', 'source_root = "a"\noutput_root = "a/b"', 'source_root = 3\noutput_root = "b"', "["):
        (tmp_path / "bad.toml").write_text(text)
        with pytest.raises(config.BadConfig):
            config.load(str(tmp_path / "bad.toml"))


def test_embedding_command_line(spark, tmp_path):
    put(tmp_path / "in", "1.html", p="<p>Some text of an article.</p>")
    put(tmp_path / "in", "2.html", "B")
    (tmp_path / "c.toml").write_text('source_root = "in"\noutput_root = "out"\n')
    cli.execute(cli.parser().parse_args(["run", "--full", "--config", str(tmp_path / "c.toml")]), spark)
    roots = ["--source-root", str(tmp_path / "in"), "--preprocessing-output-root", str(tmp_path / "out"), "--embedding-output-root", str(tmp_path / "emb")]
    go = lambda *a: embed_cli.execute(embed_cli.parser().parse_args([*a[:1], *roots, *a[1:]]), spark)
    assert go("inventory") == ({"canonical_articles": 2, "header_present": 0, "header_absent": 2}, True)
    assert [i["code"] for i in go("validate")[0]["issues"]] == ["missing_embedding_configuration"]
    done, ok = go("run", "--full")
    assert ok and (done["articles"], done["embeddings"]) == (2, 2)
    found, ok = go("validate")
    assert ok and found["issues"] == [] and found["coverage"]["text_success"] == 2 and found["configuration_id"] == done["configuration_id"]
    assert not go("validate", "--configuration-id", "x")[1]
    for args, code in ((["run", "--full", "--provider", "none:x"], "provider_unavailable"), (["run", "--full", "--provider", "tests.test_runs:hosted"], "hosted_processing_not_authorized"), (["run", "--full", "--provider", "tests.test_runs:hosted", "--authorize-hosted-processing"], "pilot_observation_required")):
        with pytest.raises(embed_cli.Refused, match=code):
            go(*args)
    with pytest.raises(embed_cli.Refused, match="overlapping_roots"):
        embed_cli.separate(str(tmp_path / "in"), str(tmp_path / "in" / "x"), str(tmp_path / "emb"))
    assert embed_cli.execute(embed_cli.parser().parse_args(["pilot"]), spark)[1] and embed_cli.execute(embed_cli.parser().parse_args(["smoke"]), spark)[1]
    with pytest.raises(SystemExit):
        embed_cli.parser().parse_args(["run"])


def hosted():
    return embed.SyntheticProvider(8, synthetic=False, streams=1, model="m")


def test_streaming_equals_batch(spark, tmp_path):
    from foliospark.operators.incremental import plain_path
    from foliospark.streaming import observations as obs

    rows = spark.read.parquet("/root/testdata/sf0.001/source_scans.parquet")
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    half = rows.filter("html_size % 2 = 0"), rows.filter("html_size % 2 = 1")
    for part in half:
        part.coalesce(2).write.mode("append").parquet(log)
        obs.follow(spark, log, state).awaitTermination()
    got = obs.current(spark, state).select("source_html_path", "html_size", "observed_at")
    expect = obs.latest_by_window(rows.withColumn("source_html_path", plain_path(F.col("source_html_path")))).select("source_html_path", "html_size", "observed_at")
    assert got.exceptAll(expect).count() == expect.exceptAll(got).count() == 0
    assert obs.arrivals(rows).agg(F.sum("observations")).first()[0] == rows.count()
