"""Ranking, manifest, store, archive, work, reconciliation and batching on small frames."""

import os
import struct
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import digests, images
from foliospark.functions import vectors as vec
from foliospark.operators import batching, manifest, parts, ranking, reconcile, validation
from foliospark.operators import work as wk
from foliospark.sources import archive, sinks, store

CAND = "article_id string, source_html_path string, editorial_character_count long, editorial_block_count int, metadata_completeness int, updated_at_utc timestamp"
D = lambda n: datetime(2024, 1, n)


def test_duplicate_reasons(spark):
    rows = [("a", "w", 9, 9, 9, D(9)), ("a", "e", 0, 9, 9, D(9)), ("a", "c", 8, 9, 9, D(9)), ("a", "b", 9, 8, 9, D(9)), ("a", "m", 9, 9, 8, D(9)), ("a", "o", 9, 9, 9, D(8)), ("a", "n", 9, 9, 9, None), ("a", "x", 9, 9, 9, D(9)), ("b", "z", 1, 1, 1, None)]
    got = {r.source_html_path: (r.duplicate_rank, r.reason, r.winner_source_html_path) for r in ranking.duplicates_of(spark.createDataFrame(rows, CAND)).collect()}
    assert got == {"x": (2, "lexical_tiebreak", "w"), "o": (3, "older_update", "w"), "n": (4, "older_update", "w"), "m": (5, "lower_metadata_completeness", "w"), "b": (6, "lower_editorial_block_count", "w"), "c": (7, "lower_editorial_character_count", "w"), "e": (8, "empty_content", "w")}


def test_ranks_of_a_hot_group_come_from_many_tasks(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) as article_id", "lpad(cast(id as string), 6, '0') as source_html_path", "id % 17 as editorial_character_count", "1 as editorial_block_count", "1 as metadata_completeness", "cast(null as timestamp) as updated_at_utc")
    got = ranking.ranked(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.article_id, []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r.candidate_rank)
        assert [r.candidate_rank for r in rows] == list(range(1, len(rows) + 1))
        keys = [(r.editorial_character_count <= 0, -r.editorial_character_count, r.source_html_path) for r in rows]
        assert keys == sorted(keys)


def test_classification(spark):
    full = "source_html_path string, html_size long, html_mtime_ns long, header_image_path string, header_image_size long, header_image_mtime_ns long"
    seen = spark.createDataFrame([(n, 1, 1, None, None, None) for n in ("new", "same", "stale", "gone", "fail")] + [("stat", 2, 1, None, None, None), ("img", 1, 1, "i", 1, 1), ("meta", 2, 1, None, None, None)], full)
    man = spark.createDataFrame(
        [(n, 1, 1, None, None, None, "h", v, s, "id") for n, v, s in (("same", "7", "succeeded"), ("stale", "6", "failed"), ("gone", "7", "missing"), ("fail", "7", "failed"), ("stat", "7", "succeeded"), ("img", "7", "succeeded"), ("meta", "7", "succeeded"), ("lost", "7", "succeeded"))],
        full + ", source_html_sha256 string, extractor_version string, status string, article_id string",
    )
    c = manifest.classify(seen, man, "7")
    kinds = {r.source_html_path: (r.kind, r.image_changed, r.was_failed) for r in c.collect()}
    assert kinds == {"new": ("new", False, False), "same": ("unchanged", False, False), "stale": ("stale_extractor", False, True), "gone": ("new", False, False), "fail": ("unchanged", False, True), "stat": ("stat_changed", False, False), "img": ("stat_changed", True, False), "meta": ("stat_changed", False, False)}
    r = manifest.refine(c.withColumn("source_html_sha256", F.when(F.col("source_html_path").isin("meta", "img"), "h")))
    assert {x.source_html_path for x in r.filter("kind = 'metadata_only'").collect()} == {"meta"}
    assert {x.source_html_path for x in manifest.to_extract(r, False).collect()} == {"new", "gone", "stat", "img"}
    assert manifest.to_extract(r, True).count() == 5
    assert [x.source_html_path for x in manifest.missing(man, seen, "full").collect()] == ["lost"] and manifest.missing(man, seen, "limit:5").count() == 0


def test_store_commits_are_atomic(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "cat"))
    meta = lambda *rows: spark.createDataFrame(rows, schemas.schema("metadata"))
    assert s.version() == 0 and s.read("metadata").count() == 0
    assert s.commit({"metadata": meta(("a", "1"))}) == 1
    base = s.version()
    s.commit({"metadata": store.upsert(s.read("metadata"), meta(("a", "2"), ("b", "1")), ["key"])}, base)
    with pytest.raises(store.ConcurrentCommit):
        s.commit({"metadata": meta(("z", "0"))}, base)
    assert {(r.key, r.value) for r in s.read("metadata").collect()} == {("a", "2"), ("b", "1")} and s.read("metadata", 1).count() == 1
    assert {r.value for r in store.insert_ignore(s.read("metadata"), meta(("a", "9"), ("c", "3")), ["key"]).collect()} == {"2", "1", "3"}
    with pytest.raises(ValueError):
        s.commit({"metadata": spark.range(1)})


def test_archive_scan_and_pairing(spark, tmp_path):
    for p in ("a.html", "a-early.html", "a/story.HTML", "a/Story_Main_Image.PNG", "a/story_main_image.jpg", "z.html", "z_main_image.webp", ".git/x.html", "backup/x.html", "a/backup/y.html", "a/__MACOSX/x.html", "b/_h.html", "b/.k.html", "b/n.txt"):
        f = tmp_path / "root" / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(p)
    os.symlink(tmp_path / "root" / "a.html", tmp_path / "root" / "link.html")
    files = archive.listing(spark, str(tmp_path / "root"), content=True)
    pages = archive.limited(archive.pair_images(files), None).collect()
    assert [r.source_html_path for r in pages] == ["a-early.html", "a.html", "a/backup/y.html", "a/story.HTML", "b/.k.html", "b/_h.html", "z.html"]
    by = {r.source_html_path: (r.header_image_path, r.warnings) for r in pages}
    assert by["a/story.HTML"] == ("a/story_main_image.jpg", ["multiple_images"]) and by["z.html"] == ("z_main_image.webp", []) and by["a.html"] == (None, ["missing_image"])
    assert {r.status for r in files.collect()} == {"ok"} and bytes(files.filter("path = 'a.html'").first().data) == b"a.html"
    assert archive.read_safely(str(tmp_path / "root"), "../x") == ("unsafe", None) and archive.read_safely(str(tmp_path / "root"), "link.html")[0] == "unsafe" and archive.read_safely(str(tmp_path / "root"), "no.html")[0] == "missing"
    with pytest.raises(ValueError):
        archive.limited(files, 0)


def test_parts_are_lossless():
    text = "aaa\n\nbb\r\n \n cccccccccc\n\nd😀\n\n\n"
    for limit in range(1, 30):
        spans = parts.plan(text, limit)
        assert (spans == []) == (len(text) <= limit)
        if spans:
            assert "".join(text[a:b] for a, b in spans) == text and all(0 < b - a <= limit for a, b in spans)
    assert [text[a:b] for a, b in parts.plan(text, 8)] == ['aaa\n\n', 'bb\r\n \n ', 'cccccccc', 'cc\n\n', 'd😀\n\n\n']
    words = lambda t: [(m.start(), m.end()) for m in __import__("re").finditer(r"\S*\s*", t) if m.end() > m.start()]
    spans = parts.plan("one two three four five\n\nsix seven", 2, words)
    assert spans == [(0, 8), (8, 19), (19, 25), (25, 34)]
    with pytest.raises(ValueError):
        parts.checked("abc", [(0, 1), (2, 3)])
    with pytest.raises(ValueError):
        parts.plan("", 3)


def test_parts_by_a_pinned_tokenizer(spark):
    import hashlib

    public_tokenizers = pytest.importorskip("public_tokenizers")

    path = public_tokenizers.path("byte_bpe_50k.json")
    digest = hashlib.sha256(open(path, "rb").read()).hexdigest()
    tokens = parts.pinned_tokenizer(path, digest)
    text = "Prices rose again, é and 😀 too.\n\n" * 6 + "unbroken" * 60 + "\r\n\r\n  Tail <|endoftext|> 価格"
    assert parts.checked(text, tokens(text)) and len(tokens("<|endoftext|>")) > 1
    for limit in (5, 16, 40):
        spans = parts.plan(text, limit, tokens)
        assert "".join(text[a:b] for a, b in spans) == text and all(0 < len(tokens(text[a:b])) <= limit for a, b in spans)
    got = parts.plan_parts(spark.createDataFrame([(1, text), (2, "short"), (3, None)], "doc_id long, text string"), 40, tokens=tokens).collect()
    assert [(r.char_start, r.char_end) for r in sorted(got, key=lambda r: r.part_index)] == parts.plan(text, 40, tokens) and {r.doc_id for r in got} == {1}
    with pytest.raises(ValueError):
        parts.pinned_tokenizer(path, "0" * 64)("x")


WORK = "article_id string, modality string, configuration_id string, source_relative_path string, input_sha256 string, state string, attempt_count int, error_code string, status_code int, retry_after_seconds double, last_run_id string, generation_run_id string, updated_at timestamp"


def work(spark, *rows):
    return spark.createDataFrame([(a, m, "c", p, h, s, 0, None, None, None, "r", g, D(1)) for a, m, p, h, s, g in rows], WORK)


def test_every_transition(spark):
    events = sorted({e for _, e in wk.TRANSITIONS})
    rows = [(f"{s}:{e}", "article_text", None, "h", s, None) for s in schemas.STATES for e in events]
    ev = spark.createDataFrame([(f"{s}:{e}", "article_text", "c", e, "code", 500, 1.5) for s in schemas.STATES for e in events], "article_id string, modality string, configuration_id string, event string, error_code string, status_code int, retry_after_seconds double")
    for r in wk.apply_events(work(spark, *rows), ev).collect():
        s, e = r.article_id.split(":")
        assert (r.state, r.illegal) == (wk.TRANSITIONS.get((s, e), s), (s, e) not in wk.TRANSITIONS)
        assert r.attempt_count == ((s, e) == ("queued", "start")) and (r.error_code == "code") == (e.startswith("fail") and not r.illegal)


def test_registration(spark):
    desired = spark.createDataFrame([(a, m, "c", "p", h, ap) for a, m, h, ap in (("new", "article_text", "h", "present"), ("same", "article_text", "h", "present"), ("changed", "header_image", "h2", "present"), ("unproven", "article_text", "h", "present"), ("busy", "article_text", "h", "present"), ("dead", "article_text", "h", "present"), ("nohead", "header_image", None, "not_applicable"), ("lost", "header_image", None, "missing"))], "article_id string, modality string, configuration_id string, source_relative_path string, input_sha256 string, applicability string")
    w = work(spark, *[(a, m, "p", "h", s, "g") for a, m, s in (("same", "article_text", "succeeded"), ("changed", "header_image", "succeeded"), ("unproven", "article_text", "succeeded"), ("busy", "article_text", "in_progress"), ("dead", "article_text", "terminal"), ("nohead", "header_image", "succeeded"))])
    v = spark.createDataFrame([("same", "article_text", "c", "h"), ("changed", "header_image", "c", "h"), ("nohead", "header_image", "c", "h")], "article_id string, modality string, configuration_id string, input_sha256 string")
    got = {r.article_id: (r.state, r.action, r.invalidates_composite) for r in wk.register(desired, w, v).collect()}
    assert got == {"new": ("eligible", "insert", False), "same": ("succeeded", "reuse", False), "changed": ("eligible", "supersede", True), "unproven": ("interrupted", "recover", True), "busy": ("interrupted", "recover", False), "dead": ("terminal", "keep", False), "nohead": ("not_applicable", "disapply", True), "lost": ("retryable", "await_input", False)}
    assert {r.article_id for r in wk.composites_to_restart(wk.register(desired, w, v)).collect()} == {"changed", "unproven", "nohead"}
    again = {r.article_id: (r.state, r.reason) for r in wk.register(desired, w, v, reprocess=True).collect()}
    assert again["dead"] == ("eligible", "explicit_reprocess") and again["new"] == ("eligible", None)


def test_reconciliation_is_all_or_nothing_and_compaction_invisible(spark):
    w = work(spark, ("a", "article_text", None, "h", "succeeded", "g"), ("a", "header_image", "old", "h", "succeeded", "g"), ("a", "multimodal_article", None, "h", "succeeded", "g"), ("b", "article_text", None, "h", "succeeded", "g"), ("c", "header_image", "x", "h", "succeeded", "g"), ("d", "header_image", "x", "h", "succeeded", "g"))
    v = w.select("article_id", "modality", "configuration_id", "source_relative_path", "input_sha256", F.lit("hosted_response").alias("derivation_kind"), F.lit(None).cast("string").alias("raw_response_sha256"), F.lit(None).cast("string").alias("response_model"), F.lit("v").alias("stored_vector_sha256"))
    seen = spark.createDataFrame([("a", "new"), ("c", None), ("d", "x")], "article_id string, header_image_path string")
    acts = reconcile.stage_actions(w, v, seen, "r9")
    assert {(r.article_id, r.modality): (r.target_state, r.target_source_relative_path) for r in acts.collect()} == {("a", "header_image"): ("stale_input", "new"), ("a", "multimodal_article"): ("stale_input", None), ("b", "article_text"): ("stale_input", None), ("c", "header_image"): ("not_applicable", None)}
    runs = lambda done: spark.createDataFrame([("r9", done)], "run_id string, reconciliation_complete boolean")
    assert reconcile.visible_vectors(v, acts, runs(False)).count() == 6 and reconcile.visible_vectors(v, acts, runs(True)).count() == 2
    assert reconcile.unexpected(acts, w, v).count() == 0 and reconcile.unexpected(acts, w.withColumn("state", F.lit("queued")), v).count() == 4
    history = spark.createDataFrame([], schemas.schema("generation_history"))
    w2, v2, h2, a2 = reconcile.compact(w, v, history, acts, runs(True))
    view = lambda *x: sorted((r.article_id, r.modality, r.state, str(r.source_relative_path)) for r in reconcile.visible_work(*x).collect())
    assert view(w, acts, runs(True)) == view(w2, a2, runs(True)) and h2.count() == 4 and a2.count() == 0 and v2.count() == 2
    assert reconcile.discard_invisible(acts, runs(False)).count() == 0


def test_packing_quota_and_delays(spark):
    items = spark.createDataFrame([("g", i, t, b) for i, (t, b) in enumerate([(3, 1), (3, 1), (3, 1), (9, 1), (1, 9), (1, 1), (1, 1)])], "grp string, pos int, tokens int, bytes int")
    p = batching.Policy(max_items=2, max_tokens=6, max_bytes=8)
    assert [r.batch_no for r in batching.pack(items, "grp", "pos", p).orderBy("pos").collect()] == [1, 1, 2, None, None, 2, 3]
    now = datetime(2024, 1, 1, 0, 1, tzinfo=UTC)
    p = batching.Policy(quota_requests=3, quota_tokens=100, max_tokens=50, concurrency=2)
    old = [(now - timedelta(seconds=50), 40), (now - timedelta(seconds=20), 40)]
    assert batching.wait_seconds(old, [10], now, p) == 0 and batching.wait_seconds(old, [30], now, p) == 10 and batching.wait_seconds(old, [50, 50], now, p) == 40 and batching.wait_seconds(old, [10, 5], now, p) == 10
    with pytest.raises(ValueError):
        batching.wait_seconds(old, [60], now, p)
    at = [(0, 0), (59_999_999, 1), (60_000_000, 2)]
    ev = spark.createDataFrame([(k, us) for us, k in at], "k int, us long").select("k", F.timestamp_micros("us").alias("ts"), F.lit(1).alias("tokens"), F.lit(1).alias("one"))
    assert {r.k: r.window_requests for r in batching.rolling_usage(ev, "ts", "tokens", ["one"]).collect()} == {0: 1, 1: 2, 2: 2}
    usage = spark.createDataFrame([("a", {"input_tokens": 3.0, "x": 9.0}), ("a", {"input_tokens": 4.0, "total_tokens": float("nan")})], "k string, u map<string,double>")
    assert [(r.name, r.total) for r in batching.sum_usage(usage, "u", ["k"]).collect()] == [("input_tokens", 7.0)]


def test_vectors_digests_images(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], 1), (2, [0.0, 0.0], 1), (3, [1.0], 1), (4, None, 1), (5, [float("nan"), 1.0], 1), (6, [None, 1.0], 1)], "i int, v array<float>, g int")
    st = {r.i: r.s for r in df.select("i", vec.status(F.col("v"), F.lit(2)).alias("s")).collect()}
    assert st == {1: None, 2: "zero_vector", 3: "invalid_dimensions", 4: "invalid_vector", 5: "nonfinite_vector", 6: "invalid_vector"}
    assert df.filter("i = 1").select(vec.normalized(F.col("v")).alias("n")).first().n == pytest.approx([0.6, 0.8]) and df.filter("i = 2").select(vec.normalized(F.col("v")).alias("n")).first().n is None
    two = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 3)], "g int, v array<float>, w int")
    assert vec.weighted_mean(two, ["g"], "v", "w", "w").first().mean == [0.25, 0.75] == vec.ordered_mean(two, ["g"], "v", "w", "w").first().mean
    a = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    assert digests.multiset_digest(a, "a", "b") == digests.multiset_digest(a.orderBy(F.desc("a")).repartition(3), "a", "b") != digests.multiset_digest(a.unionAll(a), "a", "b")
    assert digests.multiset_digest(a.limit(0), "a", "b") != digests.multiset_digest(a.unionAll(a), "a", "b")
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (40).to_bytes(4, "big") + (30).to_bytes(4, "big") + b"\x08\x02\0\0\0"
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x1e\x00\x28" + b"\0" * 12
    got = images.inspect(spark.createDataFrame([(bytearray(png),), (bytearray(jpg),), (bytearray(b"GIF"),), (None,)], "data binary"))
    rows = got.select("format", "width", "height", images.problem(F.col("format"), F.col("width"), F.col("height"), F.col("frames")).alias("p")).collect()
    assert [tuple(r) for r in rows] == [("png", 40, 30, None), ("jpeg", 40, 30, None), (None, 0, 0, "unsupported_image"), (None, 0, 0, "unsupported_image")]
    for order in "<>":
        exif = b"Exif\0\0" + (b"II" if order == "<" else b"MM") + struct.pack(order + "HIHHHIHHI", 42, 8, 1, 0x0112, 3, 1, 6, 0, 0)
        turned = b"\xff\xd8\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + jpg[2:]
        assert images.facts(turned) == ("jpeg", 30, 40, 1) and images.facts(turned.replace(b"Exif", b"Exit")) == ("jpeg", 40, 30, 1)
    for w, h in ((9000, 9000), (100_000, 300), (5000, 4000), (3, 40_000_000)):
        sw, sh = images.scaled(w, h)
        assert sw * sh <= images.MAX_PIXELS


def test_run_checks(spark):
    rows = [("a", "run", "full", "succeeded", D(1), D(2), '{"validation_ok":true}'), ("b", "run", "full", "failed", D(1), D(2), '{"validation_ok":true}'), ("c", "x", "limit:0", "odd", D(1), None, None), ("d", "run", "full\n", "running", D(1), None, "{}"), ("e", "run", "fixture", "failed", D(1), D(2), "[1]"), ("f", "run", "limit:3,reprocess", "succeeded", D(1), D(2), "{}")]
    got = {r.code: r.n for r in validation.issues(validation.run_checks(spark.createDataFrame(rows, schemas.schema("runs")))).collect()}
    assert got == {"invalid_run_command": 1, "invalid_run_scope": 2, "invalid_run_status": 1, "running_run": 1, "inconsistent_run_summary": 3}
    shown = validation.report(validation.issues(validation.run_checks(spark.createDataFrame(rows, schemas.schema("runs")))))
    assert [r.message for r in shown.collect()][0] == "inconsistent run summary: 3"


def test_file_issues(spark):
    refs = spark.createDataFrame([("a", "h"), ("b", "h"), ("../c", "h"), ("d", "h")], "path string, digest string")
    there = spark.createDataFrame([("a", "h"), ("d", "x"), ("e", "h")], "path string, sha256 string")
    assert {r.code: r.n for r in validation.file_issues(refs, there, "markdown", digest="digest").collect()} == {"missing_markdown": 1, "unsafe_markdown_path": 1, "markdown_hash_mismatch": 1, "orphan_markdown": 1}


def test_every_candidate_has_an_identity(spark, tmp_path):
    from foliospark.functions.identity import article_identity, normalize_url
    from foliospark.plans.catalog_queries import canonical_identities

    urls = [None, "", "  ", "#", "/", "N/A", "undefined", "null", "about:blank", "javascript:void(0)", "HTTPS://H.example:443/a/?b=2&a=1#x", "http://h.example/b", "Http://h.example/b/"]
    rows = [(f"p{k}", f"a{k}" if k else None, f"{k:064x}", u) for k, u in enumerate(urls)]
    spark.createDataFrame([*rows, rows[3]], "source_html_path string, article_id string, source_html_sha256 string, canonical_url string").write.parquet(str(tmp_path / "candidates.parquet"))
    got = [tuple(r) for r in canonical_identities(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((p, article_identity(None, u and normalize_url(u), h, "id")) for p, _, h, u in rows)
    assert [dict(got)[f"p{k}"] for k in range(5)] == [f"html:{k:064x}" for k in range(5)]


def test_file_sinks(spark, tmp_path):
    import hashlib

    root = str(tmp_path / "out")
    h = lambda d: hashlib.sha256(d).hexdigest()
    rows = lambda *x: spark.createDataFrame([(p, h(d), bytearray(d)) for p, d in x], "path string, sha256 string, data binary")
    go = lambda df, **o: {r.path: r.outcome for r in sinks.write_files(df, root, **o).collect()}
    assert go(rows(("renditions/a/1.jpg", b"1"), ("renditions/a/2.jpg", b"2"))) == {"renditions/a/1.jpg": "written", "renditions/a/2.jpg": "written"}
    assert go(rows(("renditions/a/1.jpg", b"1"), ("renditions/a/2.jpg", b"x"))) == {"renditions/a/1.jpg": "present", "renditions/a/2.jpg": "conflict"}
    assert go(rows(("renditions/a/2.jpg", b"x")), replace=True) == {"renditions/a/2.jpg": "written"}
    with pytest.raises(ValueError):
        sinks.put(root, "../x", b"", h(b""), False)
    with pytest.raises(ValueError):
        sinks.put(root, "x", b"1", h(b"2"), False)
    (tmp_path / "out/renditions/a/3.jpg.abc.part").write_bytes(b"left")
    os.symlink(tmp_path / "out/renditions/a/1.jpg", tmp_path / "out/renditions/a/link.jpg")
    listed = sinks.tree(spark, root, "renditions")
    assert {(r.path.rsplit("/", 1)[1], r.kind) for r in listed.collect()} == {("1.jpg", "file"), ("2.jpg", "file"), ("3.jpg.abc.part", "temp"), ("link.jpg", "other")}
    kept = spark.createDataFrame([("renditions/a/1.jpg",), (None,)], "path string")
    assert {(r.path, r.removed) for r in sinks.remove_orphans(listed, kept, root).collect()} == {("renditions/a/2.jpg", True), ("renditions/a/3.jpg.abc.part", True)}
    assert sorted(p.name for p in (tmp_path / "out/renditions/a").iterdir()) == ["1.jpg", "link.jpg"] and sinks.tree(spark, root, "none").count() == 0


def test_ordered_digests(spark):
    a = spark.createDataFrame([(i, f"v{i % 7}") for i in range(500)], "i int, v string")
    one = digests.ordered_digest(a, ["i"], "i", "v")
    assert one == digests.ordered_digest(a.repartition(7), ["i"], "i", "v") != digests.ordered_digest(a.withColumn("i", 499 - F.col("i")), ["i"], "i", "v")
    assert [r.position for r in digests.numbered(a, "i").orderBy("i").collect()] == list(range(500)) and digests.ordered_digest(a.limit(0), ["i"], "i") != one
    files = spark.createDataFrame([("a", 1, 2, None)], "path string, size long, mtime_ns long, status string")
    assert digests.tree_token(files) == digests.tree_token(files.repartition(3)) != digests.tree_token(files.withColumn("mtime_ns", F.lit(3)))
