"""Embedding runs, their validator with one corrupted frame per code, provenance of derived vectors, durable quota."""

import dataclasses
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foliospark.functions import vectors as vec
from foliospark.operators import embed, embedding_run, provenance, quota
from foliospark.operators import embedding_validation as ev
from foliospark.operators.batching import Policy
from foliospark.sources.store import Store

PNG = lambda w, h, tail=b"": b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + w.to_bytes(4, "big") + h.to_bytes(4, "big") + b"\x08\x02\0\0\0" + tail
JPG = lambda w, h: b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + b"\0" * 12
CONF = embedding_run.configuration(dimensions=8, context_token_limit=20)


def articles(spark, *rows):
    return spark.createDataFrame([(a, t, h[0] if h else None, datetime(2024, 1, 1), date(2023, 12, 31)) for a, t, *h in rows], "article_id string, text string, header_image_path string, published_at_utc timestamp, publication_date_new_york date")


def files(spark, **data):
    return spark.createDataFrame([(k + ".png", bytearray(v)) for k, v in data.items()], "path string, data binary")


def codes(catalogue, arts, **given):
    given = {"codec_rules": (CONF["image_input_rules"], CONF["image_transform"])} | given
    return {r.code: r.n for r in ev.embedding_issues(catalogue, arts, **given).collect()}


def test_runs_reuse_supersede_and_retire(spark, tmp_path):
    store, calls = Store(spark, str(tmp_path / "emb")), embed.SyntheticProvider(8, (("bad", "authentication", False),))
    go = lambda rows, **o: embedding_run.run(store, articles(spark, *rows), calls, CONF, **o)
    first = go([("a", "text a"), ("b", "text b " * 6), ("c", "bad"), ("d", "")])
    assert (first["articles"], first["insert"], first["succeeded"], first["terminal"], first["header_absent"]) == (3, 3, 2, 1, 3)
    second = go([("a", "text a"), ("b", "text b " * 6), ("c", "bad")])
    assert second["reused"] == 2 and second["keep"] == 1 and second["attempted"] == 0
    third = go([("a", "changed"), ("c", "bad")])
    assert (third["supersede"], third["succeeded"], third["retired"]) == (1, 1, 2)
    assert {(r.article_id, r.state) for r in store.read("embedding_work").filter("modality = 'article_text'").collect()} == {("a", "succeeded"), ("b", "stale_input"), ("c", "terminal")}
    assert {r.article_id for r in store.read("embedding_storage").collect()} == {"a"} and store.read("generation_history").count() == 2
    fourth = go([("a", "changed"), ("b", "back")], limit=1)
    assert fourth["articles"] == 1 and fourth["retired"] == 0 and store.read("embedding_work").count() == 6
    redone = go([("a", "changed")], reprocess=True)
    assert redone["supersede"] == 1 and {r.superseded_reason for r in store.read("generation_history").collect()} == {"input_changed", "explicit_reprocess"}
    assert {r.status for r in store.read("embedding_runs").collect()} == {"succeeded"}


def test_gates_and_the_life_of_a_run(spark, tmp_path):
    store = Store(spark, str(tmp_path / "emb"))
    hosted = embed.SyntheticProvider(8, synthetic=False, streams=1, model="m")
    conf = embedding_run.configuration(dimensions=8, observed_model="m", client_api_contract_version="v1")
    arts = articles(spark, ("a", "text"))
    with pytest.raises(embedding_run.NotAuthorized):
        embedding_run.run(store, arts, hosted, conf)
    assert store.version() == 0
    done = embedding_run.run(store, arts, hosted, conf, authorized=True)
    assert (done["hosted_requests"], done["hosted_retries"]) == (1, 0)
    v = store.read("embedding_storage").first()
    assert v.derivation_kind == "hosted_response" and v.response_model == "m" and len(v.raw_response_sha256) == 64
    r = store.read("hosted_request_reservations").collect()
    assert [(x.run_id, x.estimated_tokens, x.observed_input_tokens) for x in r] == [(done["run_id"], 4, 4)]
    assert codes(embedding_run.catalogue(store), arts) == {}
    with pytest.raises(embedding_run.ConfigurationDrift):
        embedding_run.run(store, articles(spark, ("a", "other")), embed.SyntheticProvider(8, synthetic=False, streams=1, model="m2"), conf, authorized=True)
    assert [r.status for r in store.read("embedding_runs").orderBy("started_at").collect()] == ["succeeded", "failed"]
    assert store.read("embedding_storage").count() == 1
    left = embedding_run.begin(store, conf, "full")
    embedding_run.begin(store, conf, "limited")
    states = {r.run_id: r.status for r in store.read("embedding_runs").collect()}
    assert states[left] == "interrupted" and sorted(states.values()) == ["failed", "interrupted", "running", "succeeded"]
    with pytest.raises(embedding_run.RunClosed):
        embedding_run.close_run(store.read("embedding_runs"), left, "succeeded")


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """A catalogue after runs with texts, long texts, headers of every kind and composites."""
    store, root = Store(spark, str(tmp_path_factory.mktemp("emb"))), tmp_path_factory.mktemp("images")
    provider = embed.SyntheticProvider(8, (("never", "deterministic_request", False), ("later", "rate_limit", True)))
    rows = [("a", "text a", "a.png"), ("b", "long text b. " * 6, "b.png"), ("c", "never", "c.png"), ("d", "later"), ("e", "text e", "e.png"), ("f", "text f", "f.png"), ("g", "text g", "g.png"), ("h", "text h")]
    imgs = files(spark, a=PNG(40, 30), b=PNG(9000, 4000), c=PNG(10, 10), e=b"GIF89a", f=PNG(7000, 7000))
    go = lambda rows, **o: embedding_run.run(store, articles(spark, *rows), provider, CONF, imgs, codec=lambda d: JPG(2000, 1000), rendition_root=str(root), **o)
    first = go([*rows, ("z", "text z", "a.png")])
    second = go([*rows[:1], ("b", "another long text. " * 5, "b.png"), *rows[2:]])
    placed = {r.rendition_relative_path for r in store.read("image_input_provenance").collect()} - {None}
    assert {str(p.relative_to(root)) for p in root.rglob("*.jpg")} == placed and len(placed) == 1
    return store, articles(spark, *[r if r[0] != "b" else ("b", "another long text. " * 5, "b.png") for r in rows]), first, second


def test_a_run_has_no_issues_but_the_notices(spark, filled):
    store, arts, first, second = filled
    assert (first["composites"], second["composites"], second["retired"]) == (3, 1, 3)
    work = {(r.article_id, r.modality): (r.state, r.error_code, r.attempt_count) for r in store.read("embedding_work").collect()}
    assert work[("g", "header_image")] == ("retryable", "missing_header_image", 0) and work[("e", "header_image")] == ("terminal", "unsupported_image", 0) and work[("f", "header_image")] == ("terminal", "unsafe_image", 0)
    assert work[("c", "article_text")] == ("terminal", "deterministic_request", 1) and work[("d", "article_text")] == ("retryable", "rate_limit", 6) and work[("h", "header_image")][0] == "not_applicable"
    assert {k[0] for k, v in work.items() if k[1] == "multimodal_article" and v[0] == "succeeded"} == {"a", "b"}
    p = {r.article_id: r for r in store.read("image_input_provenance").filter("article_id in ('a', 'b')").collect()}
    assert p["a"].rendition_relative_path is None and p["b"].rendition_relative_path.endswith(".jpg") and (p["b"].embedded_width, p["b"].source_width) == (2000, 9000)
    assert store.read("long_text_parts").filter("article_id = 'b'").count() == 5 and store.read("article_text_aggregation_provenance").filter("article_id = 'b'").count() == 9
    assert codes(embedding_run.catalogue(store), arts, lengths=arts.select("article_id", F.length("text").cast("long").alias("char_count"))) == {"missing_header_image": 1, "header_image_terminal_failure": 2}


NOTICES = {"missing_header_image": 1, "header_image_terminal_failure": 2}
SHA = "0" * 64


def put(df, where, **values):
    """The frame with the columns of matching rows replaced."""
    for c, v in values.items():
        df = df.withColumn(c, F.when(F.expr(where), v if hasattr(v, "cast") else F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return df


TEXT, HEAD, BOTH = "article_id = 'a' and modality = 'article_text'", "article_id = 'a' and modality = 'header_image'", "article_id = 'a' and modality = 'multimodal_article'"
NONE, GONE, WAITS = "article_id = 'h' and modality = 'header_image'", "article_id = 'z' and modality = 'header_image'", "article_id = 'g' and modality = 'header_image'"
FAIL = "article_id = 'c' and modality = 'article_text'"
W, V, R, H, C = "embedding_work", "embedding_storage", "embedding_runs", "generation_history", "embedding_configurations"
MP, IP, LP, LG, AP = "multimodal_embedding_provenance", "image_input_provenance", "long_text_parts", "long_text_part_generations", "article_text_aggregation_provenance"
CORRUPTIONS = [
    (C, lambda d: put(d, "true", task="x"), {"invalid_configuration_id"}),
    (C, lambda d: put(d, "true", quota_max_requests=1), {"invalid_configuration_id", "invalid_hosted_quota_policy"}),
    (R, lambda d: put(d, "true", usage_json='{"secret":1}'), {"invalid_run_metrics"}),
    (R, lambda d: put(d, "true", elapsed_seconds=float("nan")), {"invalid_run_metrics"}),
    (R, lambda d: put(d, "true", finished_at=None), {"invalid_run_lifecycle"}),
    (R, lambda d: put(d, "true", articles=99), {"invalid_run_lifecycle"}),
    (R, lambda d: put(d, "true", embeddings=99), {"missing_published_embedding"}),
    (R, lambda d: put(d, "true", header_absent=99), {"invalid_header_disposition_counts"}),
    ("full_run_articles", lambda d: put(d, "article_id = 'a'", run_id="none"), {"invalid_run_lifecycle"}),
    (W, lambda d: put(d, TEXT, modality="odd"), {"invalid_work_modality", "invalid_public_embedding_checkpoint", "missing_published_embedding"}),
    (W, lambda d: put(d, FAIL, article_id="nobody"), {"missing_canonical_work_article"}),
    (W, lambda d: put(d, FAIL, state="odd"), {"invalid_work_state"}),
    (W, lambda d: put(d, HEAD, state="queued", generation_run_id=None), {"header_image_queued", "embedding_without_success_checkpoint", "invalid_public_embedding_checkpoint"}),
    (W, lambda d: put(d, HEAD, state="eligible"), {"header_image_eligible", "invalid_generation_checkpoint"}),
    (W, lambda d: put(d, HEAD, state="in_progress"), {"header_image_in_progress"}),
    (W, lambda d: put(d, HEAD, state="interrupted"), {"header_image_interrupted"}),
    (W, lambda d: put(d, HEAD, state="retryable"), {"header_image_retryable_failure", "invalid_failure_checkpoint"}),
    (W, lambda d: put(d, NONE, attempt_count=2), {"invalid_not_applicable_checkpoint"}),
    (W, lambda d: put(d, FAIL, state="stale_configuration"), {"invalid_stale_configuration_checkpoint", "invalid_failure_checkpoint"}),
    (W, lambda d: put(d, GONE, source_relative_path="a.png"), {"invalid_stale_input_checkpoint"}),
    (W, lambda d: put(d, WAITS, source_relative_path="../g.png"), {"invalid_missing_header_checkpoint"}),
    (W, lambda d: put(d, FAIL, input_sha256="x"), {"invalid_work_input_hash"}),
    (W, lambda d: put(d, FAIL, source_relative_path="p"), {"invalid_source_relative_path"}),
    (W, lambda d: put(d, FAIL, error_code=None), {"invalid_failure_checkpoint"}),
    (W, lambda d: put(d, TEXT, generation_run_id="none"), {"invalid_generation_checkpoint", "invalid_public_embedding_checkpoint"}),
    (W, lambda d: d.filter(f"not ({NONE})"), {"missing_header_disposition", "invalid_header_disposition_counts"}),
    (V, lambda d: d.filter(f"not ({TEXT})"), {"missing_published_embedding"}),
    (V, lambda d: put(d, TEXT, configuration_id="none"), {"missing_configuration_reference", "missing_published_embedding"}),
    (V, lambda d: put(d, TEXT, dimensions=7), {"invalid_dimensions"}),
    (V, lambda d: put(d, TEXT, derivation_kind="hosted_response"), {"invalid_vector_provenance", "hosted_response_model_mismatch"}),
    (V, lambda d: put(d, TEXT, published_at_utc=datetime(2020, 1, 1)), {"publication_metadata_mismatch"}),
    (V, lambda d: put(d, TEXT, vector=F.array(*[F.lit(0.0)] * 8).cast("array<float>")), {"zero_vector", "vector_hash_mismatch"}),
    (V, lambda d: put(d, TEXT, vector=F.array(*[F.lit(1.0)] * 8).cast("array<float>")), {"nonunit_vector", "vector_hash_mismatch"}),
    (V, lambda d: put(d, TEXT, vector=F.array(*[F.lit(1.0)] * 3).cast("array<float>")), {"invalid_vector_dimensions"}),
    (V, lambda d: put(d, TEXT, vector=F.array(*[F.lit(float("nan"))] * 8).cast("array<float>")), {"nonfinite_vector"}),
    (V, lambda d: put(d, TEXT, vector=None), {"invalid_vector"}),
    (V, lambda d: put(d, TEXT, stored_vector_sha256=SHA), {"vector_hash_mismatch", "invalid_multimodal_source_linkage"}),
    (V, lambda d: put(d, BOTH, vector=F.transform("vector", lambda x: -x)), {"multimodal_vector_mismatch"}),
    (V, lambda d: put(d, BOTH, input_sha256=SHA), {"multimodal_input_identity_mismatch"}),
    (V, lambda d: put(d, "article_id = 'b' and modality = 'article_text'", vector=F.transform("vector", lambda x: -x)), {"long_text_vector_mismatch"}),
    (MP, lambda d: d.filter("article_id <> 'a'"), {"missing_multimodal_provenance"}),
    (MP, lambda d: put(d, "article_id = 'a'", generation_run_id="none"), {"invalid_multimodal_provenance"}),
    (H, lambda d: put(d, "true", modality="odd"), {"invalid_generation_modality"}),
    (H, lambda d: put(d, "true", generation_run_id="none"), {"invalid_generation_identity_reference", "invalid_generation_run_reference", "missing_published_embedding"}),
    (H, lambda d: put(d, "true", superseded_run_id="none"), {"invalid_generation_run_reference"}),
    (H, lambda d: put(d, "modality = 'header_image'", source_relative_path="/x"), {"invalid_generation_source_path"}),
    (H, lambda d: put(d, "true", superseded_reason="why"), {"invalid_supersession_reason"}),
    (H, lambda d: put(d, "true", stored_vector_sha256="x"), {"invalid_generation_hash"}),
    (H, lambda d: put(d, "true", derivation_kind="odd"), {"invalid_generation_provenance"}),
    (IP, lambda d: d.filter("article_id <> 'a'"), {"missing_image_input_provenance"}),
    (IP, lambda d: put(d, "article_id = 'a'", embedded_width=1), {"invalid_image_input_provenance"}),
    (IP, lambda d: put(d, "article_id = 'b'", rendition_relative_path="x.jpg"), {"invalid_rendition_path"}),
    (IP, lambda d: put(d, "article_id = 'a'", configuration_id="none"), {"unknown_image_provenance_configuration"}),
    (LP, lambda d: put(d, "part_index = 1", char_end=0), {"invalid_long_text_part"}),
    (LP, lambda d: put(d, "part_index = 1", state="retryable"), {"invalid_long_text_part"}),
    (LG, lambda d: put(d, "part_index = 1", token_count=0), {"invalid_long_text_part_generation"}),
    (LG, lambda d: put(d, "part_index = 1", char_start=F.col("char_start") + 1), {"invalid_long_text_source_coverage"}),
    (AP, lambda d: d.filter("article_id <> 'b'"), {"missing_long_text_provenance"}),
    (AP, lambda d: put(d, "part_index = 1", part_generation_run_id="none"), {"invalid_long_text_provenance"}),
]


def test_each_corruption_has_its_code(filled):
    store, arts, *_ = filled
    whole = embedding_run.catalogue(store)
    work, vectors, heads = (lambda c: ev.work_issues(c, arts)), (lambda c: ev.vector_issues(c, arts)), (lambda c: ev.header_issues(c, arts))
    images = lambda c: ev.image_issues(c, (CONF["image_input_rules"], CONF["image_transform"]))
    where = {
        "configuration": ev.configuration_issues, "missing_run": ev.configuration_issues, "unknown": ev.configuration_issues, "invalid_hosted": ev.configuration_issues, "missing_configuration": ev.configuration_issues, "invalid_configuration": ev.configuration_issues, "invalid_run": ev.run_issues, "multimodal": ev.multimodal_issues,
        "long_text": ev.long_text_issues, "invalid_header": heads, "missing_header_disposition": heads, "image_input": images, "rendition": images, "supersession": ev.history_issues,
    }
    own = {W: [work], V: [vectors, work], H: [ev.history_issues, ev.claim_issues], R: [ev.claim_issues]}

    def one(case):
        table, change, expect = case
        broken = dataclasses.replace(whole, **{table: change(getattr(whole, table))})
        checks = {f for part, f in where.items() if any(part in x for x in expect)} | set(own.get(table, [])) | ({vectors} if "invalid_vector_provenance" in expect else set())
        found = {r.code for f in checks for r in f(broken).collect()}
        return (table, expect, found) if not expect <= found else None

    with ThreadPoolExecutor(8) as pool:
        assert [x for x in pool.map(one, CORRUPTIONS) if x] == []


def test_reservations_actions_renditions_and_texts(spark, filled):
    store, arts, *_ = filled
    whole = embedding_run.catalogue(store)
    run_id = whole.embedding_runs.first().run_id
    good = ("r", run_id, CONF["configuration_id"], datetime(2024, 1, 1), 5, 9)
    res = lambda *row: dataclasses.replace(whole, hosted_request_reservations=spark.createDataFrame([row], whole.hosted_request_reservations.schema))
    found = lambda c: {r.code for r in ev.configuration_issues(c).collect()}
    assert found(res(*good)) == set()
    for k, v in ((1, "none"), (2, "none"), (3, datetime(2900, 1, 1)), (4, -1), (4, 10**8), (5, 4), (5, 2 * 10**9)):
        assert found(res(*[v if i == k else x for i, x in enumerate(good)])) == {"invalid_hosted_quota_reservation"}
    missing = dataclasses.replace(whole, embedding_configurations=whole.embedding_configurations.filter("false"))
    assert {"missing_run_configuration_reference", "missing_configuration_reference", "unknown_image_provenance_configuration"} <= found(missing)
    assert ev.select_configuration(whole.embedding_configurations) == (CONF["configuration_id"], None) and ev.select_configuration(whole.embedding_configurations, "x") == (None, "unknown_configuration_id")
    assert ev.select_configuration(missing.embedding_configurations) == (None, "missing_embedding_configuration") and ev.select_configuration(whole.embedding_configurations.union(put(whole.embedding_configurations, "true", configuration_id="y")))[1] == "configuration_id_required"
    # Actions that were made visible but not carried out yet.
    seen = arts.filter("article_id <> 'a'").select("article_id", "header_image_path")
    acts = ev.reconcile.stage_actions(whole.embedding_work.filter("state <> 'stale_input'"), whole.embedding_storage, seen, run_id)
    hidden = dataclasses.replace(whole, reconciliation_actions=acts.select(*whole.reconciliation_actions.columns))
    bad = lambda c: {r.code for r in ev.reconciliation_issues(c).collect()}
    assert bad(hidden) == set() and hidden.vectors().count() == whole.vectors().count() - 3
    assert bad(dataclasses.replace(hidden, reconciliation_actions=put(hidden.reconciliation_actions, "true", expected_state="queued"))) == {"invalid_reconciliation_action"}
    assert bad(dataclasses.replace(hidden, embedding_storage=put(whole.embedding_storage, TEXT, dimensions=3))) == {"invalid_reconciliation_vector"}
    assert bad(dataclasses.replace(hidden, multimodal_embedding_provenance=put(whole.multimodal_embedding_provenance, "true", formula_version="x"))) == {"invalid_reconciliation_vector"}
    b = whole.image_input_provenance.filter("rendition_relative_path is not null").first()
    listing = lambda *rows: spark.createDataFrame(rows, "path string, sha256 string, kind string")
    seen_codes = lambda *rows, rules=(CONF["image_input_rules"], CONF["image_transform"]): {r.code for r in ev.image_issues(whole, rules, listing(*rows)).collect()}
    own = (b.rendition_relative_path, b.embedded_input_sha256, "file")
    assert seen_codes(own) == set() and seen_codes((own[0], "x", "file")) == {"rendition_hash_mismatch"} and seen_codes((own[0], None, "other")) == {"unsafe_image_rendition"}
    assert seen_codes(("renditions/x", None, "other"), (own[0][:-68] + SHA + ".jpg", SHA, "file"), ("renditions/y.part", None, "temp")) == {"missing_image_rendition", "unsafe_image_rendition_entry", "orphan_image_rendition", "orphan_image_rendition_temp"} and seen_codes(own, rules=None) == {"image_codec_unavailable"}
    texts = arts.select("article_id", "header_image_path", F.concat("article_id", F.lit(".md")).alias("cleaned_markdown_path"), F.sha2("text", 256).alias("sha256"))
    there = texts.select(F.col("cleaned_markdown_path").alias("path"), "sha256")
    said = lambda a, l: {r.code for r in ev.text_issues(whole, a, l).collect()}  # noqa: E731, E741
    assert said(texts, there) == set() and said(texts, there.limit(0)) == {"missing_canonical_markdown"} and said(texts, there.withColumn("sha256", F.lit("x"))) == {"input_hash_mismatch"}
    assert said(texts.withColumn("cleaned_markdown_path", F.lit("../x")), there) == {"unsafe_markdown_path"} and said(texts.withColumn("header_image_path", F.lit("/x")), there) == {"header_image_path_mismatch", "unsafe_header_image_path"}


def test_parts_are_resumed_and_exhausted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "emb"))
    arts = articles(spark, ("a", "part one.\n\npart later.\n\npart three."))
    flaky = embed.SyntheticProvider(8, (("later", "rate_limit", True),))
    conf = embedding_run.configuration(dimensions=8, context_token_limit=13, long_text_part_attempt_limit=6)
    first = embedding_run.run(store, arts, flaky, conf)
    assert first["retryable"] == 1 and sorted((r.part_index, r.state, r.attempt_count) for r in store.read("long_text_parts").collect()) == [(0, "succeeded", 1), (1, "retryable", 3), (2, "succeeded", 1)]
    embedding_run.run(store, arts, flaky, conf)
    assert sorted((r.part_index, r.state, r.attempt_count) for r in store.read("long_text_parts").collect()) == [(0, "succeeded", 1), (1, "terminal", 6), (2, "succeeded", 1)]
    assert store.read("embedding_work").filter("modality = 'article_text'").first().state == "terminal" and codes(embedding_run.catalogue(store), arts) == {}
    other = Store(spark, str(tmp_path / "emb2"))
    embedding_run.run(other, arts, flaky, conf)
    embedding_run.run(other, arts, embed.SyntheticProvider(8), conf)
    gens = {r.part_index: r.generation_run_id for r in other.read("long_text_part_generations").collect()}
    assert gens[0] == gens[2] != gens[1] and other.read("embedding_storage").count() == 1 and codes(embedding_run.catalogue(other), arts) == {}


def test_pace_waits_halves_and_counts():
    now = [datetime(2024, 1, 1, tzinfo=UTC)]
    slept = []

    def sleep(s):
        slept.append(s)
        now[0] += timedelta(seconds=s)

    p = Policy(quota_requests=3, quota_tokens=100, max_tokens=50, max_items=1, concurrency=2, attempts=2)
    pace = quota.Pace(p, [(now[0] - timedelta(seconds=59), 90)], lambda: now[0], sleep)

    class Busy(embed.SyntheticProvider):
        def embed(self, items):
            return [dataclasses.replace(o, throttled=items[0].key == "k0", usage={"input_tokens": 30}) for o in super().embed(items)]

    stream = embed.Stream(Busy(4, (("again", "rate_limit", True),)), p, pace)
    final = stream.run([embed.Item(f"k{i}", "h", "again" if i == 3 else "x", tokens=20) for i in range(4)])
    assert slept[0] == 1.0 and pace.concurrency == 1 and pace.throttles == 1 and stream.requests == 5 and final["k3"][1] == 2 and stream.waits == [1.0]
    assert [r[1:] for r in pace.reserved][:2] == [[20, 30], [20, 30]]


def test_composite_issues(spark):
    gens = spark.createDataFrame([("a", "c", "article_text", "t1", "ht", [1.0, 0.0]), ("a", "c", "header_image", "h1", "hh", [0.0, 1.0])], "article_id string, configuration_id string, modality string, generation_run_id string, hash string, vector array<float>")
    prov = spark.createDataFrame([("a", "c", "g", "t1", "h1", "ht", "hh", "f")], "article_id string, configuration_id string, generation_run_id string, text_generation_run_id string, header_generation_run_id string, text_hash string, header_hash string, formula_version string")
    ident = vec.composite_identity(formula_version=F.lit("f"), text_generation_run_id=F.lit("t1"), text_stored_vector_sha256=F.lit("ht"), header_image_generation_run_id=F.lit("h1"), header_image_stored_vector_sha256=F.lit("hh"))
    good = spark.createDataFrame([("a", "c", "g", [0.70710677, 0.70710677])], "article_id string, configuration_id string, generation_run_id string, vector array<float>").withColumns({"input_sha256": ident, "formula": F.lit("f"), "hash": vec.vector_hash("vector")})
    found = lambda *x: {r.code: r.n for r in provenance.composite_issues(*x).collect()}
    assert found(good, prov, gens) == {}
    assert found(good, prov.limit(0), gens) == {"missing_multimodal_provenance": 1}
    assert found(good.limit(0), prov, gens) == {"invalid_multimodal_provenance": 1}
    assert found(good.withColumn("input_sha256", F.lit("x")), prov, gens) == {"multimodal_input_identity_mismatch": 1}
    assert found(good, prov, gens.withColumn("hash", F.lit("x"))) == {"invalid_multimodal_source_linkage": 1}
    assert found(good.withColumn("vector", F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>")), prov, gens) == {"multimodal_vector_mismatch": 1}
    opposite = gens.withColumn("vector", F.when(F.col("modality") == "header_image", F.array(F.lit(-1.0), F.lit(0.0)).cast("array<float>")).otherwise(F.col("vector")))
    assert found(good, prov, opposite) == {"multimodal_recomputation_failed": 1}


def test_aggregate_issues(spark):
    key = "article_id string, configuration_id string, generation_run_id string"
    parts = spark.createDataFrame([("a", "c", "p", 0, 0, 5, 1, [1.0, 0.0]), ("a", "c", "p", 1, 5, 9, 3, [0.0, 1.0])], key + ", part_index int, char_start long, char_end long, token_count int, vector array<float>")
    prov = spark.createDataFrame([("a", "c", "g", 0, "p"), ("a", "c", "g", 1, "p")], key + ", part_index int, part_generation_run_id string")
    n = (0.25**2 + 0.75**2) ** 0.5
    agg = spark.createDataFrame([("a", "c", "g", 9, [0.25 / n, 0.75 / n])], key + ", char_count long, vector array<float>")
    found = lambda *x: {r.code: r.n for r in provenance.aggregate_issues(*x).collect()}
    assert found(agg, prov, parts) == {}
    assert found(agg, prov.limit(0), parts) == {"missing_long_text_provenance": 1}
    assert found(agg, prov, parts.filter("part_index = 0")) == {"invalid_long_text_provenance": 1}
    assert found(agg.withColumn("char_count", F.lit(10).cast("long")), prov, parts) == {"invalid_long_text_source_coverage": 1}
    assert found(agg, prov, parts.withColumn("char_start", F.when(F.col("part_index") == 1, 6).otherwise(0).cast("long"))) == {"invalid_long_text_source_coverage": 1}
    assert found(agg, prov, parts.withColumn("token_count", F.lit(1))) == {"long_text_vector_mismatch": 1}


def test_quota(spark):
    now, p = datetime(2024, 1, 1, 0, 1, tzinfo=UTC), Policy(quota_requests=3, quota_tokens=100, max_tokens=50)
    res = spark.createDataFrame([(now - timedelta(seconds=60), 90), (now - timedelta(seconds=59), 60)], "reserved_at timestamp, tokens int")
    assert quota.live(res, F.lit(now), p).count() == 1
    assert quota.reserve(res, [40], now, p) == (0.0, [40]) and quota.reserve(res, [50], now, p) == (1.0, [])
    assert quota.settle_usage({"b": 5, "a": 5}, 13) == {"b": 5, "a": 8} and quota.settle_usage({"a": 5}, 2) == {"a": 5} and quota.settle_usage({"a": 5}, None) == {"a": 5}
    assert [quota.observed_tokens(u) for u in ({"input_tokens": 3}, {"prompt_tokens": 4.0}, {"input_tokens": 3.5}, {"input_tokens": True}, None, {"input_tokens": -1})] == [3, 4, None, None, None, None]
    assert quota.seconds("1.5", now) == 1.5 and quota.seconds("Mon, 01 Jan 2024 00:01:30 GMT", now) == 30 and quota.seconds("x", now) is None and quota.seconds("-1", now) is None
    headers = quota.rate_headers({"Retry-After": "2", "X-RateLimit-Remaining-Tokens": "0", "other": "1"}, now)
    assert headers == {"retry-after": 2.0, "x-ratelimit-remaining-tokens": 0.0} and quota.throttled(headers)
    deep = []
    for _ in range(40):
        deep = [deep]
    assert quota.bounded({"a": [1, "x"]}) and not quota.bounded(deep) and not quota.bounded("x" * 70_000) and not quota.bounded([0] * 20_001)


def test_policy():
    assert Policy().coherent() and not Policy(concurrency=3).coherent() and not Policy(quota_requests=0).coherent()
    with pytest.raises(ValueError):
        quota.wait_seconds([], [1], datetime(2024, 1, 1), Policy())
