"""The embedding validator over catalogues of any size: every part of the parts table is one work item (or superseded
generation, or run) in one of the written cases, in turn, and each case says which codes it has to raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.operators import embedding_validation as ev
from foliospark.sources.tables import table

H, X = "0" * 64, "f" * 64
#: modality, path, input, state, attempts, error, generation, stored vector's input, article there, its header; codes expected
ITEMS = [
    ("article_text", None, H, "succeeded", 1, None, "g", H, True, None, ()),
    ("header_image", "i.jpg", H, "succeeded", 1, None, "g", H, True, "i.jpg", ()),
    ("odd", None, H, "eligible", 0, None, None, None, True, None, ("invalid_work_modality",)),
    ("article_text", None, H, "eligible", 0, None, None, None, False, None, ("missing_canonical_work_article",)),
    ("article_text", None, H, "odd", 0, None, None, None, True, None, ("invalid_work_state",)),
    ("article_text", None, H, "succeeded", 1, None, "g", None, True, None, ("missing_published_embedding",)),
    ("article_text", None, H, "succeeded", 1, None, "g", X, True, None, ("missing_published_embedding", "invalid_public_embedding_checkpoint")),
    ("article_text", None, H, "queued", 0, None, None, H, True, None, ("embedding_without_success_checkpoint", "invalid_public_embedding_checkpoint")),
    ("article_text", None, H, "succeeded", 1, None, "none", H, True, None, ("invalid_generation_checkpoint", "invalid_public_embedding_checkpoint")),
    ("article_text", None, H, "terminal", 1, "x", "g", None, True, None, ("invalid_generation_checkpoint",)),
    ("header_image", None, None, "not_applicable", 0, None, None, None, True, None, ()),
    ("header_image", None, None, "not_applicable", 1, None, None, None, True, None, ("invalid_not_applicable_checkpoint",)),
    ("header_image", None, None, "not_applicable", 0, None, None, None, True, "i.jpg", ("invalid_not_applicable_checkpoint",)),
    ("article_text", None, None, "not_applicable", 0, None, None, None, True, None, ("invalid_not_applicable_checkpoint",)),
    ("article_text", None, None, "stale_configuration", 0, None, None, None, False, None, ()),
    ("article_text", None, None, "stale_configuration", 0, "x", None, None, True, None, ("invalid_stale_configuration_checkpoint", "invalid_failure_checkpoint")),
    ("article_text", None, None, "stale_input", 0, None, None, None, False, None, ()),
    ("header_image", "i.jpg", None, "stale_input", 0, None, None, None, True, "i.jpg", ()),
    ("article_text", None, H, "stale_input", 0, None, None, None, True, None, ("invalid_stale_input_checkpoint",)),
    ("header_image", "j.jpg", None, "stale_input", 0, None, None, None, True, "i.jpg", ("invalid_stale_input_checkpoint",)),
    ("header_image", "i.jpg", None, "stale_input", 0, None, None, None, False, None, ("invalid_stale_input_checkpoint",)),
    ("header_image", "i.jpg", None, "retryable", 0, "missing_header_image", None, None, True, "i.jpg", ("missing_header_image",)),
    ("header_image", "../i.jpg", None, "retryable", 0, "missing_header_image", None, None, True, "../i.jpg", ("missing_header_image", "invalid_missing_header_checkpoint")),
    ("header_image", "i.jpg", None, "retryable", 2, "missing_header_image", None, None, True, "i.jpg", ("missing_header_image", "invalid_missing_header_checkpoint")),
    ("article_text", None, "short", "eligible", 0, None, None, None, True, None, ("invalid_work_input_hash",)),
    ("article_text", "p", H, "eligible", 0, None, None, None, True, None, ("invalid_source_relative_path",)),
    ("header_image", "a//b", H, "succeeded", 1, None, "g", H, True, "a//b", ("invalid_source_relative_path",)),
    ("article_text", None, H, "terminal", 1, "x", None, None, True, None, ()),
    ("article_text", None, H, "terminal", 0, "x", None, None, True, None, ("invalid_failure_checkpoint",)),
    ("article_text", None, H, "retryable", 1, None, None, None, True, None, ("invalid_failure_checkpoint",)),
    ("article_text", None, H, "queued", 0, "x", None, None, True, None, ("invalid_failure_checkpoint",)),
    ("header_image", "i.jpg", H, "terminal", 0, "corrupt_image", None, None, True, "i.jpg", ("header_image_terminal_failure",)),
    ("header_image", "i.jpg", H, "retryable", 1, "x", None, None, True, "i.jpg", ("header_image_retryable_failure",)),
    ("header_image", "i.jpg", H, "queued", 0, None, None, None, True, "i.jpg", ("header_image_queued",)),
    ("header_image", "i.jpg", H, "eligible", 0, None, None, None, True, "i.jpg", ("header_image_eligible",)),
    ("header_image", "i.jpg", H, "in_progress", 1, None, None, None, True, "i.jpg", ("header_image_in_progress",)),
    ("header_image", "i.jpg", H, "interrupted", 1, None, None, None, True, "i.jpg", ("header_image_interrupted",)),
]
#: modality, path, generation's run, superseding run, reason, input, vector's hash, derivation, raw response, model, work there; codes expected
GENERATIONS = [
    ("article_text", None, "g", "s", "input_changed", H, H, "hosted_response", H, "m", True, ()),
    ("odd", None, "g", "s", "input_changed", H, H, "hosted_response", H, "m", True, ("invalid_generation_modality", "invalid_generation_provenance")),
    ("article_text", None, "none", "s", "input_changed", H, H, "hosted_response", H, "m", True, ("invalid_generation_identity_reference", "invalid_generation_run_reference")),
    ("article_text", None, "g", "none", "input_changed", H, H, "hosted_response", H, "m", True, ("invalid_generation_run_reference",)),
    ("article_text", None, "g", "s", "input_changed", H, H, "hosted_response", H, "m", False, ("invalid_generation_identity_reference",)),
    ("header_image", "../i.jpg", "g", "s", "input_changed", H, H, "hosted_response", H, "m", True, ("invalid_generation_source_path",)),
    ("article_text", "i.jpg", "g", "s", "input_changed", H, H, "hosted_response", H, "m", True, ("invalid_generation_source_path",)),
    ("article_text", None, "g", "s", "why", H, H, "hosted_response", H, "m", True, ("invalid_supersession_reason",)),
    ("article_text", None, "g", "s", "explicit_reprocess", "x", H, "hosted_response", H, "m", True, ("invalid_generation_hash",)),
    ("article_text", None, "g", "s", "explicit_reprocess", H, H + "\n", "hosted_response", H, "m", True, ("invalid_generation_hash",)),
    ("article_text", None, "g", "s", "input_changed", H, H, "synthetic_fixture", None, None, True, ("invalid_generation_provenance",)),
    ("multimodal_article", None, "g", "s", "input_changed", H, H, "multimodal_midpoint", None, None, True, ()),
    ("article_text", None, "g", "s", "input_changed", H, H, "hosted_response", H, "other", True, ("hosted_response_model_mismatch",)),
]
#: scope, status, discovery and reconciliation complete, articles, listed ones, ended, requests, usage, elapsed; codes expected
RUNS = [
    ("full", "succeeded", True, True, 1, 1, True, 1, '{"input_tokens":3}', 1.0, ()),
    ("limited", "succeeded", False, False, 5, 0, True, 0, "{}", 0.0, ()),
    ("full", "running", True, False, 1, 1, False, 0, "{}", 0.0, ()),
    ("full", "interrupted", False, False, 0, 0, True, 0, "{}", 0.0, ()),
    ("half", "succeeded", True, True, 1, 0, True, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("full", "done", True, False, 0, 0, True, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("full", "running", True, True, 1, 1, False, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("full", "failed", True, False, 1, 1, False, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("limited", "succeeded", True, False, 1, 0, True, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("full", "succeeded", True, True, 2, 1, True, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("full", "succeeded", False, False, 1, 1, True, 0, "{}", 0.0, ("invalid_run_lifecycle",)),
    ("limited", "failed", False, False, 1, 0, True, -1, "{}", 0.0, ("invalid_run_metrics",)),
    ("limited", "failed", False, False, 1, 0, True, 0, '{"prompt":1}', 0.0, ("invalid_run_metrics",)),
    ("limited", "failed", False, False, 1, 0, True, 0, '{"input_tokens":-1}', 0.0, ("invalid_run_metrics",)),
    ("limited", "failed", False, False, 1, 0, True, 0, "[1", 0.0, ("invalid_run_metrics",)),
    ("limited", "failed", False, False, 1, 0, True, 0, "{}", float("inf"), ("invalid_run_metrics",)),
]


def _cases(spark: SparkSession, sf: str, cases: list[tuple], schema: str) -> DataFrame:
    """The cases, each part of the parts table in one of them; `n` tells the parts apart."""
    frame = spark.createDataFrame([(k, *c[:-1]) for k, c in enumerate(cases)], "k int, " + schema)
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("n"), F.pmod("p_partkey", F.lit(len(cases))).cast("int").alias("part_k"))
    return p.join(F.broadcast(frame), F.col("part_k") == F.col("k"))


def _table(df: DataFrame, name: str, **given: object) -> DataFrame:
    value = lambda f: F.lit(None) if f.name not in given else given[f.name] if hasattr(given[f.name], "cast") else F.lit(given[f.name])
    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in schemas.schema(name)])


def _one(spark: SparkSession, name: str, **given: object) -> DataFrame:
    return _table(spark.range(1), name, **given)


def work_item_issues(spark: SparkSession, sf: str) -> DataFrame:
    c = _cases(spark, sf, ITEMS, "modality string, path string, input string, state string, attempts int, error string, generation string, stored string, there boolean, header string")
    key = {"article_id": F.col("n"), "modality": F.col("modality"), "configuration_id": "c", "source_relative_path": F.col("path")}
    work = _table(c, "embedding_work", **key, input_sha256=F.col("input"), state=F.col("state"), attempt_count=F.col("attempts"), error_code=F.col("error"), last_run_id="g", generation_run_id=F.col("generation"))
    vectors = _table(c.filter("stored is not null"), "embedding_storage", **key, input_sha256=F.col("stored"))
    articles = c.filter("there").select(F.col("n").alias("article_id"), F.col("header").alias("header_image_path"))
    runs = _one(spark, "embedding_runs", run_id="g", configuration_id="c", reconciliation_complete=False)
    return ev.work_issues(ev.Catalogue.of(spark, embedding_work=work, embedding_storage=vectors, embedding_runs=runs), articles)


def generation_issues(spark: SparkSession, sf: str) -> DataFrame:
    c = _cases(spark, sf, GENERATIONS, "modality string, path string, made string, replaced string, reason string, input string, hash string, kind string, raw string, model string, worked boolean")
    key = {"article_id": F.col("n"), "modality": F.col("modality"), "configuration_id": "c"}
    history = _table(c, "generation_history", **key, generation_run_id=F.col("made"), source_relative_path=F.col("path"), input_sha256=F.col("input"), derivation_kind=F.col("kind"), raw_response_sha256=F.col("raw"), response_model=F.col("model"), stored_vector_sha256=F.col("hash"), superseded_run_id=F.col("replaced"), superseded_reason=F.col("reason"))
    conf = _one(spark, "embedding_configurations", configuration_id="c", observed_model="m", client_api_contract_version="v1")
    runs = _one(spark, "embedding_runs", run_id="g", configuration_id="c").unionByName(_one(spark, "embedding_runs", run_id="s", configuration_id="c"))
    return ev.history_issues(ev.Catalogue.of(spark, generation_history=history, embedding_work=_table(c.filter("worked"), "embedding_work", **key), embedding_configurations=conf, embedding_runs=runs))


def embedding_run_issues(spark: SparkSession, sf: str) -> DataFrame:
    c = _cases(spark, sf, RUNS, "scope string, status string, found boolean, done boolean, articles int, listed int, ended boolean, requests int, usage string, elapsed double")
    runs = _table(c, "embedding_runs", run_id=F.col("n"), scope=F.col("scope"), status=F.col("status"), discovery_complete=F.col("found"), reconciliation_complete=F.col("done"), articles=F.col("articles"), hosted_requests=F.col("requests"), hosted_retries=0, throttles=0, usage_json=F.col("usage"), elapsed_seconds=F.col("elapsed"), finished_at=F.when(F.col("ended"), F.timestamp_seconds(F.lit(0))))
    listed = _table(c.filter("listed = 1"), "full_run_articles", run_id=F.col("n"), article_id="a")
    return ev.run_issues(ev.Catalogue.of(spark, embedding_runs=runs, full_run_articles=listed))


QUERIES = {f.__name__: f for f in (work_item_issues, generation_issues, embedding_run_issues)}


def _expected(cases: list[tuple]) -> str:
    """The codes of the cases, counted over the parts."""
    rows = ", ".join(f"({k}, '{code}')" for k, c in enumerate(cases) for code in c[-1])
    return f"SELECT code, count(*) AS n FROM part JOIN (VALUES {rows}) AS t(k, code) ON p_partkey % {len(cases)} = t.k GROUP BY code"


ORACLE = {"work_item_issues": _expected(ITEMS), "generation_issues": _expected(GENERATIONS), "embedding_run_issues": _expected(RUNS)}
