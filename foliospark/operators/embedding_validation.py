"""The validator of the embedding catalogue: each issue code is the count of a condition over a join.

`Catalogue` holds the frames of one catalogue. Every group of checks is one aggregation; the work items,
with their twenty-odd codes, are judged in a single pass over one join.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import identity as ids
from foliospark.functions import images as img
from foliospark.functions import vectors as vec
from foliospark.operators import provenance, reconcile, validation
from foliospark.operators.batching import USAGE
from foliospark.operators.validation import counts, issues, number
from foliospark.operators.work import KEY
from foliospark.sources.tables import broadcast_if_small

GENERATION = ["article_id", "configuration_id", "generation_run_id"]
#: Codes with which a header image fails before any request is made.
LOCAL_IMAGE_FAILURES = ("corrupt_image", "derived_image_oversized", "image_encode_failure", "unsafe_image", "unsupported_image")
#: States of header work that are reported as they are, and the codes.
HEADER_NOTICES = {"queued": "header_image_queued", "eligible": "header_image_eligible", "in_progress": "header_image_in_progress", "interrupted": "header_image_interrupted", "retryable": "header_image_retryable_failure", "terminal": "header_image_terminal_failure"}
#: Fixed value: the most input tokens that a response can report.
MOST_TOKENS = 1_000_000_000
RENDITION = r"\Arenditions/[0-9a-f]{64}/[0-9a-f]{64}\.jpg\z"


@dataclass(frozen=True)
class Catalogue:
    """The frames of an embedding catalogue, named after their tables."""

    embedding_configurations: DataFrame
    embedding_runs: DataFrame
    full_run_articles: DataFrame
    hosted_request_reservations: DataFrame
    embedding_work: DataFrame
    embedding_storage: DataFrame
    reconciliation_actions: DataFrame
    generation_history: DataFrame
    multimodal_embedding_provenance: DataFrame
    image_input_provenance: DataFrame
    long_text_parts: DataFrame
    long_text_part_generations: DataFrame
    article_text_aggregation_provenance: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, **given: DataFrame) -> Catalogue:
        """The given frames, and empty ones for the rest."""
        return cls(**{f.name: given.get(f.name, None) if f.name in given else spark.createDataFrame([], schemas.schema(f.name)) for f in fields(cls)})

    def work(self) -> DataFrame:
        return reconcile.visible_work(self.embedding_work, self.reconciliation_actions, self.embedding_runs)

    def vectors(self) -> DataFrame:
        return reconcile.visible_vectors(self.embedding_storage, self.reconciliation_actions, self.embedding_runs)

    def generations(self) -> DataFrame:
        """(KEY, generation_run_id, input_sha256) of every generation there ever was: active, superseded, or hidden by a visible action."""
        columns = [*KEY, "generation_run_id", "input_sha256"]
        active = self.vectors().select(*KEY, "input_sha256").join(self.work().select(*KEY, "generation_run_id"), KEY).select(*columns)
        hidden = reconcile.visible_actions(self.reconciliation_actions, self.embedding_runs).filter("expected_generation_run_id is not null")
        return active.unionByName(self.generation_history.select(*columns)).unionByName(hidden.select(*KEY, F.col("expected_generation_run_id").alias("generation_run_id"), F.col("expected_vector_input_sha256").alias("input_sha256")))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def differ(a: str, b: str) -> Column:
    return ~F.col(a).eqNullSafe(F.col(b))


def is_synthetic() -> Column:
    """Whether a configuration is the synthetic fixture's."""
    return F.coalesce((F.col("client_api_contract_version") == schemas.SYNTHETIC_CONTRACT) & F.col("tokenizer_revision").startswith("synthetic-") & F.col("tokenizer_engine").startswith("synthetic-"), F.lit(False))


def select_configuration(configurations: DataFrame, requested: str | None = None) -> tuple[str | None, str | None]:
    """(configuration_id, issue code): the one requested, or the sole one."""
    r = configurations.agg(F.count("*").alias("n"), F.min("configuration_id").alias("sole"), F.count_if(F.col("configuration_id") == F.lit(requested)).alias("known")).first()
    if requested is not None:
        return (requested, None) if r.known else (None, "unknown_configuration_id")
    return (r.sole, None) if r.n == 1 else (None, "configuration_id_required" if r.n else "missing_embedding_configuration")


def configuration_issues(c: Catalogue) -> DataFrame:
    """Identities and quota policies of configurations, and what refers to them."""
    conf = c.embedding_configurations
    positive = reduce(lambda a, b: a & b, [F.col(x) > 0 for x in ("batch_max_concurrency", "batch_max_estimated_tokens", "quota_max_requests", "quota_max_estimated_tokens", "quota_window_seconds")])
    fits = (F.col("batch_max_concurrency") <= F.col("quota_max_requests")) & (F.col("batch_max_concurrency").cast("long") * F.col("batch_max_estimated_tokens") <= F.col("quota_max_estimated_tokens"))
    known = broadcast_if_small(conf.select(F.col("configuration_id").alias("c_id"), F.col("batch_max_estimated_tokens").alias("c_tokens")))
    runs = c.embedding_runs.select("run_id", F.col("configuration_id").alias("r_configuration"))
    r = c.hosted_request_reservations.join(runs.withColumnRenamed("run_id", "r_id"), F.col("run_id") == F.col("r_id"), "left").join(known, F.col("configuration_id") == F.col("c_id"), "left")
    wrong = any_of(
        F.col("r_id").isNull(), F.col("c_id").isNull(), F.col("r_configuration") != F.col("configuration_id"), F.col("reserved_at") > F.current_timestamp(), F.col("estimated_tokens") < 0,
        F.col("estimated_tokens") > F.col("c_tokens"), F.col("observed_input_tokens") < F.col("estimated_tokens"), F.col("observed_input_tokens") > MOST_TOKENS,
    )
    some = lambda df, column: df.join(known, F.col(column) == F.col("c_id"), "left_anti")
    return issues(
        counts(conf.withColumn("_id", validation.configuration_identity(conf)), {"invalid_configuration_id": (F.col("_id") != F.col("configuration_id")) | ~ids.is_safe_label(F.col("observed_model")), "invalid_hosted_quota_policy": ~F.coalesce(positive & fits, F.lit(False))}),
        counts(r.withColumn("_bad", F.coalesce(F.col("r_id").isNull() | F.col("c_id").isNull(), F.lit(True)) | F.coalesce(wrong, F.lit(False))), {"invalid_hosted_quota_reservation": F.col("_bad")}),
        number(some(runs, "r_configuration"), "missing_run_configuration_reference"),
        number(some(c.embedding_storage, "configuration_id"), "missing_configuration_reference"),
        number(some(c.image_input_provenance, "configuration_id"), "unknown_image_provenance_configuration"),
    )


def run_issues(c: Catalogue) -> DataFrame:
    """Metrics and lifecycle of runs, and the inventories of full ones."""
    listed = c.full_run_articles.groupBy("run_id").agg(F.count("*").alias("inventory")).withColumnRenamed("run_id", "i_run")
    r = c.embedding_runs.join(listed, F.col("run_id") == F.col("i_run"), "left").withColumn("inventory", F.coalesce("inventory", F.lit(0)))
    usage = F.from_json("usage_json", "map<string,string>")
    value = lambda x: x.try_cast("double")
    sound = usage.isNotNull() & F.forall(F.map_entries(usage), lambda e: e["key"].isin(*USAGE) & F.coalesce(value(e["value"]) >= 0, F.lit(False)) & F.coalesce(value(e["value"]) < float("inf"), F.lit(False)))
    metrics = any_of(F.col("hosted_requests") < 0, F.col("hosted_retries") < 0, F.col("throttles") < 0, F.isnan("elapsed_seconds"), F.abs("elapsed_seconds") == float("inf"), F.col("elapsed_seconds") < 0, ~F.coalesce(sound, F.lit(False)))
    status, scope, full = F.col("status"), F.col("scope"), F.col("scope") == "full"
    done, found, ended = F.col("reconciliation_complete"), F.col("discovery_complete"), F.col("finished_at").isNotNull()
    contradicts = any_of(
        ~scope.isin("limited", "full"), ~status.isin("running", "succeeded", "failed", "interrupted"), (status == "running") & (ended | done), (status != "running") & ~ended, (status != "succeeded") & done,
        (scope == "limited") & (found | done | (F.col("inventory") > 0)), full & (F.col("inventory") != F.col("articles")), full & (status == "succeeded") & ~(found & done),
    )
    strays = c.full_run_articles.join(c.embedding_runs.filter("scope = 'full'").select(F.col("run_id").alias("f_run")), F.col("run_id") == F.col("f_run"), "left_anti")
    return issues(counts(r, {"invalid_run_metrics": metrics, "invalid_run_lifecycle": contradicts}), number(strays, "invalid_run_lifecycle"))


def claim_issues(c: Catalogue) -> DataFrame:
    """Runs that claim more or fewer published vectors than there are generations of theirs."""
    there = c.generations().groupBy("generation_run_id", "configuration_id").agg(F.count("*").alias("n")).select(F.col("generation_run_id").alias("g_run"), F.col("configuration_id").alias("g_configuration"), "n")
    r = c.embedding_runs.join(broadcast_if_small(c.embedding_configurations.select("configuration_id")), "configuration_id", "left_semi")
    j = r.join(there, (F.col("run_id") == F.col("g_run")) & (F.col("configuration_id") == F.col("g_configuration")), "left")
    return issues(counts(j, {"missing_published_embedding": F.coalesce("n", F.lit(0)) != F.col("embeddings")}))


def _runs_of(c: Catalogue, name: str) -> DataFrame:
    return c.embedding_runs.select(F.col("run_id").alias(f"{name}_id"), F.col("configuration_id").alias(f"{name}_configuration"))


def work_issues(c: Catalogue, articles: DataFrame) -> DataFrame:
    """Everything about visible work items. articles: article_id, header_image_path."""
    a = articles.select(F.col("article_id").alias("a_id"), F.col("header_image_path").alias("a_header"))
    v = c.vectors().select(*KEY, F.col("source_relative_path").alias("v_path"), F.col("input_sha256").alias("v_input"), F.lit(True).alias("v_there"))
    g = broadcast_if_small(_runs_of(c, "g"))
    j = c.work().join(v, KEY, "left").join(a, F.col("article_id") == F.col("a_id"), "left").join(g, (F.col("generation_run_id") == F.col("g_id")) & (F.col("configuration_id") == F.col("g_configuration")), "left")
    state, modality, path, given = F.col("state"), F.col("modality"), F.col("source_relative_path"), F.col("input_sha256")
    known, header, success = state.isin(*schemas.STATES), modality == "header_image", state == "succeeded"
    there, article, generation = F.col("v_there").isNotNull(), F.col("a_id").isNotNull(), F.col("generation_run_id").isNotNull()
    matching = there & path.eqNullSafe(F.col("v_path")) & given.eqNullSafe(F.col("v_input"))
    noted = F.col("error_code").isNotNull() | F.col("status_code").isNotNull() | F.col("retry_after_seconds").isNotNull()
    tried, safe = F.col("attempt_count") != 0, F.coalesce(ids.is_safe_path(path), F.lit(False))
    waits = header & (state == "retryable") & F.col("error_code").eqNullSafe("missing_header_image") & given.isNull()
    astray = ~path.eqNullSafe(F.col("a_header"))
    rest = known & ~state.isin("not_applicable", "stale_configuration", "stale_input") & ~waits
    local = header & (state == "terminal") & F.coalesce(F.col("error_code").isin(*LOCAL_IMAGE_FAILURES), F.lit(False)) & ~tried
    failed = state.isin("retryable", "terminal")
    checks = {
        "invalid_work_modality": ~modality.isin(*schemas.MODALITIES),
        "missing_canonical_work_article": known & ~article & ~state.isin("stale_input", "stale_configuration"),
        "invalid_work_state": ~known,
        "missing_published_embedding": success & ~matching,
        "embedding_without_success_checkpoint": known & ((~success & matching) | ((state == "not_applicable") & there)),
        "invalid_not_applicable_checkpoint": (state == "not_applicable") & any_of(~header, path.isNotNull(), given.isNotNull(), tried, noted, generation, article & F.col("a_header").isNotNull()),
        "invalid_stale_configuration_checkpoint": (state == "stale_configuration") & any_of(tried, noted, generation, there),
        "invalid_stale_input_checkpoint": (state == "stale_input") & any_of(given.isNotNull(), tried, noted, generation, header & path.isNotNull() & ~safe, header & ~article & path.isNotNull(), header & article & astray, ~header & path.isNotNull()),
        "invalid_missing_header_checkpoint": waits & any_of(~safe, ~article, astray, tried, F.col("status_code").isNotNull(), F.col("retry_after_seconds").isNotNull(), generation, there),
        "missing_header_image": waits,
        "invalid_work_input_hash": rest & ~ids.is_sha256(given),
        "invalid_source_relative_path": rest & ((header & ~safe) | (~header & path.isNotNull())),
        "invalid_generation_checkpoint": rest & ((success & F.col("g_id").isNull()) | (~success & generation)),
        "invalid_failure_checkpoint": known & ((failed & ~waits & ~local & (F.col("error_code").isNull() | (F.col("attempt_count") < 1))) | (~failed & noted)),
        **{code: header & ~waits & (state == s) for s, code in HEADER_NOTICES.items()},
    }
    unproven = c.vectors().select(*KEY, F.col("source_relative_path").alias("v_path"), F.col("input_sha256").alias("v_input")).join(c.work(), KEY, "left").join(g, (F.col("generation_run_id") == F.col("g_id")) & (F.col("configuration_id") == F.col("g_configuration")), "left")
    lacking = any_of(state.isNull(), ~success, differ("source_relative_path", "v_path"), differ("input_sha256", "v_input"), F.col("g_id").isNull())
    return issues(counts(j, checks), counts(unproven, {"invalid_public_embedding_checkpoint": F.coalesce(lacking, F.lit(True))}))


def header_issues(c: Catalogue, articles: DataFrame) -> DataFrame:
    """Articles with text work but no word on their header, and the latest run's claims about headers."""
    w = c.work()
    text, header = w.filter("modality = 'article_text'").select("article_id", "configuration_id"), w.filter("modality = 'header_image'")
    mute = text.join(header.select("article_id", "configuration_id"), ["article_id", "configuration_id"], "left_anti").join(articles.select("article_id"), "article_id", "left_semi")
    latest = c.embedding_runs.groupBy("configuration_id").agg(F.max(F.struct("started_at", "run_id", "header_absent", "header_failed")).alias("r")).select("configuration_id", F.col("r.run_id").alias("last_run_id"), "r.header_absent", "r.header_failed")
    state = F.col("state")
    seen = header.groupBy("configuration_id", "last_run_id").agg(F.count_if(state == "not_applicable").alias("absent"), F.count_if(state.isin("retryable", "terminal")).alias("failed"), F.count_if(~state.isin(*schemas.STATES)).alias("odd"))
    j = latest.join(seen, ["configuration_id", "last_run_id"], "left")
    zero = lambda x: F.coalesce(x, F.lit(0))
    return issues(number(mute, "missing_header_disposition"), counts(j, {"invalid_header_disposition_counts": (zero("odd") == 0) & ((F.col("header_absent") != zero("absent")) | (F.col("header_failed") != zero("failed")))}))


def vector_issues(c: Catalogue, articles: DataFrame) -> DataFrame:
    """Visible vectors: shape, unit length, provenance, model, article. articles also carry published_at_utc and publication_date_new_york."""
    conf = broadcast_if_small(c.embedding_configurations.select(F.col("configuration_id").alias("c_id"), F.col("dimensions").alias("c_dim"), F.col("observed_model").alias("c_model"), is_synthetic().alias("c_synthetic")))
    a = articles.select(F.col("article_id").alias("a_id"), F.col("published_at_utc").alias("a_at"), F.col("publication_date_new_york").alias("a_day"))
    told = c.article_text_aggregation_provenance.select(*GENERATION).distinct().withColumn("p_there", F.lit(True))
    w = c.work().select(*KEY, "generation_run_id")
    j = c.vectors().join(w, KEY, "left").join(told, GENERATION, "left").join(conf, F.col("configuration_id") == F.col("c_id"), "left").join(a, F.col("article_id") == F.col("a_id"), "left")
    return issues(counts(j.withColumn("_status", vec.status(F.col("vector"), F.col("c_dim"))), vector_checks()))


def vector_checks() -> dict[str, Column]:
    """Conditions on vectors joined to their configuration (c_), article (a_), part provenance (p_there) and their status."""
    return {
        "invalid_modality": ~F.col("modality").isin(*schemas.MODALITIES),
        "invalid_dimensions": ~F.col("dimensions").eqNullSafe(F.col("c_dim")),
        "invalid_vector": F.col("_status") == vec.CODES[0],
        "invalid_vector_dimensions": F.col("_status") == vec.CODES[1],
        "nonfinite_vector": F.col("_status") == vec.CODES[2],
        "zero_vector": F.col("_status") == vec.CODES[3],
        "nonunit_vector": F.col("_status").isNull() & ~vec.is_unit(F.col("vector")),
        "vector_hash_mismatch": ~F.col("_status").eqNullSafe(vec.CODES[0]) & ~vec.vector_hash("vector").eqNullSafe(F.col("stored_vector_sha256")),
        "invalid_vector_provenance": ~validation.provenance_holds(F.col("p_there").isNotNull(), F.coalesce("c_synthetic", F.lit(False))),
        "hosted_response_model_mismatch": (F.col("derivation_kind") == "hosted_response") & differ("response_model", "c_model"),
        "missing_canonical_article": F.col("a_id").isNull(),
        "publication_metadata_mismatch": F.col("a_id").isNotNull() & (differ("published_at_utc", "a_at") | differ("publication_date_new_york", "a_day")),
    }


def history_issues(c: Catalogue) -> DataFrame:
    """Superseded generations: domains, identities, runs, hashes, provenance."""
    conf = broadcast_if_small(c.embedding_configurations.select(F.col("configuration_id").alias("c_id"), F.col("observed_model").alias("c_model"), is_synthetic().alias("c_synthetic")))
    told = c.article_text_aggregation_provenance.select(*GENERATION).distinct().withColumn("p_there", F.lit(True))
    w = c.embedding_work.select(*KEY, F.lit(True).alias("w_there"))
    s = broadcast_if_small(c.embedding_runs.select(F.col("run_id").alias("s_id")))
    j = c.generation_history.join(conf, F.col("configuration_id") == F.col("c_id"), "left").join(broadcast_if_small(_runs_of(c, "g")), (F.col("generation_run_id") == F.col("g_id")) & (F.col("configuration_id") == F.col("g_configuration")), "left")
    j = j.join(s, F.col("superseded_run_id") == F.col("s_id"), "left").join(w, KEY, "left").join(told, GENERATION, "left")
    header, path = F.col("modality") == "header_image", F.col("source_relative_path")
    return issues(
        counts(
            j,
            {
                "invalid_generation_modality": ~F.col("modality").isin(*schemas.MODALITIES),
                "invalid_generation_identity_reference": any_of(F.col("c_id").isNull(), F.col("g_id").isNull(), F.col("w_there").isNull()),
                "invalid_generation_source_path": F.when(header, ~F.coalesce(ids.is_safe_path(path), F.lit(False))).otherwise(path.isNotNull()),
                "invalid_generation_run_reference": F.col("g_id").isNull() | F.col("s_id").isNull(),
                "invalid_supersession_reason": ~F.col("superseded_reason").isin(*schemas.SUPERSESSIONS),
                "invalid_generation_hash": ~ids.is_sha256(F.col("input_sha256")) | ~ids.is_sha256(F.col("stored_vector_sha256")),
                "invalid_generation_provenance": ~validation.provenance_holds(F.col("p_there").isNotNull(), F.coalesce("c_synthetic", F.lit(False))),
                "hosted_response_model_mismatch": (F.col("derivation_kind") == "hosted_response") & differ("response_model", "c_model"),
            },
        )
    )


def reconciliation_issues(c: Catalogue) -> DataFrame:
    """Actions that no longer name what is there, and vectors that visible actions hide."""
    r = broadcast_if_small(c.embedding_runs.select(F.col("run_id").alias("r_id"), F.col("scope").alias("r_scope"), F.col("status").alias("r_status"), F.col("reconciliation_complete").alias("r_done")))
    w = c.embedding_work.select(*KEY, F.lit(True).alias("w_there"), *(F.col(x).alias("w_" + x) for x in reconcile.EXPECTED))
    v = c.embedding_storage.select(*KEY, F.lit(True).alias("v_there"), "dimensions", "vector", *(F.col(x).alias("v_" + x) for x in reconcile.EXPECTED_VECTOR))
    j = c.reconciliation_actions.join(r, F.col("run_id") == F.col("r_id"), "left").join(w, KEY, "left").join(v, KEY, "left")
    ok = F.col("r_status") == "succeeded"
    wrong = any_of(
        F.col("r_id").isNull(), F.col("r_scope") != "full", F.col("r_done") & ~ok, ok & ~F.col("r_done"), ~F.col("target_state").isin("stale_input", "not_applicable"), F.col("w_there").isNull(),
        *(differ("w_" + x, e) for x, e in reconcile.EXPECTED.items()), *(differ("v_" + x, e) for x, e in reconcile.EXPECTED_VECTOR.items()),
    )
    conf = broadcast_if_small(c.embedding_configurations.select(F.col("configuration_id").alias("c_id"), F.col("dimensions").alias("c_dim"), F.col("observed_model").alias("c_model"), F.col("multimodal_formula").alias("c_formula"), is_synthetic().alias("c_synthetic")))
    told = c.article_text_aggregation_provenance.select("article_id", "configuration_id", F.col("generation_run_id").alias("expected_generation_run_id")).distinct().withColumn("p_there", F.lit(True))
    hidden = j.filter("r_done and v_there").join(conf, F.col("configuration_id") == F.col("c_id")).join(told, ["article_id", "configuration_id", "expected_generation_run_id"], "left")
    named = hidden.withColumns({x: F.col("v_" + x) for x in ("derivation_kind", "raw_response_sha256", "response_model", "stored_vector_sha256")}).withColumn("_status", vec.status(F.col("vector"), F.col("c_dim")))
    checks = vector_checks()
    bad = any_of(*(F.coalesce(checks[x], F.lit(False)) for x in ("invalid_dimensions", "nonunit_vector", "vector_hash_mismatch", "invalid_vector_provenance", "hosted_response_model_mismatch")), F.col("_status").isNotNull())
    composites = named.filter("modality = 'multimodal_article'").select("article_id", "configuration_id", F.col("expected_generation_run_id").alias("generation_run_id"), F.col("v_input_sha256").alias("input_sha256"), "vector", F.col("stored_vector_sha256").alias("hash"), F.col("c_formula").alias("formula"))
    derived = composite_checks(composites, c, c.embedding_storage.join(c.embedding_work.select(*KEY, "generation_run_id"), KEY))
    return issues(counts(j.withColumn("_bad", F.coalesce(wrong, F.lit(False))), {"invalid_reconciliation_action": F.col("_bad")}), counts(named, {"invalid_reconciliation_vector": bad}), derived.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("invalid_reconciliation_vector").alias("code"), "n"))


def composite_checks(composites: DataFrame, c: Catalogue, sources: DataFrame) -> DataFrame:
    """Issues of composites (GENERATION, input_sha256, vector, hash, formula) against their provenance; sources: generations with vectors."""
    generations = sources.select("article_id", "configuration_id", "modality", "generation_run_id", F.col("stored_vector_sha256").alias("hash"), "vector")
    told = c.multimodal_embedding_provenance.select(*GENERATION, "text_generation_run_id", F.col("header_image_generation_run_id").alias("header_generation_run_id"), F.col("text_stored_vector_sha256").alias("text_hash"), F.col("header_image_stored_vector_sha256").alias("header_hash"), "formula_version")
    return provenance.composite_issues(composites, told, generations, orphans=False)


def multimodal_issues(c: Catalogue) -> DataFrame:
    """Visible composites, recomputed from their sources."""
    conf = broadcast_if_small(c.embedding_configurations.select("configuration_id", F.col("multimodal_formula").alias("formula")))
    active = c.vectors().join(c.work().select(*KEY, "generation_run_id"), KEY)
    composites = active.filter("modality = 'multimodal_article'").join(conf, "configuration_id").select(*GENERATION, "input_sha256", "vector", F.col("stored_vector_sha256").alias("hash"), "formula")
    expected = c.generations().filter("modality = 'multimodal_article'").select(*GENERATION)
    orphan = c.multimodal_embedding_provenance.select(*GENERATION).join(expected, GENERATION, "left_anti")
    return issues(composite_checks(composites, c, active), number(orphan, "invalid_multimodal_provenance"))


def long_text_issues(c: Catalogue, lengths: DataFrame | None = None) -> DataFrame:
    """Parts, part generations and aggregates. lengths: article_id, char_count of the texts as they are, where known."""
    conf = broadcast_if_small(c.embedding_configurations.select(F.col("configuration_id").alias("c_id"), F.col("context_token_limit").alias("c_limit"), F.col("long_text_part_attempt_limit").alias("c_attempts"), F.col("dimensions").alias("c_dim"), F.col("observed_model").alias("c_model"), is_synthetic().alias("c_synthetic")))
    state, noted = F.col("state"), F.col("error_code").isNotNull() | F.col("status_code").isNotNull() | F.col("retry_after_seconds").isNotNull()
    spans = any_of(F.col("part_index") < 0, F.col("part_index") >= F.col("part_count"), F.col("part_count") < 2, F.col("char_start") < 0, F.col("char_end") <= F.col("char_start"), F.col("byte_start") < 0, F.col("byte_end") - F.col("byte_start") < F.col("char_end") - F.col("char_start"), F.col("token_count") < 1, F.col("token_count") > F.col("c_limit"))
    hashes = ~ids.is_sha256(F.col("part_input_sha256")) | ~ids.is_sha256(F.col("article_input_sha256"))
    bare = F.col("raw_response_sha256").isNull() & F.col("response_model").isNull()
    made = ((F.col("derivation_kind") == "hosted_response") & ids.is_sha256(F.col("raw_response_sha256")) & F.col("response_model").eqNullSafe(F.col("c_model"))) | ((F.col("derivation_kind") == "synthetic_fixture") & F.col("c_synthetic") & bare)
    sound = F.coalesce(made, F.lit(False)) & vec.status(F.col("vector"), F.col("c_dim")).isNull() & F.coalesce(vec.is_unit(F.col("vector")), F.lit(False)) & F.coalesce(vec.vector_hash("vector") == F.col("stored_vector_sha256"), F.lit(False))
    r = broadcast_if_small(_runs_of(c, "g"))
    own = lambda df, column: df.join(conf, F.col("configuration_id") == F.col("c_id"), "left").join(r, (F.col(column) == F.col("g_id")) & (F.col("configuration_id") == F.col("g_configuration")), "left")
    left = F.col("generation_run_id").isNotNull() | F.col("vector").isNotNull() | F.col("stored_vector_sha256").isNotNull() | F.col("derivation_kind").isNotNull()
    failed = state.isin("retryable", "terminal")
    part = any_of(
        spans, hashes, F.col("attempt_count") < 0, F.col("attempt_count") > F.col("c_attempts"), ~state.isin(*schemas.STATES), state == "not_applicable", F.col("g_id").isNull(),
        F.when(state == "succeeded", noted | (F.col("attempt_count") < 1) | F.col("generation_run_id").isNull() | ~sound).otherwise(left | (failed & F.col("error_code").isNull()) | (~failed & noted)),
    )
    key = ["article_id", "configuration_id", "article_input_sha256", "part_index"]
    aggregates = c.vectors().filter("derivation_kind = 'long_text_aggregate'").join(c.work().select(*KEY, "generation_run_id"), KEY).select(*GENERATION, "vector")
    told = c.article_text_aggregation_provenance.select(*GENERATION, "part_index", "part_generation_run_id", "article_input_sha256")
    parts = c.long_text_part_generations.select(*key, "generation_run_id", "char_start", "char_end", "token_count", "vector")
    ends = told.join(parts.withColumnRenamed("generation_run_id", "part_generation_run_id"), [*key, "part_generation_run_id"]).groupBy(*GENERATION).agg(F.max("char_end").alias("reach"))
    known = aggregates.join(ends, GENERATION, "left")
    known = known.join(lengths, "article_id", "left").withColumn("char_count", F.coalesce("char_count", "reach")) if lengths is not None else known.withColumnRenamed("reach", "char_count")
    return issues(
        counts(own(c.long_text_parts, "last_run_id").withColumn("_bad", F.coalesce(part, F.lit(False))), {"invalid_long_text_part": F.col("_bad")}),
        counts(own(c.long_text_part_generations, "generation_run_id").withColumn("_bad", F.coalesce(any_of(spans, hashes, F.col("g_id").isNull(), ~sound), F.lit(True))), {"invalid_long_text_part_generation": F.col("_bad")}),
        provenance.aggregate_issues(known, told.drop("article_input_sha256"), parts),
    )


def image_issues(c: Catalogue, codec_rules: tuple[str, str] | None = None, renditions: DataFrame | None = None) -> DataFrame:
    """Image provenance against generations, and renditions against a listing (path, sha256, kind: file, temp or other).

    `codec_rules` are the input rules and transform of the codec at hand; without one that matches, images
    cannot be checked again, which is an issue where there is any.
    """
    conf = broadcast_if_small(c.embedding_configurations.select(F.col("configuration_id").alias("c_id"), F.col("image_input_rules").alias("c_rules"), F.col("image_transform").alias("c_transform")))
    expected = c.generations().filter("modality = 'header_image'").select(*GENERATION, F.col("input_sha256").alias("source_sha256"))
    p = c.image_input_provenance
    key = [*GENERATION, "source_sha256"]
    facts = lambda side: any_of(~ids.is_sha256(F.col("source_sha256" if side == "source" else "embedded_input_sha256")), F.col(f"{side}_bytes") < 1, F.col(f"{side}_width") < 1, F.col(f"{side}_height") < 1, F.col(f"{side}_frames") != 1, ~F.col(f"{side}_format").isin("jpeg", "png", "webp"))
    whole = (F.col("source_bytes") <= img.MAX_BYTES) & (F.col("source_width").cast("long") * F.col("source_height") <= img.MAX_PIXELS)
    path = F.col("rendition_relative_path")
    same = reduce(lambda a, b: a & b, [F.col(f"embedded_{x}").eqNullSafe(F.col(f"source_{x}")) for x in ("format", "bytes", "width", "height", "frames")]) & F.col("embedded_input_sha256").eqNullSafe(F.col("source_sha256"))
    large = (F.col("embedded_bytes") > img.MAX_BYTES) | (F.col("embedded_width").cast("long") * F.col("embedded_height") > img.MAX_PIXELS) | (F.col("source_width").cast("long") * F.col("source_height") > img.MAX_DECODED)
    placed = path.eqNullSafe(F.concat(F.lit("renditions/"), F.sha2("transform_id", 256), F.lit("/"), F.col("embedded_input_sha256"), F.lit(".jpg")))
    j = p.join(expected.withColumn("e_there", F.lit(True)).distinct(), key, "left").join(conf, F.col("configuration_id") == F.col("c_id"), "left")
    found = [
        number(expected.join(p.select(*key), key, "left_anti"), "missing_image_input_provenance"),
        counts(
            j,
            {
                "invalid_image_input_provenance": any_of(F.col("e_there").isNull(), facts("source"), facts("embedded"), large, differ("transform_id", "c_transform"), whole & path.isNull() & ~same, ~whole & path.isNull()),
                "invalid_rendition_path": path.isNotNull() & ~(F.coalesce(path.rlike(RENDITION), F.lit(False)) & placed),
                "image_codec_unavailable": F.lit(codec_rules is None) | ~(F.col("c_rules").eqNullSafe(F.lit(codec_rules and codec_rules[0])) & F.col("c_transform").eqNullSafe(F.lit(codec_rules and codec_rules[1]))),
            },
        ),
    ]
    if renditions is not None:
        listed = renditions.select(F.col("path").alias("l_path"), F.col("sha256").alias("l_hash"), F.col("kind").alias("l_kind"))
        wanted = p.filter(path.isNotNull()).select("rendition_relative_path", "embedded_input_sha256").distinct().join(listed, F.col("rendition_relative_path") == F.col("l_path"), "left")
        stray = listed.join(p.select(F.col("rendition_relative_path").alias("r_path")).distinct(), F.col("l_path") == F.col("r_path"), "left_anti")
        found += [
            counts(wanted, {"missing_image_rendition": F.col("l_path").isNull(), "unsafe_image_rendition": F.col("l_kind") == "other", "rendition_hash_mismatch": (F.col("l_kind") == "file") & differ("l_hash", "embedded_input_sha256")}),
            counts(stray, {"orphan_image_rendition": (F.col("l_kind") == "file") & F.col("l_path").rlike(RENDITION), "orphan_image_rendition_temp": F.col("l_kind") == "temp", "unsafe_image_rendition_entry": (F.col("l_kind") == "other") | ((F.col("l_kind") == "file") & ~F.col("l_path").rlike(RENDITION))}),
        ]
    return issues(*found)


def text_issues(c: Catalogue, articles: DataFrame, listing: DataFrame) -> DataFrame:
    """Text work against the published files. articles: article_id, cleaned_markdown_path, header_image_path; listing: path, sha256."""
    w = c.work()
    a = articles.select(F.col("article_id").alias("a_id"), F.col("cleaned_markdown_path").alias("a_path"), F.col("header_image_path").alias("a_header"))
    own = listing.select(F.col("path").alias("l_path"), F.col("sha256").alias("l_hash"))
    text = w.filter("modality = 'article_text' and input_sha256 is not null").join(a, F.col("article_id") == F.col("a_id")).join(own, F.col("a_path") == F.col("l_path"), "left")
    header = w.filter("modality = 'header_image' and state not in ('stale_input', 'stale_configuration')").join(a, F.col("article_id") == F.col("a_id"))
    safe = lambda x: F.coalesce(ids.is_safe_path(F.col(x)), F.lit(False))
    return issues(
        counts(text, {"unsafe_markdown_path": ~safe("a_path"), "missing_canonical_markdown": safe("a_path") & F.col("l_path").isNull(), "input_hash_mismatch": F.col("l_path").isNotNull() & differ("l_hash", "input_sha256")}),
        counts(header, {"header_image_path_mismatch": differ("source_relative_path", "a_header"), "unsafe_header_image_path": F.col("a_header").isNotNull() & ~safe("a_header")}),
    )


def embedding_issues(c: Catalogue, articles: DataFrame, lengths: DataFrame | None = None, codec_rules: tuple[str, str] | None = None, renditions: DataFrame | None = None, listing: DataFrame | None = None) -> DataFrame:
    """All issues of an embedding catalogue."""
    found = [configuration_issues(c), run_issues(c), claim_issues(c), work_issues(c, articles), header_issues(c, articles), vector_issues(c, articles), history_issues(c), reconciliation_issues(c), multimodal_issues(c), long_text_issues(c, lengths), image_issues(c, codec_rules, renditions)]
    if listing is not None:
        found.append(text_issues(c, articles, listing))
    return issues(*found)
