"""Reconciliation of disappeared inputs: staged, made visible at once, compacted without a visible change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.operators.work import KEY

EXPECTED = {"source_relative_path": "expected_source_relative_path", "input_sha256": "expected_input_sha256", "state": "expected_state", "generation_run_id": "expected_generation_run_id"}

EXPECTED_VECTOR = {
    "source_relative_path": "expected_vector_source_relative_path", "input_sha256": "expected_vector_input_sha256", "derivation_kind": "expected_derivation_kind", "raw_response_sha256": "expected_raw_response_sha256",
    "response_model": "expected_response_model", "stored_vector_sha256": "expected_stored_vector_sha256",
}


def stage_actions(work: DataFrame, vectors: DataFrame, seen: DataFrame, run_id: str) -> DataFrame:
    """Actions for work whose article was not seen, or whose header is another one now, with what they expect to find.

    `seen` is a full run's inventory: article_id, header_image_path. A composite follows its header. The
    header's path is looked up in a table of one row per article and configuration, not by a subquery.
    """
    s = seen.select(F.col("article_id").alias("s_article"), F.col("header_image_path").alias("s_header"))
    headers = work.filter("modality = 'header_image'").select(F.col("article_id").alias("h_article"), F.col("configuration_id").alias("h_configuration"), F.col("source_relative_path").alias("h_path"))
    v = vectors.select(*KEY, *(F.col(c).alias(e) for c, e in EXPECTED_VECTOR.items()))
    j = work.join(s, F.col("article_id") == F.col("s_article"), "left").join(headers, (F.col("article_id") == F.col("h_article")) & (F.col("configuration_id") == F.col("h_configuration")), "left").join(v, KEY, "left")
    gone, header, composite = F.col("s_article").isNull(), F.col("modality") == "header_image", F.col("modality") == "multimodal_article"
    moved = header & ~F.col("source_relative_path").eqNullSafe(F.col("s_header"))
    followed = composite & F.col("h_article").isNotNull() & ~F.col("h_path").eqNullSafe(F.col("s_header"))
    return j.filter(gone | moved | followed).select(
        F.lit(run_id).alias("run_id"),
        *KEY,
        F.when(~gone & header, F.col("s_header")).alias("target_source_relative_path"),
        F.when(~gone & header & F.col("s_header").isNull(), "not_applicable").otherwise("stale_input").alias("target_state"),
        *(F.col(c).alias(e) for c, e in EXPECTED.items()),
        *EXPECTED_VECTOR.values(),
        F.current_timestamp().alias("staged_at"),
    )


def unexpected(actions: DataFrame, work: DataFrame, vectors: DataFrame) -> DataFrame:
    """Actions whose work or vector is not what it was when they were staged; a run with any may not become visible."""
    w = work.select(*KEY, F.lit(True).alias("w_there"), *(F.col(c).alias("w_" + c) for c in EXPECTED))
    v = vectors.select(*KEY, *(F.col(c).alias("v_" + c) for c in EXPECTED_VECTOR))
    j = actions.join(w, KEY, "left").join(v, KEY, "left")
    differs = F.col("w_there").isNull()
    for c, e in EXPECTED.items():
        differs |= ~F.col("w_" + c).eqNullSafe(F.col(e))
    for c, e in EXPECTED_VECTOR.items():
        differs |= ~F.col("v_" + c).eqNullSafe(F.col(e))
    return j.filter(differs).select("run_id", *KEY)


def visible_actions(actions: DataFrame, runs: DataFrame) -> DataFrame:
    """Actions of runs whose reconciliation is complete."""
    return actions.join(runs.filter("reconciliation_complete").select("run_id"), "run_id", "left_semi")


def visible_vectors(vectors: DataFrame, actions: DataFrame, runs: DataFrame) -> DataFrame:
    """Vectors that no visible action hides."""
    return vectors.join(visible_actions(actions, runs).select(*KEY), KEY, "left_anti").select(*vectors.columns)


def visible_work(work: DataFrame, actions: DataFrame, runs: DataFrame) -> DataFrame:
    """Work that no visible action replaces, and what the visible actions put in its place."""
    seen = visible_actions(actions, runs)
    kept = work.join(seen.select(*KEY), KEY, "left_anti").select(*work.columns)
    given = {"source_relative_path": F.col("target_source_relative_path"), "state": F.col("target_state"), "attempt_count": F.lit(0), "last_run_id": F.col("run_id"), "updated_at": F.col("staged_at"), **{k: F.col(k) for k in KEY}}
    replaced = seen.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in work.schema])
    return kept.unionByName(replaced)


def compact(work: DataFrame, vectors: DataFrame, history: DataFrame, actions: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(work, vectors, history, actions) with the visible actions carried out; what is visible stays the same."""
    seen = visible_actions(actions, runs)
    lost = vectors.join(seen.select(*KEY, F.col("run_id").alias("a_run"), F.col("expected_generation_run_id").alias("a_generation")), KEY)
    archived = lost.select(
        *KEY, F.col("a_generation").alias("generation_run_id"), "source_relative_path", "input_sha256", "derivation_kind", "raw_response_sha256", "response_model", "stored_vector_sha256",
        F.col("a_run").alias("superseded_run_id"), F.lit("input_changed").alias("superseded_reason"), F.current_timestamp().alias("superseded_at"),
    )
    rest = actions.join(seen.select("run_id").distinct(), "run_id", "left_anti").select(*actions.columns)
    return visible_work(work, actions, runs), visible_vectors(vectors, actions, runs), history.unionByName(archived.select(*history.columns)), rest


def discard_invisible(actions: DataFrame, runs: DataFrame) -> DataFrame:
    """Only the visible actions; those of abandoned runs are dropped."""
    return visible_actions(actions, runs).select(*actions.columns)
