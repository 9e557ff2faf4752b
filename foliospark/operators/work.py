"""The lifecycle of embedding work as projections over joins: one row in, one next state out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["article_id", "modality", "configuration_id"]
SOURCES = ("article_text", "header_image")

#: (state, event) -> next state. Every pair that is not listed is illegal.
TRANSITIONS: dict[tuple[str, str], str] = {
    ("eligible", "admit"): "queued",
    ("interrupted", "admit"): "queued",
    ("retryable", "admit"): "queued",
    ("queued", "start"): "in_progress",
    ("in_progress", "fail_retryable"): "retryable",
    ("in_progress", "fail_terminal"): "terminal",
    ("in_progress", "publish"): "succeeded",
    ("queued", "interrupt"): "interrupted",
    ("in_progress", "interrupt"): "interrupted",
}


def _map(pairs: dict[tuple[str, str], str]) -> Column:
    return F.create_map(*[F.lit(x) for (s, e), n in pairs.items() for x in (f"{s}:{e}", n)])


def register(desired: DataFrame, work: DataFrame, vectors: DataFrame, reprocess: bool = False) -> DataFrame:
    """Next state and action of each desired item.

    desired: KEY, source_relative_path, input_sha256, applicability (present, not_applicable, missing).
    Actions: insert, supersede (archive the generation), reuse, recover, keep, disapply, await_input.
    `reason` says why a generation is superseded; `invalidates_composite` marks text and header items
    whose composite has to start anew.
    """
    w = work.select(*KEY, F.col("state").alias("w_state"), F.col("input_sha256").alias("w_input"))
    v = vectors.select(*KEY, F.col("input_sha256").alias("v_input"))
    j = desired.join(w, KEY, "left").join(v, KEY, "left")
    known = F.col("w_state").isNotNull()
    present = F.col("applicability") == "present"
    changed = ~F.col("w_input").eqNullSafe(F.col("input_sha256"))
    proven = (F.col("w_state") == "succeeded") & F.coalesce(F.col("v_input") == F.col("input_sha256"), F.lit(False))
    unproven = (F.col("w_state") == "succeeded") & ~proven
    action = (
        F.when(F.col("applicability") == "not_applicable", "disapply")
        .when(F.col("applicability") == "missing", "await_input")
        .when(~known, "insert")
        .when(F.lit(reprocess) | changed, "supersede")
        .when(proven, "reuse")
        .when((F.col("w_state") == "in_progress") | unproven, "recover")
        .otherwise("keep")
    )
    a = F.col("action")
    state = F.when(a == "disapply", "not_applicable").when(a == "await_input", "retryable").when(a.isin("insert", "supersede"), "eligible").when(a == "reuse", "succeeded").when(a == "recover", "interrupted").otherwise(F.col("w_state"))
    hurts = (a == "supersede") | ((a == "recover") & (F.col("w_state") == "succeeded")) | (a.isin("disapply", "await_input") & F.col("v_input").isNotNull())
    out = j.withColumn("_present", present).withColumn("action", action)
    return out.select(
        *KEY,
        "source_relative_path",
        F.when(a != "await_input", F.when(F.col("_present"), F.col("input_sha256"))).alias("input_sha256"),
        F.col("w_state").alias("prior_state"),
        state.alias("state"),
        "action",
        F.when(a == "supersede", F.when(F.lit(reprocess), "explicit_reprocess").otherwise("input_changed")).alias("reason"),
        (hurts & F.col("modality").isin(*SOURCES)).alias("invalidates_composite"),
    )


def composites_to_restart(registered: DataFrame) -> DataFrame:
    """(article_id, configuration_id) whose composite loses its generation because a source did."""
    return registered.filter("invalidates_composite").select("article_id", "configuration_id").distinct()


def apply_events(work: DataFrame, events: DataFrame) -> DataFrame:
    """Work after one event per item (KEY, event, error_code, status_code, retry_after_seconds); `illegal` marks refused ones.

    Starting counts an attempt; failures keep their metadata, success clears it.
    """
    e = events.select(*KEY, "event", F.col("error_code").alias("e_code"), F.col("status_code").alias("e_status"), F.col("retry_after_seconds").alias("e_retry"))
    j = work.join(e, KEY, "left")
    fails, ok = F.col("event").startswith("fail"), F.col("next").isNotNull()
    pick = lambda old, new: F.when(ok & fails, F.col(new)).when(ok & (F.col("event") == "publish"), None).otherwise(F.col(old)).alias(old)
    j = j.withColumn("next", F.when(F.col("event").isNotNull(), F.try_element_at(_map(TRANSITIONS), F.concat_ws(":", "state", "event"))))
    rest = [c for c in work.columns if c not in (*KEY, "state", "attempt_count", "error_code", "status_code", "retry_after_seconds")]
    return j.select(
        *KEY,
        F.coalesce("next", "state").alias("state"),
        (F.col("attempt_count") + F.when(F.col("next") == "in_progress", 1).otherwise(0)).cast("int").alias("attempt_count"),
        pick("error_code", "e_code"),
        pick("status_code", "e_status"),
        pick("retry_after_seconds", "e_retry"),
        *rest,
        (F.col("event").isNotNull() & F.col("next").isNull()).alias("illegal"),
    )


def exhausted_parts(parts: DataFrame, attempt_limit: int) -> DataFrame:
    """Parts that may not be tried again: retryable with all attempts spent become terminal, and so does their text."""
    spent = (F.col("state") == "retryable") & (F.col("attempt_count") >= attempt_limit)
    return parts.withColumn("state", F.when(spent, "terminal").otherwise(F.col("state")))


def sources_ready(work: DataFrame, vectors: DataFrame) -> DataFrame:
    """(article_id, configuration_id) with hashes of both sources where text and header are current successes.

    One pass, pivoted by modality within the group; each group has at most one row per modality.
    """
    v = vectors.select(*KEY, F.col("stored_vector_sha256").alias("hash"), F.col("input_sha256").alias("v_input"))
    ok = work.filter("state = 'succeeded'").join(v, KEY).filter(F.col("input_sha256").eqNullSafe(F.col("v_input")))
    at = lambda m: F.max(F.when(F.col("modality") == m, F.col("hash")))
    g = ok.groupBy("article_id", "configuration_id").agg(at(SOURCES[0]).alias("text_hash"), at(SOURCES[1]).alias("header_hash"))
    return g.filter("text_hash is not null and header_hash is not null")
