"""Provenance of derived vectors: composites and long-text aggregates are recomputed and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import vectors as vec
from foliospark.operators.validation import counts, issues, number


def differs(stored: Column, again: Column) -> Column:
    """Whether two vectors differ in any component: a derived vector is recomputed to the last bit."""
    return ~stored.eqNullSafe(again)


def composite_issues(composites: DataFrame, provenance: DataFrame, generations: DataFrame, orphans: bool = True) -> DataFrame:
    """Issues of composites against what they say they were derived from.

    composites: article_id, configuration_id, generation_run_id, input_sha256, vector, hash, formula; provenance:
    the same key with text_/header_generation_run_id, text_/header_hash and formula_version; generations: every
    generation of text and header vectors (article_id, configuration_id, modality, generation_run_id, hash, vector).
    Provenance of no composite is an issue where `orphans` asks for it.
    """
    key = ["article_id", "configuration_id", "generation_run_id"]
    side = lambda m, p: generations.filter(F.col("modality") == m).select("article_id", "configuration_id", F.col("generation_run_id").alias(f"{p}_generation_run_id"), F.col("hash").alias(f"{p}_found"), F.col("vector").alias(f"{p}_vector"))
    j = composites.join(provenance.withColumn("told", F.lit(True)), key, "left")
    for m, p in (("article_text", "text"), ("header_image", "header")):
        j = j.join(side(m, p), ["article_id", "configuration_id", f"{p}_generation_run_id"], "left")
    derived = vec.composite_identity(formula_version=F.col("formula"), text_generation_run_id=F.col("text_generation_run_id"), text_stored_vector_sha256=F.col("text_hash"), header_image_generation_run_id=F.col("header_generation_run_id"), header_image_stored_vector_sha256=F.col("header_hash"))
    told, linked = F.col("told").isNotNull(), F.col("text_found").eqNullSafe(F.col("text_hash")) & F.col("header_found").eqNullSafe(F.col("header_hash")) & F.col("formula_version").eqNullSafe(F.col("formula"))
    again = vec.midpoint(F.col("text_vector"), F.col("header_vector"))
    j = j.withColumn("again", again)
    orphan = provenance.join(composites.select(*key), key, "left_anti")
    return issues(
        counts(
            j,
            {
                "missing_multimodal_provenance": ~told,
                "multimodal_input_identity_mismatch": told & ~derived.eqNullSafe(F.col("input_sha256")),
                "invalid_multimodal_source_linkage": told & ~linked,
                "multimodal_recomputation_failed": told & linked & F.col("again").isNull(),
                "multimodal_vector_mismatch": told & linked & F.col("again").isNotNull() & (differs(F.col("vector"), F.col("again")) | ~vec.vector_hash("again").eqNullSafe(F.col("hash"))),
            },
        ),
        *([number(orphan, "invalid_multimodal_provenance")] if orphans else []),
    )


def aggregate_issues(aggregates: DataFrame, provenance: DataFrame, parts: DataFrame) -> DataFrame:
    """Issues of long-text vectors against the parts they were made of.

    aggregates: article_id, configuration_id, generation_run_id, char_count, vector; provenance: the same
    key with part_index and part_generation_run_id; parts: part generations with char_start, char_end,
    token_count and vector. The mean is taken in order of parts, as publication takes it.
    """
    key = ["article_id", "configuration_id", "generation_run_id"]
    p = parts.select("article_id", "configuration_id", "part_index", F.col("generation_run_id").alias("part_generation_run_id"), "char_start", "char_end", "token_count", F.col("vector").alias("part_vector"))
    linked = provenance.join(p, ["article_id", "configuration_id", "part_index", "part_generation_run_id"], "left")
    whole = linked.filter("part_vector is not null")
    mean = vec.ordered_mean(whole, key, "part_vector", "token_count", "part_index").select(*key, vec.normalized(F.col("mean")).alias("again"))
    spans = linked.groupBy(*key).agg(
        F.count("*").alias("parts"), F.count("part_vector").alias("found"), F.sort_array(F.collect_list(F.struct("part_index", "char_start", "char_end"))).alias("spans"), F.max("char_end").alias("reach")
    )  # the parts of one text
    starts = F.transform("spans", lambda s: s["char_start"])
    ends = F.transform("spans", lambda s: s["char_end"])
    gapless = F.concat(ends, F.array(F.col("char_count"))) == F.concat(F.slice(starts, 2, 1 << 20), F.array(F.col("char_count"), F.col("char_count")))
    covered = (starts[0] == 0) & gapless
    j = aggregates.join(spans, key, "left").join(mean, key, "left")
    told, full = F.col("parts").isNotNull(), F.col("found") == F.col("parts")
    return issues(
        counts(
            j,
            {
                "missing_long_text_provenance": ~told,
                "invalid_long_text_provenance": told & ~full,
                "invalid_long_text_source_coverage": told & full & ~F.coalesce(covered, F.lit(False)),
                "long_text_vector_mismatch": told & full & differs(F.col("vector"), F.col("again")),
            },
        )
    )
