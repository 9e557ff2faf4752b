"""The source manifest: classification of what a scan saw, and its reconciliation after a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRINT = ("html_size", "html_mtime_ns", "header_image_path", "header_image_size", "header_image_mtime_ns")
IMAGE = PRINT[2:]


def classify(discovered: DataFrame, manifest: DataFrame, version: str) -> DataFrame:
    """Discovered sources (path and the columns of PRINT) with kind, image_changed, was_failed and the stored hash and identity.

    new (unknown or missing), then stale_extractor, unchanged, stat_changed: staleness is looked at
    before the fingerprint, and fingerprints are compared null-safely.
    """
    m = manifest.select(F.col("source_html_path").alias("m_path"), *(F.col(c).alias("m_" + c) for c in PRINT), F.col("source_html_sha256").alias("old_html_sha256"), F.col("article_id").alias("old_article_id"), F.col("status").alias("m_status"), F.col("extractor_version").alias("m_version"))
    same = lambda cols: F.forall(F.array(*[F.col(c).eqNullSafe(F.col("m_" + c)) for c in cols]), lambda x: x)
    new = F.col("m_path").isNull() | F.col("m_status").eqNullSafe("missing")
    kind = F.when(new, "new").when(~F.col("m_version").eqNullSafe(version), "stale_extractor").when(same(PRINT), "unchanged").otherwise("stat_changed")
    j = discovered.join(m, F.col("source_html_path") == F.col("m_path"), "left").withColumn("kind", kind)
    known = F.col("kind") != "new"
    return j.select(
        *discovered.columns,
        "kind",
        ((F.col("kind") == "stat_changed") & ~same(IMAGE)).alias("image_changed"),
        (known & F.col("m_status").eqNullSafe("failed")).alias("was_failed"),
        F.when(known, F.col("old_html_sha256")).alias("old_html_sha256"),
        F.when(known, F.col("old_article_id")).alias("old_article_id"),
    )


def refine(classified: DataFrame, hash_column: str = "source_html_sha256") -> DataFrame:
    """stat_changed with the same content and image, and not failed before, becomes metadata_only."""
    only = (F.col("kind") == "stat_changed") & ~F.col("was_failed") & ~F.col("image_changed") & F.col(hash_column).isNotNull() & F.col(hash_column).eqNullSafe(F.col("old_html_sha256"))
    return classified.withColumn("kind", F.when(only, "metadata_only").otherwise(F.col("kind")))


def to_extract(refined: DataFrame, reprocess: bool) -> DataFrame:
    """Sources whose pages have to be extracted; stale ones only if that is asked for."""
    kinds = ["new", "stat_changed", *(["stale_extractor"] if reprocess else [])]
    return refined.filter(F.col("kind").isin(kinds))


def missing(manifest: DataFrame, discovered: DataFrame, scope: str) -> DataFrame:
    """Manifest rows that a full run no longer saw; a limited run removes nothing."""
    if not scope.startswith("full"):
        return manifest.limit(0)
    return manifest.filter("status <> 'missing'").join(discovered.select("source_html_path"), "source_html_path", "left_anti")


def counters(refined: DataFrame) -> DataFrame:
    """One row of run counters."""
    n = lambda k: F.count_if(F.col("kind") == k)
    return refined.agg(
        F.count("*").alias("discovered"),
        n("new").alias("new"),
        n("stat_changed").alias("changed"),
        n("metadata_only").alias("metadata_only"),
        n("unchanged").alias("unchanged"),
        n("stale_extractor").alias("stale"),
        F.count_if(F.col("was_failed")).alias("failed_before"),
        F.count_if(F.col("header_image_path").isNull()).alias("missing_images"),
    )
