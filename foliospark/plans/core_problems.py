"""Queries of the general problem: processing only what is new or changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.operators import incremental as inc
from foliospark.sources.tables import new_folder, stage, table


def _capture(spark: SparkSession, sf: str) -> DataFrame:
    state = new_folder(spark, "scans-capture")
    capture = inc.ChangeCapture(spark, state, "source_html_path", ("observed_at", "arrived_at"))
    return capture.run(f"{sf}/source_scans.parquet", inc.observations_of)


def p2_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Each source to process, with the first reason that holds."""
    log = _capture(spark, sf)
    return inc.to_process(log, table(spark, sf, "source_manifest"), table(spark, sf, "runs"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_changes(spark, sf).select("source_html_path")


def p2_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same in three batches, as the scans arrived: the second one fails before its commit, and rows that arrive then wait for the third.

    Each batch decides for its own sources only; the last decision on a source holds.
    """
    scans = table(spark, sf, "source_scans")
    log, state = new_folder(spark, "scans-log"), new_folder(spark, "scans-batches")
    first, last = scans.agg(F.min(F.unix_micros("arrived_at")), F.max(F.unix_micros("arrived_at"))).first()
    third = F.least(F.floor((F.coalesce(F.unix_micros("arrived_at"), F.lit(first)) - F.lit(first)) * 3 / F.lit(max(1, (last or 0) - (first or 0)))), F.lit(2))
    capture = inc.ChangeCapture(spark, state, "source_html_path", ("observed_at", "arrived_at"))
    manifest, runs = table(spark, sf, "source_manifest"), table(spark, sf, "runs")
    decided = []

    def arrive(k: int) -> None:
        scans.filter(third == k).write.parquet(f"{log}/arrival={k}")

    def batch() -> None:
        capture.run(log, inc.observations_of)
        decided.append(stage(inc.decide(capture, manifest, runs).withColumn("batch", F.lit(len(decided))), "decided"))

    arrive(0)
    batch()
    arrive(1)
    try:
        capture.run(log, inc.observations_of, fail_before_commit=True)
    except RuntimeError:
        arrive(2)
    batch()
    batch()
    every = reduce(DataFrame.unionByName, decided)
    return every.groupBy("source_html_path").agg(F.max_by("reason", "batch").alias("reason")).filter("reason is not null")


QUERIES = {"p2_found": p2_found, "p2_changes": p2_changes, "p2_batches": p2_batches}

_LATEST = r"""
WITH plain AS (
  SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(source_html_path, '/+', '/', 'g'), '(^|/)(\./)+', '\1', 'g'), '/\.$', ''), '^/', '') AS path,
         html_size, html_mtime_ns, lower(source_html_sha256) AS h, observed_at, arrived_at
  FROM source_scans WHERE source_html_path IS NOT NULL),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY observed_at DESC NULLS LAST, arrived_at DESC NULLS LAST) AS rn FROM plain) WHERE rn = 1),
judged AS (
  SELECT l.path AS source_html_path,
    CASE WHEN m.source_html_path IS NULL THEN 'new'
         WHEN m.status IS DISTINCT FROM 'succeeded' THEN 'not_succeeded'
         WHEN NOT EXISTS (SELECT 1 FROM runs r WHERE r.run_id = m.last_run_id AND r.status = 'succeeded') THEN 'unfinished_run'
         WHEN m.extractor_version IS DISTINCT FROM '7' THEN 'stale_extractor'
         WHEN CASE WHEN l.h IS NOT NULL THEN l.h IS DISTINCT FROM lower(m.source_html_sha256)
                   ELSE l.html_size IS DISTINCT FROM m.html_size OR l.html_mtime_ns IS DISTINCT FROM m.html_mtime_ns END THEN 'changed' END AS reason
  FROM latest l LEFT JOIN source_manifest m ON m.source_html_path = l.path)
"""

ORACLE = {
    "p2_changes": _LATEST + "SELECT source_html_path, reason FROM judged WHERE reason IS NOT NULL",
    "p2_batches": _LATEST + "SELECT source_html_path, reason FROM judged WHERE reason IS NOT NULL",
    "p2_found": _LATEST + "SELECT source_html_path FROM judged WHERE reason IS NOT NULL",
}
