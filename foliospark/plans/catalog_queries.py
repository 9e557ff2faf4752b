"""Queries over the preprocessing catalogue: ranking, manifest, validation, research."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions import identity as ids
from foliospark.operators import incremental as inc
from foliospark.operators import manifest as man
from foliospark.operators import ranking, validation
from foliospark.plans.core_problems import _LATEST
from foliospark.sources import archive, store
from foliospark.sources.tables import broadcast_if_small, new_folder, stage, table


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.clean_candidates(table(spark, sf, "candidates"))


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """The published article of each identity: its winning candidate."""
    w = ranking.winners(candidates(spark, sf).select("article_id", "source_html_path", *ranking.CRITERIA, "header_image_path", "inline_image_urls", "published_at_utc", "publication_date_new_york"))
    return w.withColumn("cleaned_markdown_path", ids.markdown_path(F.col("article_id"), F.col("publication_date_new_york")))


def rank_winners(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("article_id", "source_html_path", "editorial_character_count", "editorial_block_count", "metadata_completeness")


def candidate_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked(candidates(spark, sf).select("article_id", "source_html_path", *ranking.CRITERIA)).select("article_id", "source_html_path", "candidate_rank")


def duplicate_audit(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.duplicates_of(candidates(spark, sf))


def duplicate_differences(spark: SparkSession, sf: str) -> DataFrame:
    expected = ranking.duplicates_of(candidates(spark, sf))
    return ranking.symmetric_difference(expected, table(spark, sf, "duplicates"))


def markdown_paths(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("article_id", "cleaned_markdown_path")


def new_york_dates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", ids.new_york_date(F.col("published_at_utc")).alias("day"))


def date_range_research(spark: SparkSession, sf: str) -> DataFrame:
    a = articles(spark, sf).filter(F.col("publication_date_new_york").between("2022-01-01", "2022-12-31"))
    return a.select("article_id", "publication_date_new_york", "header_image_path").orderBy("publication_date_new_york", "article_id")


def classify_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The latest observation of each path against the manifest; images are taken as they were."""
    capture = inc.ChangeCapture(spark, new_folder(spark, "scans-classify"), "source_html_path", ("observed_at", "arrived_at"))
    seen = capture.run(f"{sf}/source_scans.parquet", inc.observations_of).select("source_html_path", "html_size", "html_mtime_ns", F.lower("source_html_sha256").alias("source_html_sha256"))
    m = table(spark, sf, "source_manifest")
    images = m.select("source_html_path", *man.IMAGE)
    return man.refine(man.classify(seen.join(images, "source_html_path", "left"), m, inc.CURRENT_EXTRACTOR))


def source_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return classify_sources(spark, sf).select("source_html_path", "kind", "was_failed", "old_article_id")


def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    return man.counters(classify_sources(spark, sf))


def missing_sources(spark: SparkSession, sf: str) -> DataFrame:
    seen = table(spark, sf, "source_scans").select(inc.plain_path(F.col("source_html_path")).alias("source_html_path")).distinct()
    return man.missing(table(spark, sf, "source_manifest"), seen, "full").select("source_html_path", "article_id", "status")


def affected_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Identities with a vanished source among their candidates or duplicates (EXISTS or EXISTS, as a union of semi-joins)."""
    gone = table(spark, sf, "source_manifest").filter("status = 'missing'").select("source_html_path")
    sides = [table(spark, sf, t).select("article_id", "source_html_path").join(broadcast_if_small(gone), "source_html_path", "left_semi").select("article_id") for t in ("candidates", "duplicates")]
    return sides[0].unionByName(sides[1]).distinct()


def unknown_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates whose source the manifest does not know as succeeded."""
    good = table(spark, sf, "source_manifest").filter("status = 'succeeded'").select("source_html_path")
    return candidates(spark, sf).join(good, "source_html_path", "left_anti").select("source_html_path", "article_id")


def candidate_manifest_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "source_manifest").select("source_html_path", F.col("source_html_sha256").alias("m_hash"), F.col("header_image_path").alias("m_header"), F.col("article_id").alias("m_article"))
    j = candidates(spark, sf).join(m, "source_html_path")
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    return j.select("source_html_path", differs("source_html_sha256", "m_hash").alias("hash_differs"), differs("header_image_path", "m_header").alias("header_differs"), differs("article_id", "m_article").alias("identity_differs")).filter("hash_differs or header_differs or identity_differs")


def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    """A page of 50 duplicates after a composite key."""
    d = table(spark, sf, "duplicates").select("article_id", "source_html_path", "duplicate_rank")
    last = F.struct(F.lit("v").alias("article_id"), F.lit("m").alias("source_html_path"))
    return d.filter(F.struct("article_id", "source_html_path") > last).orderBy("article_id", "source_html_path", "duplicate_rank").limit(50)


def limited_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The first 25 sources in lexical order, as a limited run takes them."""
    return archive.limited(table(spark, sf, "source_manifest").select("source_html_path", "status"), 25)


def header_pairing(spark: SparkSession, sf: str) -> DataFrame:
    """Pages paired with the images that the manifest lists, as a scan of the archive would pair them."""
    m = table(spark, sf, "source_manifest")
    pages = m.select(F.col("source_html_path").alias("path"), F.col("html_size").alias("size"), F.col("html_mtime_ns").alias("mtime_ns"))
    images = m.filter("header_image_path is not null").select(F.col("header_image_path").alias("path"), F.col("header_image_size").alias("size"), F.col("header_image_mtime_ns").alias("mtime_ns")).dropDuplicates(["path"])
    return archive.pair_images(pages.unionByName(images)).select("source_html_path", "header_image_path", F.array_join("warnings", ",").alias("warnings"))


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "runs").orderBy(F.desc("started_at"), F.desc("run_id")).limit(1).select("run_id", "command", "scope", "status")


def run_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of the counters in run summaries, per status."""
    r = table(spark, sf, "runs").filter("summary_json is not null").select("status", F.from_json("summary_json", "map<string,string>").alias("m"))
    numbers = r.select("status", F.explode("m").alias("counter", "text")).withColumn("value", F.expr("try_cast(text as bigint)")).filter("value is not null")
    return numbers.groupBy("status", "counter").agg(F.sum("value").alias("total"), F.count("*").alias("runs"))


def inventory_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "source_manifest").agg(F.count("*").alias("discovered"), F.count("header_image_path").alias("with_image"), (F.count("*") - F.count("header_image_path")).alias("missing_image"), F.count_if(F.col("status") == "failed").alias("failed"))


def repeated_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Source paths that were delivered more than once."""
    return table(spark, sf, "candidates").groupBy("source_html_path").agg(F.count("*").alias("rows")).filter("rows > 1")


def catalog_issues(spark: SparkSession, sf: str) -> DataFrame:
    c, a = stage(candidates(spark, sf), "candidates"), stage(articles(spark, sf), "articles")  # both feed several checks
    return validation.preprocessing_issues(table(spark, sf, "source_manifest"), c, table(spark, sf, "duplicates"), table(spark, sf, "runs"), a)


def run_issues(spark: SparkSession, sf: str) -> DataFrame:
    return validation.issues(validation.run_checks(table(spark, sf, "runs"), "run-0059-none"))


def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest's statuses after the observations of changed sources were stored over it."""
    old = table(spark, sf, "source_manifest").select("source_html_path", "status", "last_run_id")
    new = classify_sources(spark, sf).filter("kind in ('new', 'stat_changed')").select("source_html_path", F.lit("succeeded").alias("status"), F.lit("run-next").alias("last_run_id"))
    return store.upsert(old, new, ["source_html_path"])


def escaped_texts(spark: SparkSession, sf: str) -> DataFrame:
    escaped = ids.escape_markdown(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.sha2(escaped, 256).alias("escaped_sha256"), F.length(escaped).alias("escaped_length"))


def text_hashes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("text_sha256"))


def canonical_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Identities of all candidates by the fallback chain where the stored id is withheld: URL hash, else content hash.

    As in extraction, any URL that is not blank once normalised counts, so pages that give the same
    placeholder ("N/A") share an identity; null, blank, "#" and "/" fall back to the content hash.
    """
    given = F.struct("source_html_sha256", F.trim("canonical_url").alias("canonical_url"))
    c = table(spark, sf, "candidates").filter("source_html_path is not null").groupBy("source_html_path").agg(F.min(given).alias("c")).select("source_html_path", "c.*")
    return c.select("source_html_path", ids.identity(F.lit(None).cast("string"), ids.normalized_url("canonical_url"), F.col("source_html_sha256"), "id").alias("identity"))


def published_article_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Published articles, some of which were changed by the first digit of their id's hash: listed twice (0), another path (1), another header (2), addresses that are none (3), another day (4)."""
    a = articles(spark, sf).withColumn("digit", F.substring(F.sha2("article_id", 256), 1, 1))
    when = lambda d, c, v: F.when(F.col("digit") == d, v).otherwise(F.col(c))
    odd = a.withColumns(
        {
            "cleaned_markdown_path": when("1", "cleaned_markdown_path", F.lit("text/x.md")),
            "header_image_path": when("2", "header_image_path", F.lit("other.jpg")),
            "inline_image_urls": when("3", "inline_image_urls", F.array(F.lit("http://h:99999/x"), F.lit("http://h/x"), F.lit("http://h/x"))),
            "publication_date_new_york": when("4", "publication_date_new_york", F.lit("1900-01-01").cast("date")),
        }
    )
    odd = stage(odd.unionAll(odd.filter("digit = '0'")), "odd-articles")
    c = stage(candidates(spark, sf), "candidates")
    found = validation.preprocessing_issues(table(spark, sf, "source_manifest"), c, table(spark, sf, "duplicates"), table(spark, sf, "runs"), odd)
    return found.filter(F.col("code").isin("duplicate_article_id", "duplicate_source_html_path", "duplicate_markdown_path", "inconsistent_article_candidate", "markdown_path_mismatch", "unstable_inline_image_urls", "invalid_inline_image_url", "publication_date_mismatch"))


QUERIES = {
    f.__name__: f
    for f in (
        rank_winners, candidate_ranks, duplicate_audit, duplicate_differences, markdown_paths, new_york_dates, date_range_research, source_kinds, run_counters, missing_sources, affected_identities, unknown_sources,
        candidate_manifest_mismatches, keyset_page, limited_scan, header_pairing, latest_run, run_summaries, inventory_counts, repeated_candidates, catalog_issues, run_issues, manifest_upsert, escaped_texts, text_hashes, canonical_identities, published_article_issues,
    )
}

_CAND = """WITH cand AS (SELECT DISTINCT * FROM candidates WHERE article_id IS NOT NULL AND source_html_path IS NOT NULL),
rk AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY CASE WHEN editorial_character_count > 0 THEN 0 ELSE 1 END, editorial_character_count DESC NULLS LAST,
  editorial_block_count DESC NULLS LAST, metadata_completeness DESC NULLS LAST, updated_at_utc DESC NULLS LAST, source_html_path)::int AS candidate_rank FROM cand),
art AS (SELECT *, 'text/' || strftime(publication_date_new_york, '%Y/%m/%d') || '/' || sha256(article_id) || '.md' AS cleaned_markdown_path FROM rk WHERE candidate_rank = 1),
dup AS (SELECT d.article_id, d.source_html_path, w.source_html_path AS winner_source_html_path, d.candidate_rank AS duplicate_rank,
  CASE WHEN coalesce(w.editorial_character_count > 0, false) <> coalesce(d.editorial_character_count > 0, false) THEN 'empty_content'
       WHEN w.editorial_character_count IS DISTINCT FROM d.editorial_character_count THEN 'lower_editorial_character_count'
       WHEN w.editorial_block_count IS DISTINCT FROM d.editorial_block_count THEN 'lower_editorial_block_count'
       WHEN w.metadata_completeness IS DISTINCT FROM d.metadata_completeness THEN 'lower_metadata_completeness'
       WHEN w.updated_at_utc IS DISTINCT FROM d.updated_at_utc THEN 'older_update' ELSE 'lexical_tiebreak' END AS reason
  FROM rk d JOIN rk w ON w.article_id = d.article_id AND w.candidate_rank = 1 WHERE d.candidate_rank > 1),
diff AS ((SELECT *, 'expected' AS side FROM (SELECT * FROM dup EXCEPT ALL SELECT article_id, source_html_path, winner_source_html_path, duplicate_rank, reason FROM duplicates))
  UNION ALL (SELECT *, 'stored' AS side FROM (SELECT article_id, source_html_path, winner_source_html_path, duplicate_rank, reason FROM duplicates EXCEPT ALL SELECT * FROM dup)))
"""

_KINDS = _LATEST.rstrip() + """, kinds AS (SELECT l.path AS source_html_path,
  CASE WHEN m.source_html_path IS NULL OR m.status = 'missing' THEN 'new' WHEN m.extractor_version IS DISTINCT FROM '7' THEN 'stale_extractor'
       WHEN l.html_size IS NOT DISTINCT FROM m.html_size AND l.html_mtime_ns IS NOT DISTINCT FROM m.html_mtime_ns THEN 'unchanged'
       WHEN m.status <> 'failed' AND l.h IS NOT NULL AND l.h IS NOT DISTINCT FROM m.source_html_sha256 THEN 'metadata_only' ELSE 'stat_changed' END AS kind,
  m.source_html_path IS NOT NULL AND m.status = 'failed' AS was_failed, CASE WHEN m.status <> 'missing' THEN m.article_id END AS old_article_id, m.header_image_path
  FROM latest l LEFT JOIN source_manifest m ON m.source_html_path = l.path)
"""

_RUNS = """SELECT 'invalid_run_command' AS code, count(*) AS n FROM runs WHERE command NOT IN ('inventory', 'run', 'smoke', 'validate')
UNION ALL SELECT 'invalid_run_scope', count(*) FROM runs WHERE NOT regexp_full_match(scope, '(?:limit:[1-9][0-9]*(?:,reprocess)?|full(?:,reprocess)?|fixture)')
UNION ALL SELECT 'invalid_run_status', count(*) FROM runs WHERE status NOT IN ('succeeded', 'failed', 'running')
UNION ALL SELECT 'running_run', count(*) FROM runs WHERE status = 'running' {active}
UNION ALL SELECT 'inconsistent_run_summary', count(*) FROM runs WHERE (status = 'running' AND (finished_at IS NOT NULL OR summary_json IS NOT NULL))
  OR (status IN ('succeeded', 'failed') AND (finished_at IS NULL OR summary_json IS NULL OR NOT json_valid(summary_json) OR json_type(summary_json) <> 'OBJECT'
      OR coalesce(json_extract(summary_json, '$.validation_ok')::varchar <> CASE WHEN status = 'succeeded' THEN 'true' ELSE 'false' END, false)))"""

ORACLE = {
    "rank_winners": _CAND + "SELECT article_id, source_html_path, editorial_character_count, editorial_block_count, metadata_completeness FROM art",
    "candidate_ranks": _CAND + "SELECT article_id, source_html_path, candidate_rank FROM rk",
    "duplicate_audit": _CAND + "SELECT * FROM dup",
    "duplicate_differences": _CAND + "SELECT * FROM diff",
    "markdown_paths": _CAND + "SELECT article_id, cleaned_markdown_path FROM art",
    "new_york_dates": "SELECT doc_id, CAST(published_at_utc AT TIME ZONE 'America/New_York' AS date) AS day FROM documents",
    "date_range_research": _CAND + "SELECT article_id, publication_date_new_york, header_image_path FROM art WHERE publication_date_new_york BETWEEN DATE '2022-01-01' AND DATE '2022-12-31'",
    "source_kinds": _KINDS + "SELECT source_html_path, kind, was_failed, old_article_id FROM kinds",
    "run_counters": _KINDS
    + """SELECT count(*) AS discovered, count(*) FILTER (WHERE kind = 'new') AS new, count(*) FILTER (WHERE kind = 'stat_changed') AS changed, count(*) FILTER (WHERE kind = 'metadata_only') AS metadata_only,
  count(*) FILTER (WHERE kind = 'unchanged') AS unchanged, count(*) FILTER (WHERE kind = 'stale_extractor') AS stale, count(*) FILTER (WHERE was_failed) AS failed_before, count(*) FILTER (WHERE header_image_path IS NULL) AS missing_images FROM kinds""",
    "missing_sources": _LATEST + "SELECT source_html_path, article_id, status FROM source_manifest WHERE status <> 'missing' AND source_html_path NOT IN (SELECT path FROM plain)",
    "affected_identities": """SELECT DISTINCT x.article_id FROM (SELECT article_id FROM candidates UNION ALL SELECT article_id FROM duplicates) x WHERE
  EXISTS (SELECT 1 FROM candidates c JOIN source_manifest m USING (source_html_path) WHERE m.status = 'missing' AND c.article_id = x.article_id)
  OR EXISTS (SELECT 1 FROM duplicates d JOIN source_manifest m USING (source_html_path) WHERE m.status = 'missing' AND d.article_id = x.article_id)""",
    "unknown_sources": _CAND + "SELECT source_html_path, article_id FROM cand c WHERE NOT EXISTS (SELECT 1 FROM source_manifest m WHERE m.source_html_path = c.source_html_path AND m.status = 'succeeded')",
    "candidate_manifest_mismatches": _CAND
    + """SELECT c.source_html_path, c.source_html_sha256 IS DISTINCT FROM m.source_html_sha256 AS hash_differs, c.header_image_path IS DISTINCT FROM m.header_image_path AS header_differs, c.article_id IS DISTINCT FROM m.article_id AS identity_differs
  FROM cand c JOIN source_manifest m ON m.source_html_path = c.source_html_path WHERE hash_differs OR header_differs OR identity_differs""",
    "keyset_page": "SELECT article_id, source_html_path, duplicate_rank FROM duplicates WHERE (article_id, source_html_path) > ('v', 'm') ORDER BY article_id, source_html_path, duplicate_rank LIMIT 50",
    "limited_scan": "SELECT source_html_path, status FROM source_manifest ORDER BY source_html_path LIMIT 25",
    "header_pairing": r"""WITH img AS (SELECT DISTINCT header_image_path AS p FROM source_manifest WHERE header_image_path IS NOT NULL),
i AS (SELECT p, regexp_replace(p, '[^/]*$', '') AS folder, lower(regexp_replace(regexp_extract(p, '[^/]*$'), '\.[^.]*$', '')) AS stem, lower(regexp_extract(p, '\.[^.]*$')) AS ext, regexp_extract(p, '[^/]*$') AS name FROM img),
j AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY folder, stem) AS n FROM i WHERE ext IN ('.jpg', '.jpeg', '.png', '.webp')
  WINDOW w AS (PARTITION BY folder, stem ORDER BY CASE ext WHEN '.jpg' THEN 1 WHEN '.jpeg' THEN 2 WHEN '.png' THEN 3 ELSE 4 END, lower(name), name))
SELECT h.source_html_path, j.p AS header_image_path, CASE WHEN j.n IS NULL THEN 'missing_image' WHEN j.n > 1 THEN 'multiple_images' ELSE '' END AS warnings
FROM source_manifest h LEFT JOIN j ON j.k = 1 AND j.folder = regexp_replace(h.source_html_path, '[^/]*$', '') AND j.stem = lower(regexp_replace(regexp_extract(h.source_html_path, '[^/]*$'), '\.[^.]*$', '')) || '_main_image'
WHERE lower(h.source_html_path) LIKE '%.html'""",
    "latest_run": "SELECT run_id, command, scope, status FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1",
    "run_summaries": """SELECT status, k AS counter, sum(try_cast(v AS bigint))::bigint AS total, count(*) AS runs FROM (SELECT status, unnest(json_keys(summary_json)) AS k, summary_json FROM runs WHERE summary_json IS NOT NULL),
  LATERAL (SELECT json_extract_string(summary_json, '$.' || k) AS v) WHERE try_cast(v AS bigint) IS NOT NULL GROUP BY status, k""",
    "inventory_counts": "SELECT count(*) AS discovered, count(header_image_path) AS with_image, count(*) - count(header_image_path) AS missing_image, count(*) FILTER (WHERE status = 'failed') AS failed FROM source_manifest",
    "repeated_candidates": "SELECT source_html_path, count(*) AS rows FROM candidates GROUP BY 1 HAVING count(*) > 1",
    "run_issues": "SELECT * FROM (" + _RUNS.format(active="AND run_id <> 'run-0059-none'") + ") WHERE n > 0",
    "catalog_issues": _CAND
    + """SELECT code, sum(n)::bigint AS n FROM (
SELECT 'unsupported_extractor_version' AS code, count(*) AS n FROM (SELECT extractor_version FROM source_manifest UNION ALL SELECT extractor_version FROM cand) WHERE extractor_version <> '7'
UNION ALL SELECT 'invalid_manifest_status', count(*) FROM source_manifest WHERE status NOT IN ('succeeded', 'failed', 'missing')
UNION ALL """
    + _RUNS.format(active="")
    + """
UNION ALL SELECT 'duplicate_article_id', count(*) FROM (SELECT article_id FROM art GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_source_html_path', count(*) FROM (SELECT source_html_path FROM art GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_markdown_path', count(*) FROM (SELECT cleaned_markdown_path FROM art GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'inconsistent_manifest_winner', count(*) FROM art a LEFT JOIN source_manifest m USING (source_html_path) WHERE m.source_html_path IS NULL OR m.article_id IS DISTINCT FROM a.article_id
UNION ALL SELECT 'failed_or_missing_winner', count(*) FROM art a JOIN source_manifest m USING (source_html_path) WHERE m.status IN ('failed', 'missing')
UNION ALL SELECT 'inconsistent_candidate_manifest', count(*) FROM cand c LEFT JOIN source_manifest m USING (source_html_path) WHERE m.source_html_path IS NULL OR m.article_id IS DISTINCT FROM c.article_id OR m.source_html_sha256 IS DISTINCT FROM c.source_html_sha256
  OR m.extractor_version IS DISTINCT FROM c.extractor_version OR m.header_image_path IS DISTINCT FROM c.header_image_path OR m.status <> 'succeeded'
UNION ALL SELECT 'inconsistent_candidate_manifest', count(*) FROM source_manifest m LEFT JOIN cand c ON c.source_html_path = m.source_html_path AND c.article_id IS NOT DISTINCT FROM m.article_id AND c.source_html_sha256 IS NOT DISTINCT FROM m.source_html_sha256
  AND c.extractor_version IS NOT DISTINCT FROM m.extractor_version AND c.header_image_path IS NOT DISTINCT FROM m.header_image_path WHERE m.status = 'succeeded' AND c.source_html_path IS NULL
UNION ALL SELECT 'broken_duplicate_winner', count(*) FROM duplicates d LEFT JOIN art a ON a.article_id = d.article_id AND a.source_html_path = d.winner_source_html_path LEFT JOIN cand w ON w.article_id = d.article_id AND w.source_html_path = d.winner_source_html_path
  WHERE a.article_id IS NULL OR w.source_html_path IS NULL
UNION ALL SELECT 'inconsistent_duplicate_candidate', count(*) FROM duplicates d LEFT JOIN cand c ON c.article_id = d.article_id AND c.source_html_path = d.source_html_path WHERE c.source_html_path IS NULL OR d.source_html_path = d.winner_source_html_path OR d.duplicate_rank < 2
UNION ALL SELECT 'inconsistent_candidate_set', count(*) FROM cand c LEFT JOIN art a ON a.article_id = c.article_id LEFT JOIN (SELECT DISTINCT article_id, source_html_path FROM duplicates) d ON d.article_id = c.article_id AND d.source_html_path = c.source_html_path
  WHERE a.article_id IS NULL OR (c.source_html_path = a.source_html_path AND d.source_html_path IS NOT NULL) OR (c.source_html_path <> a.source_html_path AND d.source_html_path IS NULL)
UNION ALL SELECT 'inconsistent_duplicate_audit', count(*) FROM diff
UNION ALL SELECT 'publication_date_mismatch', count(*) FROM art WHERE CAST(published_at_utc AT TIME ZONE 'America/New_York' AS date) IS DISTINCT FROM publication_date_new_york
UNION ALL SELECT 'unstable_inline_image_urls', count(*) FROM art WHERE len(list_distinct(inline_image_urls)) <> len(inline_image_urls)
UNION ALL SELECT 'invalid_inline_image_url', count(*) FROM art WHERE len(list_filter(inline_image_urls, lambda u: NOT regexp_matches(u, '^https?://[^\\s/]+'))) > 0
) GROUP BY code HAVING sum(n) > 0""",
    "manifest_upsert": _KINDS
    + """SELECT source_html_path, status, last_run_id FROM source_manifest WHERE source_html_path NOT IN (SELECT source_html_path FROM kinds WHERE kind IN ('new', 'stat_changed'))
UNION ALL SELECT source_html_path, 'succeeded', 'run-next' FROM kinds WHERE kind IN ('new', 'stat_changed')""",
    "published_article_issues": _CAND
    + """, odd AS (SELECT *, substr(sha256(article_id), 1, 1) AS g, CAST(published_at_utc AT TIME ZONE 'America/New_York' AS date) IS DISTINCT FROM publication_date_new_york AS wrong_day FROM art),
n AS (SELECT count(*) FILTER (WHERE g = '0') AS twice, count(*) FILTER (WHERE g = '1') AS path, count(*) FILTER (WHERE g = '2' AND header_image_path IS DISTINCT FROM 'other.jpg') AS head, count(*) FILTER (WHERE g = '3') AS urls, count(*) FILTER (WHERE g = '4') AS day,
  count(*) FILTER (WHERE g <> '3' AND len(list_distinct(inline_image_urls)) <> len(inline_image_urls)) + count(*) FILTER (WHERE g = '0' AND len(list_distinct(inline_image_urls)) <> len(inline_image_urls)) AS unstable FROM odd)
SELECT code, k AS n FROM (SELECT unnest(['duplicate_article_id', 'duplicate_source_html_path', 'duplicate_markdown_path', 'inconsistent_article_candidate', 'markdown_path_mismatch', 'unstable_inline_image_urls', 'invalid_inline_image_url', 'publication_date_mismatch']) AS code,
  unnest([twice, twice, twice + (path > 1)::bigint, head + urls + day, path + day, unstable + urls, urls, day]) AS k FROM n) WHERE k > 0""",
    "canonical_identities": r"""WITH c AS (SELECT source_html_path, min(struct_pack(h := source_html_sha256, u := trim(canonical_url))) AS c FROM candidates WHERE source_html_path IS NOT NULL GROUP BY 1),
t AS (SELECT source_html_path, c.h AS h, c.u AS u, regexp_extract(c.u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS scheme, regexp_extract(c.u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS site, regexp_extract(regexp_replace(c.u, '^([A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)?)', ''), '^[^?#]*') AS path,
  regexp_extract(c.u, '\?([^#]*)', 1) AS query FROM c),
n AS (SELECT source_html_path, h, CASE WHEN u IS NULL THEN NULL ELSE (CASE WHEN scheme <> '' THEN lower(scheme) || ':' ELSE '' END) || (CASE WHEN site <> '' THEN '//' || regexp_replace(lower(site), CASE lower(scheme) WHEN 'https' THEN ':443$' ELSE ':80$' END, '') ELSE '' END) || rtrim(path, '/')
  || CASE WHEN query <> '' THEN '?' || array_to_string(list_sort(string_split(query, '&')), '&') ELSE '' END END AS u FROM t)
SELECT source_html_path, CASE WHEN trim(coalesce(u, '')) <> '' THEN 'url:' || sha256(u) ELSE 'html:' || h END AS identity FROM n""",
    "escaped_texts": r"""SELECT doc_id, sha256(e) AS escaped_sha256, length(e)::int AS escaped_length FROM (SELECT doc_id, regexp_replace(text, '([\\`*_\[\]{}|])', '\\\1', 'g') AS e FROM documents)""",
    "text_hashes": "SELECT doc_id, length(text)::int AS chars, octet_length(encode(text))::int AS bytes, sha256(text) AS text_sha256 FROM documents",
}
