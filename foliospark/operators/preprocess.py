"""One preprocessing run: scan, classify by what the listing says, read and extract what changed, rank the identities it touches, commit.

Pages are read where they are extracted and nowhere else: a run over an archive that has not changed
reads no page. The run is recorded as running before it begins and ends once, as succeeded or failed; all
tables change in one commit, so a run that fails leaves the catalogue as it was, but for its record. Only
identities whose candidates changed are ranked again; a winner that was promoted is extracted again, and
if that fails it is no candidate any more and the next one is tried.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import identity as ids
from foliospark.operators import extraction, ranking, validation
from foliospark.operators import manifest as man
from foliospark.sources import archive, sinks
from foliospark.sources.store import Store, replace_groups, upsert
from foliospark.sources.tables import spread, stage

#: Pages that one task reads and extracts, about.
PAGES_A_TASK = 500


@dataclass(frozen=True)
class Options:
    """Scope of a run: all sources, or the first `limit` by path; `reprocess` also takes stale ones. Texts go to `markdown_root`, if given."""

    limit: int | None = None
    reprocess: bool = False
    version: str = "7"
    namespace: str = "id"
    markdown_root: str | None = None

    @property
    def scope(self) -> str:
        return ("full" if self.limit is None else f"limit:{self.limit}") + (",reprocess" if self.reprocess else "")


def read_and_extract(pages: DataFrame, root: str, options: Options) -> DataFrame:
    """Pages (source_html_path, known_sha256, warnings) read below `root` and extracted where their hash is not the known one.

    Gives x_hash, unchanged (the hash is the known one), and the fields of extraction; a page that cannot be
    read safely carries the code unreadable_source. Bytes are dropped as soon as a page is done.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from foliospark.functions.markdown import Article, extract

        names = [f.split()[0] for f in extraction.FIELDS.split(", ")]
        for pdf in batches:
            rows = []
            for path, known, warnings in zip(pdf["source_html_path"], pdf["known_sha256"], pdf["warnings"]):
                status, data = archive.read_safely(root, path)
                digest = hashlib.sha256(data).hexdigest() if status == "ok" else None
                if digest is None:
                    found = Article(error="unreadable_source")
                else:
                    found = Article() if digest == known else extract(data, list(warnings) if warnings is not None else [], options.namespace)
                rows.append({"source_html_path": path, "x_hash": digest, "unchanged": digest is not None and digest == known, **extraction.record(found)})
            yield extraction.frame(rows, ["source_html_path", "x_hash", "unchanged", *names])

    given = spread(pages.select("source_html_path", "known_sha256", "warnings"), PAGES_A_TASK)
    found = given.mapInPandas(run, f"source_html_path string, x_hash string, unchanged boolean, {extraction.FIELDS}").drop("source_html_sha256")
    return found.withColumns({"publication_date_new_york": ids.new_york_date(F.col("published_at_utc")), "extractor_version": F.lit(options.version)})


def run(store: Store, root: str, options: Options = Options()) -> dict:
    """Run over the archive below `root`; returns the run's summary."""
    run_id, started = f"run-{uuid.uuid4().hex[:12]}", datetime.now(UTC)
    base = store.version()
    before = store.read("runs", base)
    record = lambda status, summary=None: store.spark.createDataFrame([(run_id, "run", options.scope, status, started, datetime.now(UTC) if summary is not None else None, json.dumps(summary, sort_keys=True, separators=(",", ":")) if summary is not None else None)], schemas.schema("runs"))
    base = store.commit({"runs": before.unionByName(record("running"))}, base, {"run_id": run_id})
    try:
        changed, texts, summary = _work_off(store, base, run_id, started, root, options, before)
    except Exception as e:
        store.commit({"runs": before.unionByName(record("failed", {"error": type(e).__name__, "validation_ok": False}))}, base, {"run_id": run_id})
        raise
    status = "succeeded" if summary["validation_ok"] else "failed"
    store.commit(changed | {"runs": before.unionByName(record(status, summary))}, base, {"run_id": run_id})
    if options.markdown_root:
        export_markdown(changed["articles"].join(texts.select("source_html_path"), "source_html_path", "left_semi"), texts, options.markdown_root).count()
        sinks.remove_orphans(sinks.tree(store.spark, options.markdown_root, "text"), changed["articles"], options.markdown_root, "cleaned_markdown_path").count()
    return summary | {"run_id": run_id, "status": status, "scope": options.scope}


def _work_off(store: Store, base: int, run_id: str, started: datetime, root: str, options: Options, runs: DataFrame) -> tuple[dict[str, DataFrame], DataFrame, dict]:
    spark = store.spark
    old = {t: store.read(t, base) for t in ("source_manifest", "candidates", "duplicates", "failures", "articles")}
    paired = archive.pair_images(archive.listing(spark, root))
    seen = stage(archive.limited(paired, options.limit) if options.limit is not None else paired, "listed")
    classified = stage(man.classify(seen, old["source_manifest"], options.version), "compared")
    # A changed stat with the known hash and image is no change; a failure is tried again in any case.
    known = F.when((F.col("kind") == "stat_changed") & ~F.col("was_failed") & ~F.col("image_changed"), F.col("old_html_sha256"))
    todo = man.to_extract(classified, options.reprocess).withColumn("known_sha256", known)
    extracted = stage(read_and_extract(todo, root, options), "extracted")
    read = extracted.select("source_html_path", "x_hash", "unchanged", F.col("article_id").alias("x_article"), F.col("error_code").alias("x_error"))
    joined = classified.join(read, "source_html_path", "left")
    kinds = stage(joined.withColumn("kind", F.when(F.coalesce("unchanged", F.lit(False)), "metadata_only").otherwise(F.col("kind"))), "classified")
    good, bad = extracted.filter("error_code is null and not unchanged"), extracted.filter("error_code is not null")
    gone = man.missing(old["source_manifest"], seen, options.scope)

    # The manifest: what was read anew, the rest only marked as seen, vanished sources as missing.
    columns, key = schemas.schema("source_manifest").names, ["source_html_path"]
    renewed = kinds.filter(F.col("x_hash").isNotNull() | F.col("x_error").isNotNull()).select(
        "source_html_path", *man.PRINT, F.coalesce("x_hash", "old_html_sha256").alias("source_html_sha256"), F.lit(options.version).alias("extractor_version"), F.when(F.col("x_error").isNull(), "succeeded").otherwise("failed").alias("status"),
        F.coalesce("x_article", F.when(F.col("kind") == "metadata_only", F.col("old_article_id"))).alias("article_id"), F.lit(run_id).alias("last_run_id"), F.lit(run_id).alias("last_seen_run_id"),
    )
    touched = old["source_manifest"].join(kinds.select("source_html_path"), "source_html_path", "left_semi").withColumn("last_seen_run_id", F.lit(run_id)).select(*columns)
    lost = gone.withColumns({"status": F.lit("missing"), "last_run_id": F.lit(run_id)}).select(*columns)
    new_manifest = upsert(upsert(upsert(old["source_manifest"], touched, key), lost, key), renewed.select(*columns), key)

    # Candidates: failed and vanished sources leave, extracted ones come in.
    fresh = good.join(kinds.select("source_html_path", "header_image_path"), "source_html_path").select(
        *[(F.lit(run_id) if f.name == "last_run_id" else F.col("x_hash") if f.name == "source_html_sha256" else F.col(f.name)).cast(f.dataType).alias(f.name) for f in schemas.schema("candidates")]
    )
    out = bad.select("source_html_path").unionByName(gone.select("source_html_path"))
    candidates = stage(upsert(old["candidates"].join(out, "source_html_path", "left_anti").select(*old["candidates"].columns), fresh, key), "candidates")
    changed = fresh.select("source_html_path").unionByName(out)
    affected = stage(fresh.select("article_id").unionByName(old["candidates"].join(changed.distinct(), "source_html_path", "left_semi").select("article_id")).distinct(), "affected")

    # Winners; one whose text is not at hand is extracted again, and leaves if that fails.
    texts = good.select("source_html_path", "markdown_text", F.sha2("markdown_text", 256).alias("markdown_sha256"))
    before = old["articles"].select("source_html_path", F.col("markdown_sha256").alias("b_hash"))
    broken = extracted.select("source_html_path", "error_code").filter("false")
    while True:
        part = candidates.join(affected, "article_id", "left_semi")
        won = stage(ranking.winners(part), "winners")
        promoted = won.join(texts, "source_html_path", "left_anti").join(before, "source_html_path", "left_anti")
        again = stage(read_and_extract(promoted.select("source_html_path", F.lit(None).cast("string").alias("known_sha256"), "warnings"), root, options), "promoted")
        texts = stage(texts.unionByName(again.filter("error_code is null").select("source_html_path", "markdown_text", F.sha2("markdown_text", 256).alias("markdown_sha256"))), "texts")
        failed = again.filter("error_code is not null").select("source_html_path", "error_code")
        if failed.isEmpty():
            break
        broken = broken.unionByName(failed)
        candidates = stage(candidates.join(failed, "source_html_path", "left_anti").select(*candidates.columns), "candidates")
    unfit = broken.select("source_html_path")
    renamed = new_manifest.join(unfit, "source_html_path", "left_semi").withColumns({"status": F.lit("failed"), "last_run_id": F.lit(run_id)}).select(*columns)
    new_manifest = stage(upsert(new_manifest, renamed, key), "manifest")
    duplicates = stage(replace_groups(old["duplicates"], ranking.duplicates_of(part).withColumn("run_id", F.lit(run_id)), "article_id", affected), "duplicates")
    published = won.join(texts.select("source_html_path", "markdown_sha256"), "source_html_path", "left").join(before, "source_html_path", "left")
    published = published.withColumns({"cleaned_markdown_path": ids.markdown_path(F.col("article_id"), F.col("publication_date_new_york")), "markdown_sha256": F.coalesce("markdown_sha256", "b_hash"), "last_run_id": F.lit(run_id)})
    articles = stage(replace_groups(old["articles"], published.select(*schemas.schema("articles").names), "article_id", affected), "articles")

    messages = F.create_map(*[F.lit(x) for kv in schemas.FAILURE_MESSAGES.items() for x in kv])
    every = bad.select("source_html_path", "error_code").unionByName(broken)
    failures = old["failures"].unionByName(every.select(F.lit(run_id).alias("run_id"), "source_html_path", F.lit("extract").alias("stage"), "error_code", F.element_at(messages, F.col("error_code")).alias("message"), F.lit(options.version).alias("extractor_version"), F.lit(started).cast("timestamp").alias("failed_at")))
    summary = {k: int(v) for k, v in man.counters(kinds).first().asDict().items()}
    summary |= {"failed": every.count(), "removed": gone.count(), "articles": articles.count(), "duplicates": duplicates.count(), "pages_read": extracted.count()}
    found = validation.preprocessing_issues(new_manifest, candidates, duplicates, runs, articles, options.version).collect()
    summary |= {"validation_ok": not found, "issues": sorted(r.code for r in found)}
    tables = {"source_manifest": new_manifest, "candidates": candidates, "duplicates": duplicates, "failures": failures, "articles": articles}
    return tables, texts.select("source_html_path", "markdown_text"), summary


def export_markdown(articles: DataFrame, texts: DataFrame, root: str) -> DataFrame:
    """Write each article's text to its path under `root` and report (path, sha256, outcome).

    Articles come with cleaned_markdown_path and markdown_sha256, texts with source_html_path and markdown_text.
    """
    a = articles.select("source_html_path", F.col("cleaned_markdown_path").alias("path"), F.col("markdown_sha256").alias("sha256"))
    return sinks.write_files(a.join(texts.select("source_html_path", F.encode("markdown_text", "utf-8").alias("data")), "source_html_path"), root, replace=True)
