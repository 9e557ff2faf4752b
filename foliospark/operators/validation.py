"""Validators: every issue code is a count, reported as (code, n) where it is not zero.

Checks of one table are conditions of one aggregation over it; checks across tables are joins. Nothing
but counts leaves a check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import identity as ids
from foliospark.functions import vectors as vec
from foliospark.operators import ranking
from foliospark.sources.tables import broadcast_if_small


def counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(code, n) of each condition's rows, in one aggregation."""
    one = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(code) for code, c in checks.items()))
    return one.select(F.explode(F.array(*[F.struct(F.lit(code).alias("code"), F.col(code).alias("n")) for code in checks])).alias("i")).select("i.code", "i.n")


def number(df: DataFrame, code: str) -> DataFrame:
    """(code, n) of a frame's rows."""
    return df.agg(F.count("*").alias("n")).select(F.lit(code).alias("code"), "n")


def issues(*found: DataFrame) -> DataFrame:
    """One row per code with a count above zero; counts of one code from several checks are added."""
    return reduce(DataFrame.unionByName, found).groupBy("code").agg(F.sum("n").alias("n")).filter("n > 0")


def report(found: DataFrame, messages: dict[str, str] | None = None) -> DataFrame:
    """(code, message) without repetition, in order of code and message."""
    named = F.create_map(*[F.lit(x) for kv in (messages or {"": ""}).items() for x in kv])
    text = F.concat(F.coalesce(F.try_element_at(named, F.col("code")), F.regexp_replace("code", "_", " ")), F.lit(": "), F.col("n"))
    return found.select("code", text.alias("message")).distinct().orderBy("code", "message")


def _outside(c: Column, domain: tuple[str, ...]) -> Column:
    return ~c.isin(*domain)


def run_checks(runs: DataFrame, active: str | None = None) -> DataFrame:
    """Domains of runs, unfinished runs other than the active one, and summaries that contradict their status."""
    status, text = F.col("status"), F.col("summary_json")
    parsed = F.from_json(text, "map<string,string>")
    said = F.regexp_extract(text, r'"validation_ok"\s*:\s*(true|false)\s*[,}]', 1)
    contradicts = F.map_contains_key(parsed, "validation_ok") & (said != F.when(status == "succeeded", "true").otherwise("false"))
    ended = status.isin("succeeded", "failed") & (F.col("finished_at").isNull() | text.isNull() | parsed.isNull() | F.coalesce(contradicts, F.lit(False)))
    open_ = (status == "running") & (F.col("finished_at").isNotNull() | text.isNotNull())
    running = status == "running"
    return counts(
        runs,
        {
            "invalid_run_command": _outside(F.col("command"), schemas.RUN_COMMANDS),
            "invalid_run_scope": ~F.col("scope").rlike(rf"\A{schemas.RUN_SCOPE}\z"),
            "invalid_run_status": _outside(status, schemas.RUN_STATUSES),
            "running_run": running if active is None else running & (F.col("run_id") != active),
            "inconsistent_run_summary": open_ | ended,
        },
    )


def repeated(df: DataFrame, column: str, code: str) -> DataFrame:
    """Groups of more than one row with the same value."""
    return number(df.groupBy(column).count().filter("count > 1"), code)


def article_checks(articles: DataFrame) -> DataFrame:
    """Dates, paths and image addresses of published articles."""
    day = ids.new_york_date(F.col("published_at_utc"))
    urls = F.col("inline_image_urls")
    return counts(
        articles,
        {
            "publication_date_mismatch": ~day.eqNullSafe(F.col("publication_date_new_york")),
            "markdown_path_mismatch": ~F.col("cleaned_markdown_path").eqNullSafe(ids.markdown_path(F.col("article_id"), F.col("publication_date_new_york"))),
            "unstable_inline_image_urls": F.size(F.array_distinct(urls)) != F.size(urls),
            "invalid_inline_image_url": F.exists(urls, lambda u: ~ids.http_url(u)),
        },
    )


def preprocessing_issues(manifest: DataFrame, candidates: DataFrame, duplicates: DataFrame, runs: DataFrame, articles: DataFrame, version: str = "7", active: str | None = None) -> DataFrame:
    """All issues of the preprocessing catalogue."""
    m = manifest.select(*(F.col(c).alias("m_" + c) for c in ("source_html_path", "article_id", "source_html_sha256", "extractor_version", "header_image_path", "status")))
    shared = ("header_image_path", "inline_image_urls", "published_at_utc", "publication_date_new_york")
    c_of = candidates.select(F.col("source_html_path").alias("c_path"), F.col("article_id").alias("c_article"), *(F.col(x).alias("c_" + x) for x in shared))
    versions = manifest.select("extractor_version").unionAll(candidates.select("extractor_version"))
    winner = articles.join(m, F.col("source_html_path") == F.col("m_source_html_path"), "left")
    own = articles.join(c_of, (F.col("source_html_path") == F.col("c_path")) & (F.col("article_id") == F.col("c_article")), "left")
    cm = candidates.join(m, F.col("source_html_path") == F.col("m_source_html_path"), "left")
    linked = ("article_id", "source_html_sha256", "extractor_version", "header_image_path")
    back = m.filter("m_status = 'succeeded'").join(candidates, reduce(lambda a, b: a & b, [F.col("source_html_path") == F.col("m_source_html_path"), *(F.col(x).eqNullSafe(F.col("m_" + x)) for x in linked)]), "left_anti")
    a_of = articles.select(F.col("article_id").alias("a_article"), F.col("source_html_path").alias("a_path"))
    c_key = candidates.select(F.col("article_id").alias("k_article"), F.col("source_html_path").alias("k_path")).distinct()
    d = duplicates.select("article_id", "source_html_path", "winner_source_html_path", "duplicate_rank")
    by_winner = (F.col("article_id") == F.col("a_article")) & (F.col("winner_source_html_path") == F.col("a_path"))
    dw = d.join(a_of, by_winner, "left").join(c_key, (F.col("article_id") == F.col("k_article")) & (F.col("winner_source_html_path") == F.col("k_path")), "left")
    dc = d.join(c_key, (F.col("article_id") == F.col("k_article")) & (F.col("source_html_path") == F.col("k_path")), "left")
    d_key = duplicates.select(F.col("article_id").alias("d_article"), F.col("source_html_path").alias("d_path")).distinct()
    member = candidates.select("article_id", "source_html_path").join(a_of, F.col("article_id") == F.col("a_article"), "left").join(d_key, (F.col("article_id") == F.col("d_article")) & (F.col("source_html_path") == F.col("d_path")), "left")
    expected = ranking.duplicates_of(candidates)
    lost = ranking.winners(candidates.select("article_id", "source_html_path", *ranking.CRITERIA)).select(F.col("article_id").alias("w_article"), F.col("source_html_path").alias("w_path")).join(a_of, F.col("w_article") == F.col("a_article"), "left").filter(~F.col("w_path").eqNullSafe(F.col("a_path")))
    return issues(
        counts(versions, {"unsupported_extractor_version": F.col("extractor_version") != version}),
        counts(manifest, {"invalid_manifest_status": _outside(F.col("status"), schemas.MANIFEST_STATUSES)}),
        run_checks(runs, active),
        repeated(articles, "article_id", "duplicate_article_id"),
        repeated(articles, "source_html_path", "duplicate_source_html_path"),
        repeated(articles, "cleaned_markdown_path", "duplicate_markdown_path"),
        counts(winner, {"inconsistent_manifest_winner": F.col("m_source_html_path").isNull() | ~F.col("m_article_id").eqNullSafe(F.col("article_id")), "failed_or_missing_winner": F.col("m_status").isin("failed", "missing")}),
        counts(own, {"inconsistent_article_candidate": reduce(lambda a, b: a | b, [F.col("c_path").isNull(), *(~F.col(x).eqNullSafe(F.col("c_" + x)) for x in shared)])}),
        counts(cm, {"inconsistent_candidate_manifest": reduce(lambda a, b: a | b, [F.col("m_source_html_path").isNull(), *(~F.col(x).eqNullSafe(F.col("m_" + x)) for x in linked), F.col("m_status") != "succeeded"])}),
        number(back, "inconsistent_candidate_manifest"),
        counts(dw, {"broken_duplicate_winner": F.col("a_article").isNull() | F.col("k_path").isNull()}),
        counts(dc, {"inconsistent_duplicate_candidate": F.col("k_path").isNull() | (F.col("source_html_path") == F.col("winner_source_html_path")) | (F.col("duplicate_rank") < 2)}),
        counts(member, {"inconsistent_candidate_set": F.col("a_article").isNull() | ((F.col("source_html_path") == F.col("a_path")) & F.col("d_path").isNotNull()) | ((F.col("source_html_path") != F.col("a_path")) & F.col("d_path").isNull())}),
        number(ranking.symmetric_difference(expected, duplicates.select(*expected.columns)), "inconsistent_duplicate_audit"),
        number(lost, "inconsistent_duplicate_audit"),
        article_checks(articles),
    )


def file_issues(referenced: DataFrame, listing: DataFrame, kind: str, path: str = "path", digest: str | None = None) -> DataFrame:
    """missing_<kind>, unsafe_<kind>_path, <kind>_hash_mismatch and orphan_<kind> of references (path[, digest]) against a listing (path[, sha256])."""
    safe = ids.is_safe_path(F.col(path))
    own = listing.select(F.col("path").alias("l_path"), *([F.col("sha256").alias("l_hash")] if digest else []))
    j = referenced.join(own, F.col(path) == F.col("l_path"), "left")
    checks = {f"unsafe_{kind}_path": ~safe, f"missing_{kind}": safe & F.col("l_path").isNull()}
    if digest:
        checks[f"{kind}_hash_mismatch"] = F.col("l_hash").isNotNull() & ~F.col("l_hash").eqNullSafe(F.col(digest))
    return issues(counts(j, checks), number(own.join(referenced.select(F.col(path).alias("r_path")), F.col("l_path") == F.col("r_path"), "left_anti"), f"orphan_{kind}"))


def configuration_identity(configurations: DataFrame) -> Column:
    """SHA-256 of the compact JSON of every public column, names in order."""
    return vec.composite_identity(**{c: F.col(c) for c in configurations.columns if c != "configuration_id"})


def provenance_holds(has_aggregation: Column, synthetic: Column) -> Column:
    """Whether modality, derivation kind and the pattern of nulls of a vector go together."""
    kind, modality = F.col("derivation_kind"), F.col("modality")
    bare = F.col("raw_response_sha256").isNull() & F.col("response_model").isNull()
    source = modality.isin("article_text", "header_image")
    hosted = (kind == "hosted_response") & source & ids.is_sha256(F.col("raw_response_sha256")) & ids.is_safe_label(F.col("response_model"))
    made = (kind == "synthetic_fixture") & synthetic & source & bare
    joined = (kind == "long_text_aggregate") & (modality == "article_text") & has_aggregation & bare
    return F.coalesce(F.when(modality == "multimodal_article", (kind == "multimodal_midpoint") & bare).otherwise(hosted | made | joined), F.lit(False))


def vector_issues(storage: DataFrame, configurations: DataFrame, articles: DataFrame, aggregated: DataFrame) -> DataFrame:
    """Issues of stored vectors; `aggregated` has the (article_id, configuration_id) with part provenance."""
    c = broadcast_if_small(configurations.select(F.col("configuration_id").alias("c_id"), F.col("dimensions").alias("c_dim"), F.col("observed_model").alias("c_model")))
    a = articles.select(F.col("article_id").alias("a_id"), F.col("published_at_utc").alias("a_at"), F.col("publication_date_new_york").alias("a_day"))
    g = aggregated.select(F.col("article_id").alias("g_id"), F.col("configuration_id").alias("g_c")).distinct()
    j = storage.join(c, F.col("configuration_id") == F.col("c_id"), "left").join(a, F.col("article_id") == F.col("a_id"), "left").join(g, (F.col("article_id") == F.col("g_id")) & (F.col("configuration_id") == F.col("g_c")), "left")
    status = vec.status(F.col("vector"), F.col("c_dim"))
    return issues(
        counts(
            j.withColumn("_status", status),
            {
                "missing_configuration_reference": F.col("c_id").isNull(),
                "invalid_modality": _outside(F.col("modality"), schemas.MODALITIES),
                "invalid_dimensions": ~F.col("dimensions").eqNullSafe(F.col("c_dim")),
                "invalid_vector": F.col("_status") == vec.CODES[0],
                "invalid_vector_dimensions": F.col("_status") == vec.CODES[1],
                "nonfinite_vector": F.col("_status") == vec.CODES[2],
                "zero_vector": F.col("_status") == vec.CODES[3],
                "nonunit_vector": F.col("_status").isNull() & ~vec.is_unit(F.col("vector")),
                "invalid_vector_provenance": ~provenance_holds(F.col("g_id").isNotNull(), F.lit(False)),
                "hosted_response_model_mismatch": (F.col("derivation_kind") == "hosted_response") & ~F.col("response_model").eqNullSafe(F.col("c_model")),
                "missing_canonical_article": F.col("a_id").isNull(),
                "publication_metadata_mismatch": F.col("a_id").isNotNull() & (~F.col("published_at_utc").eqNullSafe(F.col("a_at")) | ~F.col("publication_date_new_york").eqNullSafe(F.col("a_day"))),
            },
        ),
        counts(configurations.withColumn("_id", configuration_identity(configurations)), {"invalid_configuration_id": F.col("_id") != F.col("configuration_id")}),
    )


def hash_mismatches(storage: DataFrame) -> DataFrame:
    """Stored vectors whose hash is not that of their float32 bytes."""
    return storage.filter(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())).filter(~vec.vector_hash("vector").eqNullSafe(F.col("stored_vector_sha256"))).select("article_id", "modality", "configuration_id", "stored_vector_sha256")


PART_KEY = ["article_id", "configuration_id", "article_input_sha256"]


def part_gaps(parts: DataFrame) -> DataFrame:
    """Per long text: parts, the stored part count, and how often a part does not begin where the one before ends."""
    before = Window.partitionBy(*PART_KEY).orderBy("part_index")
    start = F.coalesce(F.lag("char_end").over(before), F.lit(0))
    byte = F.coalesce(F.lag("byte_end").over(before), F.lit(0))
    j = parts.withColumn("bad", (F.col("char_start") != start) | (F.col("byte_start") != byte) | (F.col("part_index") != F.row_number().over(before) - 1))
    return j.groupBy(*PART_KEY).agg(F.count("*").alias("parts"), F.max("part_count").alias("part_count"), F.count_if(F.col("bad")).alias("gaps"), F.max("char_end").alias("char_end"), F.sum(F.col("token_count").cast("long")).alias("token_count"))


def part_issues(parts: DataFrame, configurations: DataFrame, runs: DataFrame) -> DataFrame:
    """Issues of long-text parts."""
    c = broadcast_if_small(configurations.select(F.col("configuration_id").alias("c_id"), F.col("context_token_limit").alias("c_limit"), F.col("long_text_part_attempt_limit").alias("c_attempts")))
    r = broadcast_if_small(runs.select(F.col("run_id").alias("r_id")).distinct())
    j = parts.join(c, F.col("configuration_id") == F.col("c_id"), "left").join(r, F.col("last_run_id") == F.col("r_id"), "left")
    spans = (F.col("part_index") < 0) | (F.col("part_index") >= F.col("part_count")) | (F.col("char_start") < 0) | (F.col("char_end") <= F.col("char_start")) | (F.col("byte_end") - F.col("byte_start") < F.col("char_end") - F.col("char_start"))
    tokens = (F.col("token_count") < 1) | (F.col("token_count") > F.col("c_limit"))
    failed = F.col("state").isin("retryable", "terminal")
    noted = F.col("error_code").isNotNull()
    gaps = part_gaps(parts)
    return issues(
        counts(
            j,
            {
                "missing_configuration_reference": F.col("c_id").isNull(),
                "invalid_long_text_part": spans | tokens | ~ids.is_sha256(F.col("part_input_sha256")) | ~ids.is_sha256(F.col("article_input_sha256")),
                "invalid_work_state": _outside(F.col("state"), schemas.STATES),
                "invalid_failure_checkpoint": (failed & ~noted) | (~failed & noted) | (F.col("attempt_count") > F.col("c_attempts")),
                "invalid_generation_run_reference": F.col("r_id").isNull(),
            },
        ),
        counts(gaps, {"invalid_long_text_source_coverage": (F.col("gaps") > 0) | (F.col("parts") != F.col("part_count"))}),
    )


def coverage(articles: DataFrame, work: DataFrame) -> DataFrame:
    """Per configuration: the consistent counters of what is covered. work: KEY and state; articles: article_id, header_image_path."""
    whole = articles.agg(F.count("*").alias("canonical_articles"), F.count("header_image_path").alias("header_present"))
    a = articles.select(F.col("article_id").alias("a_id"), F.col("header_image_path").alias("a_header"))
    j = work.join(a, F.col("article_id") == F.col("a_id"), "left")
    done = F.col("a_id").isNotNull() & (F.col("state") == "succeeded")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    per = j.groupBy("configuration_id").agg(
        n(done & (F.col("modality") == "article_text")).alias("text_success"),
        n(done & F.col("a_header").isNotNull() & (F.col("modality") == "header_image")).alias("header_success"),
        n(done & F.col("a_header").isNotNull() & (F.col("modality") == "multimodal_article")).alias("multimodal_success"),
        n(F.col("state") == "stale_input").alias("stale_work"),
        n(F.col("state") == "retryable").alias("unresolved_retryable_work"),
    )
    total, present = whole.select("canonical_articles").scalar(), whole.select("header_present").scalar()
    x = per.withColumns({"canonical_articles": total, "header_present": present})
    return x.select(
        "configuration_id",
        "canonical_articles",
        "text_success",
        (F.col("canonical_articles") - F.col("text_success")).alias("text_failure"),
        "header_present",
        (F.col("canonical_articles") - F.col("header_present")).alias("header_absent"),
        "header_success",
        (F.col("header_present") - F.col("header_success")).alias("header_failure"),
        "multimodal_success",
        (F.col("canonical_articles") - F.col("header_present")).alias("multimodal_unavailable"),
        (F.col("header_present") - F.col("multimodal_success")).alias("multimodal_failure"),
        "stale_work",
        "unresolved_retryable_work",
    )
