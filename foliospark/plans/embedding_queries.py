"""Queries over the embedding catalogue: vectors, parts, coverage, work lifecycle, batching, quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import digests, images
from foliospark.functions import vectors as vec
from foliospark.operators import batching, parts, reconcile, validation
from foliospark.operators import work as wk
from foliospark.plans.catalog_queries import _CAND, articles
from foliospark.sources.tables import broadcast_if_small, table

KEY = wk.KEY


def stored(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embedding_storage")


def configurations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embedding_configurations")


def with_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """Stored vectors with the dimensions that their configuration gives."""
    c = configurations(spark, sf).select("configuration_id", F.col("dimensions").alias("c_dim"))
    return stored(spark, sf).join(broadcast_if_small(c), "configuration_id")


def usable(spark: SparkSession, sf: str) -> DataFrame:
    return with_dimensions(spark, sf).filter(vec.status(F.col("vector"), F.col("c_dim")).isNull())


def vector_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return with_dimensions(spark, sf).select(*KEY, F.coalesce(vec.status(F.col("vector"), F.col("c_dim")), F.lit("ok")).alias("vector_status"))


def vector_norms(spark: SparkSession, sf: str) -> DataFrame:
    return usable(spark, sf).select(*KEY, F.round(vec.norm(F.col("vector")), 6).alias("norm"), vec.is_unit(F.col("vector")).alias("is_unit"))


def normalized_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every component of every normalised vector, by position."""
    n = usable(spark, sf).select(*KEY, F.posexplode(vec.normalized(F.col("vector"))).alias("pos", "x"))
    return n.select(*KEY, "pos", F.round(F.col("x").cast("double"), 6).alias("x"))


def midpoint_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The midpoint of text and header vector of each article and configuration, checked by its norm and first components."""
    u = usable(spark, sf).select(*KEY, "vector")
    at = lambda m: u.filter(F.col("modality") == m).select("article_id", "configuration_id", F.col("vector").alias(m))
    j = at("article_text").join(at("header_image"), ["article_id", "configuration_id"])
    m = j.withColumn("m", vec.midpoint(F.col("article_text"), F.col("header_image"))).filter("m is not null")
    first = lambda i: F.round(F.element_at("m", i).cast("double"), 5)
    return m.select("article_id", "configuration_id", F.round(vec.norm(F.col("m")), 5).alias("norm"), first(1).alias("m1"), first(2).alias("m2"))


def weighted_mean_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of each label of `embeddings`, weighted by 1 + vec_id mod 7."""
    e = table(spark, sf, "embeddings").withColumn("w", 1 + F.col("vec_id") % 7)
    m = vec.weighted_mean(e, ["label"], "embedding", "w", "vec_id")
    return m.select("label", F.posexplode("mean").alias("pos", "x")).select("label", "pos", F.round("x", 8).alias("mean_value"))


def composite_identities(spark: SparkSession, sf: str) -> DataFrame:
    """The input identity of each derivable composite."""
    s = stored(spark, sf)
    at = lambda m: s.filter(F.col("modality") == m).select("article_id", "configuration_id", F.col("stored_vector_sha256").alias(m + "_hash"), F.col("input_sha256").alias(m + "_run"))
    j = at("article_text").join(at("header_image"), ["article_id", "configuration_id"]).join(broadcast_if_small(configurations(spark, sf).select("configuration_id", "multimodal_formula")), "configuration_id")
    digest = vec.composite_identity(
        formula_version=F.col("multimodal_formula"), text_generation_run_id=F.col("article_text_run"), text_stored_vector_sha256=F.col("article_text_hash"), header_image_generation_run_id=F.col("header_image_run"), header_image_stored_vector_sha256=F.col("header_image_hash")
    )
    return j.select("article_id", "configuration_id", digest.alias("composite_sha256"))


def configuration_identities(spark: SparkSession, sf: str) -> DataFrame:
    c = configurations(spark, sf)
    return c.select("configuration_id", validation.configuration_identity(c).alias("derived_id"))


def digit(c: str = "article_id") -> Column:
    """The first digit of an id's hash: which rows a query over damaged tables damages, and how."""
    return F.substring(F.sha2(c, 256), 1, 1)


def vector_hash_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Stored vectors whose hash is not theirs, after the hashes of the articles of digit 0 were overwritten."""
    damaged = F.when(digit() == "0", F.lit("0" * 64)).otherwise(F.col("stored_vector_sha256"))
    return validation.hash_mismatches(stored(spark, sf).withColumn("stored_vector_sha256", damaged))


def storage_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The order-independent digest of all stored vectors' identities, in parts that combine."""
    d = digests.multiset_parts(stored(spark, sf), *KEY, "input_sha256", "stored_vector_sha256")
    return d.select(*[F.col(c).cast("long").alias(c) for c in d.columns])


def research_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of one modality with their model, ordered."""
    c = configurations(spark, sf).select("configuration_id", "model", F.col("dimensions").alias("model_dimensions"))
    return stored(spark, sf).filter("modality = 'article_text'").join(broadcast_if_small(c), "configuration_id").select("article_id", "configuration_id", "model", "model_dimensions", "publication_date_new_york").orderBy("publication_date_new_york", "article_id")


def coverage_states(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf).groupBy("configuration_id", "modality", "derivation_kind").agg(F.count("*").alias("vectors"))


def part_states(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "long_text_parts")
    return p.groupBy("configuration_id", "state").agg(F.count("*").alias("parts"), F.count_if(F.col("error_code").isNotNull()).alias("failed"), F.sum(F.col("token_count").cast("long")).alias("tokens"))


def work_of(spark: SparkSession, sf: str) -> DataFrame:
    """Work implied by the stored vectors: a usable vector is a success, any other one is to be retried."""
    v = with_dimensions(spark, sf)
    return v.select(*KEY, "source_relative_path", "input_sha256", F.when(vec.status(F.col("vector"), F.col("c_dim")).isNull(), "succeeded").otherwise("retryable").alias("state"))


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return validation.coverage(articles(spark, sf).select("article_id", "header_image_path"), work_of(spark, sf))


def vector_issues(spark: SparkSession, sf: str) -> DataFrame:
    whole = table(spark, sf, "long_text_parts").select("article_id", "configuration_id")
    return validation.vector_issues(stored(spark, sf), configurations(spark, sf), articles(spark, sf), whole)


def part_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Issues of the stored parts, after spans (digit 2), states (3), errors (4) and runs (5) of some articles were damaged."""
    p = table(spark, sf, "long_text_parts")
    change = {"char_end": ("2", F.col("char_start")), "state": ("3", F.lit("odd")), "error_code": ("4", F.lit("x")), "last_run_id": ("5", F.lit("none"))}
    odd = p.withColumns({c: F.when(digit() == d, v).otherwise(F.col(c)) for c, (d, v) in change.items()})
    return validation.part_issues(odd, configurations(spark, sf), table(spark, sf, "runs"))


def part_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return validation.part_gaps(table(spark, sf, "long_text_parts"))


def part_plans(spark: SparkSession, sf: str) -> DataFrame:
    """Lossless parts of every document beyond 2,000 code points."""
    return parts.plan_parts(table(spark, sf, "documents"), 2000)


def part_plan_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Per planned document: that its parts add up to the text in code points and bytes."""
    p = part_plans(spark, sf).groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum(F.col("char_end") - F.col("char_start")).alias("chars"), F.sum(F.col("byte_end") - F.col("byte_start")).alias("bytes"), F.max("token_count").alias("largest"))
    return p.select("doc_id", "chars", "bytes", (F.col("largest") <= 2000).alias("within"))


def publication_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of known articles whose publication time is another one now; the articles of digit 1 were moved by a day."""
    moved = F.col("published_at_utc") + F.when(digit() == "1", F.expr("interval 1 day")).otherwise(F.expr("interval 0 day"))
    a = articles(spark, sf).select("article_id", moved.alias("a_at"))
    return stored(spark, sf).join(a, "article_id").filter(~F.col("published_at_utc").eqNullSafe(F.col("a_at"))).select(*KEY)


def stored_or_planned(spark: SparkSession, sf: str) -> DataFrame:
    """Each article with marks for a text vector, long-text parts, and duplicates (EXISTS as projected booleans), and its number of vectors."""
    a = articles(spark, sf).select("article_id")
    mark = lambda df, name: df.select("article_id").distinct().withColumn(name, F.lit(True))
    n = stored(spark, sf).groupBy("article_id").agg(F.count("*").alias("vectors"))
    j = a
    for df, name in ((stored(spark, sf).filter("modality = 'article_text'"), "has_text"), (table(spark, sf, "long_text_parts"), "has_parts"), (table(spark, sf, "duplicates"), "has_duplicates")):
        j = j.join(mark(df, name), "article_id", "left")
    no = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    return j.join(n, "article_id", "left").select("article_id", no("has_text"), no("has_parts"), no("has_duplicates"), F.coalesce("vectors", F.lit(0)).cast("long").alias("vectors"))


def generations_by_run(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that claim more or fewer generations than there are: manifest rows, candidates and parts against the rows last seen."""
    one = lambda df: df.select(F.col("last_run_id").alias("run_id"))
    every = one(table(spark, sf, "candidates")).unionAll(one(table(spark, sf, "long_text_parts")))
    there = every.groupBy("run_id").agg(F.count("*").alias("generations"))
    claims = one(table(spark, sf, "source_manifest")).groupBy("run_id").agg(F.count("*").alias("claims"))
    runs = table(spark, sf, "runs").select("run_id", "status")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    j = runs.join(there, "run_id", "left").join(claims, "run_id", "left").select("run_id", "status", zero("generations"), zero("claims"))
    return j.filter("generations <> claims")


def registered_work(spark: SparkSession, sf: str) -> DataFrame:
    """Text and header work of each article under each configuration, against the stored vectors."""
    a = articles(spark, sf).select("article_id", "header_image_path", F.sha2("article_id", 256).alias("text_hash"))
    c = configurations(spark, sf).select("configuration_id")
    ids = F.array(F.struct(F.lit("article_text").alias("modality"), F.col("text_hash").alias("h"), F.lit("present").alias("applicability")), F.struct(F.lit("header_image").alias("modality"), F.sha2("header_image_path", 256).alias("h"), F.when(F.col("header_image_path").isNull(), "not_applicable").otherwise("present").alias("applicability")))
    known = F.broadcast(c.agg(F.collect_list("configuration_id").alias("cs")))  # one row: a catalogue's few configurations
    items = a.withColumn("i", F.explode(ids)).withColumn("cs", known.scalar()).withColumn("configuration_id", F.explode("cs"))
    desired = items.select("article_id", F.col("i.modality").alias("modality"), "configuration_id", F.col("header_image_path").alias("source_relative_path"), F.col("i.h").alias("input_sha256"), F.col("i.applicability").alias("applicability"))
    r = wk.register(desired, work_of(spark, sf), stored(spark, sf).select(*KEY, "input_sha256"))
    return r.select(*KEY, "prior_state", "state", "action", "invalidates_composite")


def work_table(spark: SparkSession, sf: str) -> DataFrame:
    """Work in the full layout, generations named after their input."""
    w = work_of(spark, sf)
    return w.select(
        *KEY, "source_relative_path", "input_sha256", "state", F.lit(1).alias("attempt_count"), F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("int").alias("status_code"), F.lit(None).cast("double").alias("retry_after_seconds"),
        F.lit("run-0").alias("last_run_id"), F.substring("input_sha256", 1, 12).alias("generation_run_id"), F.lit("2026-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


def staged_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Actions of a full run that saw exactly the articles of today."""
    seen = articles(spark, sf).select("article_id", "header_image_path")
    return reconcile.stage_actions(work_table(spark, sf), stored(spark, sf), seen, "run-full")


def reconciliation_actions(spark: SparkSession, sf: str) -> DataFrame:
    return staged_actions(spark, sf).select(*KEY, "target_source_relative_path", "target_state", "expected_state")


def _complete(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("run-full", True)], "run_id string, reconciliation_complete boolean")


def visible_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.visible_vectors(stored(spark, sf).select(*KEY, "input_sha256"), staged_actions(spark, sf), _complete(spark))


def visible_work(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.visible_work(work_table(spark, sf), staged_actions(spark, sf), _complete(spark)).select(*KEY, "source_relative_path", "input_sha256", "state", "attempt_count")


def compacted_work(spark: SparkSession, sf: str) -> DataFrame:
    """The work as compaction leaves it, which is what was visible before."""
    w, v, a, r = work_table(spark, sf), stored(spark, sf), staged_actions(spark, sf), _complete(spark)
    history = spark.createDataFrame([], schemas.schema("generation_history"))
    return reconcile.compact(w, v, history, a, r)[0].select(*KEY, "source_relative_path", "input_sha256", "state", "attempt_count")


def compacted_history(spark: SparkSession, sf: str) -> DataFrame:
    """The generations that compaction archives: the vectors that were hidden."""
    w, v, a, r = work_table(spark, sf), stored(spark, sf), staged_actions(spark, sf), _complete(spark)
    history = reconcile.compact(w, v, spark.createDataFrame([], schemas.schema("generation_history")), a, r)[2]
    return history.select(*KEY, "generation_run_id", "input_sha256", "stored_vector_sha256", "superseded_run_id", "superseded_reason")


def rolling_quota(spark: SparkSession, sf: str) -> DataFrame:
    """Per event: how many of its user's events, and what value, lie in the trailing hour, half-open."""
    e = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 97).alias("tokens"))
    return batching.rolling_usage(e, "ts", "tokens", ["user_id"], 3600).select("event_id", "window_requests", "window_tokens")


def rolling_quota_of_all(spark: SparkSession, sf: str) -> DataFrame:
    """Per event: how many of all events lie in the trailing minute, half-open, and what they cost."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 97).alias("tokens"))
    return batching.rolling_usage(e, "ts", "tokens", []).select("event_id", "window_requests", "window_tokens")


def greedy_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Each source's documents packed in order of id under the policy's three ceilings."""
    d = table(spark, sf, "documents").select(F.coalesce("source", F.lit("")).alias("grp"), "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("tokens"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    return batching.pack(d, "grp", "doc_id").select("grp", "doc_id", "batch_no")


def retry_delays(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    delay = batching.retry_delay(F.col("p_size") % 7 + 1, batching.Policy(), F.when(F.col("p_size") % 3 == 0, F.col("p_size") / 4), [F.when(F.col("p_size") % 5 == 0, F.lit(12.5)).otherwise(0.0)], (F.col("p_size") % 10) / 10)
    return p.select("p_partkey", F.round(delay, 6).alias("delay_seconds"))


def http_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", (200 + (F.col("p_partkey") * 7) % 400).cast("int").alias("status"))
    code, again = batching.http_outcome(F.col("status"))
    return p.select("p_partkey", "status", code.alias("code"), again.alias("retryable"))


def image_admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Admission, scaled size and token estimate of images whose sizes derive from the parts table."""
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, 1).otherwise(F.col("p_size") * 211 + 1).cast("int").alias("width"), F.when(F.col("p_partkey") % 10 == 0, 30_000_000 + F.col("p_partkey")).otherwise(F.col("p_partkey") % 9000 + 1).cast("int").alias("height"), (F.col("p_retailprice") * 4000).cast("long").alias("bytes"))
    w, h = images.scaled_columns(F.col("width"), F.col("height"))
    return p.select("p_partkey", images.admission(F.col("bytes"), F.col("width"), F.col("height")).alias("admission"), w.alias("scaled_width"), h.alias("scaled_height"), images.token_estimate(w, h).alias("tokens"))


def event_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Typed values of the events' JSON, totalled per name."""
    e = table(spark, sf, "events").select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("name", "text"))
    return e.groupBy("event_type", "name").agg(F.count("*").alias("events"), F.countDistinct("text").alias("distinct_values"))


QUERIES = {
    f.__name__: f
    for f in (
        vector_statuses, vector_norms, normalized_vectors, midpoint_vectors, weighted_mean_vectors, composite_identities, configuration_identities, vector_hash_mismatches, storage_digest, research_vectors, coverage_states, part_states, coverage,
        vector_issues, part_issues, part_gaps, part_plans, part_plan_checks, publication_mismatches, stored_or_planned, generations_by_run, registered_work, reconciliation_actions, visible_vectors, visible_work, compacted_work, compacted_history,
        rolling_quota, rolling_quota_of_all, greedy_packing, retry_delays, http_outcomes, image_admissions, event_properties,
    )
}

_STATUS = """CASE WHEN s.vector IS NULL OR len(list_filter(s.vector, lambda x: x IS NULL)) > 0 THEN 'invalid_vector' WHEN len(s.vector) <> c.dimensions THEN 'invalid_dimensions'
  WHEN len(list_filter(s.vector, lambda x: NOT isfinite(x))) > 0 THEN 'nonfinite_vector' WHEN len(list_filter(s.vector, lambda x: x <> 0)) = 0 THEN 'zero_vector' END"""
_V = f"""vs AS (SELECT s.*, c.dimensions AS c_dim, c.observed_model AS c_model, c.multimodal_formula, {_STATUS} AS status,
  sqrt(list_sum(list_transform(s.vector, lambda x: x::double * x::double))) AS norm FROM embedding_storage s JOIN embedding_configurations c ON c.configuration_id = s.configuration_id),
wk AS (SELECT article_id, modality, configuration_id, source_relative_path, input_sha256, CASE WHEN status IS NULL THEN 'succeeded' ELSE 'retryable' END AS state FROM vs)
"""
_ACTIONS = (
    _CAND
    + ", "
    + _V
    + """, act AS (SELECT w.article_id, w.modality, w.configuration_id, CASE WHEN a.article_id IS NOT NULL AND w.modality = 'header_image' THEN a.header_image_path END AS target_source_relative_path,
  CASE WHEN a.article_id IS NOT NULL AND w.modality = 'header_image' AND a.header_image_path IS NULL THEN 'not_applicable' ELSE 'stale_input' END AS target_state, w.state AS expected_state
  FROM wk w LEFT JOIN art a ON a.article_id = w.article_id WHERE a.article_id IS NULL OR (w.modality = 'header_image' AND w.source_relative_path IS DISTINCT FROM a.header_image_path)
  OR (w.modality = 'multimodal_article' AND EXISTS (SELECT 1 FROM wk h WHERE h.article_id = w.article_id AND h.configuration_id = w.configuration_id AND h.modality = 'header_image' AND h.source_relative_path IS DISTINCT FROM a.header_image_path)))
"""
)

ORACLE = {
    "vector_statuses": "WITH " + _V + "SELECT article_id, modality, configuration_id, coalesce(status, 'ok') AS vector_status FROM vs",
    "vector_norms": "WITH " + _V + "SELECT article_id, modality, configuration_id, round(norm, 6) AS norm, abs(norm - 1) <= 1e-5 AS is_unit FROM vs WHERE status IS NULL",
    "normalized_vectors": "WITH " + _V + "SELECT article_id, modality, configuration_id, (unnest(generate_series(1, len(vector))) - 1)::int AS pos, round(unnest(list_transform(vector, lambda x: (x::double / norm)::float))::double, 6) AS x FROM vs WHERE status IS NULL",
    "midpoint_vectors": "WITH "
    + _V
    + """, t AS (SELECT article_id, configuration_id, list_transform(vector, lambda x: (x::double / norm)::float) AS n FROM vs WHERE status IS NULL AND modality = 'article_text'),
h AS (SELECT article_id, configuration_id, list_transform(vector, lambda x: (x::double / norm)::float) AS n FROM vs WHERE status IS NULL AND modality = 'header_image'),
m AS (SELECT article_id, configuration_id, list_transform(list_zip(t.n, h.n), lambda p: p[1]::double * 0.5 + p[2]::double * 0.5) AS m FROM t JOIN h USING (article_id, configuration_id)),
u AS (SELECT article_id, configuration_id, list_transform(m, lambda x: (x / sqrt(list_sum(list_transform(m, lambda y: y * y))))::float) AS u FROM m)
SELECT article_id, configuration_id, round(sqrt(list_sum(list_transform(u, lambda x: x::double * x::double))), 5) AS norm, round(u[1]::double, 5) AS m1, round(u[2]::double, 5) AS m2 FROM u""",
    "weighted_mean_vectors": """SELECT label, pos::int AS pos, round(sum(w * x) / sum(w), 8) AS mean_value FROM (SELECT label, (1 + vec_id % 7)::double AS w, unnest(generate_series(1, len(embedding))) - 1 AS pos, unnest(embedding)::double AS x FROM embeddings) GROUP BY label, pos""",
    "composite_identities": """SELECT t.article_id, t.configuration_id, sha256('{"formula_version":"' || c.multimodal_formula || '","header_image_generation_run_id":"' || h.input_sha256 || '","header_image_stored_vector_sha256":"' || h.stored_vector_sha256
  || '","text_generation_run_id":"' || t.input_sha256 || '","text_stored_vector_sha256":"' || t.stored_vector_sha256 || '"}') AS composite_sha256
FROM embedding_storage t JOIN embedding_storage h ON h.article_id = t.article_id AND h.configuration_id = t.configuration_id AND h.modality = 'header_image' JOIN embedding_configurations c ON c.configuration_id = t.configuration_id WHERE t.modality = 'article_text'""",
    "configuration_identities": "SELECT configuration_id, configuration_id AS derived_id FROM embedding_configurations",
    "research_vectors": "SELECT s.article_id, s.configuration_id, c.model, c.dimensions AS model_dimensions, s.publication_date_new_york FROM embedding_storage s JOIN embedding_configurations c USING (configuration_id) WHERE s.modality = 'article_text'",
    "coverage_states": "SELECT configuration_id, modality, derivation_kind, count(*) AS vectors FROM embedding_storage GROUP BY ALL",
    "part_states": "SELECT configuration_id, state, count(*) AS parts, count(error_code) AS failed, sum(token_count)::bigint AS tokens FROM long_text_parts GROUP BY ALL",
    "coverage": _CAND
    + ", "
    + _V
    + """, w AS (SELECT count(*) AS ca, count(header_image_path) AS hp FROM art),
per AS (SELECT configuration_id, count(*) FILTER (WHERE a.article_id IS NOT NULL AND state = 'succeeded' AND modality = 'article_text') AS ts,
  count(*) FILTER (WHERE a.header_image_path IS NOT NULL AND state = 'succeeded' AND modality = 'header_image') AS hs, count(*) FILTER (WHERE a.header_image_path IS NOT NULL AND state = 'succeeded' AND modality = 'multimodal_article') AS ms,
  count(*) FILTER (WHERE state = 'stale_input') AS st, count(*) FILTER (WHERE state = 'retryable') AS rt FROM wk LEFT JOIN art a USING (article_id) GROUP BY configuration_id)
SELECT configuration_id, ca AS canonical_articles, ts AS text_success, ca - ts AS text_failure, hp AS header_present, ca - hp AS header_absent, hs AS header_success, hp - hs AS header_failure, ms AS multimodal_success,
  ca - hp AS multimodal_unavailable, hp - ms AS multimodal_failure, st AS stale_work, rt AS unresolved_retryable_work FROM per, w""",
    "vector_issues": _CAND
    + ", "
    + _V
    + r""", g AS (SELECT DISTINCT article_id, configuration_id FROM long_text_parts),
j AS (SELECT vs.*, a.article_id AS a_id, a.published_at_utc AS a_at, a.publication_date_new_york AS a_day, g.article_id AS g_id, raw_response_sha256 IS NULL AND response_model IS NULL AS bare,
  coalesce(regexp_full_match(raw_response_sha256, '[0-9a-f]{64}') AND regexp_full_match(response_model, '[A-Za-z0-9][A-Za-z0-9._:/-]*') AND octet_length(encode(response_model)) <= 128
    AND len(list_filter(string_split(response_model, '/'), lambda p: p IN ('', '.', '..'))) = 0, false) AS answered
  FROM vs LEFT JOIN art a ON a.article_id = vs.article_id LEFT JOIN g ON g.article_id = vs.article_id AND g.configuration_id = vs.configuration_id)
SELECT * FROM (SELECT 'missing_configuration_reference' AS code, count(*) AS n FROM embedding_storage WHERE configuration_id IS NULL OR configuration_id NOT IN (SELECT configuration_id FROM embedding_configurations)
UNION ALL SELECT 'invalid_modality', count(*) FROM j WHERE modality NOT IN ('article_text', 'header_image', 'multimodal_article')
UNION ALL SELECT 'invalid_dimensions', count(*) FROM j WHERE dimensions IS DISTINCT FROM c_dim
UNION ALL SELECT CASE status WHEN 'invalid_dimensions' THEN 'invalid_vector_dimensions' ELSE status END, count(*) FROM j WHERE status IS NOT NULL GROUP BY status
UNION ALL SELECT 'nonunit_vector', count(*) FROM j WHERE status IS NULL AND abs(norm - 1) > 1e-5
UNION ALL SELECT 'invalid_vector_provenance', count(*) FROM j WHERE NOT coalesce(CASE WHEN modality = 'multimodal_article' THEN derivation_kind = 'multimodal_midpoint' AND bare
  ELSE (derivation_kind = 'hosted_response' AND modality IN ('article_text', 'header_image') AND answered) OR (derivation_kind = 'long_text_aggregate' AND modality = 'article_text' AND g_id IS NOT NULL AND bare) END, false)
UNION ALL SELECT 'hosted_response_model_mismatch', count(*) FROM j WHERE derivation_kind = 'hosted_response' AND response_model IS DISTINCT FROM c_model
UNION ALL SELECT 'missing_canonical_article', count(*) FROM j WHERE a_id IS NULL
UNION ALL SELECT 'publication_metadata_mismatch', count(*) FROM j WHERE a_id IS NOT NULL AND (published_at_utc IS DISTINCT FROM a_at OR publication_date_new_york IS DISTINCT FROM a_day)) WHERE n > 0""",
    "part_gaps": """SELECT article_id, configuration_id, article_input_sha256, count(*) AS parts, max(part_count) AS part_count, count(*) FILTER (WHERE bad) AS gaps, max(char_end) AS char_end, sum(token_count)::bigint AS token_count FROM (
  SELECT *, char_start <> coalesce(lag(char_end) OVER w, 0) OR byte_start <> coalesce(lag(byte_end) OVER w, 0) OR part_index <> row_number() OVER w - 1 AS bad FROM long_text_parts WINDOW w AS (PARTITION BY article_id, configuration_id, article_input_sha256 ORDER BY part_index)) GROUP BY ALL""",
    "part_issues": r"""WITH odd AS (SELECT * REPLACE (CASE WHEN g = '2' THEN char_start ELSE char_end END AS char_end, CASE WHEN g = '3' THEN 'odd' ELSE state END AS state, CASE WHEN g = '4' THEN 'x' ELSE error_code END AS error_code, CASE WHEN g = '5' THEN 'none' ELSE last_run_id END AS last_run_id)
  FROM (SELECT *, substr(sha256(article_id), 1, 1) AS g FROM long_text_parts)),
j AS (SELECT p.*, c.configuration_id AS c_id, c.context_token_limit AS lim, c.long_text_part_attempt_limit AS att FROM odd p LEFT JOIN embedding_configurations c USING (configuration_id)),
gaps AS (SELECT article_id, configuration_id, article_input_sha256, count(*) AS parts, max(part_count) AS part_count, count(*) FILTER (WHERE bad) AS gaps FROM (SELECT *, char_start <> coalesce(lag(char_end) OVER w, 0) OR byte_start <> coalesce(lag(byte_end) OVER w, 0)
  OR part_index <> row_number() OVER w - 1 AS bad FROM odd WINDOW w AS (PARTITION BY article_id, configuration_id, article_input_sha256 ORDER BY part_index)) GROUP BY 1, 2, 3)
SELECT * FROM (SELECT 'missing_configuration_reference' AS code, count(*) AS n FROM j WHERE c_id IS NULL
UNION ALL SELECT 'invalid_long_text_part', count(*) FROM j WHERE part_index < 0 OR part_index >= part_count OR char_start < 0 OR char_end <= char_start OR byte_end - byte_start < char_end - char_start OR token_count < 1 OR token_count > lim
  OR NOT coalesce(regexp_full_match(part_input_sha256, '[0-9a-f]{64}'), false) OR NOT coalesce(regexp_full_match(article_input_sha256, '[0-9a-f]{64}'), false)
UNION ALL SELECT 'invalid_work_state', count(*) FROM j WHERE state NOT IN ('eligible', 'queued', 'in_progress', 'succeeded', 'retryable', 'terminal', 'interrupted', 'not_applicable', 'stale_input', 'stale_configuration')
UNION ALL SELECT 'invalid_failure_checkpoint', count(*) FROM j WHERE (state IN ('retryable', 'terminal') AND error_code IS NULL) OR (state NOT IN ('retryable', 'terminal') AND error_code IS NOT NULL) OR attempt_count > att
UNION ALL SELECT 'invalid_generation_run_reference', count(*) FROM j WHERE last_run_id IS NULL OR last_run_id NOT IN (SELECT run_id FROM runs)
UNION ALL SELECT 'invalid_long_text_source_coverage', count(*) FROM gaps WHERE gaps > 0 OR parts <> part_count) WHERE n > 0""",
    "part_plans": r"""WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS item, doc_id, text, length(text) AS n FROM documents WHERE length(text) > 2000),
hits AS (SELECT item, list_transform(string_split_regex(text, '(?:\r?\n[ \t]*){2,}'), lambda x: length(x)) AS gaps, list_transform(regexp_extract_all(text, '(?:\r?\n[ \t]*){2,}'), lambda x: length(x)) AS seps FROM d),
cells AS (SELECT item, i, gaps[i] + seps[i] AS step FROM hits, LATERAL (SELECT unnest(range(1, len(seps) + 1)) AS i) r),
ends AS (SELECT item, sum(step) OVER (PARTITION BY item ORDER BY i) AS p FROM cells UNION SELECT item, n FROM d UNION SELECT item, 0 FROM d),
k AS (SELECT item, n, list(p::bigint) AS edges FROM ends JOIN d USING (item) GROUP BY ALL),
walk AS (SELECT item, -1 AS part_index, 0::bigint AS s, 0::bigint AS e, n, edges FROM k
UNION ALL SELECT item, part_index + 1, e, CASE WHEN list_contains(edges, e) THEN coalesce(list_max(list_filter(edges, lambda p: p > e AND p <= e + 2000)), e + 2000)
    ELSE coalesce(list_min(list_filter(edges, lambda p: p > e AND p <= e + 2000)), e + 2000) END, n, edges FROM walk WHERE e < n)
SELECT doc_id, part_index::int AS part_index, s AS char_start, e AS char_end, octet_length(encode(left(text, s::int)))::bigint AS byte_start, octet_length(encode(left(text, e::int)))::bigint AS byte_end, sha256(substring(text, s::int + 1, (e - s)::int)) AS part_input_sha256, (e - s)::int AS token_count
FROM walk JOIN d USING (item) WHERE part_index >= 0""",
    "storage_digest": r"""WITH h AS (SELECT sha256('{"article_id":' || coalesce('"' || article_id || '"', 'null') || ',"modality":' || coalesce('"' || modality || '"', 'null') || ',"configuration_id":' || coalesce('"' || configuration_id || '"', 'null') || ',"input_sha256":' || coalesce('"' || input_sha256 || '"', 'null') || ',"stored_vector_sha256":' || coalesce('"' || stored_vector_sha256 || '"', 'null') || '}') AS h FROM embedding_storage),
w AS (SELECT list_transform(range(0, 8), lambda i: ('0x' || substr(h, (8 * i + 1)::int, 8))::bigint) AS w FROM h)
SELECT count(*) AS n, bit_xor(w[1]) AS x0, bit_xor(w[2]) AS x1, bit_xor(w[3]) AS x2, bit_xor(w[4]) AS x3, bit_xor(w[5]) AS x4, bit_xor(w[6]) AS x5, bit_xor(w[7]) AS x6, bit_xor(w[8]) AS x7,
  sum(w[1])::bigint AS s0, sum(w[2])::bigint AS s1, sum(w[3])::bigint AS s2, sum(w[4])::bigint AS s3, sum(w[5])::bigint AS s4, sum(w[6])::bigint AS s5, sum(w[7])::bigint AS s6, sum(w[8])::bigint AS s7 FROM w""",
    "part_plan_checks": "SELECT doc_id, length(text) AS chars, octet_length(encode(text)) AS bytes, true AS within FROM documents WHERE length(text) > 2000",
    "publication_mismatches": _CAND + "SELECT s.article_id, s.modality, s.configuration_id FROM embedding_storage s JOIN art a USING (article_id) WHERE s.published_at_utc IS DISTINCT FROM a.published_at_utc + CASE WHEN substr(sha256(article_id), 1, 1) = '1' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END",
    "stored_or_planned": _CAND
    + """SELECT a.article_id, EXISTS (SELECT 1 FROM embedding_storage s WHERE s.article_id = a.article_id AND s.modality = 'article_text') AS has_text, EXISTS (SELECT 1 FROM long_text_parts p WHERE p.article_id = a.article_id) AS has_parts,
  EXISTS (SELECT 1 FROM duplicates d WHERE d.article_id = a.article_id) AS has_duplicates, (SELECT count(*) FROM embedding_storage s WHERE s.article_id = a.article_id) AS vectors FROM art a""",
    "generations_by_run": """WITH every AS (SELECT last_run_id FROM candidates UNION ALL SELECT last_run_id FROM long_text_parts)
SELECT r.run_id, r.status, (SELECT count(*) FROM every e WHERE e.last_run_id = r.run_id) AS generations, (SELECT count(*) FROM source_manifest m WHERE m.last_run_id = r.run_id) AS claims FROM runs r WHERE generations <> claims""",
    "registered_work": _CAND
    + ", "
    + _V
    + """, d AS (SELECT a.article_id, 'article_text' AS modality, c.configuration_id, sha256(a.article_id) AS h, 'present' AS ap FROM art a, embedding_configurations c
  UNION ALL SELECT a.article_id, 'header_image', c.configuration_id, sha256(a.header_image_path), CASE WHEN a.header_image_path IS NULL THEN 'not_applicable' ELSE 'present' END FROM art a, embedding_configurations c),
x AS (SELECT d.*, w.state AS prior_state, w.input_sha256 AS w_input, CASE WHEN ap = 'not_applicable' THEN 'disapply' WHEN w.state IS NULL THEN 'insert' WHEN w.input_sha256 IS DISTINCT FROM d.h THEN 'supersede'
  WHEN w.state = 'succeeded' THEN 'reuse' ELSE 'keep' END AS action FROM d LEFT JOIN wk w USING (article_id, modality, configuration_id))
SELECT article_id, modality, configuration_id, prior_state, CASE action WHEN 'disapply' THEN 'not_applicable' WHEN 'insert' THEN 'eligible' WHEN 'supersede' THEN 'eligible' WHEN 'reuse' THEN 'succeeded' ELSE prior_state END AS state, action,
  action = 'supersede' OR (action = 'disapply' AND w_input IS NOT NULL) AS invalidates_composite FROM x""",
    "reconciliation_actions": _ACTIONS + "SELECT * FROM act",
    "visible_vectors": _ACTIONS + "SELECT article_id, modality, configuration_id, input_sha256 FROM embedding_storage s WHERE NOT EXISTS (SELECT 1 FROM act WHERE act.article_id = s.article_id AND act.modality = s.modality AND act.configuration_id = s.configuration_id)",
    "visible_work": _ACTIONS
    + """SELECT article_id, modality, configuration_id, source_relative_path, input_sha256, state, 1 AS attempt_count FROM wk w WHERE NOT EXISTS (SELECT 1 FROM act WHERE act.article_id = w.article_id AND act.modality = w.modality AND act.configuration_id = w.configuration_id)
UNION ALL SELECT article_id, modality, configuration_id, target_source_relative_path, NULL, target_state, 0 FROM act""",
    "compacted_history": _ACTIONS
    + """SELECT s.article_id, s.modality, s.configuration_id, substr(s.input_sha256, 1, 12) AS generation_run_id, s.input_sha256, s.stored_vector_sha256, 'run-full' AS superseded_run_id, 'input_changed' AS superseded_reason
  FROM embedding_storage s JOIN act ON act.article_id = s.article_id AND act.modality = s.modality AND act.configuration_id = s.configuration_id""",
    "vector_hash_mismatches": "SELECT article_id, modality, configuration_id, repeat('0', 64) AS stored_vector_sha256 FROM embedding_storage WHERE vector IS NOT NULL AND len(list_filter(vector, lambda x: x IS NULL)) = 0 AND substr(sha256(article_id), 1, 1) = '0'",
    "rolling_quota": "SELECT event_id, count(*) OVER w AS window_requests, (sum(event_id % 97) OVER w)::bigint AS window_tokens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)",
    "rolling_quota_of_all": "SELECT event_id, count(*) OVER w AS window_requests, (sum(event_id % 97) OVER w)::bigint AS window_tokens FROM events WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)",
    "greedy_packing": """WITH RECURSIVE d AS (SELECT coalesce(source, '') AS grp, doc_id, coalesce(length(text), 0) AS t, coalesce(octet_length(encode(text)), 0) AS b FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) AS rn FROM d),
f AS (SELECT grp, doc_id, rn, CASE WHEN t > 45000 OR b > 8000000 THEN 0 ELSE 1 END AS n, CASE WHEN t > 45000 OR b > 8000000 THEN 0 ELSE t END AS st, CASE WHEN t > 45000 OR b > 8000000 THEN 0 ELSE b END AS sb, CASE WHEN t > 45000 OR b > 8000000 THEN 0 ELSE 1 END AS batch, t > 45000 OR b > 8000000 AS bad FROM o WHERE rn = 1
UNION ALL SELECT o.grp, o.doc_id, o.rn, CASE WHEN x.bad THEN f.n WHEN x.new THEN 1 ELSE f.n + 1 END, CASE WHEN x.bad THEN f.st WHEN x.new THEN o.t ELSE f.st + o.t END, CASE WHEN x.bad THEN f.sb WHEN x.new THEN o.b ELSE f.sb + o.b END,
  CASE WHEN x.bad THEN f.batch WHEN x.new THEN f.batch + 1 ELSE f.batch END, x.bad FROM f JOIN o ON o.grp = f.grp AND o.rn = f.rn + 1,
  LATERAL (SELECT o.t > 45000 OR o.b > 8000000 AS bad, f.batch = 0 OR f.n + 1 > 16 OR f.st + o.t > 45000 OR f.sb + o.b > 8000000 AS new) x)
SELECT grp, doc_id, CASE WHEN bad THEN NULL ELSE batch::bigint END AS batch_no FROM f""",
    "retry_delays": "SELECT p_partkey, round(least(30.0, greatest(least(30.0, pow(2.0, p_size % 7)), CASE WHEN p_size % 3 = 0 THEN p_size / 4.0 ELSE 0 END, CASE WHEN p_size % 5 = 0 THEN 12.5 ELSE 0.0 END) + (p_size % 10) / 10.0)::double, 6) AS delay_seconds FROM part",
    "http_outcomes": """SELECT p_partkey, status, CASE WHEN status BETWEEN 200 AND 299 THEN NULL WHEN status = 401 THEN 'authentication' WHEN status = 403 THEN 'authorization' WHEN status = 429 THEN 'rate_limit' WHEN status IN (400, 404, 409, 413, 422) THEN 'deterministic_request'
  WHEN status BETWEEN 500 AND 599 THEN 'transient_server' ELSE 'request_failure' END AS code, CASE WHEN status BETWEEN 200 AND 299 THEN NULL ELSE status = 429 OR status BETWEEN 500 AND 599 END AS retryable FROM (SELECT p_partkey, (200 + (p_partkey * 7) % 400)::int AS status FROM part)""",
    "image_admissions": """WITH p AS (SELECT p_partkey, p_partkey % 10 = 0 AS thin, CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE p_size * 211 + 1 END::int AS w, CASE WHEN p_partkey % 10 = 0 THEN 30000000 + p_partkey ELSE p_partkey % 9000 + 1 END::int AS h, trunc(p_retailprice * 4000)::bigint AS b FROM part),
s AS (SELECT *, CASE WHEN w::bigint * h > 20000000 THEN sqrt(20000000.0::double / (w::double * h)) ELSE 1.0 END AS k FROM p), t AS (SELECT *, CASE WHEN thin THEN 1 ELSE greatest(1, floor(w * k)) END::int AS sw, CASE WHEN thin THEN 20000000 ELSE greatest(1, floor(h * k)) END::int AS sh FROM s)
SELECT p_partkey, CASE WHEN b <= 5000000 AND w::bigint * h <= 20000000 THEN 'pass_through' ELSE 'render' END AS admission, sw AS scaled_width, sh AS scaled_height, (ceil(sw / 28.0) * ceil(sh / 28.0) * 10)::bigint AS tokens FROM t""",
    "event_properties": "SELECT event_type, k AS name, count(*) AS events, count(DISTINCT json_extract_string(props, '$.' || k)) AS distinct_values FROM (SELECT event_type, props, unnest(json_keys(props)) AS k FROM events) GROUP BY ALL",
}
ORACLE["compacted_work"] = ORACLE["visible_work"]
