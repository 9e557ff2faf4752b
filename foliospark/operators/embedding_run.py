"""One embedding run over a snapshot: inventory, work, vectors, composites, reconciliation, one commit.

The run is recorded as running before anything is asked of a provider, and ends as succeeded or failed,
once. Texts, header images and composites go through the same register of work; what is proven by a
stored vector of the same input is reused, superseded generations go to the history, and every vector
made leaves its provenance. All tables change in one commit.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import schemas
from foliospark.functions import images as img
from foliospark.operators import batching, embed, quota, reconcile
from foliospark.operators import work as wk
from foliospark.operators.embedding_validation import Catalogue
from foliospark.sources import sinks
from foliospark.sources.store import Store, insert_ignore, upsert
from foliospark.sources.tables import stage

KEY = wk.KEY
#: The public columns of the synthetic configuration, and what a hosted one has in their place by default.
PROFILE = {
    "model": "synthetic", "observed_model": "synthetic", "client_api_contract_version": schemas.SYNTHETIC_CONTRACT, "task": "document", "dimensions": 16, "output_type": "float", "normalization": "l2-client-float32-v1", "tokenizer_revision": "synthetic-codepoints-v1",
    "tokenizer_engine": "synthetic-codepoints-v1", "context_token_limit": 8000, "context_rules": "markdown-block-greedy-no-overlap-truncate-false-v1", "long_text_aggregation": "l2-token-count-weighted-mean-float32-v1", "long_text_part_attempt_limit": 3, "batch_max_items": 16, "batch_max_estimated_tokens": 45000,
    "batch_max_encoded_bytes": 8000000, "batch_max_response_bytes": 2000000, "batch_max_concurrency": 2, "batch_max_attempts": 3, "batch_initial_backoff_seconds": 1.0, "batch_max_backoff_seconds": 30.0, "quota_max_requests": 90, "quota_max_estimated_tokens": 90000, "quota_window_seconds": 60,
    "image_input_rules": "header-facts-v1", "image_transform": "none-v1", "multimodal_formula": "l2-normalize-0.5-text-0.5-image-v1", "client_configuration_version": "config-v1",
}


class NotAuthorized(RuntimeError):
    """A hosted provider may be asked only with an explicit authorization."""


class ConfigurationDrift(RuntimeError):
    """The provider answers with another model than the configuration has observed."""


class RunClosed(RuntimeError):
    """A run ends once."""


def configuration(**changed: object) -> dict:
    """A configuration with its identity, the SHA-256 of the compact JSON of its public columns, names in order."""
    public = PROFILE | changed
    return {"configuration_id": hashlib.sha256(json.dumps(public, sort_keys=True, separators=(",", ":")).encode()).hexdigest(), **public}


def policy_of(c: dict) -> batching.Policy:
    return batching.Policy(
        c["batch_max_items"], c["batch_max_estimated_tokens"], c["batch_max_encoded_bytes"], c["batch_max_concurrency"], c["batch_max_attempts"], c["batch_initial_backoff_seconds"], c["batch_max_backoff_seconds"], c["quota_max_requests"], c["quota_max_estimated_tokens"], c["quota_window_seconds"],
    )


def _rows(store: Store, name: str, *rows: dict) -> DataFrame:
    s = schemas.schema(name)
    return store.spark.createDataFrame([tuple(r.get(f.name) for f in s) for r in rows], s)


def _as(df: DataFrame, name: str, **given: object) -> DataFrame:
    """The frame in a table's layout; columns it lacks are null or as given."""
    column = lambda f: (given[f.name] if hasattr(given.get(f.name), "cast") else F.lit(given[f.name])) if f.name in given else F.col(f.name) if f.name in df.columns else F.lit(None)
    return df.select(*[column(f).cast(f.dataType).alias(f.name) for f in schemas.schema(name)])


def close_run(runs: DataFrame, run_id: str, status: str, **numbers: object) -> DataFrame:
    """The runs with one ended; only a running one can end."""
    if status not in ("succeeded", "failed", "interrupted"):
        raise ValueError(status)
    if not runs.filter((F.col("run_id") == run_id) & (F.col("status") == "running")).count():
        raise RunClosed(run_id)
    own = F.col("run_id") == run_id
    given = {"status": status, "finished_at": datetime.now(UTC), **numbers}
    return runs.select(*[F.when(own, F.lit(given[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in given else F.col(f.name) for f in runs.schema])


def begin(store: Store, conf: dict, scope: str) -> str:
    """Record a run as running; runs that were left running are interrupted first."""
    run_id, base = f"run-{uuid.uuid4().hex[:12]}", store.version()
    runs = store.read("embedding_runs", base)
    left = F.col("status") == "running"
    runs = runs.withColumns({"finished_at": F.when(left, F.current_timestamp()).otherwise(F.col("finished_at")), "status": F.when(left, "interrupted").otherwise(F.col("status"))})
    zero = {f.name: 0 for f in schemas.schema("embedding_runs") if f.dataType.simpleString() == "int"}
    record = zero | {"run_id": run_id, "configuration_id": conf["configuration_id"], "scope": scope, "status": "running", "discovery_complete": False, "reconciliation_complete": False, "usage_json": "{}", "elapsed_seconds": 0.0, "started_at": datetime.now(UTC)}
    known = insert_ignore(store.read("embedding_configurations", base), _rows(store, "embedding_configurations", conf), ["configuration_id"])
    store.commit({"embedding_runs": runs.unionByName(_rows(store, "embedding_runs", record)), "embedding_configurations": known}, base, {"run_id": run_id})
    return run_id


def header_inputs(scope: DataFrame, files: DataFrame, codec: Callable[[bytes], bytes] | None) -> DataFrame:
    """Each article's header: applicability, the image's hash and facts, what is embedded, and a local error code.

    files: path, data. An image within the ceilings is embedded as it is; a larger one needs a codec, which
    turns bytes into those of a JPEG within them.
    """
    f = files.select(F.col("path").alias("f_path"), F.col("data").alias("source"))
    j = scope.select("article_id", "header_image_path").join(f, F.col("header_image_path") == F.col("f_path"), "left").drop("f_path")
    facts = img.inspect(j, "source")
    code = img.problem(F.col("format"), F.col("width"), F.col("height"), F.col("frames"))
    renders = img.admission(F.octet_length("source"), F.col("width"), F.col("height")) == "render"
    known = facts.withColumns({"code": F.when(F.col("source").isNotNull(), code), "renders": F.col("source").isNotNull() & code.isNull() & renders})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for data, wanted in zip(pdf["source"], pdf["renders"]):
                made, problem = None, None
                if wanted:
                    try:
                        made = codec(data) if codec else None
                    except Exception:  # whatever a codec throws means that it could not encode
                        made = None
                    fmt, w, h, _ = img.facts(made)
                    problem = "image_encode_failure" if made is None or fmt != "jpeg" else "derived_image_oversized" if len(made) > img.MAX_BYTES or w * h > img.MAX_PIXELS else None
                out.append((made if not problem else None, problem))
            pdf["made"], pdf["made_code"] = zip(*out) if out else ((), ())
            yield pdf

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in known.schema)
    done = known.mapInPandas(encode, schema + ", made binary, made_code string")
    embedded = F.coalesce("made", "source")
    e = img.inspect(done.withColumn("embedded", embedded).withColumnsRenamed({c: f"source_{c}" for c in ("format", "width", "height", "frames")}), "embedded").withColumnsRenamed({c: f"embedded_{c}" for c in ("format", "width", "height", "frames")})
    return e.select(
        "article_id", "header_image_path", F.when(F.col("header_image_path").isNull(), "not_applicable").when(F.col("source").isNull(), "missing").otherwise("present").alias("applicability"), F.sha2("source", 256).alias("input_sha256"), F.coalesce("code", "made_code").alias("local_code"), F.col("embedded").alias("data"),
        img.token_estimate(F.col("embedded_width"), F.col("embedded_height")).alias("tokens"), F.col("made").isNotNull().alias("rendered"), F.sha2("embedded", 256).alias("embedded_input_sha256"), F.octet_length("source").alias("source_bytes"), F.octet_length("embedded").alias("embedded_bytes"),
        *(f"{side}_{c}" for side in ("source", "embedded") for c in ("format", "width", "height", "frames")),
    )


def run(store: Store, articles: DataFrame, provider: embed.Provider, conf: dict, files: DataFrame | None = None, limit: int | None = None, reprocess: bool = False, authorized: bool = False, codec: Callable[[bytes], bytes] | None = None, rendition_root: str | None = None) -> dict:
    """Embed articles (article_id, text, header_image_path, published_at_utc, publication_date_new_york); files are the images (path, data).

    A limited run takes the first articles by id and reconciles nothing; a full run also retires work of
    articles that are gone. Articles without an id or a text take no part. Images that the codec made are
    installed below `rendition_root`, if given, before the commit; a full run removes there what nothing
    refers to any more. Returns the run's record.
    """
    if not provider.synthetic and not authorized:
        raise NotAuthorized("a hosted provider needs an authorization")
    began = time.monotonic()
    run_id = begin(store, conf, "full" if limit is None else "limited")
    base = store.version()
    try:
        changed, numbers = _work_off(store, base, run_id, articles, provider, conf, files, limit, reprocess, codec, rendition_root)
    except Exception:
        store.commit({"embedding_runs": close_run(store.read("embedding_runs", base), run_id, "failed", elapsed_seconds=time.monotonic() - began)}, base, {"run_id": run_id})
        raise
    ended = close_run(store.read("embedding_runs", base), run_id, "succeeded", discovery_complete=limit is None, reconciliation_complete=limit is None, elapsed_seconds=time.monotonic() - began, **{k: v for k, v in numbers.items() if k in schemas.schema("embedding_runs").names})
    store.commit(changed | {"embedding_runs": ended}, base, {"run_id": run_id})
    if rendition_root and limit is None:
        removed = sinks.remove_orphans(sinks.tree(store.spark, rendition_root, "renditions"), changed["image_input_provenance"], rendition_root, "rendition_relative_path")
        numbers["renditions_removed"] = removed.filter("removed").count()
    return {"run_id": run_id, **numbers}


def _work_off(store: Store, base: int, run_id: str, articles: DataFrame, provider: embed.Provider, conf: dict, files: DataFrame | None, limit: int | None, reprocess: bool, codec: Callable[[bytes], bytes] | None, rendition_root: str | None) -> tuple[dict[str, DataFrame], dict]:
    spark, cid, policy = store.spark, conf["configuration_id"], policy_of(conf)
    old = {t: store.read(t, base) for t in ("embedding_work", "embedding_storage", "generation_history", "full_run_articles", "multimodal_embedding_provenance", "image_input_provenance", "long_text_parts", "long_text_part_generations", "article_text_aggregation_provenance")}
    work, vectors, reservations = old["embedding_work"], old["embedding_storage"], store.read("hosted_request_reservations", base)
    headers = "header_image_path" in articles.columns
    scope = articles.filter("article_id is not null and text is not null and text <> ''").select("article_id", "text", (F.col("header_image_path") if headers else F.lit(None).cast("string")).alias("header_image_path"), "published_at_utc", "publication_date_new_york")
    scope = stage(scope.orderBy("article_id").limit(limit) if limit is not None else scope, "inventory")
    files = files if files is not None else spark.createDataFrame([], "path string, data binary")
    image = stage(header_inputs(scope, files, codec), "headers")
    tries = ["eligible", "interrupted", "retryable"]

    # Texts and headers: what is to be done, and what comes of it.
    desired = lambda df, modality, path, given, applies: df.select("article_id", F.lit(modality).alias("modality"), F.lit(cid).alias("configuration_id"), path.alias("source_relative_path"), given.alias("input_sha256"), applies.alias("applicability"))
    none = F.lit(None).cast("string")
    wanted = desired(scope, "article_text", none, F.sha2("text", 256), F.lit("present")).unionByName(desired(image, "header_image", F.col("header_image_path"), F.col("input_sha256"), F.col("applicability")))
    registered = stage(wk.register(wanted, work, vectors, reprocess), "registered")
    due = lambda modality: registered.filter((F.col("modality") == modality) & F.col("state").isin(tries)).select("article_id")
    quota_of = reservations.filter(F.col("configuration_id") == cid).select("reserved_at", F.coalesce("observed_input_tokens", "estimated_tokens").alias("tokens"))
    made_before = [] if provider.streams is None else quota.within_window(quota_of, datetime.now(UTC), policy)
    own_parts = old["long_text_parts"].filter(F.col("configuration_id") == cid)
    known = own_parts.filter("false") if reprocess else own_parts
    texts, parts = embed.embed_texts(scope.join(due("article_text"), "article_id", "left_semi").select("article_id", "text"), provider, conf["context_token_limit"], policy, known, conf["long_text_part_attempt_limit"], made_before)
    texts, parts = stage(texts, "texts"), stage(parts, "text-parts")
    todo = image.join(due("header_image"), "article_id", "left_semi").filter("applicability = 'present'")
    booked_by = lambda df: df.select(F.explode("booked").alias("b")).select(F.col("b.at").alias("reserved_at"), F.col("b.estimated").alias("estimated_tokens"), F.col("b.observed").alias("observed_input_tokens"))
    made_now = [] if provider.streams is None else quota.within_window(booked_by(texts).select("reserved_at", F.coalesce("observed_input_tokens", "estimated_tokens").alias("tokens")), datetime.now(UTC), policy)
    pictures = stage(embed.embed_images(todo.filter("local_code is null"), provider, policy, made_before + made_now), "pictures")
    models = texts.agg(F.min("least_model").alias("a"), F.max("most_model").alias("b")).unionAll(pictures.agg(F.min("least_model"), F.max("most_model"))).collect()
    if seen := {m for r in models for m in r if m is not None} - {conf["observed_model"]}:
        raise ConfigurationDrift(f"configuration_drift: {sorted(seen)[0]}")
    columns = ["state", "vector", "error_code", "status_code", "retry_after_seconds", "attempt_count", "calls", "derivation_kind", "raw_response_sha256", "response_model", "stored_vector_sha256", "units"]
    local = todo.filter("local_code is not null").select("article_id", F.lit("terminal").alias("state"), F.col("local_code").alias("error_code"), F.lit(0).alias("attempt_count"), F.lit(0).alias("calls"))
    outcomes = texts.select("article_id", F.lit("article_text").alias("modality"), *columns).unionByName(pictures.select("article_id", F.lit("header_image").alias("modality"), *columns)).unionByName(local.withColumn("modality", F.lit("header_image")), allowMissingColumns=True)
    done = stage(outcomes.withColumn("configuration_id", F.lit(cid)), "done")

    # Work and vectors after texts and headers.
    dropped = registered.filter("action in ('supersede', 'recover', 'disapply', 'await_input')").select(*KEY, F.coalesce("reason", F.lit("input_changed")).alias("superseded_reason"))
    archive = lambda lost: _as(lost.join(work.select(*KEY, "generation_run_id"), KEY), "generation_history", superseded_run_id=run_id, superseded_at=F.current_timestamp()).filter("generation_run_id is not null")
    lost = vectors.join(dropped, KEY)
    kept = vectors.join(dropped.select(*KEY), KEY, "left_anti").select(*vectors.columns)
    dates = scope.select("article_id", "published_at_utc", "publication_date_new_york")
    made = done.filter("state = 'succeeded'").join(registered.select(*KEY, "source_relative_path", "input_sha256"), KEY).join(dates, "article_id")
    fresh = stage(_as(made, "embedding_storage", dimensions=provider.dimensions), "fresh")
    prior = work.select(*KEY, F.col("attempt_count").alias("w_attempts"), F.col("generation_run_id").alias("w_generation"), F.col("error_code").alias("w_error"), F.col("status_code").alias("w_status"), F.col("retry_after_seconds").alias("w_retry"))
    o = done.select(*KEY, F.col("state").alias("d_state"), "error_code", "status_code", "retry_after_seconds", F.col("attempt_count").alias("d_attempts"), "units")
    j = registered.join(o, KEY, "left").join(prior, KEY, "left")
    state, asked, waits = F.coalesce("d_state", "state"), F.col("d_state").isNotNull(), F.col("action") == "await_input"
    same = lambda new, before: F.when(asked, F.col(new)).when(F.col("state").isin("retryable", "terminal") & (F.col("action") == "keep"), F.col(before))
    attempts = F.when(asked & (F.coalesce("units", F.lit(1)) == 1) & (F.col("action") != "supersede"), F.coalesce("w_attempts", F.lit(0)) + F.col("d_attempts")).when(asked, F.col("d_attempts")).when(F.col("action").isin("reuse", "keep", "recover"), F.coalesce("w_attempts", F.lit(0))).otherwise(F.lit(0))
    new_work = _as(
        j.withColumn("_state", state), "embedding_work", state=F.col("_state"), attempt_count=attempts, error_code=F.when(waits, "missing_header_image").otherwise(same("error_code", "w_error")), status_code=same("status_code", "w_status"), retry_after_seconds=same("retry_after_seconds", "w_retry"), last_run_id=run_id,
        source_relative_path=F.when(F.col("action") != "disapply", F.col("source_relative_path")), generation_run_id=F.when(F.col("d_state") == "succeeded", F.lit(run_id)).when(state == "succeeded", F.col("w_generation")), updated_at=F.current_timestamp(),
    )
    sources = stage(upsert(work, new_work, KEY), "source-work")
    held = stage(upsert(kept, fresh, KEY), "source-vectors")

    # Composites of what is current on both sides now.
    current = held.filter(F.col("configuration_id") == cid).join(sources.filter("state = 'succeeded'").select(*KEY, "generation_run_id"), KEY).join(scope.select("article_id"), "article_id", "left_semi")
    side = lambda m: current.filter(F.col("modality") == m).select("article_id", "generation_run_id", "stored_vector_sha256", "vector")
    both = stage(embed.composites(side("article_text"), side("header_image"), conf["multimodal_formula"]), "composites")
    joined = stage(wk.register(desired(both, "multimodal_article", none, F.col("input_sha256"), F.lit("present")), sources, held, reprocess), "joined")
    publish = joined.filter(F.col("action") != "reuse").select("article_id")
    new_composites = stage(_as(both.join(publish, "article_id", "left_semi").join(dates, "article_id"), "embedding_storage", modality="multimodal_article", configuration_id=cid, source_relative_path=none, dimensions=provider.dimensions, derivation_kind="multimodal_midpoint", raw_response_sha256=none, response_model=none), "new-composites")
    alone = sources.filter((F.col("modality") == "multimodal_article") & (F.col("configuration_id") == cid) & (F.col("state") == "succeeded")).join(scope.select("article_id"), "article_id", "left_semi").join(both.select("article_id"), "article_id", "left_anti")
    replaced = held.join(joined.filter("action in ('supersede', 'recover')").select(*KEY, F.coalesce("reason", F.lit("input_changed")).alias("superseded_reason")).unionByName(alone.select(*KEY, F.lit("input_changed").alias("superseded_reason"))), KEY)
    composite_work = _as(
        joined.join(work.select(*KEY, F.col("generation_run_id").alias("w_generation")), KEY, "left"), "embedding_work", state="succeeded", attempt_count=0, last_run_id=run_id, generation_run_id=F.when(F.col("action") == "reuse", F.col("w_generation")).otherwise(run_id), updated_at=F.current_timestamp(),
        error_code=none, status_code=F.lit(None), retry_after_seconds=F.lit(None),
    ).unionByName(_as(alone, "embedding_work", state="eligible", attempt_count=0, last_run_id=run_id, generation_run_id=none, updated_at=F.current_timestamp()))
    history = insert_ignore(old["generation_history"], archive(lost).unionByName(archive(replaced)), [*KEY, "generation_run_id"])
    new_work = stage(upsert(sources, composite_work, KEY), "work")
    new_vectors = stage(upsert(held.join(replaced.select(*KEY), KEY, "left_anti").select(*held.columns), new_composites, KEY), "vectors")

    # Provenance of everything made.
    now = F.current_timestamp()
    told = both.join(publish, "article_id", "left_semi").select("article_id", F.col("text_run").alias("text_generation_run_id"), F.col("text_hash").alias("text_stored_vector_sha256"), F.col("header_run").alias("header_image_generation_run_id"), F.col("header_hash").alias("header_image_stored_vector_sha256"))
    pictured = image.join(pictures.filter("state = 'succeeded'").select("article_id"), "article_id", "left_semi").withColumns({"source_sha256": F.col("input_sha256"), "transform_id": F.lit(conf["image_transform"])})
    rendition = F.when(F.col("rendered"), F.concat(F.lit("renditions/"), F.sha2("transform_id", 256), F.lit("/"), F.col("embedded_input_sha256"), F.lit(".jpg")))
    if rendition_root:
        made_files = pictured.filter("rendered").select(rendition.alias("path"), F.col("embedded_input_sha256").alias("sha256"), "data").dropDuplicates(["path"])
        if conflict := sinks.write_files(made_files, rendition_root).filter("outcome = 'conflict'").take(1):
            raise RuntimeError(f"another file is at {conflict[0].path}")
    mark = {"configuration_id": cid, "generation_run_id": run_id, "created_at": now}
    tried = parts.withColumnRenamed("input_sha256", "part_input_sha256").withColumn("derivation_kind", F.when(F.col("state") == "succeeded", F.lit("synthetic_fixture" if provider.synthetic else "hosted_response")))
    bare = {c: none for c in ("raw_response_sha256", "response_model")} if provider.synthetic else {}
    generation = F.when(F.col("state") == "succeeded", F.coalesce("earlier_run", F.lit(run_id)))
    checkpoints = _as(tried, "long_text_parts", configuration_id=cid, last_run_id=run_id, generation_run_id=generation, updated_at=now, **bare)
    born = _as(tried.filter("state = 'succeeded' and earlier_run is null"), "long_text_part_generations", **mark, **bare)
    whole = tried.join(done.filter("modality = 'article_text' and derivation_kind = 'long_text_aggregate' and state = 'succeeded'").select("article_id"), "article_id", "left_semi")
    aggregated = _as(whole, "article_text_aggregation_provenance", **mark, part_generation_run_id=F.coalesce("earlier_run", F.lit(run_id)), part_stored_vector_sha256=F.col("stored_vector_sha256"), aggregation_version=conf["long_text_aggregation"])
    part_key = ["article_id", "configuration_id", "article_input_sha256", "part_index"]
    requests = booked_by(texts).unionByName(booked_by(pictures)).withColumn("reservation_id", F.concat(F.lit(run_id + "-"), F.monotonically_increasing_id()))
    booked = stage(_as(requests, "hosted_request_reservations", run_id=run_id, configuration_id=cid), "reservations")
    changed = {
        "hosted_request_reservations": reservations.filter(F.col("configuration_id") != cid).unionByName(quota.live(reservations.filter(F.col("configuration_id") == cid), F.current_timestamp(), policy)).unionByName(booked),  # older ones bind nobody
        "multimodal_embedding_provenance": old["multimodal_embedding_provenance"].unionByName(_as(told, "multimodal_embedding_provenance", **mark, formula_version=conf["multimodal_formula"])),
        "image_input_provenance": old["image_input_provenance"].unionByName(_as(pictured, "image_input_provenance", **mark, rendition_relative_path=rendition)),
        "long_text_parts": upsert(old["long_text_parts"].join(checkpoints.select("article_id", "configuration_id").distinct(), ["article_id", "configuration_id"], "left_anti").select(*old["long_text_parts"].columns), checkpoints, part_key),
        "long_text_part_generations": insert_ignore(old["long_text_part_generations"], born, [*part_key, "generation_run_id"]),
        "article_text_aggregation_provenance": old["article_text_aggregation_provenance"].unionByName(aggregated),
    }

    # A full run retires what it no longer saw.
    retired = 0
    if limit is None:
        seen = scope.select("article_id", "header_image_path")
        actions = stage(reconcile.stage_actions(new_work.filter(F.col("configuration_id") == cid).filter("state <> 'stale_input'"), new_vectors, seen, run_id), "actions")
        retired = actions.count()
        if reconcile.unexpected(actions, new_work, new_vectors).count():
            raise RuntimeError("the base of the reconciliation has changed")
        complete = spark.createDataFrame([(run_id, True)], "run_id string, reconciliation_complete boolean")
        new_work, new_vectors, history, _ = reconcile.compact(new_work, new_vectors, history, actions, complete)
        changed["full_run_articles"] = old["full_run_articles"].unionByName(_as(seen, "full_run_articles", run_id=run_id))
    n = {f"{r.modality}:{r.state}": r["count"] for r in done.groupBy("modality", "state").count().collect()}
    total = lambda s: sum(v for k, v in n.items() if k.endswith(":" + s))
    headers_now = {r.state: r["count"] for r in registered.join(o, KEY, "left").filter("modality = 'header_image'").select(state.alias("state")).groupBy("state").count().collect()}
    calls = done.agg(F.coalesce(F.sum("units"), F.lit(0)).alias("units"), F.coalesce(F.sum("calls"), F.lit(0)).alias("calls")).first()
    numbers = {
        "articles": scope.count(), "embeddings": fresh.count() + new_composites.count(), "reused": registered.filter("action = 'reuse'").count() + joined.filter("action = 'reuse'").count(), "attempted": done.filter("attempt_count > 0").count(), "succeeded": total("succeeded"), "retryable": total("retryable"), "terminal": total("terminal"),
        "interrupted": 0, "header_absent": headers_now.get("not_applicable", 0), "header_failed": headers_now.get("retryable", 0) + headers_now.get("terminal", 0), "hosted_requests": booked.count() if provider.streams is not None else 0 if provider.synthetic else int(calls["calls"]), "hosted_retries": 0 if provider.synthetic else int(max(0, calls["calls"] - calls["units"])), "retired": retired, "composites": new_composites.count(),
        **{r.action: r["count"] for r in registered.groupBy("action").count().collect() if r.action != "reuse"},
    }
    tables = {"embedding_work": new_work, "embedding_storage": new_vectors, "generation_history": history}
    return changed | {t: _as(df, t) for t, df in tables.items()}, numbers


def catalogue(store: Store) -> Catalogue:
    """The store's latest version as the validator takes it."""
    version = store.version()
    return Catalogue(**{name: store.read(name, version) for name in Catalogue.__dataclass_fields__})


def inventory(articles: DataFrame) -> dict:
    """How many articles there are, and how many of them have a header image."""
    r = articles.agg(F.count("*").alias("canonical"), F.count("header_image_path").alias("present")).first()
    return {"canonical_articles": r.canonical, "header_present": r.present, "header_absent": r.canonical - r.present}

