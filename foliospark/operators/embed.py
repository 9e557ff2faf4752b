"""Obtaining vectors: providers, waves of batches with retries, long texts, images, composites.

A provider is any object with `embed(items) -> outcomes`. Calls run in a map over batches; outcomes are
written to a staged table before anything is derived from them, so a repeated stage reads outcomes and
does not call again. Every call carries the item's key and input hash, by which a provider can answer
a repeated task from what it did before.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import vectors as vec
from foliospark.operators import batching, parts, quota
from foliospark.sources.tables import stage


@dataclass(frozen=True)
class Item:
    """A text, or an image as base64 text, with the estimate that counts against ceilings and quota."""

    key: str
    input_sha256: str
    text: str
    kind: str = "text"
    tokens: int = 0


@dataclass(frozen=True)
class Outcome:
    """A vector, or an error code that can be retried or not."""

    key: str
    vector: list[float] | None = None
    error_code: str | None = None
    retryable: bool = False
    retry_after: float | None = None
    model: str | None = None
    status: int | None = None
    usage: dict | None = None
    throttled: bool = False

    def raw_sha256(self) -> str | None:
        """The hash of the response as it came: the vector's double-precision values."""
        return None if self.vector is None else hashlib.sha256(struct.pack(f"<{len(self.vector)}d", *self.vector)).hexdigest()


class Provider(Protocol):
    """`synthetic` providers need no authorization and leave no response provenance; `streams` bounds how many tasks call at once (None: as many as there are)."""

    dimensions: int
    model: str
    synthetic: bool
    streams: int | None

    def embed(self, items: list[Item]) -> list[Outcome]: ...


@dataclass(frozen=True)
class SyntheticProvider:
    """Deterministic vectors from the text's hash; no network. Texts that hold a part of `fails` fail as it says."""

    dimensions: int = 16
    fails: tuple[tuple[str, str, bool], ...] = ()
    model: str = "synthetic"
    synthetic: bool = True
    streams: int | None = None

    def embed(self, items: list[Item]) -> list[Outcome]:
        return [self._one(i) for i in items]

    def _one(self, item: Item) -> Outcome:
        for part, code, again in self.fails:
            if part in item.text:
                return Outcome(item.key, error_code=code, retryable=again, retry_after=0.5 if again else None)
        raw = hashlib.sha256(item.text.encode()).digest() * (1 + self.dimensions // 32)
        return Outcome(item.key, [b / 255 - 0.5 for b in raw[: self.dimensions]], model=self.model, usage={"input_tokens": item.tokens})


def is_vector(values: object, dimensions: int) -> bool:
    """Whether a response's vector is a list of so many finite numbers, none of them a truth value."""
    return isinstance(values, list | tuple) and len(values) == dimensions and all(isinstance(x, int | float) and not isinstance(x, bool) and math.isfinite(x) for x in values)


def settle(items: list[Item], outcomes: list[Outcome]) -> list[Outcome]:
    """One outcome per item: a missing answer can be retried, a doubled one is invalid; siblings are kept."""
    by: dict[str, list[Outcome]] = {}
    for o in outcomes:
        by.setdefault(o.key, []).append(o)
    return [(found[0] if len(found := by.get(i.key, [])) == 1 else Outcome(i.key, error_code="invalid_response" if found else "missing_response_item", retryable=not found)) for i in items]


@dataclass
class Stream:
    """One stream of calls: packs what waits into batches, sends waves of them, retries what can be."""

    provider: Provider
    policy: batching.Policy
    pace: quota.Pace | None = None
    jitter: float = 0.0
    requests: int = 0
    waits: list[float] = field(default_factory=list)
    booked: dict[str, list[int]] = field(default_factory=dict)  # by the first item of a batch: its reservations

    def run(self, items: list[Item]) -> dict[str, tuple[Outcome, int]]:
        """The last outcome of each item and the attempts it took."""
        final: dict[str, tuple[Outcome, int]] = {}
        waiting, attempts = items, 0
        while waiting and attempts < self.policy.attempts:
            attempts += 1
            packer, packed = batching.Packer(self.policy), {}
            for i in waiting:
                n = packer.place(i.tokens, len(i.text.encode()))
                if n is None:
                    final[i.key] = (Outcome(i.key, error_code="item_over_budget"), attempts)
                else:
                    packed.setdefault(n, []).append(i)
            batches, waiting, wait = list(packed.values()), [], 0.0
            while batches:
                wide = self.pace.concurrency if self.pace else self.policy.concurrency
                wave, batches = batches[:wide], batches[wide:]
                numbers = self.pace.admit([sum(i.tokens for i in b) for b in wave]) if self.pace else [0] * len(wave)
                for batch, number in zip(wave, numbers):
                    self.requests += 1
                    answers = [o if o.vector is None or is_vector(o.vector, self.provider.dimensions) else replace(o, vector=None, error_code="invalid_response") for o in self.provider.embed(batch)]
                    found = settle(batch, answers)
                    if self.pace:
                        self.booked.setdefault(batch[0].key, []).append(number)
                        self.pace.observe(number, found[0].usage)
                        if any(o.throttled for o in found):
                            self.pace.throttle()
                    for i, o in zip(batch, found):
                        final[i.key] = (o, attempts)
                        if o.vector is None and o.retryable:
                            waiting.append(i)
                            wait = max(wait, o.retry_after or 0.0)
            if waiting and self.pace and attempts < self.policy.attempts:
                p = self.policy
                self.waits.append(min(p.max_backoff, max(p.initial_backoff * 2 ** (attempts - 1), wait) + self.jitter * random.random()))
                self.pace.sleep(self.waits[-1])
        return final


OUTCOME = "key string, input_sha256 string, vector array<float>, error_code string, retryable boolean, attempts int, retry_after double, status_code int, model string, raw_response_sha256 string, usage string, booked array<struct<at:timestamp,estimated:int,observed:int>>"


def call(items: DataFrame, provider: Provider, policy: batching.Policy = batching.Policy(), made: list[tuple[datetime, int]] = []) -> DataFrame:  # noqa: B006
    """The OUTCOME columns of items (key, input_sha256, text[, kind, tokens]). Staged when it returns.

    Items are packed into batches under the policy's ceilings; what can be retried is tried again in the
    next wave, up to the policy's attempts. A provider with `streams` is called by that many tasks and each
    of them keeps to its share of the quota, after the reservations `made` so far; others are called by as
    many tasks as there are partitions.
    """
    n, shares = provider.streams, max(1, provider.streams or 1)
    share = batching.Policy(**{**policy.__dict__, "quota_requests": max(policy.concurrency, policy.quota_requests // shares), "quota_tokens": max(policy.concurrency * policy.max_tokens, policy.quota_tokens // shares)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream = Stream(provider, share, quota.Pace(share, made) if n else None, 0.0 if provider.synthetic else 1.0)
        for pdf in batches:
            rows = [Item(*r) for r in zip(pdf["key"], pdf["input_sha256"], pdf["text"], pdf["kind"], pdf["tokens"])]
            final = stream.run(rows)
            booked = lambda key: [dict(zip(("at", "estimated", "observed"), stream.pace.reserved[n])) for n in stream.booked.pop(key, [])]  # noqa: B023, E731
            yield pd.DataFrame(
                [(i.key, i.input_sha256, o.vector, o.error_code, bool(o.retryable), k, o.retry_after, o.status, o.model, o.raw_sha256(), json.dumps(o.usage, sort_keys=True) if o.usage else None, booked(i.key)) for i in rows for o, k in [final[i.key]]],
                columns=[c.split()[0] for c in OUTCOME.split(", ")],
            ).astype({"status_code": "Int32"})

    kind = F.col("kind") if "kind" in items.columns else F.lit("text")
    tokens = F.col("tokens").cast("int") if "tokens" in items.columns else F.length("text")
    given = items.select("key", "input_sha256", "text", kind.alias("kind"), tokens.alias("tokens"))
    return stage((given.repartition(n, "key") if n else given.repartition("key")).mapInPandas(run, OUTCOME), "outcomes")


def checked(outcomes: DataFrame, dimensions: int) -> DataFrame:
    """Outcomes with normalised vectors; a vector that cannot be normalised becomes its error code."""
    status = F.when(F.col("vector").isNotNull(), vec.status(F.col("vector"), F.lit(dimensions)))
    return outcomes.withColumn("error_code", F.coalesce("error_code", status)).withColumn("vector", F.when(F.col("error_code").isNull(), vec.normalized(F.col("vector"))))


SPAN = ("part_count", "char_start", "char_end", "byte_start", "byte_end", "token_count")


def embed_texts(texts: DataFrame, provider: Provider, limit: int, policy: batching.Policy = batching.Policy(), known: DataFrame | None = None, attempt_limit: int | None = None, made: list[tuple[datetime, int]] = []) -> tuple[DataFrame, DataFrame]:  # noqa: B006
    """(articles, parts) of texts (article_id, text): one vector per article, and the parts of texts beyond `limit`.

    A long text's vector is the normalised mean of its parts' vectors, weighted by their tokens and summed
    in their order, and exists only if all parts succeeded. `known` are parts stored by earlier runs: those
    that succeeded are not embedded again, and attempts add up; a part that has spent `attempt_limit` is not
    tried again. A part that failed for good fails the text for good; otherwise the text can be retried.
    """
    given = texts.filter("article_id is not null and text is not null and text <> ''").select("article_id", "text").withColumn("article_input_sha256", F.sha2("text", 256))
    planned = parts.plan_parts(given, limit, "article_id").withColumnRenamed("part_input_sha256", "input_sha256")
    counted = planned.groupBy("article_id").agg(F.count("*").cast("int").alias("part_count"))
    cut = planned.join(counted, "article_id").join(given, "article_id").select("article_id", "article_input_sha256", "part_index", *SPAN, "input_sha256", F.expr("substring(text, cast(char_start + 1 as int), cast(char_end - char_start as int))").alias("text"))
    size = F.length("text")
    short = given.filter(size <= limit).select("article_id", "article_input_sha256", F.lit(-1).alias("part_index"), F.lit(0).alias("part_count"), F.lit(0).cast("long").alias("char_start"), size.cast("long").alias("char_end"), F.lit(0).cast("long").alias("byte_start"), F.octet_length("text").cast("long").alias("byte_end"), size.alias("token_count"), F.col("article_input_sha256").alias("input_sha256"), "text")
    units = short.unionByName(cut).withColumn("key", F.concat_ws("\x1f", "article_id", "part_index"))
    key = ["article_id", "article_input_sha256", "part_index"]
    before = "k_state string, k_attempts int, k_error string, k_run string, k_vector array<float>, k_raw string, k_model string"
    if known is not None:
        stored = known.select(*key, F.col("part_input_sha256").alias("input_sha256"), F.col("state").alias("k_state"), F.col("attempt_count").alias("k_attempts"), F.col("error_code").alias("k_error"), F.col("generation_run_id").alias("k_run"), F.col("vector").alias("k_vector"), F.col("raw_response_sha256").alias("k_raw"), F.col("response_model").alias("k_model"))
        units = units.join(stored, [*key, "input_sha256"], "left")
    else:
        units = units.select("*", *(F.lit(None).cast(kind).alias(c) for c, kind in (x.split() for x in before.split(", "))))
    units = stage(units, "units")
    spent = (F.col("k_attempts") >= attempt_limit) if attempt_limit is not None else F.lit(False)
    open_ = F.coalesce(~F.col("k_state").isin("succeeded", "terminal") & ~spent, F.lit(True))
    done = checked(call(units.filter(open_).select("key", "input_sha256", "text", F.col("token_count").alias("tokens")), provider, policy, made), provider.dimensions).drop("input_sha256")
    each = units.drop("text").join(done.withColumn("fresh", F.lit(True)), "key", "left")
    again = F.coalesce("retryable", F.lit(False)) & F.lit(True if attempt_limit is None else False)
    tries = (F.coalesce("k_attempts", F.lit(0)) + F.coalesce("attempts", F.lit(0))).cast("int")
    if attempt_limit is not None:
        again = F.coalesce("retryable", F.lit(False)) & ((F.col("part_index") < 0) | (tries < attempt_limit))
    state = F.when(F.col("vector").isNotNull() | (F.col("fresh").isNull() & (F.col("k_state") == "succeeded")), "succeeded").when(again, "retryable").otherwise("terminal")
    each = each.select(
        *key, *SPAN, "input_sha256", state.alias("state"), tries.alias("attempt_count"), F.coalesce("error_code", F.when(F.col("fresh").isNull() & (F.col("k_state") != "succeeded"), F.col("k_error"))).alias("error_code"), "status_code", F.col("retry_after").alias("retry_after_seconds"),
        F.coalesce("vector", "k_vector").alias("vector"), F.coalesce("raw_response_sha256", "k_raw").alias("raw_response_sha256"), F.coalesce("model", "k_model").alias("response_model"), F.when(F.col("fresh").isNull(), F.col("k_run")).alias("earlier_run"), F.coalesce("attempts", F.lit(0)).alias("calls"), "booked",
    )
    each = stage(each.withColumn("stored_vector_sha256", vec.vector_hash("vector")), "parts")
    mean = vec.ordered_mean(each.filter("state = 'succeeded'"), ["article_id"], "vector", "token_count", "part_index").select("article_id", vec.normalized(F.col("mean")).alias("mean"))
    one = F.col("part_index") < 0
    whole = each.groupBy("article_id").agg(
        F.count("*").alias("units"),
        F.count_if(F.col("state") == "succeeded").alias("succeeded"),
        F.count_if(F.col("state") == "terminal").alias("terminal"),
        F.min(F.when(F.col("error_code").isNotNull(), F.struct("part_index", "error_code")))["error_code"].alias("error_code"),  # that of the first part that failed
        F.max("attempt_count").alias("attempt_count"),
        F.sum("calls").cast("int").alias("calls"),
        F.max("status_code").alias("status_code"),
        F.max("retry_after_seconds").alias("retry_after_seconds"),
        F.max(F.when(one, F.lit("synthetic_fixture" if provider.synthetic else "hosted_response")).otherwise("long_text_aggregate")).alias("derivation_kind"),
        F.max(F.when(one & F.lit(not provider.synthetic), F.col("raw_response_sha256"))).alias("raw_response_sha256"),
        F.max(F.when(one & F.lit(not provider.synthetic), F.col("response_model"))).alias("response_model"),
        F.min("response_model").alias("least_model"),
        F.max("response_model").alias("most_model"),
        F.flatten(F.collect_list("booked")).alias("booked"),
    )
    full = F.col("succeeded") == F.col("units")
    failed = lambda c: F.when(~full, F.col(c)).alias(c)
    j = whole.join(mean, "article_id", "left").select(
        "article_id", F.when(full, "succeeded").when(F.col("terminal") > 0, "terminal").otherwise("retryable").alias("state"), F.when(full, F.col("mean")).alias("vector"), failed("error_code"), failed("status_code"), failed("retry_after_seconds"), "attempt_count", "calls", "derivation_kind", "raw_response_sha256", "response_model", "least_model", "most_model", "units", "booked",
    )
    return j.withColumn("stored_vector_sha256", vec.vector_hash("vector")), each.filter("part_index >= 0")


def embed_images(images: DataFrame, provider: Provider, policy: batching.Policy = batching.Policy(), made: list[tuple[datetime, int]] = []) -> DataFrame:  # noqa: B006
    """A vector per image of (article_id, input_sha256, data, tokens); columns as of the articles of `embed_texts`."""
    units = images.select("article_id", F.col("article_id").alias("key"), "input_sha256", F.base64("data").alias("text"), F.lit("image").alias("kind"), "tokens")
    done = checked(call(units, provider, policy, made), provider.dimensions)
    hosted = lambda c: (F.col(c) if not provider.synthetic else F.lit(None).cast("string"))
    return done.select(
        F.col("key").alias("article_id"), F.when(F.col("vector").isNotNull(), "succeeded").when(F.coalesce("retryable", F.lit(False)), "retryable").otherwise("terminal").alias("state"), "vector", "error_code", "status_code", F.col("retry_after").alias("retry_after_seconds"), F.col("attempts").alias("attempt_count"), F.col("attempts").alias("calls"),
        F.lit("synthetic_fixture" if provider.synthetic else "hosted_response").alias("derivation_kind"), hosted("raw_response_sha256").alias("raw_response_sha256"), hosted("model").alias("response_model"), F.col("model").alias("least_model"), F.col("model").alias("most_model"), F.lit(1).alias("units"), vec.vector_hash("vector").alias("stored_vector_sha256"), "booked",
    )


def composites(text: DataFrame, header: DataFrame, formula: str) -> DataFrame:
    """Composite vectors of articles with both sources current: (article_id, generation, hash, vector) on either side."""
    t = text.select("article_id", F.col("generation_run_id").alias("text_run"), F.col("stored_vector_sha256").alias("text_hash"), F.col("vector").alias("t_v"))
    h = header.select("article_id", F.col("generation_run_id").alias("header_run"), F.col("stored_vector_sha256").alias("header_hash"), F.col("vector").alias("h_v"))
    identity = vec.composite_identity(formula_version=F.lit(formula), text_generation_run_id=F.col("text_run"), text_stored_vector_sha256=F.col("text_hash"), header_image_generation_run_id=F.col("header_run"), header_image_stored_vector_sha256=F.col("header_hash"))
    j = t.join(h, "article_id").select("article_id", identity.alias("input_sha256"), vec.midpoint(F.col("t_v"), F.col("h_v")).alias("vector"), "text_run", "text_hash", "header_run", "header_hash")
    return j.filter("vector is not null").withColumn("stored_vector_sha256", vec.vector_hash("vector"))


def pilot(provider: Provider, policy: batching.Policy, probes: list[str]) -> dict:
    """Probe a provider: a fixed text twice, a batch at the item ceiling, as many batches as may run at once, an image, the given probes; and whether it is ready."""
    item = lambda k, t, kind="text": Item(k, hashlib.sha256(t.encode()).hexdigest(), t, kind, len(t))
    ask = lambda items: settle(items, provider.embed(items))
    first, again = (ask([i])[0] for i in (item("a", "probe"), item("a", "probe")))
    batch = ask([item(str(k), f"probe {k}") for k in range(policy.max_items)])
    at_once = [ask([item(f"c{k}", f"at once {k}")])[0] for k in range(policy.concurrency)]
    image = ask([item("i", "iVBORw0KGgo=", "image")])[0]
    rest = [ask([item(f"p{k}", t)])[0] for k, t in enumerate(probes)]
    every = [first, again, *batch, *at_once, image]
    observed = {
        "deterministic": first.vector is not None and first.vector == again.vector,
        "dimensions": len(first.vector) if first.vector else 0,
        "full_batch": all(o.vector is not None for o in batch),
        "concurrent": all(o.vector is not None for o in at_once),
        "image": image.vector is not None,
        "models": sorted({o.model for o in every if o.model}),
        "probe_errors": sorted({o.error_code for o in rest if o.error_code}),
        "policy_coherent": policy.coherent(),
    }
    ready = observed["deterministic"] and observed["full_batch"] and observed["concurrent"] and observed["image"] and observed["dimensions"] == provider.dimensions and observed["policy_coherent"] and len(observed["models"]) == 1 and not observed["probe_errors"]
    return observed | {"ready": ready}
