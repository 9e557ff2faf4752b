"""python -m foliospark.embed_cli smoke|pilot|inventory|validate|run: one JSON object on standard output.

Roots are three separate folders: the archive, the preprocessing output (its catalogue, and texts under
`markdown`), and the embedding catalogue. Providers are named as module:factory; without one, vectors are
synthetic. A hosted provider needs --authorize-hosted-processing and --observed-model.
"""

from __future__ import annotations

import argparse
import importlib
import json
import os
import sys
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.cli import positive
from foliospark.functions.identity import is_safe_label
from foliospark.operators import embed, embedding_run, validation
from foliospark.operators import embedding_validation as ev
from foliospark.session import build, share_code
from foliospark.sources import archive
from foliospark.sources.store import ConcurrentCommit, Store


class Refused(RuntimeError):
    """The command cannot run; the text is its error code."""


class Quiet(argparse.ArgumentParser):
    """Errors name no argument's content."""

    def error(self, message: str) -> None:
        self.exit(2, json.dumps({"error": "invalid_arguments"}) + "\n")


def parser() -> argparse.ArgumentParser:
    p = Quiet(prog="foliospark-embed")
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("smoke")
    commands.add_parser("pilot").add_argument("--provider")
    for name in ("inventory", "validate", "run"):
        c = commands.add_parser(name)
        for root in ("source", "preprocessing-output", "embedding-output"):
            c.add_argument(f"--{root}-root", required=True)
        if name == "validate":
            c.add_argument("--configuration-id")
        if name == "run":
            scope = c.add_mutually_exclusive_group(required=True)
            scope.add_argument("--limit", type=positive)
            scope.add_argument("--full", action="store_true")
            c.add_argument("--reprocess", action="store_true")
            c.add_argument("--authorize-hosted-processing", action="store_true")
            c.add_argument("--observed-model")
            c.add_argument("--provider")
    return p


def separate(*roots: str) -> None:
    """The roots may not be the same, nor lie in one another."""
    real = [os.path.realpath(r) for r in roots]
    for i, a in enumerate(real):
        if any(os.path.commonpath([a, b]) in (a, b) for b in real[i + 1 :]):
            raise Refused("overlapping_roots")


def provider_of(name: str | None) -> embed.Provider:
    if name is None:
        return embed.SyntheticProvider()
    module, _, factory = name.partition(":")
    try:
        return getattr(importlib.import_module(module), factory)()
    except (ImportError, AttributeError) as e:
        raise Refused("provider_unavailable") from e


def published(spark: SparkSession, preprocessing_root: str) -> DataFrame:
    """The articles of the preprocessing catalogue; Refused if there is none."""
    store = Store(spark, preprocessing_root)
    if not store.version():
        raise Refused("missing_preprocessing_catalog")
    return store.read("articles")


def with_texts(articles: DataFrame, preprocessing_root: str) -> DataFrame:
    """The articles whose text is there and is the published one."""
    read = archive.read_files(articles, os.path.join(preprocessing_root, "markdown"), "cleaned_markdown_path").withColumnRenamed("path", "t_path")
    j = articles.join(read, F.col("cleaned_markdown_path") == F.col("t_path"))
    return j.filter(F.sha2("data", 256) == F.col("markdown_sha256")).withColumn("text", F.decode("data", "utf-8")).drop("t_path", "status", "data")


def validate(spark: SparkSession, source_root: str, preprocessing_root: str, embedding_root: str, configuration_id: str | None = None) -> dict:
    """Issues and coverage of the embedding catalogue, for the requested or the sole configuration."""
    articles, store = published(spark, preprocessing_root), Store(spark, embedding_root)
    whole = embedding_run.catalogue(store)
    chosen, problem = ev.select_configuration(whole.embedding_configurations, configuration_id)
    texts = with_texts(articles, preprocessing_root)
    lengths = texts.select("article_id", F.length("text").cast("long").alias("char_count"))
    listing = archive.read_files(articles, os.path.join(preprocessing_root, "markdown"), "cleaned_markdown_path").filter("data is not null").select("path", F.sha2("data", 256).alias("sha256"))
    rules = (embedding_run.PROFILE["image_input_rules"], embedding_run.PROFILE["image_transform"])
    before = store.version()
    rows = [r.asDict() for r in validation.report(ev.embedding_issues(whole, articles, lengths, rules, listing=listing)).collect()]
    if problem:
        rows.append({"code": problem, "message": problem.replace("_", " ")})
    if store.version() != before:
        rows.append({"code": "concurrent_validation_state_change", "message": "the catalogue has changed in the meantime"})
    counted = validation.coverage(articles, whole.work()).filter(F.col("configuration_id") == F.lit(chosen)).first()
    return {"configuration_id": chosen, "issues": sorted(rows, key=lambda r: (r["code"], r["message"])), "coverage": counted.asDict() if counted else None, "validation_ok": not rows}


def run(spark: SparkSession, args: argparse.Namespace) -> dict:
    provider = provider_of(args.provider)
    conf = embedding_run.configuration(dimensions=provider.dimensions)
    if not provider.synthetic:
        if not args.authorize_hosted_processing:
            raise Refused("hosted_processing_not_authorized")
        if not spark.range(1).select(is_safe_label(F.lit(args.observed_model))).first()[0]:
            raise Refused("pilot_observation_required")
        conf = embedding_run.configuration(dimensions=provider.dimensions, model=provider.model, observed_model=args.observed_model, client_api_contract_version="v1")
    articles = with_texts(published(spark, args.preprocessing_output_root), args.preprocessing_output_root)
    images = archive.read_files(articles, args.source_root, "header_image_path").filter("status = 'ok'").select("path", "data")
    return embedding_run.run(Store(spark, args.embedding_output_root), articles, provider, conf, images, args.limit, args.reprocess, args.authorize_hosted_processing) | {"configuration_id": conf["configuration_id"]}


def smoke(spark: SparkSession) -> dict:
    """A full run over three made articles, its validation, and a second run that reuses everything."""
    with tempfile.TemporaryDirectory() as folder:
        store = Store(spark, folder)
        articles = spark.sql("select * from values ('a', 'one', null), ('b', 'two. two.', null), ('c', repeat('three. ', 9), null) as t (article_id, text, header_image_path)").withColumns({"header_image_path": F.col("header_image_path").cast("string"), "published_at_utc": F.timestamp_seconds(F.lit(0)), "publication_date_new_york": F.lit("1969-12-31").cast("date")})
        conf = embedding_run.configuration(context_token_limit=40)
        first, second = (embedding_run.run(store, articles, embed.SyntheticProvider(), conf) for _ in range(2))
        found = ev.embedding_issues(embedding_run.catalogue(store), articles).count()
        return {"first": first, "second": second, "validation_ok": found == 0 and first["embeddings"] == second["reused"] == 3}


def execute(args: argparse.Namespace, spark: SparkSession) -> tuple[dict, bool]:
    """The command's result and whether it went well."""
    if args.command == "smoke":
        result = smoke(spark)
        return result, result["validation_ok"]
    if args.command == "pilot":
        provider = provider_of(args.provider)
        result = embed.pilot(provider, embedding_run.policy_of(embedding_run.configuration()), ["x", "é😀", "x" * 8000])
        return result, result["ready"]
    separate(args.source_root, args.preprocessing_output_root, args.embedding_output_root)
    if args.command == "inventory":
        return embedding_run.inventory(published(spark, args.preprocessing_output_root)), True
    if args.command == "run":
        return run(spark, args), True
    result = validate(spark, args.source_root, args.preprocessing_output_root, args.embedding_output_root, args.configuration_id)
    return result, result["validation_ok"]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build()
    share_code(spark)
    try:
        result, ok = execute(args, spark)
    except Refused as e:
        result, ok = {"error": str(e)}, False
    except (embedding_run.NotAuthorized, embedding_run.ConfigurationDrift, ConcurrentCommit) as e:
        result, ok = {"error": type(e).__name__}, False
    print(json.dumps(result, sort_keys=True, default=str))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
