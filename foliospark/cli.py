"""python -m foliospark.cli inventory|run|validate|smoke --config FILE: one JSON object on standard output."""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile

from pyspark.sql import functions as F

from foliospark import config
from foliospark.operators import preprocess, validation
from foliospark.session import build, share_code
from foliospark.sources import archive
from foliospark.sources.store import ConcurrentCommit, Store

SMOKE_PAGE = '<html><head><meta name="article.id" content="{i}"><meta name="article.published" content="2024-01-0{d}T12:00:00Z"></head><body><article><h1>T{i}</h1><p>Body {i}.</p></article></body></html>'


def positive(text: str) -> int:
    n = int(text)
    if n < 1:
        raise argparse.ArgumentTypeError("must be positive")
    return n


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="foliospark")
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("inventory", "run", "validate"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        if name == "run":
            scope = c.add_mutually_exclusive_group(required=True)
            scope.add_argument("--limit", type=positive)
            scope.add_argument("--full", action="store_true")
            c.add_argument("--reprocess", action="store_true")
    commands.add_parser("smoke")
    return p


def execute(args: argparse.Namespace, spark) -> tuple[dict, bool]:
    """The command's result and whether it went well."""
    if args.command == "smoke":
        return smoke(spark)
    c = config.load(args.config)
    store = Store(spark, c.output_root)
    if args.command == "inventory":
        r = archive.pair_images(archive.listing(spark, c.source_root)).agg(F.count("*").alias("discovered"), F.count("header_image_path").alias("with_image")).first()
        return {"discovered": r.discovered, "with_image": r.with_image, "missing_image": r.discovered - r.with_image}, True
    if args.command == "run":
        summary = preprocess.run(store, c.source_root, preprocess.Options(args.limit, args.reprocess, c.extractor_version, c.namespace, os.path.join(c.output_root, "markdown")))
        return summary, summary["status"] == "succeeded"
    if not store.version():
        return {"issues": [{"code": "missing_catalog", "message": "there is no catalogue"}]}, False
    found = validation.preprocessing_issues(*(store.read(t) for t in ("source_manifest", "candidates", "duplicates", "runs", "articles")), c.extractor_version)
    rows = [r.asDict() for r in validation.report(found).collect()]
    return {"issues": rows}, not rows


def smoke(spark) -> tuple[dict, bool]:
    """A run over generated pages and a second one that finds nothing to do."""
    with tempfile.TemporaryDirectory() as folder:
        for i in range(1, 4):
            os.makedirs(f"{folder}/in/{i}")
            with open(f"{folder}/in/{i}/p.html", "w") as f:
                f.write(SMOKE_PAGE.format(i=i, d=i))
        store = Store(spark, f"{folder}/out")
        first, second = (preprocess.run(store, f"{folder}/in") for _ in range(2))
        ok = first["new"] == first["articles"] == second["unchanged"] == 3 and first["validation_ok"] and second["validation_ok"]
        return {"first": first, "second": second}, ok


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build()
    share_code(spark)
    try:
        result, ok = execute(args, spark)
    except (config.BadConfig, ConcurrentCommit) as e:
        result, ok = {"error": type(e).__name__, "detail": str(e)}, False
    print(json.dumps(result, sort_keys=True))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
