"""Extraction of article records from pages, as one Arrow-batched map."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions.identity import new_york_date

if TYPE_CHECKING:
    from foliospark.functions.markdown import Article

FIELDS = "article_id string, source_html_sha256 string, canonical_url string, published_at_utc timestamp, updated_at_utc timestamp, markdown_text string, editorial_character_count long, editorial_block_count int, metadata_completeness int, inline_image_urls array<string>, warnings array<string>, error_code string"


def record(a: Article) -> dict:
    """The FIELDS of an extracted article."""
    return {"error_code" if k == "error" else k: v for k, v in vars(a).items()}


def frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    """Rows as a frame in which times are instants."""
    out = pd.DataFrame(rows, columns=names)
    for c in ("published_at_utc", "updated_at_utc"):
        out[c] = pd.to_datetime(out[c], utc=True)
    return out


def extract_articles(pages: DataFrame, namespace: str = "id", version: str = "7") -> DataFrame:
    """A candidate record per page of (source_html_path, html[, warnings]).

    Pages that fail carry an error_code and no article; null html fails like an empty page. Row order
    and number are those of the input, other columns are not read.
    """
    has_warnings = "warnings" in pages.columns
    given = pages.select("source_html_path", F.coalesce("html", F.lit("")).alias("html"), (F.col("warnings") if has_warnings else F.array().cast("array<string>")).alias("warnings"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from foliospark.functions.markdown import extract

        names = ["source_html_path", *(f.split()[0] for f in FIELDS.split(", "))]
        for pdf in batches:
            rows = [{"source_html_path": path, **record(extract(html, list(warnings) if warnings is not None else [], namespace))} for path, html, warnings in zip(pdf["source_html_path"], pdf["html"], pdf["warnings"])]
            yield frame(rows, names)

    found = given.mapInPandas(run, f"source_html_path string, {FIELDS}")
    return found.withColumns({"publication_date_new_york": new_york_date(F.col("published_at_utc")), "extractor_version": F.lit(version)})
