"""One surviving record for each group of duplicates, chosen field by field.

Everything comes out of a single hash-partitioned aggregation: for each attribute the minimum of a
composite struct (unusable last, attribute's own order, record order, source path). Minima of structs
are combined on the map side, so a group that holds a third of all rows sends one row per task to its
reducer, and no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("record", "canonical_url", "header_image_path", "updated_at_utc", "inline_image_urls")


def _descending(c: Column, kind: str = "bigint") -> Column:
    """Ascending sort key for `c` descending, missing values last."""
    return F.struct(c.isNull().alias("missing"), (-F.coalesce(c.cast(kind), F.lit(0).cast(kind))).alias("value"))


def usable_url(c: Column) -> Column:
    """A URL is usable if it starts with http:// or https://, in any letter case."""
    low = F.lower(c)
    return F.coalesce(low.startswith("http://") | low.startswith("https://"), F.lit(False))


def usable_image(c: Column) -> Column:
    """An image path is usable if it ends in .jpg, .jpeg, .png or .webp, in any letter case."""
    low = F.lower(c)
    ends = [low.endswith(x) for x in (".jpg", ".jpeg", ".png", ".webp")]
    return F.coalesce(ends[0] | ends[1] | ends[2] | ends[3], F.lit(False))


def prepare(candidates: DataFrame, runs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Candidates with their record order and what is usable in each attribute.

    updated_at_utc is usable if it is neither before the row's published_at_utc nor after the latest
    finished_at in `runs`; a missing bound does not bind. Only the columns that decide and those
    named in `carried` are kept, so extra columns, whatever their names, never reach the aggregation.
    """
    latest = runs.agg(F.max("finished_at").alias("latest")).scalar()
    c = candidates.select(
        "article_id", "source_html_path", "canonical_url", "published_at_utc", "updated_at_utc", "editorial_character_count", "editorial_block_count", "metadata_completeness", "header_image_path", "inline_image_urls"
    ).filter(F.col("article_id").isNotNull() & F.col("source_html_path").isNotNull())
    updated = F.when(~F.coalesce(F.col("updated_at_utc") < F.col("published_at_utc"), F.lit(False)) & ~F.coalesce(F.col("updated_at_utc") > latest, F.lit(False)), F.unix_micros("updated_at_utc"))
    chars = F.col("editorial_character_count")
    return c.select(
        "article_id",
        "source_html_path",
        updated.alias("updated_us"),
        usable_url(F.col("canonical_url")).alias("has_url"),
        usable_image(F.col("header_image_path")).alias("has_image"),
        F.coalesce(F.size(F.array_distinct(F.array_compact("inline_image_urls"))), F.lit(0)).alias("images"),
        F.struct(
            (~F.coalesce(chars > 0, F.lit(False))).alias("empty"),
            _descending(chars).alias("chars"),
            _descending(F.col("editorial_block_count")).alias("blocks"),
            _descending(F.col("metadata_completeness")).alias("complete"),
            _descending(updated).alias("updated"),
            F.col("source_html_path").alias("path"),
        ).alias("order"),
        *carried,
    )


def choose(prepared: DataFrame, least_sources: int = 2) -> DataFrame:
    """One row per article: for each attribute the path of the row that supplies it, null if none does.

    Only articles with at least `least_sources` (1 or 2) different source paths come out.
    """
    order = F.col("order")
    picks = prepared.groupBy("article_id").agg(
        F.min("source_html_path").alias("low"),
        F.max("source_html_path").alias("high"),
        F.min(order).alias("record"),
        F.min(F.when(F.col("has_url"), order)).alias("canonical_url"),
        F.min(F.when(F.col("has_image"), order)).alias("header_image_path"),
        F.min(F.when(F.col("updated_us").isNotNull(), F.struct((-F.col("updated_us")).alias("own"), order.alias("o")))).alias("updated_at_utc"),
        F.min(F.when(F.col("images") > 0, F.struct((-F.col("images")).alias("own"), order.alias("o")))).alias("inline_image_urls"),
    )
    if least_sources > 1:
        picks = picks.filter(F.col("low") < F.col("high"))
    return picks.select(
        "article_id",
        F.col("record.path").alias("record"),
        F.col("canonical_url.path").alias("canonical_url"),
        F.col("header_image_path.path").alias("header_image_path"),
        F.col("updated_at_utc.o.path").alias("updated_at_utc"),
        F.col("inline_image_urls.o.path").alias("inline_image_urls"),
    )


def sources_by_field(candidates: DataFrame, runs: DataFrame) -> DataFrame:
    """(article_id, field_name, source_html_path): where each part of each surviving record comes from.

    Rows without article_id or source_html_path take no part; repeated rows change nothing; an empty
    table gives no row; a field that no row can supply gives no row.
    """
    wide = choose(prepare(candidates, runs))
    pairs = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("source_html_path")) for f in FIELDS])
    return wide.select("article_id", F.explode(pairs).alias("p")).select("article_id", "p.field_name", "p.source_html_path").filter("source_html_path is not null")


def surviving_records(candidates: DataFrame, runs: DataFrame) -> DataFrame:
    """One built record per article_id, articles with a single source included.

    Each value rides behind its order keys in the composite struct, so the same single aggregation
    yields the record without a join back. Equal orders (repeated rows) take the smaller value.
    """
    order = F.col("order")
    carried = ("canonical_url", "header_image_path", "inline_image_urls", "editorial_character_count", "editorial_block_count", "metadata_completeness")
    p = prepare(candidates, runs, carried)
    best = lambda usable, *parts: F.min(F.when(usable, F.struct(*parts)))
    wide = p.groupBy("article_id").agg(
        F.count("*").alias("rows"),
        F.min(F.struct(order.alias("o"), F.struct("editorial_character_count", "editorial_block_count", "metadata_completeness").alias("v"))).alias("record"),
        best(F.col("has_url"), order.alias("o"), F.col("canonical_url").alias("v")).alias("url"),
        best(F.col("has_image"), order.alias("o"), F.col("header_image_path").alias("v")).alias("image"),
        best(F.col("images") > 0, (-F.col("images")).alias("own"), order.alias("o"), F.col("inline_image_urls").alias("v")).alias("inline"),
        F.max("updated_us").alias("updated_us"),
    )
    return wide.select(
        "article_id",
        "rows",
        F.col("record.o.path").alias("source_html_path"),
        F.col("record.v.editorial_character_count").alias("editorial_character_count"),
        F.col("record.v.editorial_block_count").alias("editorial_block_count"),
        F.col("record.v.metadata_completeness").alias("metadata_completeness"),
        F.col("url.v").alias("canonical_url"),
        F.col("image.v").alias("header_image_path"),
        F.coalesce(-F.col("inline.own"), F.lit(0)).alias("inline_images"),
        F.col("updated_us"),
    )
