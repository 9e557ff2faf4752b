"""Winners and duplicates of each article identity.

Winners come from one aggregation (the minimum of the order struct). Full ranks come from a sort that
range-partitions by identity and order, so a group that holds a third of all rows is ranked by many
tasks: a row's rank is its place among its identity's rows of its partition plus the number of such
rows in the partitions before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.tables import broadcast_if_small, stage

# Reasons for which a duplicate lost, by the first criterion that differs.
REASONS = ("empty_content", "lower_editorial_character_count", "lower_editorial_block_count", "lower_metadata_completeness", "older_update", "lexical_tiebreak")
CRITERIA = ("editorial_character_count", "editorial_block_count", "metadata_completeness", "updated_at_utc")


def order_columns() -> list[Column]:
    """Content first, then more characters, blocks and metadata, the newer update (none last), the lesser path."""
    c = F.col
    return [F.when(c("editorial_character_count") > 0, 0).otherwise(1).asc(), *(c(n).desc_nulls_last() for n in CRITERIA), c("source_html_path").asc()]


def order_struct() -> Column:
    """The same order as one ascending value."""
    down = lambda c: F.struct(c.isNull().alias("n"), (-c).alias("v"))
    return F.struct(
        F.when(F.col("editorial_character_count") > 0, 0).otherwise(1).alias("empty"),
        *(down(F.col(n).cast("long")).alias(n) for n in CRITERIA[:3]),
        down(F.unix_micros("updated_at_utc")).alias("updated"),
        F.col("source_html_path").alias("path"),
    )


def clean_candidates(candidates: DataFrame) -> DataFrame:
    """One row per source path, the least by all columns where they differ; rows without path or identity are no candidates."""
    rest = [c for c in candidates.columns if c != "source_html_path"]
    least = candidates.filter("article_id is not null and source_html_path is not null").groupBy("source_html_path").agg(F.min(F.struct(*rest)).alias("least"))
    return least.select("source_html_path", "least.*").select(*candidates.columns)


def ranked(candidates: DataFrame, key: str = "article_id", name: str = "candidate_rank") -> DataFrame:
    """Candidates with their rank within their identity, from 1."""
    ordered = order_columns()
    spread = stage(candidates.repartitionByRange(F.col(key), *ordered).withColumn("_range", F.spark_partition_id()), "ranked")
    counts = spread.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select(F.col(key).alias("_key"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(key, "_range").orderBy(*ordered))
    joined = spread.withColumn("_local", local).join(broadcast_if_small(offsets), (F.col(key) == F.col("_key")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn(name, (F.col("_local") + F.col("_before")).cast("int")).drop("_local", "_before", "_range", "_key", "_r")


def winners(candidates: DataFrame) -> DataFrame:
    """The whole winning row of each identity."""
    others = [c for c in candidates.columns if c != "article_id"]
    best = candidates.groupBy("article_id").agg(F.min(F.struct(order_struct().alias("o"), F.struct(*others).alias("row"))).alias("b"))
    return best.select("article_id", "b.row.*")


def duplicates_of(candidates: DataFrame) -> DataFrame:
    """(article_id, source_html_path, winner_source_html_path, duplicate_rank, reason) of every candidate that lost."""
    w = candidates.groupBy("article_id").agg(F.min(F.struct(order_struct().alias("o"), F.struct(*CRITERIA).alias("w"))).alias("b")).select(F.col("article_id").alias("w_article"), F.col("b.o.path").alias("winner_source_html_path"), "b.w")
    lost = ranked(candidates.select("article_id", "source_html_path", *CRITERIA), name="duplicate_rank").filter("duplicate_rank > 1")
    j = lost.join(w, F.col("article_id") == F.col("w_article"))
    filled = lambda c: F.coalesce(c > 0, F.lit(False))
    reason = F.when(filled(F.col("w.editorial_character_count")) != filled(F.col("editorial_character_count")), REASONS[0])
    for n, r in zip(CRITERIA, REASONS[1:]):
        reason = reason.when(~F.col(f"w.{n}").eqNullSafe(F.col(n)), r)
    return j.select("article_id", "source_html_path", "winner_source_html_path", "duplicate_rank", reason.otherwise(REASONS[5]).alias("reason"))


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, as often as that, with the side."""
    b = b.select(*a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("expected")).unionByName(b.exceptAll(a).withColumn("side", F.lit("stored")))
