"""Digests of row sets that do not depend on order but on how often a row occurs.

A row's SHA-256 is split into eight 32-bit words. Sums and XORs of words are aggregations that combine
on the map side; the words of a sum are carried on the driver, modulo 2**256.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.tables import stage


def row_hash(df: DataFrame, *columns: str) -> DataFrame:
    """The SHA-256 of each row's compact JSON, nulls kept."""
    return df.select(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256).alias("h"))


def multiset_parts(df: DataFrame, *columns: str) -> DataFrame:
    """One row: count, x0..x7 and s0..s7, the XOR and the sum of each 32-bit word of the rows' hashes."""
    words = [F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long") for i in range(8)]
    h = row_hash(df, *columns)
    return h.agg(F.count("*").alias("n"), *(F.coalesce(F.bit_xor(w), F.lit(0)).alias(f"x{i}") for i, w in enumerate(words)), *(F.coalesce(F.sum(w.cast("decimal(38,0)")), F.lit(0)).alias(f"s{i}") for i, w in enumerate(words)))


def multiset_digest(df: DataFrame, *columns: str) -> str:
    """The digest of all rows: the hash of (count, XOR, sum mod 2**256)."""
    r = multiset_parts(df, *columns).first()
    join = lambda values: sum(int(v) << (32 * (7 - i)) for i, v in enumerate(values)) % (1 << 256)
    text = f"{r.n}:{join([r[f'x{i}'] for i in range(8)]):064x}:{join([r[f's{i}'] for i in range(8)]):064x}"
    return hashlib.sha256(text.encode()).hexdigest()


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Rows with their position in the order, from 0, without a sort in one task: places within ranges, and the counts of the ranges before."""
    spread = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = spread.groupBy("_range").agg(F.count("*").alias("_n")).select(F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return spread.withColumn("_place", place).join(F.broadcast(offsets), F.col("_range") == F.col("_r")).withColumn("position", F.col("_place") + F.col("_before")).drop("_range", "_r", "_place", "_before")


def ordered_digest(df: DataFrame, order: list[str], *columns: str) -> str:
    """A digest that depends on the rows and on their order: that of the rows with their positions. Ties in the order must be equal rows."""
    return multiset_digest(numbered(df, *order), "position", *columns)


def tree_token(listing: DataFrame) -> str:
    """One token for a listing (path, size, mtime_ns, status): any file that comes, goes or changes gives another one."""
    return multiset_digest(listing, "path", "size", "mtime_ns", "status")
