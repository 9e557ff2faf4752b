"""Observations as a stream: the latest state of each source, kept up to date by micro-batches.

An extension beside the batch change capture: the same rules under Structured Streaming. The stream's
checkpoint holds the offsets and the write-ahead plan; the sink deduplicates by key and version and is
written per batch number, so a batch that is replayed overwrites what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.operators.incremental import plain_path
from foliospark.sources.files import Folder

COLUMNS = "scan_run_id string, source_html_path string, html_size long, html_mtime_ns long, source_html_sha256 string, observed_at timestamp, arrived_at timestamp"


def newest(rows: DataFrame) -> DataFrame:
    """One row per path, that observed last; combined on the map side."""
    order = F.struct(F.col("observed_at").alias("a"), F.col("arrived_at").alias("b"), F.col("html_mtime_ns").alias("c"), F.col("html_size").alias("d"), F.col("source_html_sha256").alias("e"))
    rest = [c for c in rows.columns if c != "source_html_path"]
    best = rows.filter("source_html_path is not null").groupBy("source_html_path").agg(F.max(F.struct(order.alias("o"), F.struct(*rest).alias("r"))).alias("b"))
    return best.select("source_html_path", "b.r.*")


def follow(spark: SparkSession, log: str, state: str, trigger: dict | None = None):
    """Start the stream over Parquet files in `log`; `current` reads its result. Stops by itself when it has caught up."""
    rows = spark.readStream.schema(COLUMNS).parquet(log).withColumn("source_html_path", plain_path(F.col("source_html_path")))

    def merge(batch: DataFrame, number: int) -> None:
        before = current(batch.sparkSession, state, number)
        fresh = newest(batch)
        merged = newest(before.select(*fresh.columns).unionByName(fresh)) if before is not None else fresh
        merged.write.mode("overwrite").parquet(f"{state}/sink/{number:012d}")
        Folder(batch.sparkSession, f"{state}/done").create(f"{number:012d}", "")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{state}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def current(spark: SparkSession, state: str, before: int | None = None) -> DataFrame | None:
    """The result of the last finished batch (before the given one); None if there is none."""
    done = [int(n) for n in Folder(spark, f"{state}/done").names() if before is None or int(n) < before]
    return spark.read.parquet(f"{state}/sink/{max(done):012d}") if done else None


def arrivals(rows: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Observations per scan and hour, late ones within the watermark included."""
    return rows.withWatermark("observed_at", late).groupBy(F.window("observed_at", width).alias("w"), "scan_run_id").agg(F.count("*").alias("observations"), F.count_if(F.col("source_html_sha256").isNull()).alias("without_hash")).select("scan_run_id", F.col("w.start").alias("hour"), "observations", "without_hash")


def latest_by_window(rows: DataFrame) -> DataFrame:
    """The batch form by a window function, for comparison."""
    w = Window.partitionBy("source_html_path").orderBy(F.desc("observed_at"), F.desc("arrived_at"))
    return rows.filter("source_html_path is not null").withColumn("k", F.row_number().over(w)).filter("k = 1").drop("k")
