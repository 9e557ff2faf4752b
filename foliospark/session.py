"""Sessions and the settings that all operators assume."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Every timestamp of the catalogues is an instant; the session must not shift it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(cpus: int | str = "*", partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the session that is given."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName("foliospark")
    settings = SETTINGS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory} | extra
    for key, value in settings.items():
        b = b.config(key, value)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def share_code(spark: SparkSession) -> None:
    """Put this package on the workers' path, for Python functions that executors must import."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    have = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])
    context = spark.sparkContext
    if root not in context._python_includes and context.environment.get("PYTHONPATH", "").find(root) < 0:
        context.environment["PYTHONPATH"] = os.environ["PYTHONPATH"]
