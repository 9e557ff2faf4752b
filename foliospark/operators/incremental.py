"""Processing only new or changed records: change capture over a log with per-partition offsets.

A log is an append-only set of Parquet files. Each file is a partition of the log and a row's offset
is its position in the file (Spark's `_metadata.row_index`), so offsets cost nothing to assign and
never change. A batch runs in four steps:

1. plan: the rows of each partition beyond the committed offsets, as half-open ranges. Files that are
   as large and as old as they were at the last commit are not opened; of the others the footers are read;
2. the plan is written ahead to `plans/<batch>.json` (create-if-absent) before any row is processed;
3. the ranges are processed and added to the sink, which keeps one row per key and takes a row only
   if its version (event time, arrival, partition, offset) is above the stored one;
4. the commit marker `commits/<batch>.json` is created, holding the new offsets.

A run that dies between 2 and 4 leaves a plan without a commit: the next run replays exactly that plan.
Since the sink deduplicates by key and offset, replaying rows that were merged already changes nothing.

The sink is a list of levels. A batch writes its own keys as a new level and merges levels only while
the one before is at most twice as large, so a row is rewritten a logarithmic number of times and a
batch costs what its own rows cost. Levels that a commit replaces stay for one more commit, for those
who read them. Only plans, offsets and levels (one entry per log file) pass through the driver, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources.files import Folder
from foliospark.sources.tables import broadcast_if_small, remove

CURRENT_EXTRACTOR = "7"
#: Log files of a batch up to which their offset ranges (some 60 bytes each) are broadcast.
BROADCAST_RANGES = 100_000


def plain_path(c: Column) -> Column:
    """A path in plain relative form: single slashes, no "." segments, no leading slash."""
    slashes = F.regexp_replace(c, "/+", "/")
    inner = F.regexp_replace(slashes, r"(?:(?<=/)|^)(?:\./)+", "")
    return F.regexp_replace(F.regexp_replace(inner, r"/\.$", ""), "^/", "")


def log_files(spark: SparkSession, path: str) -> dict[str, tuple[str, int, int]]:
    """The files of a log by partition name (the path within the log): (path, size, modification time)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    given = jvm.org.apache.hadoop.fs.Path(path)
    fs = given.getFileSystem(conf)
    out: dict[str, tuple[str, int, int]] = {}
    for top in fs.globStatus(given) or []:
        root = top.getPath().toUri().getPath().rstrip("/")
        several = any(c in path for c in "*?[{")
        todo = [top]
        while todo:
            s = todo.pop()
            name = s.getPath().getName()
            if s.isDirectory():
                todo += [c for c in fs.listStatus(s.getPath()) if not c.getPath().getName().startswith((".", "_"))]
                continue
            whole = s.getPath().toUri().getPath()
            partition = whole if several else name if whole == root else whole[len(root) + 1 :]
            out[partition] = (s.getPath().toString(), s.getLen(), s.getModificationTime())
    return out


def read_log(spark: SparkSession, path: str, files: dict[str, str] | None = None) -> DataFrame:
    """The log, or these files of it (path by partition name), with the file and offset of each row.

    The columns are log_file (as Spark names it) and log_offset; columns of its own by these names, and by
    log_partition, are left out.
    """
    whole = spark.read.parquet(path)  # one footer, for the schema
    log = whole
    if files is not None:
        reader = spark.read.schema(whole.schema)
        if whole.inputFiles() and not any(c in path for c in "*?[{") and not path.endswith(".parquet"):
            reader = reader.option("basePath", path)
        log = reader.parquet(*files.values())
    own = [F.col(f"`{c}`") for c in log.columns if c not in ("log_file", "log_partition", "log_offset")]
    return log.select(*own, F.col("_metadata.file_path").alias("log_file"), F.col("_metadata.row_index").alias("log_offset"))


def _spark_name(spark: SparkSession, path: str) -> str:
    """A file's path as `_metadata.file_path` gives it."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


class ChangeCapture:
    """Incremental batches over one log into one sink.

    `version` names the columns that order the rows of a key, most significant first; partition and
    offset break the rest. Rows with a null key take no part. Null version columns count as oldest.
    """

    def __init__(self, spark: SparkSession, state: str, key: str, version: tuple[str, ...]) -> None:
        self.spark, self.state, self.key, self.version = spark, state.rstrip("/"), key, version
        self.plans, self.commits = Folder(spark, f"{self.state}/plans"), Folder(spark, f"{self.state}/commits")

    def committed(self) -> dict:
        """What the last commit says: offsets, levels, delta and retired folders."""
        done = self.commits.names()
        return json.loads(self.commits.read(done[-1])) if done else {"offsets": {}, "levels": [], "delta": None, "retired": []}

    def offsets(self) -> dict[str, list[int]]:
        """Of each partition: the first row not yet processed, and the file's size and time then."""
        return self.committed()["offsets"]

    def plan(self, log_path: str) -> dict | None:
        """The batch to run: an unfinished plan if there is one, else a new one, written ahead; None if nothing is new."""
        plans, commits = self.plans.names(), set(self.commits.names())
        open_plans = [p for p in plans if p not in commits]
        if open_plans:
            return json.loads(self.plans.read(open_plans[0]))
        done = self.offsets()
        fresh = {k: v for k, v in log_files(self.spark, log_path).items() if k not in done or done[k][1:] != [v[1], v[2]]}
        if not fresh:
            return None
        ends = read_log(self.spark, log_path, {k: v[0] for k, v in fresh.items()}).groupBy("log_file").agg(F.count("*").alias("rows")).collect()  # one row per new file, from footers
        rows = {r.log_file: r["rows"] for r in ends}
        marks = {k: [rows.get(_spark_name(self.spark, path), 0), size, at] for k, (path, size, at) in fresh.items()}
        start = {k: done[k][0] if k in done else 0 for k in marks}
        if shrunk := sorted(k for k in marks if marks[k][0] < start[k]):
            raise RuntimeError(f"the log is not append-only: {shrunk[0]} has lost rows")
        ranges = {k: [start[k], marks[k][0], fresh[k][0]] for k in sorted(marks) if marks[k][0] > start[k]}
        if not ranges:
            return None
        name = f"{len(plans):012d}.json"
        plan = {"batch": name, "ranges": ranges, "offsets": dict(sorted((done | marks).items()))}
        if not self.plans.create(name, json.dumps(plan)):
            raise RuntimeError("another run has planned this batch")
        return plan

    def rows(self, log_path: str, plan: dict) -> DataFrame:
        """Exactly the planned rows; no other file is opened."""
        log = read_log(self.spark, log_path, {k: path for k, (_, _, path) in plan["ranges"].items()})
        ranges = self.spark.createDataFrame([(_spark_name(self.spark, path), k, a, b) for k, (a, b, path) in plan["ranges"].items()], "range_file string, log_partition string, range_from long, range_until long")
        within = (F.col("log_file") == F.col("range_file")) & (F.col("log_offset") >= F.col("range_from")) & (F.col("log_offset") < F.col("range_until"))
        small = len(plan["ranges"]) <= BROADCAST_RANGES  # a frame made of local rows has no size estimate
        return log.join(F.broadcast(ranges) if small else ranges, within).drop("range_file", "range_from", "range_until", "log_file")

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row per key, that of the highest version; combined on the map side, so hot keys stay small."""
        order = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(self.version)], F.col("log_partition").alias("p"), F.col("log_offset").alias("o"))
        others = [c for c in rows.columns if c != self.key]
        best = rows.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(F.struct(order.alias("order"), F.struct(*others).alias("row"))).alias("best"))
        return best.select(self.key, "best.row.*")

    def _read(self, folders: list[str]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f) for f in folders])

    def sink(self) -> DataFrame | None:
        """The sink as of the last commit: one row per key with the partition and offset it came from."""
        folders = [f for f, _ in self.committed()["levels"]]
        return None if not folders else self._read(folders) if len(folders) == 1 else self.latest(self._read(folders))

    def delta(self) -> DataFrame | None:
        """What the last committed batch brought: one row per key of that batch, late rows included."""
        folder = self.committed()["delta"]
        return self.spark.read.parquet(folder) if folder else None

    def current(self, keys: DataFrame) -> DataFrame | None:
        """The sink's rows of these keys; only they are merged."""
        folders = [f for f, _ in self.committed()["levels"]]
        if not folders:
            return None
        found = self._read(folders).join(keys.select(F.col(self.key).alias("wanted_key")), F.col(self.key) == F.col("wanted_key"), "left_semi")
        return found if len(folders) == 1 else self.latest(found)

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        folder = f"{self.state}/sink/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(folder)
        return folder, self.spark.read.parquet(folder).count()  # from footers

    def run(self, log_path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, fail_before_commit: bool = False) -> DataFrame | None:
        """Run one batch; returns the sink after it, or the unchanged sink if nothing is new.

        New levels are new folders; the commit marker is what makes them visible, so a failure at any
        point leaves the old ones in force. `fail_before_commit` is for tests of the replay.
        """
        plan = self.plan(log_path)
        if plan is None:
            return self.sink()
        before = self.committed()
        delta, size = self._write(self.latest(transform(self.rows(log_path, plan))))
        levels, merged, total = list(before["levels"]), [], size
        while levels and levels[-1][1] <= 2 * total:
            folder, n = levels.pop()
            merged.append(folder)
            total += n
        if merged:
            levels.append(list(self._write(self.latest(self._read([*merged, delta])))))
        else:
            levels.append([delta, size])
        if fail_before_commit:
            raise RuntimeError("stopped before the commit")
        retired = [*merged, *([delta] if merged else [])]
        if not self.commits.create(plan["batch"], json.dumps({"offsets": plan["offsets"], "levels": levels, "delta": delta, "retired": retired})):
            raise RuntimeError("another run has committed this batch")
        for folder in before["retired"]:
            remove(self.spark, folder)
        return self.sink()


def decide(capture: ChangeCapture, manifest: DataFrame, runs: DataFrame, touched_runs: DataFrame | None = None, extractor: str = CURRENT_EXTRACTOR) -> DataFrame:
    """(source_html_path, reason) of what the last batch can have changed, reason null where nothing has to be done.

    That is the keys of the batch and, if `touched_runs` (run_id) is given, the sources that those runs
    handled last. Only their observations and manifest rows are joined.
    """
    keys = capture.delta().select("source_html_path")
    if touched_runs is not None:
        ran = touched_runs.select(F.col("run_id").alias("t_run"))
        keys = keys.unionByName(manifest.join(broadcast_if_small(ran), F.col("last_run_id") == F.col("t_run"), "left_semi").select("source_html_path")).distinct()
    wanted = keys.select(F.col("source_html_path").alias("wanted_key"))  # a batch may be of any size: no hint
    own = manifest.join(wanted, F.col("source_html_path") == F.col("wanted_key"), "left_semi")
    return judged(capture.current(keys), own, runs, extractor)


def to_process(observations: DataFrame, manifest: DataFrame, runs: DataFrame, extractor: str = CURRENT_EXTRACTOR) -> DataFrame:
    """The sources of `observations` (one row per plain path) that the next run has to process, with why.

    In order: new (not in the manifest), not_succeeded, unfinished_run (its run is unknown or not
    succeeded), stale_extractor, changed. Changed means another hash, letter case aside; without an
    observed hash, another size or mtime (null-safe). Empty tables give no row.
    """
    return judged(observations, manifest, runs, extractor).filter("reason is not null")


def judged(observations: DataFrame, manifest: DataFrame, runs: DataFrame, extractor: str = CURRENT_EXTRACTOR) -> DataFrame:
    """`to_process` with every observed source, its reason null if the next run can leave it."""
    m = manifest.select(
        F.col("source_html_path").alias("m_path"), F.col("html_size").alias("m_size"), F.col("html_mtime_ns").alias("m_mtime"), F.lower("source_html_sha256").alias("m_hash"), F.col("extractor_version").alias("m_version"), F.col("status").alias("m_status"), F.col("last_run_id").alias("m_run")
    )
    good = runs.filter("status = 'succeeded'").select(F.col("run_id").alias("r_id")).distinct()
    seen = observations.select("source_html_path", "html_size", "html_mtime_ns", "source_html_sha256")
    joined = seen.join(m, F.col("source_html_path") == F.col("m_path"), "left").join(broadcast_if_small(good), F.col("m_run") == F.col("r_id"), "left")
    hash_ = F.lower("source_html_sha256")
    changed = F.when(hash_.isNotNull(), ~hash_.eqNullSafe(F.col("m_hash"))).otherwise(~F.col("html_size").eqNullSafe(F.col("m_size")) | ~F.col("html_mtime_ns").eqNullSafe(F.col("m_mtime")))
    reason = (
        F.when(F.col("m_path").isNull(), "new")
        .when(~F.col("m_status").eqNullSafe("succeeded"), "not_succeeded")
        .when(F.col("r_id").isNull(), "unfinished_run")
        .when(~F.col("m_version").eqNullSafe(extractor), "stale_extractor")
        .when(changed, "changed")
    )
    return joined.select("source_html_path", reason.alias("reason"))


def observations_of(log: DataFrame) -> DataFrame:
    """The columns of the observation log that decide, the path in plain form."""
    return log.select(plain_path(F.col("source_html_path")).alias("source_html_path"), "html_size", "html_mtime_ns", "source_html_sha256", "observed_at", "arrived_at", "log_partition", "log_offset")
