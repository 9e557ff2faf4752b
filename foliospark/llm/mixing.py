"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear between breakpoints. Its
integral up to t, scaled to the tokens that the source is to supply, is the source's cumulative demand.
A source's documents are put in a pseudo-random order and their tokens summed up; a document gets the
time at which its source's demand reaches its place in that sum, the inverse of the integral, which is
a root of a quadratic in each segment. Range-sorting by time gives the training order, in which every
source follows its schedule.

How much a source supplies is found by water-filling: sources take their target share of a common
level until they reach their cap (tokens times the most repeats), and the level rises until the total
is met or every source is at its cap. Prefix sums run in two levels, buckets of a source and documents
of a bucket, so a source that holds a third of all documents is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.encode import count_tokens
from foliospark.sources.tables import broadcast_if_small, stage

#: Documents of a source that share a bucket of the prefix sum, about.
BUCKET = 4000
#: Breakpoints and weights of a source without a schedule of its own.
FLAT = [(0.0, 1.0), (1.0, 1.0)]


def check_schedule(points: list[tuple[float, float]]) -> None:
    """A schedule starts at 0, ends at 1, rises in time, and has no negative weights and some positive one."""
    times = [t for t, _ in points]
    if len(points) < 2 or times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times, times[1:])) or min(w for _, w in points) < 0 or max(w for _, w in points) <= 0:
        raise ValueError(f"not a schedule: {points}")


def supplies(available: dict[str, int], targets: dict[str, tuple[float, int]], total: float) -> dict[str, float]:
    """Tokens that each source of `targets` (share, most repeats) supplies to a mixture of `total` tokens.

    Sources without tokens, with a share of 0 or less, or with no repeats supply nothing.
    """
    caps = {s: available.get(s, 0) * max(0, r) for s, (_, r) in targets.items()}
    open_ = {s: share for s, (share, _) in targets.items() if share > 0 and caps[s] > 0}
    out = dict.fromkeys(targets, 0.0)
    left = min(float(total), float(sum(caps[s] for s in open_)))
    while open_:
        level = left / sum(open_.values())
        full = [s for s, share in open_.items() if level * share >= caps[s]]
        for s in full or list(open_):
            out[s] = float(caps[s]) if full else level * open_[s]
            left -= out[s]
            del open_[s]
    return out


def curves(schedules: dict[str, list[tuple[float, float]]], supply: dict[str, float]) -> dict[str, tuple[list[float], list[float], list[float]]]:
    """Per source: breakpoints, weights there (tokens per unit of time) and cumulative demand there."""
    out = {}
    for source, tokens in supply.items():
        points = schedules.get(source, FLAT)
        check_schedule(points)
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:])]
        scale = tokens / sum(areas)
        sums = [0.0]
        for a in areas:
            sums.append(sums[-1] + a * scale)
        out[source] = ([t for t, _ in points], [w * scale for _, w in points], sums)
    return out


def time_of(demand: Column, times: Column, weights: Column, sums: Column) -> Column:
    """The time at which the cumulative demand of a curve reaches `demand`."""
    k = F.least(F.greatest(F.size(F.filter(sums, lambda x: x <= demand)), F.lit(1)), F.size(sums) - 1)
    at = lambda a, i: F.element_at(a, i.cast("int"))
    t0, t1, w0, w1 = at(times, k), at(times, k + 1), at(weights, k), at(weights, k + 1)
    area = F.greatest(F.least(demand, at(sums, F.size(sums))) - at(sums, k), F.lit(0.0))
    root = w0 + F.sqrt(F.greatest(w0 * w0 + 2 * area * (w1 - w0) / (t1 - t0), F.lit(0.0)))
    return F.least(t1, F.when(root > 0, t0 + 2 * area / root).otherwise(t0))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens), staged: the one pass over the texts."""
    return stage(count_tokens(docs.filter("source is not null"), vocabulary, ("doc_id", "source")), "tokens")


def mixture(counts: DataFrame, targets: DataFrame, schedules: dict[str, list[tuple[float, float]]] | None = None, total: float | None = None) -> DataFrame:
    """(position, doc_id, source, copy, n_tokens), range-sorted by position.

    `position` in 0..1 is the training time, `copy` counts a document's repeats from 0. `total` is the
    mixture's size in tokens, by default that of all documents of the named sources. A source's share is
    met to within half a document. Documents of unnamed sources and without tokens stay out; a source
    named twice counts with the row of the least share; several rows with one id are documents of their
    own. No targets, or none within reach, give no row.
    """
    spark = counts.sparkSession
    counts = counts.select("doc_id", "source", "n_tokens")
    named = targets.filter("source is not null and target_share is not null and max_repeats is not null").groupBy("source").agg(F.min(F.struct("target_share", "max_repeats")).alias("t"))
    rows = named.join(counts.filter("n_tokens > 0").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "source", "left").collect()  # one row per named source
    available = {r.source: r.tokens or 0 for r in rows}
    wanted = {r.source: (r.t.target_share, r.t.max_repeats) for r in rows}
    supply = supplies(available, wanted, sum(available.values()) if total is None else total)
    curve = curves(schedules or {}, {s: x for s, x in supply.items() if x > 0})
    plan = spark.createDataFrame(
        [(s, float(available[s]), supply[s], max(1, round(next(r.docs for r in rows if r.source == s) / BUCKET)), *curve[s]) for s in curve],
        "p_source string, p_tokens double, p_supply double, p_buckets int, times array<double>, weights array<double>, sums array<double>",
    )
    keyed = counts.filter("n_tokens > 0").join(F.broadcast(plan) if len(rows) <= 100_000 else plan, F.col("source") == F.col("p_source"))
    keyed = keyed.withColumn("place", F.xxhash64("doc_id")).withColumn("bucket", F.floor((F.shiftrightunsigned("place", 12) / float(1 << 52)) * F.col("p_buckets")).cast("int"))
    sizes = keyed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("size"))
    offsets = sizes.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), (F.sum("size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("size")).alias("offset"))
    within = F.sum("n_tokens").over(Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("place", 12), "place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = keyed.withColumn("within", within).join(broadcast_if_small(offsets), (F.col("source") == F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    middle = F.col("offset") + F.col("within") + F.col("n_tokens") / 2
    # Copy r of a document stands r rounds of its source later; those beyond the supply are not made.
    copies = F.floor((F.col("p_supply") - middle) / F.col("p_tokens"))
    made = placed.withColumn("middle", middle).withColumn("last", copies.cast("int")).filter("last >= 0")
    spread = made.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("last"))))
    position = time_of(F.col("middle") + F.col("copy") * F.col("p_tokens"), F.col("times"), F.col("weights"), F.col("sums"))
    return spread.select(position.alias("position"), "doc_id", "source", "copy", "n_tokens").orderBy("position", "doc_id", "copy")


def reached_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, tokens, reached_share, most_copies) of every named source."""
    per = mixed.select("source", "n_tokens", "doc_id", "copy").groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), (F.max("copy") + 1).alias("most_copies"))
    whole = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy())  # one row per named source
    named = targets.filter("source is not null").select(F.col("source").alias("t_source"), "target_share", "max_repeats")
    joined = named.join(per, F.col("t_source") == F.col("source"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select(F.col("t_source").alias("source"), "target_share", "max_repeats", zero("documents"), zero("tokens"), F.when(whole > 0, F.coalesce("tokens", F.lit(0)) / whole).otherwise(0.0).alias("reached_share"), zero("most_copies"))
