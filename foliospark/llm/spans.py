"""Long exact spans shared between records, by level-wise doubling.

A window of `length` code points can only be repeated if what it contains is repeated, so windows are
compared at a quarter of the length first, and only what is repeated there, in two different records,
is looked at at twice that length, and again; `levels` goes on to twice the length and twice that, until
no candidates survive.

Level 1 (a quarter of the length) does not compare every position. Every full window is represented
by one short window in it, that with the least hash (ties: the leftmost), which depends on nothing
but the full window's own text. Equal full windows therefore have equal representatives at the same
place in them, and about one position in forty-five is compared. A representative stands for the full
windows `lo..hi` (their starts) that chose it. Only the hashes pass a shuffle; those that are repeated
go into a filter of bounded size, and a second pass over the texts takes out the stretches around
representatives that pass it, so that no text without a candidate is ever moved.

Level 2 (half the length) compares the two windows of that length that continue a surviving
representative to the right and to the left; a full window contains at least one of them.

Level 3 (the full length) compares, per representative, the stretch of all its full windows as one:
where two records agree on the whole stretch, all its windows are shared at once. Stretches that
differ from the others of their representative are compared window by window, once per different
text, however many records hold it; before that, what an eighth of a length of neighbouring windows
have in common is compared, which settles passages that are shared, but not at the full length.

All comparisons are aggregations by hash of (least record, greatest record), combined on the map
side: copies of one text collapse before the shuffle, pairs of records are never formed, and a hash
that a third of all rows share costs one row per task. Level 1 and 2 hashes only propose; level 3
compares texts by two 64-bit hashes and their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.sources.tables import stage

#: Window starts handled at once; longer texts are worked off in stretches of this many.
STRETCH = 1 << 20
#: Bits of the filter of repeated hashes at most (64 MB), and how many a hash should have. Beyond that no filter is used and all stretches are compared.
MOST_BITS, BITS_A_HASH = 1 << 29, 16
#: An odd base and its inverse modulo 2**64, by which a window's hash is freed of the window's place.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Hasher:
    """Hashes of all windows of a text, by wrapping prefix sums of code points times powers of a base."""

    def __init__(self) -> None:
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 1 << 15)
            self.powers, self.inverses = np.ones(size, np.uint64), np.ones(size, np.uint64)
            np.cumprod(np.full(size - 1, _BASE, np.uint64), out=self.powers[1:])
            np.cumprod(np.full(size - 1, _INVERSE, np.uint64), out=self.inverses[1:])

    def windows(self, codes: np.ndarray, k: int) -> np.ndarray:
        """The hash of codes[i:i+k] for each i; len(codes) >= k."""
        n = len(codes)
        self._grow(n)
        c = (codes.astype(np.uint64) + np.uint64(7)) * np.uint64(0xBF58476D1CE4E5B9)
        c ^= c >> np.uint64(29)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(c * self.powers[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.inverses[: n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        return h


def least_in_windows(values: np.ndarray, w: int) -> np.ndarray:
    """The least of values[i:i+w] for each i, in log2(w) passes."""
    span, out = 1, values
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(values) - w + 1], out[w - span : w - span + len(values) - w + 1])


def representatives(text: str, length: int, k: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, at, hash): the starts lo..hi of the full windows that are represented by the short window at `at`."""
    out = []
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for base in range(0, len(codes) - length + 1, STRETCH):
        part = codes[base : base + STRETCH + length - 1]
        h = hasher.windows(part, k)
        low = np.uint64((1 << max(1, int(len(h)).bit_length())) - 1)
        least = least_in_windows((h & ~low) | np.arange(len(h), dtype=np.uint64), length - k + 1)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        at = (least[first] & low).astype(np.int64)
        last = np.concatenate([first[1:], [len(least)]]) - 1
        out.append((first + base, last + base, at + base, h[at].view(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


def _hashes(rows: DataFrame, length: int, k: int, kind: str) -> DataFrame:
    """(id, h): the representatives' hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [np.unique(representatives(t, length, k, hasher)[3]) for t in part.column("text").to_pylist()]
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(rows)), pa.array(np.concatenate(found))], names=["id", "h"])

    return rows.select("id", "text").mapInArrow(run, f"id {kind}, h long")


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one record has; expects the columns a and z, least and greatest record."""
    return df.groupBy(*keys).agg(F.min("a").alias("a"), F.max("z").alias("z")).filter(F.col("a") < F.col("z")).select(*keys)


def filter_of(hashes: DataFrame) -> np.ndarray | None:
    """A bit filter of a staged frame's 64-bit hashes h, combined by the executors; None if it would exceed MOST_BITS."""
    n = hashes.count()
    bits = 1 << max(10, (BITS_A_HASH * n - 1).bit_length())
    if bits > MOST_BITS:
        return None
    place = F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1))).alias("p")
    word = hashes.select(place).select(F.shiftright("p", 5).cast("int").alias("at"), F.expr("shiftleft(1L, cast(p & 31 as int))").alias("bit"))
    found = word.groupBy("at").agg(F.bit_or("bit").alias("word")).toArrow()  # a row per word of the filter at most
    out = np.zeros(bits // 32, np.uint32)
    out[found["at"].to_numpy()] = found["word"].to_numpy().astype(np.uint32)
    return out


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes can be in the filter."""
    u, low = h.view(np.uint64), np.uint64(len(words) * 32 - 1)
    first, second = u & low, (u >> np.uint64(32)) & low
    hit = lambda p: (words[(p >> np.uint64(5)).astype(np.int64)] >> (p & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
    return (hit(first) & hit(second)).astype(bool)


def _stretches(rows: DataFrame, words: np.ndarray | None, length: int, k: int, kind: str) -> DataFrame:
    """(id, lo, hi, off, h, text) of each stretch whose representative passes the filter; off is the representative's place in it."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                at, columns, texts = [], [], []
                for row, (base, text) in enumerate(zip(part.column("base").to_pylist(), part.column("text").to_pylist())):
                    lo, hi, place, h = representatives(text, length, k, hasher)
                    kept = passes(shared.value, h) if shared.value is not None else np.ones(len(h), bool)
                    lo, hi, place, h = lo[kept], hi[kept], place[kept], h[kept]
                    texts += [text[a : b + length] for a, b in zip(lo.tolist(), hi.tolist())]
                    at += [row] * len(h)
                    columns.append((lo + base, hi + base, place - lo, h))
                own = [np.concatenate(x) for x in zip(*columns)]
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(at, pa.int64())), *(pa.array(x, pa.int64()) for x in own[:2]), pa.array(own[2], pa.int32()), pa.array(own[3], pa.int64()), pa.array(texts, pa.string())], names=["id", "lo", "hi", "off", "h", "text"])

    return rows.select("id", "base", "text").mapInArrow(run, f"id {kind}, lo long, hi long, off int, h long, text string")


def _two_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("w1"), F.xxhash64(F.lit("second"), text).alias("w2")]


def texts_of(docs: DataFrame, length: int, id_column: str, text_column: str) -> DataFrame:
    """(id, base, text) of the records that can hold a window; base is where the text begins in the record."""
    return docs.select(F.col(id_column).alias("id"), F.lit(0).cast("long").alias("base"), F.col(text_column).alias("text")).filter(F.col("id").isNotNull() & (F.length("text") >= length))


def shared_windows(rows: DataFrame, length: int) -> DataFrame:
    """(id, lo, hi): starts of windows of `length` code points in rows (id, base, text) that another record holds too."""
    if length < 8:
        raise ValueError("length must be 8 at least")
    k, half = length // 4, length // 4 * 2
    kind = rows.schema["id"].dataType.simpleString()
    alive = stage(_repeated(_hashes(rows, length, k, kind).select("h", F.col("id").alias("a"), F.col("id").alias("z")), "h"), "spans-1")
    found = stage(_stretches(rows, filter_of(alive), length, k, kind), "spans-2")

    # Level 2: copies of a stretch stand for themselves once from here on.
    same = found.groupBy("h", "off", "text").agg(F.min("id").alias("a"), F.max("id").alias("z"))
    same = stage(same.withColumn("n", F.length("text")).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), "text")}), "spans-3")
    right = F.when(F.col("off") + half <= F.col("n"), F.xxhash64(F.lit("r"), F.expr(f"substring(text, off + 1, {half})")))
    left = F.when(F.col("off") >= half - k, F.xxhash64(F.lit("l"), F.expr(f"substring(text, off + 1 - {half - k}, {half})")))
    alone = same.filter(F.col("a") == F.col("z"))
    halves = same.select("a", "z", F.explode(F.array_compact(F.array(right, left))).alias("w"))
    good = _repeated(halves, "w")
    keys = ["h", "off", "t1", "t2", "n"]
    survivors = alone.select(*keys, F.explode(F.array_compact(F.array(right, left))).alias("w")).join(good, "w", "left_semi").select(*keys).distinct()

    # Level 3: whole stretches first, then window by window within the representatives that have an open one.
    # What neighbouring windows have in common is compared first: windows are counted in blocks from the
    # representative's place on, and the core of a block is repeated if any of its windows is.
    rivals = same.join(survivors.select("h").distinct(), "h", "left_semi")
    block = max(1, length // 8)
    of = lambda start: F.floor((start - F.col("off")) / block).cast("int")
    blocks = F.explode(F.sequence(of(F.lit(0)), of(F.col("n") - length))).alias("b")
    core = F.expr(f"substring(text, off + b * {block} + {block}, {length - block + 1})")
    cores = stage(rivals.select("a", "z", *keys, "text", blocks).select("a", "z", *keys, "b", *_two_hashes(core)), "spans-4")
    open_ = cores.join(_repeated(cores, "w1", "w2"), ["w1", "w2"], "left_semi").select(*keys, "b")
    first = F.col("off") + F.col("b") * block
    starts = F.explode(F.sequence(F.greatest(F.lit(0), first), F.least(F.col("n") - length, first + block - 1))).alias("i")
    windows = stage(rivals.join(open_, keys).select("a", "z", *keys, "text", starts).select("a", "z", *keys, "i", *_two_hashes(F.expr(f"substring(text, i + 1, {length})"))), "spans-5")
    both = _repeated(windows, "w1", "w2")
    parts = windows.filter(F.col("a") == F.col("z")).join(both, ["w1", "w2"], "left_semi").select(*keys, "i")
    slim = found.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("second"), "text"), "n": F.length("text")}).select("id", "lo", "hi", *keys)
    whole = same.filter(F.col("a") < F.col("z")).select(*keys)
    all_of = slim.join(whole, keys, "left_semi").select("id", "lo", "hi")
    some = slim.join(parts, keys).select("id", (F.col("lo") + F.col("i")).alias("lo"), (F.col("lo") + F.col("i")).alias("hi"))
    return all_of.unionByName(some)


def shared_regions(docs: DataFrame, length: int = 120, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, char_start, char_end): the maximal regions of each record that other records hold word for word.

    A position belongs to a region if it lies in a run of at least `length` code points that the text of
    another id holds as well. Rows without an id or with a text shorter than `length` (null, empty) have
    no regions and are no partners; repeated rows and repetition inside one id do not count; if rows of
    one id differ, their regions are united. `length` is 8 or more. Extra columns are not read.
    """
    return regions_of(shared_windows(texts_of(docs, length, id_column, text_column), length), length).withColumnRenamed("id", id_column)


def regions_of(windows: DataFrame, length: int) -> DataFrame:
    """(id, char_start, char_end): windows (id, lo, hi) united where they touch."""
    w = windows.select("id", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    before = Window.partitionBy("id").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    island = F.sum("new").over(Window.partitionBy("id").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0))
    marked = w.withColumn("reach", F.max("e").over(before)).withColumn("new", (F.col("reach").isNull() | (F.col("s") > F.col("reach"))).cast("long")).withColumn("island", island)
    return marked.groupBy("id", "island").agg(F.min("s").cast("long").alias("char_start"), F.max("e").cast("long").alias("char_end")).select("id", "char_start", "char_end")


def levels(docs: DataFrame, length: int = 120, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, length, char_start, char_end): the regions shared at `length`, at twice that, and so on, until none survives.

    A level looks only into regions of the level before that are long enough for it, cut out of their texts.
    Rows of one id are taken together; null ids and texts take no part.
    """
    rows, found = texts_of(docs, length, id_column, text_column), []
    while True:
        r = stage(regions_of(shared_windows(rows, length), length), f"level-{length}")
        found.append(r.withColumn("length", F.lit(length)))
        length *= 2
        longer = r.filter(F.col("char_end") - F.col("char_start") >= length).withColumnRenamed("id", "r_id")
        if longer.isEmpty():
            return reduce(DataFrame.unionByName, found).select(F.col("id").alias(id_column), "length", "char_start", "char_end")
        inside = (F.col("id") == F.col("r_id")) & (F.col("base") <= F.col("char_start")) & (F.col("char_end") <= F.col("base") + F.length("text"))
        cut = F.substring("text", (F.col("char_start") - F.col("base") + 1).cast("int"), (F.col("char_end") - F.col("char_start")).cast("int"))
        rows = stage(rows.join(longer, inside).select("id", F.col("char_start").alias("base"), cut.alias("text")), f"texts-{length}")


def shared_amounts(docs: DataFrame, regions: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, shared_chars, share) of every record that has an id; records without regions share 0."""
    sums = regions.groupBy(id_column).agg(F.sum(F.col("char_end") - F.col("char_start")).alias("shared_chars"))
    sizes = docs.filter(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.max(F.coalesce(F.length(text_column), F.lit(0))).cast("long").alias("n_chars"))
    shared = F.coalesce("shared_chars", F.lit(0).cast("long"))
    return sizes.join(sums, id_column, "left").select(id_column, "n_chars", shared.alias("shared_chars"), F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(0.0).alias("share"))
