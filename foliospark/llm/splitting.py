"""Splitting oversized items at natural boundaries, with overlap, by ranges.

Each item is cut into ranges that workers look at on their own. A worker sees its range with a halo:
code points before it, so that a gap or sentence end that began in the range before is recognised
(widened until it holds a code point that cannot be inside of one), and as many after it as a piece
may be long. It leaves a boundary table: the range's length, the places right after blank-line gaps
and right after sentence ends, a bitmap of word starts (an eighth of a byte a code point), and the
range's passage: for each place in it where a piece can begin, where in the next range the first
piece begins then, and how many pieces lie between. Pieces that begin apart soon end alike, so a
passage has few different outcomes.

The passages of an item, some hundred bytes each, are stitched in order: lengths are summed up to
offsets, piece counts to indices, and each range gets the place where its first piece begins. With
that every range emits its own pieces by offset, all ranges at once. No worker holds a whole file, and
no task works through the boundary tables of an item one after the other.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources.tables import stage

SPACES = " \t\r\n 　"
GAP = re.compile(r"(?:\r?\n[ \t]*){2,}")
SENTENCE = re.compile(f"[.!?…][\"'”’»)\\]]*[{SPACES}]+")
#: Code points that can be inside a gap or a sentence end; any other one makes what follows certain.
OPEN = re.compile(f"[^{SPACES}.!?…\"'”’»)\\]]")

#: Code points of a range of a text in a column, and of the halo before it at first.
RANGE, HALO = 1 << 13, 1 << 8
#: Bytes of a range of a file, and of its halo at first.
FILE_RANGE, FILE_HALO = 8 << 20, 1 << 12
#: Tasks that read ranges of files at most.
MOST_TASKS = 100_000
#: What tells that a gap has ended: a range sees this many code points more than a piece may be long.
BEYOND = 2


@dataclass(frozen=True)
class Limits:
    """Pieces have more than `least` and at most `most` code points, and overlap by up to `overlap`."""

    most: int = 2000
    least: int = 200
    overlap: int = 200

    def __post_init__(self) -> None:
        if not 0 <= self.overlap <= self.least < self.most:
            raise ValueError("0 <= overlap <= least < most must hold, else a piece may not advance")


@dataclass
class Table:
    """The boundary table of one range; places count from its first code point and reach `most` beyond its end.

    `tail` is how far the item's end lies from the range's start, if it lies within that reach, else -1.
    """

    length: int
    tail: int
    gaps: list[int]
    sentences: list[int]
    words: list[int]

    def end(self, start: int, limits: Limits) -> int:
        """Where a piece that is not the last one ends."""
        high = start + limits.most
        for kind in (self.gaps, self.sentences, self.words):
            k = bisect_right(kind, high) - 1
            if k >= 0 and kind[k] > start + limits.least:
                return kind[k]
        return high

    def following(self, end: int, limits: Limits) -> int:
        """Where the piece after one that ends at `end` begins."""
        k = bisect_left(self.words, end - limits.overlap)
        return self.words[k] if k < len(self.words) and self.words[k] < end else end - limits.overlap

    def pieces(self, start: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
        """(start, end, start of the piece after it or -1) of the pieces that begin in this range, the first one at `start`."""
        while 0 <= start < self.length:
            if 0 <= self.tail <= start + limits.most:
                yield start, self.tail, -1
                return
            end = self.end(start, limits)
            after = self.following(end, limits)
            yield start, end, after
            start = after

    def entries(self, first: bool, limits: Limits) -> list[int]:
        """The places where the first piece of this range can begin: word starts, and places that no word start follows within the overlap."""
        if first:
            return [0]
        reach = min(limits.most, self.length)
        words = np.array(self.words, np.int64)
        at = np.arange(reach)
        k = np.searchsorted(words, at)
        following = np.append(words, np.iinfo(np.int64).max)[k]
        return np.flatnonzero((following == at) | (following >= at + limits.overlap)).tolist()

    def passage(self, first: bool, limits: Limits) -> tuple[list[int], list[int], list[int]]:
        """(from, exit, count): a piece that begins at an entry of from[k] or more leads to exit[k] in the next range after count[k] pieces; -1 where the item ends."""
        known: dict[int, tuple[int, int]] = {}
        froms, exits, counts = [], [], []
        for entry in self.entries(first, limits):
            path, found = [], None
            at = entry
            while found is None:
                found = known.get(at)
                if found is None:
                    path.append(at)
                    _, _, after = next(self.pieces(at, limits))
                    if after < 0:
                        found = (-1, 0)
                    elif after >= self.length:
                        found = (after - self.length, 0)
                    at = after
            leave, n = found
            for p in reversed(path):
                n += 1
                known[p] = (leave, n)
            if not froms or (exits[-1], counts[-1]) != known[entry]:
                froms.append(entry), exits.append(known[entry][0]), counts.append(known[entry][1])
        return froms, exits, counts


def table_of(seen: str, lead: int, length: int, ends: bool, limits: Limits) -> Table:
    """The table of seen[lead:lead + length]; `ends` tells whether the item ends with what is seen."""
    reach = length + limits.most
    places = lambda r: [p for m in r.finditer(seen) if 0 < (p := m.end() - lead) <= reach]
    codes = np.frombuffer(seen.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (codes == 32) | (codes == 10) | (codes == 13) | (codes == 9) | (codes == 0xA0) | (codes == 0x3000)
    words = np.flatnonzero(space[:-1] & ~space[1:]) + 1 - lead
    tail = len(seen) - lead
    return Table(length, tail if ends and tail <= reach else -1, places(GAP), places(SENTENCE), words[(words >= 0) & (words <= reach)].tolist())


def ranges_of(text: str, limits: Limits, size: int = RANGE, halo: int = HALO) -> Iterator[Table]:
    """The tables of a text's ranges, in order; only a range and its halos are looked at at once."""
    size = max(size, limits.most)
    for low in range(0, len(text), size):
        lead = min(halo, low)
        while lead < low and OPEN.search(text, low - lead, low) is None:
            lead = min(2 * lead, low)
        length = min(size, len(text) - low)
        upto = min(len(text), low + length + limits.most + BEYOND)
        yield table_of(text[low - lead : upto], lead, length, upto == len(text), limits)


def _bits(places: list[int]) -> bytes:
    if not places:
        return b""
    mask = np.zeros(places[-1] + 1, np.bool_)
    mask[places] = True
    return np.packbits(mask).tobytes()


def _from_bits(packed: bytes) -> list[int]:
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8))).tolist()


TABLE = "item long, range_no long, length long, tail long, gaps array<long>, sentences array<long>, words binary, froms array<long>, exits array<long>, counts array<long>"
LONGS = pa.list_(pa.int64())
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), LONGS, LONGS, pa.binary(), LONGS, LONGS, LONGS]
NAMES = [c.split()[0] for c in TABLE.split(", ")]


def _row(item: int, number: int, t: Table, limits: Limits) -> tuple:
    return (item, number, t.length, t.tail, t.gaps, t.sentences, _bits(t.words), *t.passage(number == 0, limits))


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(KINDS)
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, KINDS))], names=["id", *NAMES])


#: Tables that are handed on at once.
TABLES_A_BATCH = 500


def _tables_of_texts(texts: DataFrame, kind: str, limits: Limits, size: int, halo: int) -> DataFrame:
    """A row per range of each text of (id, item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, items, texts = batch.column("id"), batch.column("item").to_pylist(), batch.column("text")
            rows, at = [], []
            for k, item in enumerate(items):
                for number, t in enumerate(ranges_of(texts[k].as_py(), limits, size, halo)):
                    rows.append(_row(item, number, t, limits))
                    at.append(k)
                    if len(rows) >= TABLES_A_BATCH:
                        yield _batch(ids.take(pa.array(at)), rows)
                        rows, at = [], []
            if rows:
                yield _batch(ids.take(pa.array(at)), rows)

    return texts.mapInArrow(run, f"id {kind}, {TABLE}")


def stitch(tables: DataFrame) -> DataFrame:
    """(item, range_no, entry, first_index, offset) of each range in which a piece begins, from the ranges' passages.

    The passages of an item are read in order as a stream; nothing but the running sums is held.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = None
        entry = index = offset = 0
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("item", "range_no", "length", "froms", "exits", "counts")]
            for own, number, length, froms, exits, counts in zip(*columns):
                if own != item:
                    item, entry, index, offset = own, 0, 0, 0
                if entry >= 0:
                    k = bisect_right(froms, entry) - 1
                    out.append((own, number, entry, index, offset))
                    entry, index = exits[k], index + counts[k]
                offset += length
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "range_no", "entry", "first_index", "offset"])

    passages = tables.select("item", "range_no", "length", "froms", "exits", "counts")
    return passages.repartition("item").sortWithinPartitions("item", "range_no").mapInArrow(walk, "item long, range_no long, entry long, first_index long, offset long")


def emit(tables: DataFrame, entries: DataFrame, kind: str, limits: Limits) -> DataFrame:
    """(id, part_index, char_start, char_end): every range's pieces, at its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            columns = [batch.column(c).to_pylist() for c in ("length", "tail", "gaps", "sentences", "words", "entry", "first_index", "offset")]
            for k, (length, tail, gaps, sentences, words, entry, index, offset) in enumerate(zip(*columns)):
                for start, end, _ in Table(length, tail, gaps, sentences, _from_bits(words)).pieces(entry, limits):
                    at.append(k), rows.append((index, offset + start, offset + end))
                    index += 1
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], names=["id", "part_index", "char_start", "char_end"])

    e = entries.select(F.col("item").alias("e_item"), F.col("range_no").alias("e_range"), "entry", "first_index", "offset")
    joined = tables.drop("froms", "exits", "counts").join(e, (F.col("item") == F.col("e_item")) & (F.col("range_no") == F.col("e_range")))
    return joined.select("id", "length", "tail", "gaps", "sentences", "words", "entry", "first_index", "offset").mapInArrow(run, f"id {kind}, part_index long, char_start long, char_end long")


def split_texts(docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text_column: str = "text", size: int = RANGE, halo: int = HALO) -> DataFrame:
    """(id, part_index, char_start, char_end, token_count) of every text longer than the limit.

    Null, empty and short texts give no row; a null id stays null; each of several rows with one id is
    an item of its own. Ranges and halos of any size give the same pieces; extra columns are not read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    long_ = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter(F.length("text") > limits.most).withColumn("item", F.monotonically_increasing_id())
    tables = stage(_tables_of_texts(long_, kind, limits, size, halo), "boundaries")
    out = emit(tables, stitch(tables), kind, limits)
    return out.select(F.col("id").alias(id_column), "part_index", "char_start", "char_end", (F.col("char_end") - F.col("char_start")).alias("token_count"))


def open_file(uri: str):
    """A file for random access, wherever Arrow's file systems reach (local paths, file:, hdfs:, s3:, gs:)."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return system.open_input_file(path)


def _sizes(paths: list[str]) -> list[tuple[str, int]]:
    out = []
    for p in paths:
        with open_file(p) as f:
            out.append((p, f.size()))
    return out


def _edge(raw: bytes, at: int) -> int:
    """The first byte from `at` on that begins a code point; of malformed text, at most three bytes on."""
    k = at
    while k < min(at + 3, len(raw)) and raw[k] & 0xC0 == 0x80:
        k += 1
    return k


def table_of_bytes(read: Callable[[int, int], bytes], total: int, low: int, high: int, limits: Limits, halo: int) -> Table:
    """The table of the code points that begin in the bytes [low, high) of a file of `total` bytes; `read` gives the bytes of an interval.

    Malformed bytes count as replacement characters.
    """
    upto = min(total, high + 4 * (limits.most + BEYOND) + 4)
    ahead = read(low, upto)
    begin = _edge(ahead, 0) if low else 0
    stop = _edge(ahead, high - low) if high < total else len(ahead)
    before = ""
    lead = min(halo, low)
    while lead:
        raw = read(low - lead, low) + ahead[:begin]
        before = raw[_edge(raw, 0) if lead < low else 0 :].decode("utf-8", "replace")
        if lead == low or OPEN.search(before):
            break
        lead = min(2 * lead, low)
    own = ahead[begin:stop].decode("utf-8", "replace")
    after = ahead[stop:].decode("utf-8", "ignore" if upto < total else "replace")
    return table_of(before + own + after, len(before), len(own), upto == total, limits)


def split_files(spark: SparkSession, paths: list[str], limits: Limits = Limits(), size: int = FILE_RANGE, halo: int = FILE_HALO) -> DataFrame:
    """(path, part_index, char_start, char_end) of UTF-8 files that all workers can open, by URI or local path.

    Workers read byte ranges with halos, never whole files; code points are counted per range and summed
    up when the passages are stitched. A file of at most `limits.most` code points is one piece, an empty
    one has none; a path named twice counts once. A halo is widened backwards until it is certain, which
    re-reads what is nothing but spaces and marks.
    """
    size = max(size, 4 * limits.most)
    listed = [(k, p, n) for k, (p, n) in enumerate(_sizes(sorted(set(paths)))) if n]  # one row per file
    files = spark.createDataFrame(listed, "item long, path string, bytes long")
    ranges = files.select("item", "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / size).cast("long"))).alias("range_no"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (item, path, total, number) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("item", "path", "bytes", "range_no")))):
                with open_file(path) as f:
                    t = table_of_bytes(lambda a, b: f.read_at(b - a, a), total, number * size, min(total, (number + 1) * size), limits, halo)  # noqa: B023
                yield _batch(batch.column("path").slice(k, 1), [_row(item, number, t, limits)])

    tasks = min(MOST_TASKS, max(1, sum(-(-n // size) for _, _, n in listed)))  # given, else these few bytes would be few tasks
    tables = stage(ranges.repartition(tasks).mapInArrow(run, f"id string, {TABLE}"), "boundaries")
    return emit(tables, stitch(tables), "string", limits).withColumnRenamed("id", "path")
