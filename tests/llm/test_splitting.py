"""The splitter against a naive reading of its definition."""

from hypothesis import given, settings
from hypothesis import strategies as st

from foliospark.llm import splitting as sp

SPACE, CLOSE = set(" \t\r\n 　"), set("\"'”’»)]")


def gap_ends(t):
    out, i = set(), 0
    while i < len(t):
        j, units = i, 0
        while True:
            k = j + 2 if t.startswith("\r\n", j) else j + 1 if t.startswith("\n", j) else 0
            if not k:
                break
            while k < len(t) and t[k] in " \t":
                k += 1
            j, units = k, units + 1
        if units >= 2:
            out.add(j)
        i = max(j, i + 1)
    return out


def sentence_ends(t):
    out = set()
    for i, c in enumerate(t):
        if c in ".!?…":
            j = i + 1
            while j < len(t) and t[j] in CLOSE:
                j += 1
            k = j
            while k < len(t) and t[k] in SPACE:
                k += 1
            if k > j:
                out.add(k)
    return out


def naive(t, most, least, overlap):
    if len(t) <= 0:
        return []
    gaps, ends = gap_ends(t), sentence_ends(t)
    words = {i for i in range(1, len(t)) if t[i] not in SPACE and t[i - 1] in SPACE}
    out, start = [], 0
    while len(t) - start > most:
        end = start + most
        for kind in (gaps, ends, words):
            fits = [p for p in kind if start + least < p <= start + most]
            if fits:
                end = max(fits)
                break
        out.append((len(out), start, end))
        start = min([p for p in words if end - overlap <= p < end], default=end - overlap)
    return [*out, (len(out), start, len(t))]


TEXT = st.text(st.sampled_from("ab.!…\"') \n\r\t 　é😀"), max_size=160)
LIMITS = sp.Limits(most=20, least=4, overlap=4)


def pieces(t, size, halo):
    """The operator's steps on one text, without Spark."""
    tables = list(sp.ranges_of(t, LIMITS, size, halo))
    out, entry, offset = [], 0, 0
    for n, x in enumerate(tables):
        assert sp._from_bits(sp._bits(x.words)) == x.words
        if entry >= 0:
            froms, exits, counts = x.passage(n == 0, LIMITS)
            k = sp.bisect_right(froms, entry) - 1
            own = list(x.pieces(entry, LIMITS))
            assert counts[k] == len(own) and exits[k] == (own[-1][2] - x.length if own[-1][2] >= 0 else -1)
            out += [(len(out) + i, offset + a, offset + b) for i, (a, b, _) in enumerate(own)]
            entry = exits[k]
        offset += x.length
    return out


@given(TEXT, st.integers(20, 60), st.integers(1, 8))
@settings(max_examples=800, deadline=None)
def test_ranges_of_any_size_stitch_to_what_the_definition_says(t, size, halo):
    assert pieces(t, size, halo) == naive(t, 20, 4, 4)


@given(TEXT, st.integers(80, 120), st.integers(1, 8))
@settings(max_examples=300, deadline=None)
def test_byte_ranges_stitch_to_what_the_definition_says(t, size, halo):
    raw = t.encode()
    out, entry, offset = [], 0, 0
    for n, low in enumerate(range(0, len(raw), size)):
        x = sp.table_of_bytes(lambda a, b: raw[a:b], len(raw), low, min(len(raw), low + size), LIMITS, halo)
        if entry >= 0:
            froms, exits, counts = x.passage(n == 0, LIMITS)
            out += [(len(out) + i, offset + a, offset + b) for i, (a, b, _) in enumerate(x.pieces(entry, LIMITS))]
            entry = exits[sp.bisect_right(froms, entry) - 1]
        offset += x.length
    assert offset == len(t) and out == naive(t, 20, 4, 4)


def long_text():
    para = "Prices rose again. Nobody “knew.” Why not?  "
    return ("x" * 700 + " " + para * 9 + "\r\n \n" + para * 3 + "\n\n\n") * 12 + " " * 400 + "y" * 5000


def test_split_texts_by_ranges_equals_whole(spark):
    rows = [(1, long_text(), "z"), (2, None, "z"), (3, "", "z"), (4, "short", "z"), (5, "a" * 2001, "z"), (6, long_text()[:2000], "z"), (None, long_text(), "z"), (1, long_text(), "z"), (7, "w. " + " " * 9000 + "\n\n end" * 900, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string")
    expect = sorted((i or -1, *p) for i, t, _ in rows if t and len(t) > 2000 for p in naive(t, 2000, 200, 200))
    for size, halo in ((1 << 18, 1024), (4096, 16), (sp.RANGE, sp.HALO)):
        got = sp.split_texts(docs, size=size, halo=halo).collect()
        assert sorted((r.doc_id or -1, r.part_index, r.char_start, r.char_end) for r in got) == expect
        assert all(r.token_count == r.char_end - r.char_start <= 2000 for r in got)
    assert sp.split_texts(docs.limit(0)).count() == 0


def test_split_files_reads_ranges(spark, tmp_path):
    texts = [long_text(), "é😀 " * 9000, "", "tiny", "w. " + " " * 30_000 + "\n\n end" * 900, "x" * 40_000]
    paths = []
    for k, t in enumerate(texts):
        p = tmp_path / f"{k}.txt"
        p.write_bytes(t.encode())
        paths.append(str(p))
    got = sp.split_files(spark, [*paths, "file://" + paths[0]], size=9000, halo=30).collect()
    assert sorted((r.part_index, r.char_start, r.char_end) for r in got if r.path == "file://" + paths[0]) == sorted((r.part_index, r.char_start, r.char_end) for r in got if r.path == paths[0])
    got = [r for r in got if not r.path.startswith("file:")]
    expect = sorted((p, *x) for p, t in zip(paths, texts) for x in naive(t, 2000, 200, 200))
    assert sorted((r.path, r.part_index, r.char_start, r.char_end) for r in got) == expect


def test_parts_of_the_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect() if r.text and len(r.text) > 2000}
    got = sorted((r.doc_id, r.part_index, r.char_start, r.char_end) for r in sp.split_texts(docs).collect())
    assert got == sorted((i, *p) for i, t in texts.items() for p in naive(t, 2000, 200, 200))
