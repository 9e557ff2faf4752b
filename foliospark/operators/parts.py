"""Lossless parts of long texts: blocks packed greedily under a token limit, without overlap."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: what separates blocks; it stays with the block before it.
SEPARATOR = re.compile(r"(?:\r?\n[ \t]*){2,}")
Offsets = list[tuple[int, int]]
PART = "part_index int, char_start long, char_end long, byte_start long, byte_end long, part_input_sha256 string, token_count int"


def code_points(text: str) -> Offsets:
    """One token per code point."""
    return [(i, i + 1) for i in range(len(text))]


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str, sha256: str):
    from tokenizers import Tokenizer, processors

    with open(path, "rb") as f:
        if hashlib.file_digest(f, "sha256").hexdigest() != sha256:
            raise ValueError("the tokenizer file is not the pinned one")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets cover the text, spaces included
    return t


def _offsets(path: str, sha256: str, text: str) -> Offsets:
    return _tokenizer(path, sha256).encode(text, add_special_tokens=False).offsets


def pinned_tokenizer(path: str, sha256: str) -> Callable[[str], Offsets]:
    """Token offsets by a tokenizer file whose content is pinned by its hash; each worker loads it once."""
    return functools.partial(_offsets, path, sha256)


def checked(text: str, offsets: Offsets) -> Offsets:
    """The offsets, if they rise and cover the text without a gap; else ValueError."""
    reach, before = 0, (-1, -1)
    for o in offsets:
        if not (len(o) == 2 and all(type(x) is int for x in o) and 0 <= o[0] < o[1] <= len(text) and o[0] >= before[0] and o[1] >= before[1] and o[0] <= reach):
            raise ValueError("token offsets do not cover the text")
        reach, before = max(reach, o[1]), o
    if reach != len(text):
        raise ValueError("token offsets do not cover the text")
    return offsets


def plan(text: str, limit: int, tokens: Callable[[str], Offsets] = code_points) -> list[tuple[int, int]]:
    """(start, end) of each part; empty if the text fits as it is. A block beyond the limit is cut at token ends."""
    if limit < 1:
        raise ValueError("the limit must be positive")
    if not text:
        raise ValueError("the text is empty")
    additive = tokens is code_points  # one token per code point: counts are lengths
    count = len if additive else lambda t: len(checked(t, tokens(t)))
    if count(text) <= limit:
        return []
    ends = [m.end() for m in SEPARATOR.finditer(text)]
    edges = [0, *ends, *([len(text)] if not ends or ends[-1] < len(text) else [])]
    parts: list[tuple[int, int]] = []
    open_ = 0  # start of the part being filled
    for a, b in zip(edges, edges[1:]):
        if count(text[a:b]) > limit:
            if open_ < a:
                parts.append((open_, a))
            open_ = a
            while count(text[open_:b]) > limit:
                end = open_ + (limit if additive else _cut(text[open_:b], limit, tokens, count))
                parts.append((open_, end))
                open_ = end
            if open_ < b:
                parts.append((open_, b))
            open_ = b
        elif open_ < a and count(text[open_:b]) > limit:
            parts.append((open_, a))
            open_ = a
    return [*parts, (open_, len(text))] if open_ < len(text) else parts


def _cut(rest: str, limit: int, tokens: Callable[[str], Offsets], count: Callable[[str], int]) -> int:
    """The last token end whose prefix is within the limit when it is tokenized alone."""
    first = tokens(rest)[: limit + 1]
    starts = [a for a, _ in first[1:]] + ([len(rest)] if len(first) <= limit else [])
    parted = [end for (_, end), start in zip(first[:limit], starts) if end <= start]  # no token reaches over these ends
    fitting = (end for end in reversed(parted) if count(rest[:end]) <= limit)
    if (end := next(fitting, None)) is None:
        raise ValueError("no token end is within the limit")
    return end


def plan_parts(docs: DataFrame, limit: int, id_column: str = "doc_id", text_column: str = "text", tokens: Callable[[str], Offsets] = code_points) -> DataFrame:
    """The id and PART columns of each part of each text over the limit; null, empty and fitting texts have none."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["id"], pdf["text"]):
                byte = 0
                for k, (a, b) in enumerate(plan(text, limit, tokens)):
                    raw = text[a:b].encode()
                    rows.append((i, k, a, b, byte, byte + len(raw), hashlib.sha256(raw).hexdigest(), b - a if tokens is code_points else len(tokens(text[a:b]))))
                    byte += len(raw)
            yield pd.DataFrame(rows, columns=["id", *(c.split()[0] for c in PART.split(", "))])

    given = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null and text <> ''")
    if tokens is code_points:
        given = given.filter(F.length("text") > limit)
    return given.mapInPandas(run, f"id {kind}, {PART}").withColumnRenamed("id", id_column)
