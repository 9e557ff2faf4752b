"""Encoding of a whole corpus with a public byte-pair tokenizer, and decoding back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Where the public tokenizers' files are; a parameter of every operator that needs one.
TOKENIZERS = "/opt/tokenizers"
DEFAULT = "byte_bpe_50k"

#: Rows that leave a worker at once; bounds its memory on long texts.
ROWS_OUT = 500


def vocabulary(name: str = DEFAULT, folder: str = TOKENIZERS) -> str:
    """The rank file of a public byte-level tokenizer."""
    return f"{folder}/{name}.tiktoken"


def encode_corpus(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids array<int>) of each row, without special tokens.

    An empty and a null text both give an empty list; a null id stays null; repeated rows come out as
    often as they come in; other columns are not read. One narrow map, no shuffle.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from foliospark.llm.bpe import load

        encode = load(path).encode
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(start, ROWS_OUT)
                ids = [np.array(encode(t), np.int32) for t in part.column(1).to_pylist()]
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=[id_column, "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The kept columns and n_tokens of each row, by the same encoder; only counts leave the workers."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from foliospark.llm.bpe import load

        encode = load(path).encode
        for batch in batches:
            counts = pa.array([len(encode(t)) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], counts], names=[*keep, "n_tokens"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, text_column).mapInArrow(run, f"{kinds}, n_tokens long")


def decode_corpus(encoded: DataFrame, path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """(id, text) of (id, ids); an empty list gives an empty text, a null list a null text."""
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from foliospark.llm.bpe import load

        decode = load(path).decode
        for batch in batches:
            texts = pa.array([None if i is None else decode(i) for i in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=[id_column, "text"])

    kind = encoded.schema[id_column].dataType.simpleString()
    return encoded.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, text string")
