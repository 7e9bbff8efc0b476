"""Shared pieces of the operators: table access, Arrow batch slices, word limits, block counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = np.array([0x20, *range(0x09, 0x0E)], dtype=np.uint8)

#: Text bytes that one vectorised step works on, unless a single document is longer.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the columns an operator reads, so that other columns and their names never matter."""
    return docs.select(*[docs[c] for c in (cols or ("doc_id", "text"))])


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `size` bytes of text; a longer document stands alone."""
    n = batch.num_rows
    if not n:
        return
    lengths = np.array([0 if v is None else v for v in
                        pc.binary_length(batch.column(text)).to_pylist()], dtype=np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def encoded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes], gap: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array, `gap` after each; start and end of each text in it."""
    data = np.frombuffer(gap.join([*texts, b""]), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(sizes + len(gap)) - len(gap)
    return data, ends - sizes, ends


def space_mask(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; `data` must end in white space and have it between documents."""
    word = np.empty(len(data) + 1, dtype=np.int8)
    word[0] = 0
    word[1:] = ~space_mask(data)
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def blocks_for(rows: int, size: int) -> int:
    """How many blocks of about `size` rows hold `rows`."""
    return max(1, -(-rows // size))


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`: the folds that the queries are told to hold out."""
    return F.crc32(key.cast("string")) % parts
