"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Texts are handed to numpy in chunks of about so many bytes, so that memory does not follow the
#: size of an Arrow batch; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 19
#: Rows of an Arrow batch whose texts are turned into Python values together.
SLICE_ROWS = 512

stored = cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) ranges of ``texts`` of about ``limit`` bytes each."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply, shift, xor)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``buffer[start:end]`` for many spans, in time linear in the buffer.

    A polynomial hash: prefix sums of byte times power, differences shifted back to power 0.
    """
    n = len(buffer)
    totals = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((mix(buffer.astype(np.uint64) + np.uint64(1))) * powers(_ODD, n), out=totals[1:])
    back = powers(_ODD_INVERSE, n + 1)
    return mix((totals[ends] - totals[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows a few at a time: texts that become Python values then take little memory, even
    beside others in one executor."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def row_key(*columns: str | Column) -> Column:
    """Identity of a row by its content: rows that agree in these columns count as one."""
    parts = [x for c in columns for x in (F.isnull(c), F.col(c) if isinstance(c, str) else c)]
    return F.xxhash64(*parts)
