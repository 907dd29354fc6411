"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Rows of two or three numbers; a broadcast of this many takes some tens of megabytes.
BROADCAST_ROWS = 500_000


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the table doesn't have, whatever its own are called."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def whole_text(text: str | Column = "text") -> Column:
    """The text, where a missing one counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def few(df: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether the table is known to have at most ``bound`` rows; counts no further than that."""
    return df.limit(bound + 1).count() <= bound


def lookup(df: DataFrame, table: DataFrame, on: list[str], how: str = "left", bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join a table of one row per key: broadcast where it has been counted to be small, else by a shuffle.

    The rows are the same either way. In the shuffle, hot keys of ``df`` are left to the adaptive skew join.
    """
    return df.join(F.broadcast(table) if few(table, bound) else table, on, how)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows of Arrow batches with about ``most`` code points of text, and their texts; one row at least.

    A missing text is given as an empty one.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for i, length in enumerate(lengths):
            if i > first and held + length > most:
                part = batch.slice(first, i - first)
                yield part, pc.fill_null(part.column(column), "").to_pylist()
                first, held = i, 0
            held += length
        if first < len(lengths):
            part = batch.slice(first)
            yield part, pc.fill_null(part.column(column), "").to_pylist()


def give_back() -> None:
    """Return what this worker has freed to the system. Workers outlive their tasks, and would hold the most that any of them took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# Rows that are read from files at once, and those of an Arrow batch that goes to Python.
BATCH_SETTINGS = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Within this, batches that are read or go to Python have so many rows at most; for jobs that hold more than one batch of whole texts."""
    before = {name: spark.conf.get(name) for name in BATCH_SETTINGS}
    for name in BATCH_SETTINGS:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def byte_slices(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts of about ``most`` bytes, cut before a space or a line feed; one without any is left whole."""
    at = 0
    while len(text) - at > most:
        cuts = [cut for cut in (text.find(b" ", at + most), text.find(b"\n", at + most)) if cut >= 0]
        if not cuts:
            break
        yield text[at : min(cuts)]
        at = min(cuts)
    yield text[at:]


def planes(values: np.ndarray) -> bytes:
    """Small numbers, as few bytes of each as the largest needs, compressed byte plane after byte plane."""
    wide = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    bytes_ = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)[:, :wide]
    return bytes([wide]) + zstandard.compress(bytes_.T.tobytes(), 3)


def from_planes(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    values = np.zeros((flat.shape[1], 4), np.uint8)
    values[:, : data[0]] = flat.T
    return values.view("<u4").ravel()


def gaps(values: np.ndarray) -> bytes:
    """Sorted distinct numbers of up to 62 bits, by their differences."""
    # The upper half is shifted in place: values may be millions, and workers keep the memory of their largest arrays.
    between = values.copy()
    between[1:] -= values[:-1]
    low = planes(between.astype(np.uint32) & np.uint32(0x7FFFFFFF))
    between >>= 31
    return len(low).to_bytes(4, "little") + low + planes(between.astype(np.uint32))


def from_gaps(data: bytes) -> np.ndarray:
    end = 4 + int.from_bytes(data[:4], "little")
    values = from_planes(data[end:]).astype(np.int64)
    values <<= 31
    values += from_planes(data[4:end])
    return np.cumsum(values, out=values)
