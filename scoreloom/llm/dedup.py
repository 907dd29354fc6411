"""Exact deduplication by counting quotient filters.

Each partition of the corpus builds a counting quotient filter of its texts' 64-bit fingerprints. A filter keeps the
upper bits of a fingerprint (the quotient) only as a place in a table of slots and stores the lower bits (the
remainder), so the fingerprints and their counts can be read back in order, and two filters merge without loss by
merging their sorted remainders. Filters are cut into blocks of quotients, and the blocks of all partitions
are merged after a shuffle by block. A text that occurs a billion times is one slot of each partition's filter, so
no block is hot. Only texts whose fingerprint counts more than one are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.llm.common import lookup, unused, whole_text

FINGERPRINT_BITS = 60
# Expected fingerprints of one merged block, and how many a partition gathers before it writes a filter out.
BLOCK_ROWS = 1 << 17
BUILD_ROWS = 1 << 21


@dataclass(frozen=True)
class QuotientFilter:
    """Counting quotient filter of fingerprints of ``quotient_bits + remainder_bits`` bits.

    ``occupied`` has a bit per quotient. The remainders of a quotient form a run of consecutive slots, sorted, at or
    after the quotient's own slot; ``used`` and ``run_end`` have a bit per slot. Counts above one stand in
    ``counts``, in the order of the slots that ``counted`` marks.
    """

    quotient_bits: int
    remainder_bits: int
    occupied: np.ndarray
    used: np.ndarray
    run_end: np.ndarray
    counted: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, prints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From distinct, sorted fingerprints of ``bits`` bits and their counts."""
        quotient_bits = min(bits, max(1, int(np.ceil(np.log2(max(1, len(prints)) / 0.75)))))
        remainder_bits = bits - quotient_bits
        quotients = (prints >> np.uint64(remainder_bits)).astype(np.int64)
        order = np.arange(len(prints), dtype=np.int64)
        # A remainder takes its quotient's slot, or the next one after the remainder before it.
        slots = order + np.maximum.accumulate(quotients - order) if len(prints) else order
        size = max(1 << quotient_bits, int(slots[-1]) + 1 if len(slots) else 0)
        last = np.append(quotients[1:] != quotients[:-1], True) if len(prints) else np.zeros(0, bool)
        flags = np.zeros((4, size), bool)
        flags[0, quotients] = flags[1, slots] = True
        flags[2, slots[last]] = flags[3, slots[counts > 1]] = True
        kept = prints & np.uint64((1 << remainder_bits) - 1)
        narrow = np.uint32 if remainder_bits <= 32 else np.uint64
        return cls(quotient_bits, remainder_bits, *flags, kept.astype(narrow), counts[counts > 1].astype(np.int64))

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted fingerprints and their counts."""
        ends, occupied = self.run_end[self.used], np.flatnonzero(self.occupied)
        run = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
        prints = occupied[run].astype(np.uint64) << np.uint64(self.remainder_bits) | self.remainders.astype(np.uint64)
        counts = np.ones(len(prints), np.int64)
        counts[self.counted[self.used]] = self.counts
        return prints, counts

    def to_bytes(self) -> bytes:
        size = len(self.used)
        head = np.array([self.quotient_bits, self.remainder_bits, size, len(self.remainders)], np.int64)
        flags = [np.packbits(x) for x in (np.resize(self.occupied, size), self.used, self.run_end, self.counted)]
        return b"".join(x.tobytes() for x in (head, *flags, self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        quotient_bits, remainder_bits, size, n = (int(x) for x in np.frombuffer(data, np.int64, 4))
        at, wide, flags = 32, (size + 7) // 8, []
        for _ in range(4):
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, wide, at), count=size).astype(bool))
            at += wide
        kept = np.frombuffer(data, np.uint32 if remainder_bits <= 32 else np.uint64, n, at)
        counts = np.frombuffer(data[at + kept.nbytes :], np.int64)
        return cls(quotient_bits, remainder_bits, *flags, kept, counts)


def merged(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints of all filters, with the sums of their counts."""
    parts = [f.items() for f in filters]
    return summed(np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts]))


def summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.zeros(0, np.int64)
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def repeated_fingerprints(prints: DataFrame, bits: int = FINGERPRINT_BITS, blocks: int | None = None) -> DataFrame:
    """``print, count`` of the fingerprints that occur more than once in ``prints(print)``.

    ``prints`` are longs of ``bits`` bits. The number of blocks follows the number of rows.
    """
    if blocks is None:
        least = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = max(least, prints.count() // BLOCK_ROWS)
    block_bits = min(bits - 1, max(0, int(blocks - 1).bit_length()))
    inner = bits - block_bits

    def filters(values: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        block = (values >> np.uint64(inner)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        rows = []
        for a, b in zip(starts, np.append(starts[1:], len(block))):
            part = QuotientFilter.build(values[a:b] & np.uint64((1 << inner) - 1), counts[a:b], inner)
            rows.append((int(block[a]), part.to_bytes()))
        return pd.DataFrame(rows, columns=["block", "filter"])

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            values = batch["print"].to_numpy().astype(np.uint64)
            held.append(np.unique(values, return_counts=True))
            size += len(values)
            if size >= BUILD_ROWS:
                yield filters(*summed(*map(np.concatenate, zip(*held))))
                held, size = [], 0
        if size:
            yield filters(*summed(*map(np.concatenate, zip(*held))))

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values, counts = merged([QuotientFilter.from_bytes(x) for x in rows["filter"]])
        values = values | np.uint64(int(key[0]) << inner)
        more = counts > 1
        return pd.DataFrame({"print": values[more].astype(np.int64), "count": counts[more]})

    built = prints.mapInPandas(build, "block long, filter binary")
    return built.groupBy("block").applyInPandas(merge, "print long, count long")


def duplicate_classes(texts: DataFrame, bits: int = FINGERPRINT_BITS, blocks: int | None = None) -> DataFrame:
    """``print, sha, keep_id, size`` of each class of equal texts with more than one row in ``texts(doc_id, text)``.

    Texts whose fingerprint is repeated are grouped by their SHA-256, and the least and the greatest text of a group,
    compared byte by byte, must be the same. Were two texts ever to share a SHA-256, the job would stop with an
    error rather than merge them. Both aggregates run before the shuffle, so a hot text moves once per task.
    """
    hashed = texts.select("doc_id", "text", fingerprint("text", bits).alias("print"))
    suspects = settled(repeated_fingerprints(hashed.select("print"), bits, blocks), "repeated").select("print")
    suspected = lookup(hashed, suspects, ["print"], "left_semi")
    grouped = suspected.groupBy("print", F.sha2("text", 256).alias("sha")).agg(
        F.max("doc_id").alias("keep_id"),
        F.count(F.lit(1)).alias("size"),
        F.min("text").alias("least"),
        F.max("text").alias("greatest"),
    )
    same = F.when(F.col("least") == F.col("greatest"), F.col("size")).otherwise(
        F.raise_error(F.lit("two different texts have one SHA-256")).cast("long")
    )
    return grouped.select("print", "sha", "keep_id", same.alias("size")).where(F.col("size") > 1)


def fingerprint(text: str, bits: int = FINGERPRINT_BITS):
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def exact_duplicates(docs: DataFrame, bits: int = FINGERPRINT_BITS, blocks: int | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for each row of ``docs(doc_id, text)``.

    Texts are equal when their bytes are; a missing text counts as empty. Of equal texts the row with the largest
    ``doc_id`` stays. A row without a ``doc_id`` stays only if its text is not in a row that has one. Rows that
    repeat both ``doc_id`` and text can't be told apart and share one verdict; ``deduplicated`` gives one of them.
    An empty table gives no rows; other columns are not read.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    classes = settled(duplicate_classes(texts, bits, blocks), "classes")
    keyed = texts.select("doc_id", fingerprint("text", bits).alias("print"), F.sha2("text", 256).alias("sha"))
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return lookup(keyed, classes, ["print", "sha"]).select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each class of equal texts, with the columns of ``docs``: that with the largest ``doc_id``.

    Rows that repeat id and text are reduced to one after the others have gone, by a first that runs before the shuffle.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    classes = settled(duplicate_classes(texts), "classes")
    whole, mark, sha, keep, size = unused(docs, "whole", "print", "sha", "keep_id", "size")
    keyed = docs.withColumn(whole, whole_text()).withColumn(mark, fingerprint(whole)).withColumn(sha, F.sha2(whole, 256))
    classes = classes.select(F.col("print").alias(mark), F.col("sha").alias(sha), F.col("keep_id").alias(keep), F.col("size").alias(size))
    found = lookup(keyed, classes, [mark, sha])
    staying = found.where(F.col(size).isNull() | F.col(keep).eqNullSafe(F.col("doc_id")))
    alone = staying.where(F.col(size).isNull()).select(*docs.columns)
    chosen = staying.where(F.col(size).isNotNull()).dropDuplicates([mark, sha]).select(*docs.columns)
    return alone.unionByName(chosen)
