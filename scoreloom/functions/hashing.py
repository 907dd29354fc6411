"""Reproducible randomness and content fingerprints, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int | str | Column, *key: Column | str) -> Column:
    """md5 of the seed and the key, as 32 hex digits."""
    first = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat_ws(":", first.cast("string"), *[_text(k) for k in key]))


def uniform(seed: int | str | Column, *key: Column | str) -> Column:
    """A number in [0, 1) that depends on the seed and the key alone.

    Unlike ``rand(seed)`` it does not change with the partitioning, a retried task or a lost executor.
    """
    return F.conv(F.substring(digest(seed, *key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def row_hashes(*columns: Column) -> tuple[Column, Column]:
    """Two independent 60-bit numbers for a row. Summed as decimals they identify a bag of rows.

    A missing value is written as a marker, so that it differs from an empty string and keeps its place.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns]
    digits = F.md5(F.concat_ws("|", *parts))
    return tuple(F.conv(F.substring(digits, at, 15), 16, 10).cast("decimal(20,0)") for at in (1, 17))


def _text(value: Column | str) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(value)
