"""Stored sequence sets: three Parquet tables in one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.functions.storage import rows_written, write_table
from scoreloom.model import ROOT, SeqSet

TABLES = ("sequences", "notes", "events")


def write_seqset(seqs: SeqSet, path: str, mode: str = "errorifexists") -> dict[str, int]:
    """Write the three tables and return how many rows each has, by the files that were committed."""
    counts = {}
    for name in TABLES:
        write_table(getattr(seqs, name).drop(ROOT), f"{path}/{name}", mode)
        counts[name] = rows_written(seqs.notes.sparkSession, f"{path}/{name}")
    return counts


def read_seqset(spark: SparkSession, path: str, *, measure: bool = True) -> SeqSet:
    """A stored set. Measuring counts the rows of the largest sequence, which lets small ones use plain windows."""
    seqs = SeqSet(*[spark.read.parquet(f"{path}/{name}") for name in TABLES])
    return seqs.measured() if measure else seqs


def read_sequences(spark: SparkSession, *patterns: str) -> DataFrame:
    """Headers from all folders that match the patterns; only the columns used are read."""
    return spark.read.parquet(*[f"{p}/sequences" for p in patterns])
