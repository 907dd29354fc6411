"""Write tables, split directories and debug records, with the policy for output that already exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.functions.storage import write_table
from scoreloom.model import SeqSet
from scoreloom.operators.audit import tap


# Spark leaves the first in a table's folder when all its files are there; a job leaves the second in its output's.
TABLE_DONE, JOB_DONE = "_SUCCESS", "_COMPLETE"


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on whatever file system it names."""
    system, target = _file(spark, path)
    return system.exists(target)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing its output: half-written output counts as none."""
    return exists(spark, f"{path}/{JOB_DONE}")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Write a job's marker, after all of its tables."""
    system, target = _file(spark, f"{path}/{JOB_DONE}")
    system.create(target, True).close()


def unmark(spark: SparkSession, path: str) -> None:
    """Take a job's marker away before its output is written again."""
    system, target = _file(spark, f"{path}/{JOB_DONE}")
    system.delete(target, False)


def write_dataset(df: DataFrame, path: str, force_overwrite: bool = False, partition_by: list[str] | None = None) -> bool:
    """Write unless a complete table exists there, or replace it if told to. True if something was written."""
    if not force_overwrite and exists(df.sparkSession, f"{path}/{TABLE_DONE}"):
        return False
    write_table(df, path, "overwrite", partition_by)
    return True


def write_splits(examples: DataFrame, path: str, force_overwrite: bool = False) -> bool:
    """One directory per split, ``split=<name>``, so that a reader of one split opens only its files."""
    return write_dataset(examples, path, force_overwrite, ["split"])


def write_debug(seqs: SeqSet, path: str, stage: str, pattern: str = ".*", folder: str = "debug") -> None:
    """Headers and notes of the sequences whose id matches, as JSON below ``<path>/<folder>/<stage>``."""
    for name in ("sequences", "notes"):
        tap(getattr(seqs, name), pattern).write.mode("overwrite").json(f"{path}/{folder}/{stage}/{name}")
