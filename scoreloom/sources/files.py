"""Raw files as rows: read the files an index lists, or import a whole tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Entries, of some hundred bytes each, that are sent to every task.
FEW_ENTRIES = 100_000


def binary_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, content`` of all files below a folder, with plain paths relative to it as ``rel_path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = F.lit(plain(root).rstrip("/") + "/")
    path = plain_path(F.col("path"))
    return files.select(F.substr(path, F.length(base) + 1).alias("rel_path"), "length", "content")


def plain(path: str) -> str:
    """A path without the local file scheme."""
    return path.removeprefix("file://").removeprefix("file:")


def plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:(//)?", "")


def suffix(path: Column) -> Column:
    """File suffix with its dot, as written; empty if there is none."""
    return F.regexp_extract(path, r"(\.[^./]+)$", 1)


def read_entry_files(spark: SparkSession, entries: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Join entries with their files below ``root``; the second table lists entries without a readable file.

    Only files that an entry names are joined. Where the entries are known to be few they go to the files, so that no
    content is moved; otherwise files are dealt out by their paths. Which are missing is decided on the paths alone.
    """
    files = binary_files(spark, root).withColumnRenamed("rel_path", "filepath")
    named = entries.filter(F.col("filepath").isNotNull())
    few = named.limit(FEW_ENTRIES + 1).count() <= FEW_ENTRIES
    found = files.join(F.broadcast(named) if few else named, "filepath")
    found = found.select(*entries.columns, "length", "content").withColumn("source_type", suffix(F.col("filepath")))
    lost = entries.join(files.select("filepath"), "filepath", "left_anti")
    reason = F.when(F.col("filepath").isNull(), "no file of this type").otherwise("file not found")
    return found, lost.withColumn("error", reason)


def import_tree(
    spark: SparkSession, root: str, checksums: DataFrame | None = None, allow_invalid_checksum: bool = False
) -> DataFrame:
    """Every file below a folder: ``rel_path, length, sha256, content, checksum_ok``.

    ``checksums`` has ``rel_path, checksum``. Files whose content does not match are dropped, or only flagged
    with ``allow_invalid_checksum``; files without a listed checksum pass.
    """
    files = binary_files(spark, root).withColumn("sha256", F.sha2("content", 256))
    if checksums is None:
        return files.withColumn("checksum_ok", F.lit(True))
    listed = files.join(checksums.select("rel_path", "checksum"), "rel_path", "left")
    matches = F.coalesce(F.lower("checksum") == F.col("sha256"), F.col("checksum").isNull())
    checked = listed.withColumn("checksum_ok", matches).drop("checksum")
    return checked if allow_invalid_checksum else checked.filter("checksum_ok")
