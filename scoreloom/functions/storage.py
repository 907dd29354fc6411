"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of the context's checkpoints, or the one that ``spark.checkpoint.dir`` names.

    Only a local master may do without: it then uses a temporary folder. On a cluster each executor would write
    to its own disk there, and a later read would miss rows, so an error is raised instead.
    """
    context = spark.sparkContext
    set_for_context = context._jsc.sc().getCheckpointDir()
    if set_for_context.isDefined():
        return set_for_context.get()
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return tempfile.mkdtemp(prefix="scoreloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def rows_written(spark: SparkSession, path: str) -> int:
    """Rows of a written table, from its files' footers.

    Unlike a count that tasks add up while they write, it says nothing twice for a task that was run again.
    """
    return spark.read.parquet(path).count()


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For a result that several branches of a plan use: without this each branch computes it again. The table
    outlives a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
