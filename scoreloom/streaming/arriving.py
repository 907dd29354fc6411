"""Canonicalize a folder that grows: each run takes the files that came since the last one, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.functions.storage import settled
from scoreloom.sources.canonical import decoded, document_key, separated
from scoreloom.sources.files import suffix

# What the binary file source delivers.
FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(spark: SparkSession, folder: str, collection_name: str) -> DataFrame:
    """New files as rows for ``canonicalize``; the id of a sequence is its file name without suffix."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace(name, r"\.[^.]+$", "").alias("seq_id"),
        F.col("path").alias("filepath"),
        suffix(F.col("path")).alias("source_type"),
        F.lit(collection_name).alias("collection_name"),
        F.lit(None).cast("string").alias("metadata_json"),
        "content",
    )


def canonicalize_arriving(
    spark: SparkSession, folder: str, output: str, checkpoint: str, collection_name: str = "", distinct: bool = False
) -> StreamingQuery:
    """Decode what has arrived and add it to the tables below ``output``; then stop.

    A batch writes to folders of its own number and replaces them, so a batch that is run again after a failure
    leaves each file's rows once. Read with ``<output>/*/notes`` and the like.

    With ``distinct`` a file is passed over whose notes and events are those of one taken before, in this run or an earlier one: the
    keys of all contents are kept as the query's state, 64 bytes each, spread over its shuffle partitions and restored
    from the checkpoint. Of copies in one batch one stays. Files that can't be decoded are all reported.
    """
    rows = decoded(arriving_files(spark, folder, collection_name))
    if distinct:
        key = F.when(F.col("error").isNull(), document_key()).otherwise(F.concat(F.lit("file:"), "filepath"))
        rows = rows.withColumn("content", key).dropDuplicates(["content"]).drop("content")

    def write(batch_rows: DataFrame, batch: int) -> None:
        done = separated(settled(batch_rows, "arrived"))
        tables = {"sequences": done.seqs.sequences, "notes": done.seqs.notes, "events": done.seqs.events}
        for table, made in {**tables, "quarantine": done.quarantine}.items():
            made.write.mode("overwrite").parquet(f"{output}/batch={batch}/{table}")

    stream = rows.writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
