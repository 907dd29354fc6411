"""Hand out stored examples as shuffled, repeated and batched training tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import digest
from scoreloom.functions.storage import write_table

# The order key is a hash, so equal ranges of it hold equal shares of the rows whatever the data looks like.
# 4 hex digits give 65,536 ranges: the table of range sizes stays that small, and a range is one sorted window.
RANGE_DIGITS = 4
STABLE_SEED = "stable"


@dataclass(frozen=True)
class Loader:
    """Steps in fixed order: parse, map, filter, cache, shuffle, repeat, batch.

    Rows come with ``epoch`` and ``position``, their 0-based place, or in batches with ``batch_id`` and ``pos_in_batch``.
    """

    id_column: str = "seq_id"
    parse: Callable[[DataFrame], DataFrame] | None = None
    map: Callable[[DataFrame], DataFrame] | None = None
    filter: Column | Callable[[DataFrame], DataFrame] | None = None
    cache: bool = False
    cache_path: str | None = None
    shuffle: bool = False
    shuffle_repeat: bool = False
    seed: int | None = None
    repeat_count: int | None = None
    batch_size: int | None = 64
    batch_drop_remainder: bool = False

    def load(self, spark: SparkSession, *paths: str) -> DataFrame:
        return self.run(spark.read.parquet(*paths))

    def run(self, rows: DataFrame) -> DataFrame:
        if self.parse:
            rows = self.parse(rows)
        if self.map:
            rows = self.map(rows)
        if self.filter is not None:
            rows = rows.filter(self.filter) if isinstance(self.filter, Column) else self.filter(rows)
        if self.cache:
            rows = cached(rows, self.cache_path)
        epochs = self.repeat_count or 1
        if self.shuffle_repeat and self.shuffle:
            rows = repeated(rows, self.repeat_count).withColumn("order_key", self.order_key())
            rows = positioned(rows, self.id_column)
        else:
            # All epochs have one order, so rows are numbered before they are repeated.
            rows = positioned(rows.withColumns({"epoch": F.lit(0), "order_key": self.order_key()}), self.id_column)
            rows = repeated(rows.drop("epoch"), self.repeat_count)
            rows = rows.withColumn("position", F.col("epoch") * F.col("epoch_rows") + F.col("position"))
        if self.batch_size:
            rows = batched(rows, self.batch_size, self.batch_drop_remainder, epochs)
        return rows.drop("order_key", "epoch_rows")

    def order_key(self) -> Column:
        """Place of a row: a hash of its id, with the seed if shuffled, and with the epoch if reshuffled."""
        if not self.shuffle:
            return digest(STABLE_SEED, F.col(self.id_column))
        key = [F.col(self.id_column)]
        if self.shuffle_repeat:
            key.insert(0, F.col("epoch"))
        return digest(self.seed if self.seed is not None else 0, *key)


def cached(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Keep the rows for later epochs: in a table if a path is given, otherwise persisted by Spark."""
    if path is None:
        return rows.persist()
    write_table(rows, path, mode="overwrite")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def repeated(rows: DataFrame, count: int | None) -> DataFrame:
    """Each row once per ``epoch``. None and 0 mean once; without an end it could not be a table."""
    if count is not None and count < 0:
        raise ValueError("an endless repeat is not a bounded table")
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit((count or 1) - 1))))


def positioned(rows: DataFrame, id_column: str, order: str = "order_key") -> DataFrame:
    """Add ``position``, the 0-based place by (epoch, order key, id), and ``epoch_rows``, the rows per epoch.

    Rows are numbered inside (epoch, range of the order key), and each range starts where the ranges before it
    end, so nothing is sorted as a whole. Range sizes are a reduced count of at most 65,536 rows per epoch.
    Ids must be unique within an epoch, and every epoch must have the same rows (``repeated`` makes it so).
    """
    ranges = rows.withColumn("_range", F.substring(order, 1, RANGE_DIGITS))
    sizes = ranges.groupBy("epoch", "_range").agg(F.count(F.lit(1)).alias("_size"))
    epoch = Window.partitionBy("epoch")
    before = epoch.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "epoch",
        "_range",
        F.sum("_size").over(epoch).alias("epoch_rows"),
        F.coalesce(F.sum("_size").over(before), F.lit(0).cast("bigint")).alias("_start"),
    )
    inside = Window.partitionBy("epoch", "_range").orderBy(order, id_column)
    place = F.col("epoch") * F.col("epoch_rows") + F.col("_start") + F.col("_row") - 1
    return (
        ranges.withColumn("_row", F.row_number().over(inside))
        .join(starts, ["epoch", "_range"])
        .withColumn("position", place)
        .drop("_range", "_row", "_start")
    )


def batched(placed: DataFrame, batch_size: int, drop_remainder: bool = False, epochs: int = 1) -> DataFrame:
    """``batch_id`` and ``pos_in_batch`` instead of ``position``; batches may span epochs, the last one may be short or dropped."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    placed = placed.withColumns(
        {
            "batch_id": F.floor(F.col("position") / batch_size).cast("bigint"),
            "pos_in_batch": (F.col("position") % batch_size).cast("int"),
        }
    )
    if drop_remainder:
        placed = placed.filter(F.col("batch_id") < F.floor(F.col("epoch_rows") * epochs / batch_size))
    return placed.drop("position")


def batch_rows(rows: DataFrame, *features: str) -> DataFrame:
    """One row per batch with the features as arrays in order; a list holds one batch."""
    order = F.sort_array(F.collect_list(F.struct("pos_in_batch", *features)))
    return (
        rows.groupBy("batch_id")
        .agg(order.alias("_rows"))
        .select("batch_id", *[F.col(f"_rows.{f}").alias(f) for f in features])
    )
