"""Equal-width histograms of attribute values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.model import ATTRIBUTES

DEFAULT_BINS = (30,)


def attribute_values(table: DataFrame, attributes: Sequence[str] | None = None) -> DataFrame:
    """``metric, value`` per sequence and selected attribute; values not computed count as 0."""
    chosen = list(attributes) if attributes else list(ATTRIBUTES)
    unknown = [a for a in chosen if a not in ATTRIBUTES]
    if unknown:
        raise ValueError(f"unknown attributes: {', '.join(unknown)}")
    zero = F.lit(0.0)
    values = [(F.coalesce(F.col(a).cast("double"), zero) if a in table.columns else zero).alias(a) for a in chosen]
    return table.select(*values).unpivot([], chosen, "metric", "value")


def histogram(
    table: DataFrame, attributes: Sequence[str] | None = None, bins: Sequence[int] = DEFAULT_BINS
) -> DataFrame:
    """``metric, bins, bin, lo, hi, count`` with every bin of every metric, empty ones too.

    Bins have equal width over [min, max] and the last is closed; if min equals max the range is widened by
    half on both sides. The values are counted in one pass over the table, and the counts, a row per distinct value, are
    written; ranges and bins come from those, so the table is not read again.
    """
    if not bins or min(bins) < 1:
        raise ValueError("bins must be positive")
    counted = settled(attribute_values(table, attributes).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n")), "counted")
    low, high = F.min("value"), F.max("value")
    pad = F.when(low == high, 0.5).otherwise(0.0)
    # One row per metric, of which there are at most as many as attributes: safe to broadcast.
    ranges = counted.groupBy("metric").agg((low - pad).alias("lo"), (high + pad).alias("hi"), F.sum("n").alias("values"))
    ranges = ranges.withColumn("bins", F.explode(F.array(*[F.lit(int(b)) for b in bins])))
    width = F.col("hi") - F.col("lo")
    at = F.floor((F.col("value") - F.col("lo")) / width * F.col("bins")).cast("int")
    binned = (
        counted.join(F.broadcast(ranges), "metric")
        .groupBy("metric", "bins", F.least(at, F.col("bins") - 1).alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    grid = ranges.select("metric", "lo", "hi", "bins", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    step = (F.col("hi") - F.col("lo")) / F.col("bins")
    return grid.join(binned, ["metric", "bins", "bin"], "left").select(
        "metric",
        "bins",
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("lo"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("hi"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )
