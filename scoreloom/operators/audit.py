"""Counters: while the data passes (observations), or as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scoreloom.model import SeqSet


def count_elements(df: DataFrame, name: str = "total_elements") -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds their number once an action has run over them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def tap(df: DataFrame, pattern: str = ".*", id_column: str = "seq_id") -> DataFrame:
    """Rows whose id matches a pattern from its start on. The input is not changed."""
    return df.filter(F.col(id_column).rlike(f"^(?:{pattern})"))


def counters(table: DataFrame, stage: str, metrics: Mapping[str, Column]) -> DataFrame:
    """``stage, metric, value`` from aggregates over a table."""
    row = table.agg(*[c.cast("bigint").alias(n) for n, c in metrics.items()])
    return row.unpivot([], list(metrics), "metric", "value").select(F.lit(stage).alias("stage"), "metric", "value")


def stage_audit(stage: str, before: SeqSet, after: SeqSet) -> DataFrame:
    """Input and output sequences of one stage."""
    count = F.count(F.lit(1))
    return counters(before.sequences, stage, {"input_sequences": count}).unionByName(
        counters(after.sequences, stage, {"output_sequences": count})
    )

