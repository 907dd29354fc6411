"""Put notes on a step grid, either per quarter note or per second."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import with_group
from scoreloom.model import (
    DEFAULT_DENOMINATOR,
    DEFAULT_NUMERATOR,
    DEFAULT_QPM,
    DEFAULT_STEPS_PER_QUARTER,
    GRID,
    SeqSet,
)
from scoreloom.registry import operator

REASONS = ("multiple_time_signatures", "multiple_tempos", "bad_time_signature", "negative_time")


def first_header(events: DataFrame) -> DataFrame:
    """Tempo and time signature of each sequence, with how many values it has of each.

    All aggregates are mergeable, so a sequence with very many events is reduced before the shuffle.
    """
    tempo, signature = F.col("kind") == "tempo", F.col("kind") == "time_signature"
    value = F.struct("num", "den")
    return (
        events.filter(tempo | signature)
        .groupBy("seq_id")
        .agg(
            F.min_by(F.when(tempo, F.col("qpm")), F.when(tempo, F.col("time"))).alias("qpm"),
            (F.min(F.when(tempo, F.col("qpm"))) != F.max(F.when(tempo, F.col("qpm")))).alias("many_tempos"),
            F.min(F.when(signature, F.struct("time", "num", "den"))).alias("first_sig"),
            (F.min(F.when(signature, value)) != F.max(F.when(signature, value))).alias("many_signatures"),
        )
        .select(
            "seq_id",
            "qpm",
            F.col("first_sig.num").alias("num"),
            F.col("first_sig.den").alias("den"),
            "many_tempos",
            "many_signatures",
        )
    )


def with_defaults(header: DataFrame) -> DataFrame:
    return header.withColumns(
        {
            "qpm": F.coalesce("qpm", F.lit(DEFAULT_QPM)),
            "num": F.coalesce("num", F.lit(DEFAULT_NUMERATOR)),
            "den": F.coalesce("den", F.lit(DEFAULT_DENOMINATOR)),
        }
    )


def to_step(time: Column, steps_per_time: Column) -> Column:
    return F.floor(time * steps_per_time + 0.5).cast("bigint")


def check_grid(steps_per_quarter: int | None, steps_per_second: float | None) -> None:
    if (steps_per_quarter is None) == (steps_per_second is None):
        raise ValueError("Exactly one of steps_per_quarter or steps_per_second must be set.")


def grid_columns(steps_per_quarter: int | None, steps_per_second: float | None) -> dict[str, Column]:
    """Grid of a row that has its sequence's header and extent: rate, bar and length in steps, and ``reason``.

    A sequence has one reason not to be quantized at most; they are tested in the order of ``REASONS``. The
    absolute grid does not depend on tempo or signature, so only negative time counts there.
    """
    check_grid(steps_per_quarter, steps_per_second)
    negative = F.least("first_start", "first_end") < 0
    if steps_per_quarter is not None:
        rate = F.col("qpm") / 60.0 * steps_per_quarter
        power_of_two = (F.col("den") > 0) & (F.col("den").bitwiseAND(F.col("den") - 1) == 0)
        bad = ~((F.col("num") > 0) & power_of_two)
        reason = (
            F.when(F.col("many_signatures"), REASONS[0])
            .when(F.col("many_tempos"), REASONS[1])
            .when(bad, REASONS[2])
            .when(negative, REASONS[3])
        )
        bar = F.when(~bad, F.lit(4.0 * steps_per_quarter) * F.col("num") / F.col("den"))
    else:
        rate = F.lit(float(steps_per_second))
        reason = F.when(negative, REASONS[3])
        bar = F.try_divide(F.lit(240.0 * steps_per_second) * F.col("num"), F.col("qpm") * F.col("den"))
    steps = F.greatest(to_step(F.col("last_end"), rate), to_step(F.col("last_start"), rate) + 1)
    return {
        "step_rate": rate,
        "steps_per_bar": bar,
        "total_steps": F.coalesce(steps, F.lit(0).cast("bigint")),
        "reason": reason,
    }


HEADER = ("qpm", "num", "den", "many_tempos", "many_signatures")
EXTENT = ("first_start", "last_start", "first_end", "last_end")


def extent() -> dict[str, Column]:
    first, last = F.min, F.max
    return dict(zip(EXTENT, (first("start_time"), last("start_time"), first("end_time"), last("end_time"))))


def grid_headers(seqs: SeqSet, steps_per_quarter: int | None, steps_per_second: float | None) -> DataFrame:
    """One row per sequence, with or without notes: ``seq_id`` and the grid columns."""
    extents = seqs.notes.groupBy("seq_id").agg(*[c.alias(n) for n, c in extent().items()])
    header = with_defaults(
        seqs.sequences.select("seq_id")
        .join(first_header(seqs.events), "seq_id", "left")
        .join(extents, "seq_id", "left")
    )
    return header.select(
        "seq_id", *[c.alias(n) for n, c in grid_columns(steps_per_quarter, steps_per_second).items()]
    )


@operator("processor", "quantizer", steps_per_quarter=DEFAULT_STEPS_PER_QUARTER, steps_per_second=None)
def quantize(
    seqs: SeqSet, steps_per_quarter: int | None = DEFAULT_STEPS_PER_QUARTER, steps_per_second: float | None = None
) -> SeqSet:
    """Round note times to grid steps (half up; every note lasts at least one step).

    Sequences that cannot be put on one grid are left out; ``discards`` says which and why. Headers keep ``step_rate``,
    the steps per second.
    """
    columns = grid_columns(steps_per_quarter, steps_per_second)

    @functools.cache
    def grid() -> DataFrame:
        return grid_headers(seqs, steps_per_quarter, steps_per_second).filter("reason is null").drop("reason")

    rate = F.col("step_rate")
    start = to_step(F.col("start_time"), rate)
    if seqs.bounded:
        if set(GRID) <= set(seqs.notes.columns):
            never = F.lit(False)
            header = seqs.notes.withColumns({"many_tempos": never, "many_signatures": never})
        else:
            header = with_defaults(seqs.notes.join(first_header(seqs.events), "seq_id", "left"))
        gridded = with_group(header, seqs.keys, extent(), bounded=True).withColumns(columns).filter("reason is null")
        gridded = gridded.drop(*HEADER, *EXTENT, "reason")
    else:
        gridded = seqs.notes.drop(*GRID).join(grid(), "seq_id")
    notes = gridded.withColumns(
        {"q_start": start, "q_end": F.greatest(to_step(F.col("end_time"), rate), start + 1)}
    ).drop("step_rate")

    def events() -> DataFrame:
        with_rate = seqs.events.join(grid().select("seq_id", "step_rate"), "seq_id")
        return with_rate.withColumn("q_step", to_step(F.col("time"), rate)).drop("step_rate")

    def sequences() -> DataFrame:
        return seqs.sequences.join(grid().select("seq_id", "total_steps", "step_rate"), "seq_id").withColumns(
            {
                "steps_per_quarter": F.lit(steps_per_quarter).cast("int"),
                "steps_per_second": F.lit(steps_per_second).cast("double"),
            }
        )

    return SeqSet(sequences, notes, events, max_rows=seqs.max_rows)


def discards(
    seqs: SeqSet, steps_per_quarter: int | None = DEFAULT_STEPS_PER_QUARTER, steps_per_second: float | None = None
) -> DataFrame:
    """Sequences the quantizer leaves out: ``seq_id, reason``."""
    grid = grid_headers(seqs, steps_per_quarter, steps_per_second)
    return grid.filter(F.col("reason").isNotNull()).select("seq_id", "reason")
