"""Seeded augmentation and dataset splits.

Every draw is a hash of the seed, the sequence id and a purpose, so it is a column expression: no per-row
state, the same result on any number of partitions, and independent between purposes.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.hashing import uniform
from scoreloom.functions.ordered import with_group
from scoreloom.model import NOTES_PER_OCTAVE, PIANO_MAX_PITCH, PIANO_MIN_PITCH, SeqSet
from scoreloom.operators.transform import moved_pitch, out_of_band, transpose_events
from scoreloom.registry import operator

DEFAULT_SEED = 42
COPY_MARK = "#transposed"

TRANSPOSER_DEFAULTS = {
    "threshold": 0.5,
    "min_transpose_amount": -NOTES_PER_OCTAVE,
    "max_transpose_amount": NOTES_PER_OCTAVE,
    "min_allowed_pitch": PIANO_MIN_PITCH,
    "max_allowed_pitch": PIANO_MAX_PITCH,
    "transpose_chords": True,
    "delete_notes": True,
    "in_place": True,
    "seed": DEFAULT_SEED,
    "only_splits": None,
}


def gate(seed: int, threshold: float, seq_id: Column) -> Column:
    """True for the sequences to augment: a share of ``1 - threshold`` of them."""
    return uniform(seed, seq_id, "gate") > threshold


def drawn_amount(seed: int, seq_id: Column, low: Column, high: Column) -> Column:
    """A whole number in ``[low, high)``; ``low`` itself if the two are equal."""
    spread = F.floor(uniform(seed, seq_id, "amount") * (high - low))
    return F.when(low == high, low).otherwise(low + spread).cast("int")


def clamped_bounds(pitches: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    """Range of amounts that keeps every note of a sequence in the band. Adds ``low`` and ``high``."""

    def clamp(amount: int) -> Column:
        if amount < 0:
            return -F.least(F.col("lowest") - o["min_allowed_pitch"], F.lit(abs(amount)))
        return F.least(o["max_allowed_pitch"] - F.col("highest"), F.lit(amount))

    return pitches.withColumns({"low": clamp(o["min_transpose_amount"]), "high": clamp(o["max_transpose_amount"])})


def pitch_extent(o: Mapping[str, Any]) -> dict[str, Column]:
    """Mergeable aggregates of a sequence's notes that decide what happens to it."""
    low, high = F.lit(o["min_transpose_amount"]), F.lit(o["max_transpose_amount"])
    moved = moved_pitch(drawn_amount(o["seed"], F.col("seq_id"), low, high))
    pitched = F.when(~F.col("is_drum"), F.col("pitch"))
    return {
        "lowest": F.min(pitched),
        "highest": F.max(pitched),
        "notes": F.count(F.lit(1)),
        "outside": F.count_if(out_of_band(moved, o["min_allowed_pitch"], o["max_allowed_pitch"])),
    }


def decided(rows: DataFrame, o: Mapping[str, Any]) -> DataFrame:
    """Add ``outcome, amount, deleted`` to rows that have their sequence's ``pitch_extent``.

    Outcomes: ``passed`` (not drawn), ``invalid_range`` (no pitched note, or no amount keeps it in the band),
    ``range_exceeded`` (nothing would be left) and ``augmented``.
    """
    zero = F.lit(0).cast("bigint")
    drawn = gate(o["seed"], o["threshold"], F.col("seq_id"))
    if o["only_splits"] is not None:
        drawn = drawn & F.col("split").isin(list(o["only_splits"]))
    if o["delete_notes"]:
        rows = rows.withColumns({"low": F.lit(o["min_transpose_amount"]), "high": F.lit(o["max_transpose_amount"])})
        invalid, deleted = F.lit(False), F.coalesce("outside", zero)
    else:
        rows = clamped_bounds(rows, o)
        invalid, deleted = F.col("lowest").isNull() | (F.col("low") > F.col("high")), zero
    outcome = (
        F.when(~drawn, "passed")
        .when(invalid, "invalid_range")
        .when(F.coalesce(F.col("notes") - deleted, zero) == 0, "range_exceeded")
        .otherwise("augmented")
    )
    amount = drawn_amount(o["seed"], F.col("seq_id"), F.col("low"), F.col("high"))
    return (
        rows.withColumn("outcome", outcome)
        .withColumns(
            {
                "amount": F.when(F.col("outcome") == "augmented", amount),
                "deleted": F.when(F.col("outcome").isin("augmented", "range_exceeded"), deleted),
            }
        )
        .drop("low", "high", "lowest", "highest", "notes", "outside")
    )


def amounts(seqs: SeqSet, o: Mapping[str, Any]) -> DataFrame:
    """One row per sequence, with or without notes: ``seq_id, outcome, amount, deleted`` (and ``split``)."""
    header = ["seq_id", "split"] if "split" in seqs.sequences.columns else ["seq_id"]
    extent = seqs.notes.groupBy("seq_id").agg(*[c.alias(n) for n, c in pitch_extent(o).items()])
    return decided(seqs.sequences.select(*header).join(extent, "seq_id", "left"), o)


@operator("augmenter", "transposer", **TRANSPOSER_DEFAULTS)
def augment_transpose(seqs: SeqSet, **given) -> SeqSet:
    """Transpose a random share of the sequences by a random amount.

    ``in_place`` replaces a drawn sequence by its transposed form; otherwise the transposed form is added under
    a new id. A drawn sequence with no note left in the band is dropped (``augment_audit`` counts it). With
    ``delete_notes=False`` the range of amounts is narrowed so that no note leaves the band.
    """
    o = {**TRANSPOSER_DEFAULTS, **given}
    amount = F.coalesce("amount", F.lit(0))

    @functools.cache
    def plan() -> DataFrame:
        return amounts(seqs, o).select("seq_id", "outcome", "amount")

    def emitted(table: DataFrame) -> DataFrame:
        """Rows of kept sequences with ``moving``: once, or a second time for the added transposed form."""
        kept = table.filter("outcome <> 'range_exceeded'")
        if o["in_place"]:
            return kept.withColumn("moving", F.lit(True))
        twice = F.when(F.col("outcome") == "augmented", F.array(F.lit(False), F.lit(True)))
        return kept.withColumn("moving", F.explode(F.coalesce(twice, F.array(F.lit(False)))))

    def finished(table: DataFrame, notes: bool = False) -> DataFrame:
        if not o["in_place"]:
            seq_id = F.when(F.col("moving"), F.concat("seq_id", F.lit(COPY_MARK))).otherwise(F.col("seq_id"))
            table = seqs.renamed(table, seq_id).drop("parent_id") if notes else table.withColumn("seq_id", seq_id)
        return table.drop("outcome", "amount", "deleted", "moving")

    split_known = o["only_splits"] is None or "split" in seqs.notes.columns
    if o["in_place"] and o["delete_notes"] and split_known:
        # The draw follows from the id, and deleting its notes is what empties a sequence: a plain projection.
        nothing = {"lowest": F.lit(None).cast("int"), "highest": F.lit(None).cast("int")}
        alone = seqs.notes.withColumns({**nothing, "notes": F.lit(1), "outside": F.lit(0).cast("bigint")})
        notes = decided(alone, o)
    elif seqs.bounded and split_known:
        notes = decided(with_group(seqs.notes, seqs.keys, pitch_extent(o), bounded=True), o)
    else:
        notes = seqs.notes.join(plan(), "seq_id")
    notes = emitted(notes)
    pitch = F.when(F.col("moving"), moved_pitch(amount)).otherwise(F.col("pitch"))
    outside = out_of_band(moved_pitch(amount), o["min_allowed_pitch"], o["max_allowed_pitch"])
    notes = notes.filter(~F.col("moving") | F.col("amount").isNull() | ~outside).withColumn("pitch", pitch.cast("int"))

    def events() -> DataFrame:
        found = emitted(seqs.events.join(plan(), "seq_id"))
        if o["transpose_chords"]:
            found = transpose_events(found, F.when(F.col("moving"), amount).otherwise(F.lit(0)))
        return finished(found)

    return seqs.with_(
        sequences=lambda: finished(emitted(seqs.sequences.join(plan(), "seq_id"))),
        notes=finished(notes, notes=True),
        events=events,
    )


def original_id(seq_id: Column) -> Column:
    """Id of the sequence that an added transposed form comes from, or the id itself."""
    return F.regexp_replace(seq_id, f"({COPY_MARK})+$", "")


def augment_audit(seqs: SeqSet, **given) -> DataFrame:
    """One row of counters (per split if there are splits) and of the ``deleted_notes`` distribution."""
    o = {**TRANSPOSER_DEFAULTS, **given}
    rows = amounts(seqs, o)
    group = ["split"] if "split" in rows.columns else []
    tried = F.col("outcome").isin("augmented", "range_exceeded")
    copies = F.lit(0) if o["in_place"] else F.count_if(F.col("outcome") == "augmented")
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("input_sequences"),
        (F.count_if(F.col("outcome") != "range_exceeded") + copies).alias("output_sequences"),
        F.count_if(tried).alias("augmented_sequences"),
        F.count_if(F.col("outcome") == "range_exceeded").alias("skipped_due_to_range_exceeded"),
        F.count_if(F.col("outcome") == "invalid_range").alias("skipped_invalid_range"),
        F.count("deleted").alias("deleted_count"),
        F.sum("deleted").alias("deleted_sum"),
        F.min("deleted").alias("deleted_min"),
        F.max("deleted").alias("deleted_max"),
    )


def check_ratios(ratios: Mapping[str, float]) -> None:
    if len(ratios) < 2:
        raise ValueError("At least two splits are needed.")
    if min(ratios.values()) <= 0 or abs(sum(ratios.values()) - 1) > 1e-6:
        raise ValueError("Split ratios must be positive and sum to 1.")


def split_of(ratios: Mapping[str, float], seq_id: Column, seed: int = DEFAULT_SEED) -> Column:
    """Name of the split a sequence falls in."""
    check_ratios(ratios)
    u, upper, chosen = uniform(seed, seq_id, "split"), 0.0, None
    names = list(ratios)
    for name in names[:-1]:
        upper += ratios[name]
        chosen = F.when(u < upper, name) if chosen is None else chosen.when(u < upper, name)
    return chosen.otherwise(names[-1])


def assign_splits(seqs: SeqSet, ratios: Mapping[str, float], seed: int = DEFAULT_SEED) -> SeqSet:
    """Give each sequence header, and its notes, their ``split``."""
    split = split_of(ratios, F.col("seq_id"), seed)
    return seqs.with_(sequences=lambda: seqs.sequences.withColumn("split", split), notes=lambda: seqs.notes.withColumn("split", split))


def split_report(sequences: DataFrame, ratios: Mapping[str, float]) -> DataFrame:
    """``split, actual, expected`` with expected the whole part of total times ratio."""
    counts = sequences.groupBy("split").agg(F.count(F.lit(1)).alias("actual"))
    # The counts are one row per configured split by now, so the list has as many entries as the configuration.
    named = F.array(*[F.struct(F.lit(n).alias("split"), F.lit(float(r)).alias("ratio")) for n, r in ratios.items()])
    grouped = counts.agg(
        F.sum("actual").alias("total"), F.map_from_entries(F.collect_list(F.struct("split", "actual"))).alias("by_split")
    )
    rows = grouped.select("total", "by_split", F.inline(named))
    return rows.select(
        "split",
        F.coalesce(F.try_element_at("by_split", F.col("split")), F.lit(0).cast("bigint")).alias("actual"),
        F.floor(F.coalesce("total", F.lit(0)) * F.col("ratio")).cast("bigint").alias("expected"),
    )
