"""Thirteen descriptors per sequence, all from one ordered scan and one grouped aggregate.

They describe the melody line: one note per step (the top one), each ending where the next starts. Every
descriptor is a ratio of mergeable aggregates over rows that know their previous notes, so no sequence is
ever gathered: ``contour`` telescopes to last minus first, time sounding is added up note by note as the next
one arrives, and repeated sections are counted from each note's position in its run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import BLOCK_STEPS, block_of, scan
from scoreloom.model import ATTRIBUTES, PIANO_PITCHES, SeqSet
from scoreloom.operators.melody import one_note_per_step
from scoreloom.registry import lookup, operator

# Metrical weight of each position of a bar, in sixteen (binary) or twelve (ternary) parts.
BINARY_WEIGHTS = (5, 1, 2, 1, 3, 1, 2, 1, 4, 1, 2, 1, 3, 1, 2, 1)
TERNARY_WEIGHTS = (4, 1, 1, 2, 1, 1, 3, 1, 1, 2, 1, 1)

ROUND_DIGITS = 5


def melody_line(seqs: SeqSet) -> DataFrame:
    """The onset rows the descriptors are computed from, with what each knows of the notes before it."""
    if not seqs.quantized:
        raise ValueError("attributes need quantized sequences")
    notes = seqs.notes.select(
        *seqs.keys, "note_idx", "q_start", "q_end", "pitch", "velocity", "steps_per_bar", "total_steps"
    )
    if not seqs.monophonic:
        notes = one_note_per_step(notes, seqs.keys).drop("voices")
    return scan(
        notes.drop("note_idx"),
        seqs.keys,
        "q_start",
        ["q_end", "pitch"],
        block=block_of("q_start", BLOCK_STEPS, seqs.bounded or seqs.short),
        starts_run=lambda before, row: before["pitch"] != row["pitch"],
        look_back=2,
    )


def grid_position(step: Column, parts: int) -> Column:
    return F.floor(step * F.lit(parts) / F.col("steps_per_bar"))


def on_grid(bars: int, parts: int) -> Column:
    """True for the first onset on each of the first ``bars * parts`` grid positions."""
    here, before = grid_position(F.col("q_start"), parts), grid_position(F.col("prev.q_start"), parts)
    return (here < bars * parts) & (before.isNull() | (before != here))


def sounding() -> Column:
    """Steps during which something sounds: each note up to the next onset, the last one to its end."""
    previous = F.least("prev.q_end", "q_start") - F.col("prev.q_start")
    return F.coalesce(F.sum(previous), F.lit(0)) + F.max_by(F.col("q_end") - F.col("q_start"), F.col("q_start"))


def _weights(binary: bool) -> tuple[int, ...]:
    return BINARY_WEIGHTS if binary else TERNARY_WEIGHTS


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


@operator("attribute", "toussaint", bars=2, binary=True)
def toussaint(bars: int = 2, binary: bool = True) -> Column:
    """Share of the metrical weight of ``bars`` bars that falls on onsets; null where no onset lies in them, as in SQL a sum of nothing."""
    weights = _weights(binary)
    weight = F.get(F.array(*map(F.lit, weights)), (grid_position(F.col("q_start"), len(weights)) % len(weights)).cast("int"))
    taken = F.sum(F.when(on_grid(bars, len(weights)), weight))
    return F.try_divide(taken.cast("double"), F.lit(float(bars * sum(weights))))


@operator("attribute", "note_density", bars=2, binary=True)
def note_density(bars: int = 2, binary: bool = True) -> Column:
    """Share of the grid positions of ``bars`` bars that hold an onset."""
    parts = len(_weights(binary))
    return _ratio(F.count_if(on_grid(bars, parts)), F.lit(bars * parts))


@operator("attribute", "pitch_range", num_midi_pitches=PIANO_PITCHES)
def pitch_range(num_midi_pitches: int = PIANO_PITCHES) -> Column:
    return _ratio(F.max("pitch") - F.min("pitch"), F.lit(num_midi_pitches))


@operator("attribute", "contour", num_midi_pitches=PIANO_PITCHES)
def contour(num_midi_pitches: int = PIANO_PITCHES) -> Column:
    """Mean interval between consecutive notes, which is (last - first) over the number of intervals."""
    rise = F.max_by("pitch", "q_start") - F.min_by("pitch", "q_start")
    return _ratio(rise, (F.count(F.lit(1)) - 1) * num_midi_pitches)


@operator("attribute", "unique_notes_ratio", num_midi_pitches=PIANO_PITCHES)
def unique_notes_ratio(num_midi_pitches: int = PIANO_PITCHES) -> Column:
    return _ratio(_kinds(F.col("pitch")), F.count(F.lit(1)))


def _kinds(values: Column) -> Column:
    """Number of different values of a small domain. Sets merge in one aggregate; a distinct count would copy every row."""
    return F.size(F.collect_set(values))


def _bigram() -> Column:
    return F.col("prev.pitch") * 128 + F.col("pitch")


def _trigram() -> Column:
    return F.col("prev2.pitch") * 16384 + _bigram()


@operator("attribute", "unique_bigrams_ratio", num_midi_pitches=PIANO_PITCHES)
def unique_bigrams_ratio(num_midi_pitches: int = PIANO_PITCHES) -> Column:
    return _ratio(_kinds(_bigram()), F.count("prev.pitch"))


@operator("attribute", "unique_trigrams_ratio", num_midi_pitches=PIANO_PITCHES)
def unique_trigrams_ratio(num_midi_pitches: int = PIANO_PITCHES) -> Column:
    return _ratio(F.count_distinct(_trigram()), F.count("prev2.pitch"))


@operator("attribute", "dynamic_range")
def dynamic_range() -> Column:
    return _ratio(F.max("velocity") - F.min("velocity"), F.lit(127))


@operator("attribute", "note_change_ratio")
def note_change_ratio() -> Column:
    return _ratio(F.count_if(F.col("prev.pitch") != F.col("pitch")), F.count("prev.pitch"))


@operator("attribute", "ratio_note_off_steps")
def ratio_note_off_steps() -> Column:
    total = F.max("total_steps")
    return _ratio(total - sounding(), total)


@operator("attribute", "ratio_hold_note_steps")
def ratio_hold_note_steps() -> Column:
    return _ratio(sounding() - F.count(F.lit(1)), F.max("total_steps"))


def _in_long_runs(min_repetitions: int) -> Column:
    """Notes in runs of at least ``min_repetitions``: the note that completes one counts for all before it."""
    at = F.col("run_pos")
    return F.when(at == min_repetitions, min_repetitions).when(at > min_repetitions, 1).otherwise(0)


@operator("attribute", "repetitive_section_ratio", min_repetitions=4)
def repetitive_section_ratio(min_repetitions: int = 4) -> Column:
    return _ratio(F.sum(_in_long_runs(min_repetitions)), F.count(F.lit(1)))


@operator("attribute", "len_longest_rep_section", min_repetitions=4)
def len_longest_rep_section(min_repetitions: int = 4) -> Column:
    longest = F.max(F.when(F.col("run_pos") >= min_repetitions, F.col("run_pos")))
    return F.coalesce(longest.cast("double"), F.lit(0.0))


def attribute_columns(config: Mapping[str, Mapping[str, Any]] | Sequence[str] | None = None) -> dict[str, Column]:
    """Rounded aggregate columns for the configured attributes (default: all, with their defaults)."""
    if config is None:
        config = ATTRIBUTES
    if not isinstance(config, Mapping):
        config = {name: {} for name in config}
    columns = {}
    for name, options in config.items():
        options = {k: v for k, v in (options or {}).items() if k != "order"}
        digits = options.pop("round_digits", ROUND_DIGITS)
        op = lookup("attribute", name)
        columns[name] = F.round(op.fn(**op.options(options)), digits)
    return columns


def attribute_table(seqs: SeqSet, config: Mapping[str, Mapping[str, Any]] | Sequence[str] | None = None) -> DataFrame:
    """``seq_id`` and one column per attribute, for every sequence that has a note."""
    columns = attribute_columns(config)
    table = melody_line(seqs).groupBy(*seqs.keys).agg(*[c.alias(n) for n, c in columns.items()])
    return table.select("seq_id", *columns)


def compute_attributes(seqs: SeqSet, config: Mapping[str, Mapping[str, Any]] | Sequence[str] | None = None) -> SeqSet:
    """Write the attributes onto the sequence headers; a sequence without notes keeps nulls."""

    def sequences() -> DataFrame:
        table = attribute_table(seqs, config)
        return seqs.sequences.drop(*table.columns[1:]).join(table, "seq_id", "left")

    return seqs.with_(sequences=sequences)
