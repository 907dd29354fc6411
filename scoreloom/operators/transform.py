"""Operators that change notes one sequence to one: stretch, sustain pedal, transpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import BLOCK_SECONDS, asof, block_of, scan
from scoreloom.functions.storage import settled
from scoreloom.model import MAX_MIDI_PITCH, MIN_MIDI_PITCH, SeqSet
from scoreloom.registry import operator

# Pitch classes with sharps, and the class of each root name a chord may start with.
PITCH_CLASS_NAMES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")
ROOT_CLASSES = {
    "C": 0, "C#": 1, "Db": 1, "D": 2, "D#": 3, "Eb": 3, "E": 4, "Fb": 4, "E#": 5, "F": 5, "F#": 6, "Gb": 6,
    "G": 7, "G#": 8, "Ab": 8, "A": 9, "A#": 10, "Bb": 10, "B": 11, "Cb": 11, "B#": 0,
}
ROOT_PATTERN = "^([A-G][#b]?)(.*)$"


@operator("processor", "stretcher", stretch_factor=1.0, in_place=False)
def stretch(seqs: SeqSet, stretch_factor: float = 1.0, in_place: bool = False) -> SeqSet:
    """Multiply all times by the factor and divide the tempo by it. Only for unquantized sequences.

    ``in_place`` is accepted for configurations that set it; tables are immutable, so it changes nothing.
    """
    if seqs.quantized:
        raise ValueError("Only unquantized sequences can be stretched.")
    if stretch_factor <= 0:
        raise ValueError("stretch_factor must be positive")
    factor = F.lit(float(stretch_factor))
    tempo = {"qpm": F.col("qpm") / factor} if "qpm" in seqs.notes.columns else {}
    return seqs.with_(
        sequences=lambda: seqs.sequences.withColumn("total_time", F.col("total_time") * factor),
        notes=seqs.notes.withColumns(
            {"start_time": F.col("start_time") * factor, "end_time": F.col("end_time") * factor, **tempo}
        ),
        events=lambda: seqs.events.withColumns({"time": F.col("time") * factor, "qpm": F.col("qpm") / factor}),
    )


def pedal_changes(events: DataFrame, control_number: int, bounded: bool = False) -> DataFrame:
    """Pedal states per (sequence, instrument): ``time, down, until``, where ``until`` is the next change.

    Several values at one time count once (the largest). Repeated values of one state are one state.
    """
    values = (
        events.filter((F.col("kind") == "control") & (F.col("cc_number") == control_number))
        .groupBy("seq_id", "instrument", "time")
        .agg((F.max("cc_value") >= 64).alias("down"))
    )
    keys, block = ["seq_id", "instrument"], block_of("time", BLOCK_SECONDS, bounded)
    states = scan(values, keys, "time", ["down"], block=block, time="time")
    changes = states.filter(F.col("prev").isNull() | (F.col("prev.down") != F.col("down"))).drop("prev")
    ahead = scan(changes, keys, "time", [], block=block, look_ahead=True, time="time")
    return ahead.select(*keys, "time", "down", F.col("next.time").alias("until"))


def restrikes(notes: DataFrame, bounded: bool = False) -> DataFrame:
    """The next start of the same pitch and instrument, for each distinct start."""
    keys = ["seq_id", "instrument", "pitch"]
    starts = notes.select(*keys, "start_time").distinct()
    block = block_of("start_time", BLOCK_SECONDS, bounded)
    ahead = scan(starts, keys, "start_time", [], block=block, look_ahead=True, time="start_time")
    return ahead.select(*keys, "start_time", F.col("next.start_time").alias("restrike"))


@operator("processor", "sustainer", sustain_control_number=64)
def sustain(seqs: SeqSet, sustain_control_number: int = 64) -> SeqSet:
    """Lengthen notes that end while the sustain pedal of their instrument is down (value 64 or more).

    Such a note sounds until the pedal is released or its pitch is struck again, whichever comes first, and
    to the end of the sequence if the pedal stays down.
    """
    keys = ["seq_id", "instrument"]
    ends = seqs.notes.groupBy("seq_id").agg(F.max("end_time").alias("last_end"))
    pedal = (
        pedal_changes(seqs.events, sustain_control_number, seqs.bounded)
        .join(ends, "seq_id")
        .withColumn("until", F.coalesce("until", "last_end"))
    )
    if not seqs.bounded:
        pedal = settled(pedal, "pedal")
    # A change exactly at a note's end takes effect first.
    held = asof(
        seqs.notes, pedal, keys, "end_time", "time", values=["down", "until"], name="pedal", bounded=seqs.bounded
    )
    held = held.join(restrikes(seqs.notes, seqs.bounded), [*keys, "pitch", "start_time"], "left")
    lengthened = F.greatest(F.col("end_time"), F.least("pedal.until", "restrike"))
    notes = held.withColumn("end_time", F.when(F.col("pedal.down"), lengthened).otherwise(F.col("end_time")))
    return seqs.with_(notes=notes.select(*seqs.notes.columns))


def shifted_chord(text: Column, amount: Column) -> Column:
    """Move the root of a chord name; text that does not start with a root is left as it is."""
    roots = F.create_map(*[F.lit(v) for pair in ROOT_CLASSES.items() for v in pair])
    names = F.array(*[F.lit(n) for n in PITCH_CLASS_NAMES])
    root = F.regexp_extract(text, ROOT_PATTERN, 1)
    moved = F.get(names, F.pmod(roots[root] + amount, F.lit(12)).cast("int"))
    return F.when(root != "", F.concat(moved, F.regexp_extract(text, ROOT_PATTERN, 2))).otherwise(text)


def moved_pitch(amount: Column) -> Column:
    return F.when(F.col("is_drum"), F.col("pitch")).otherwise(F.col("pitch") + amount)


def out_of_band(pitch: Column, low: int, high: int) -> Column:
    """Drum notes are never out of band: their pitch names an instrument."""
    return ~F.col("is_drum") & ~pitch.between(low, high)


def transpose_notes(
    notes: DataFrame, amount: Column, min_allowed_pitch: int, max_allowed_pitch: int, delete_notes: bool
) -> DataFrame:
    """Notes moved by ``amount``. Those that leave the band are deleted, or else empty their sequence."""
    pitch = moved_pitch(amount)
    outside = out_of_band(pitch, min_allowed_pitch, max_allowed_pitch)
    moved = notes.filter(~outside).withColumn("pitch", pitch.cast("int"))
    if delete_notes:
        return moved
    return moved.join(notes.filter(outside).select("seq_id").distinct(), "seq_id", "left_anti")


def transpose_events(events: DataFrame, amount: Column) -> DataFrame:
    chord = (F.col("kind") == "chord") & F.col("text").isNotNull()
    return events.withColumn("text", F.when(chord, shifted_chord(F.col("text"), amount)).otherwise(F.col("text")))


TRANSPOSE_DEFAULTS = {
    "amount": 0,
    "min_allowed_pitch": MIN_MIDI_PITCH,
    "max_allowed_pitch": MAX_MIDI_PITCH,
    "transpose_chords": True,
    "delete_notes": True,
    "in_place": False,
}


@operator("processor", "transposer", **TRANSPOSE_DEFAULTS)
def transpose(seqs: SeqSet, **given) -> SeqSet:
    """Move all pitched notes by ``amount`` semitones; sequences left without a note are dropped."""
    o = {**TRANSPOSE_DEFAULTS, **given}
    amount = F.lit(o["amount"])
    notes = transpose_notes(seqs.notes, amount, o["min_allowed_pitch"], o["max_allowed_pitch"], o["delete_notes"])
    moved = {"events": lambda: transpose_events(seqs.events, amount)} if o["transpose_chords"] else {}
    return seqs.with_(notes=notes, **moved).without_empty()


def deleted_per_sequence(
    seqs: SeqSet, amount: Column, min_allowed_pitch: int, max_allowed_pitch: int, delete_notes: bool
) -> DataFrame:
    """``seq_id, deleted, remaining`` for every sequence, empty ones included."""
    outside = out_of_band(moved_pitch(amount), min_allowed_pitch, max_allowed_pitch)
    counts = seqs.notes.groupBy("seq_id").agg(
        F.count_if(outside).alias("deleted"), F.count(F.lit(1)).alias("notes")
    )
    zero = F.lit(0).cast("bigint")
    joined = seqs.sequences.select("seq_id").join(counts, "seq_id", "left")
    deleted, total = F.coalesce("deleted", zero), F.coalesce("notes", zero)
    remaining = total - deleted if delete_notes else F.when(deleted > 0, zero).otherwise(total)
    return joined.select("seq_id", deleted.alias("deleted"), remaining.alias("remaining"))


def transpose_audit(seqs: SeqSet, **given) -> DataFrame:
    """One row of counters and of the ``deleted_notes`` distribution."""
    o = {**TRANSPOSE_DEFAULTS, **given}
    per_sequence = deleted_per_sequence(
        seqs, F.lit(o["amount"]), o["min_allowed_pitch"], o["max_allowed_pitch"], o["delete_notes"]
    )
    return per_sequence.agg(
        F.count_if(F.col("remaining") == 0).alias("skipped_due_to_range_exceeded"),
        F.count_if(F.col("remaining") > 0).alias("transpositions_generated"),
        F.count(F.lit(1)).alias("deleted_count"),
        F.sum("deleted").alias("deleted_sum"),
        F.min("deleted").alias("deleted_min"),
        F.max("deleted").alias("deleted_max"),
        F.round(F.avg("deleted"), 6).alias("deleted_mean"),
    )
