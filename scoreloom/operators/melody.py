"""Extract melodies from quantized sequences, one track (sequence, instrument) at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import BLOCK_STEPS, asof, block_of, scan, with_group
from scoreloom.model import MELODY_PROGRAMS, PIANO_MAX_PITCH, PIANO_MIN_PITCH, SeqSet, derive_sequences
from scoreloom.operators.split import moved_events, on_grid, state_events
from scoreloom.registry import operator

DEFAULTS = {
    "search_start_step": 0,
    "min_bars": 2,
    "max_bars_truncate": None,
    "max_bars_discard": None,
    "min_pitch": PIANO_MIN_PITCH,
    "max_pitch": PIANO_MAX_PITCH,
    "gap_bars": 1,
    "min_unique_pitches": 3,
    "ignore_polyphonic_notes": True,
    "filter_drums": True,
    "valid_programs": MELODY_PROGRAMS,
}


def track(seqs: SeqSet) -> list[str]:
    return list(dict.fromkeys([*seqs.keys, "instrument"]))


def melody_of(seqs: SeqSet) -> list[str]:
    return [*track(seqs), "melody_start"]


def top_rank() -> Column:
    """One number that orders the notes of a step: highest pitch, then longest, then loudest.

    It is reduced before the shuffle, and pitch, length and velocity can be read back from it.
    """
    length = F.col("q_end") - F.col("q_start")
    return F.col("pitch").cast("bigint") * F.lit(1 << 48) + length * F.lit(1 << 8) + F.col("velocity")


def unrank(rank: Column) -> dict[str, Column]:
    return {
        "pitch": F.shiftright(rank, 48).cast("int"),
        "q_end": F.col("q_start") + F.shiftright(rank.bitwiseAND(F.lit((1 << 48) - 1)), 8),
        "velocity": rank.bitwiseAND(F.lit(255)).cast("int"),
    }


def one_note_per_step(notes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the top note of each step, with ``voices``, the number of notes that started there.

    Of notes that are alike in pitch, length and loudness the first stays.
    """
    more = ["program"] if "program" in notes.columns else []
    kept = notes.groupBy(*keys, "q_start").agg(
        F.max(F.struct(top_rank().alias("rank"), (-F.col("note_idx")).alias("last"), *more)).alias("_top"),
        F.count(F.lit(1)).alias("voices"),
        F.max("steps_per_bar").alias("steps_per_bar"),
        F.max("total_steps").alias("total_steps"),
    )
    return kept.withColumns({**unrank(F.col("_top.rank")), "note_idx": -F.col("_top.last"), **{c: F.col(f"_top.{c}") for c in more}}).drop("_top")


def candidates(seqs: SeqSet, options: dict) -> DataFrame:
    """Notes that may be part of a melody."""
    keep = (F.col("q_start") >= options["search_start_step"]) & F.col("pitch").between(
        options["min_pitch"], options["max_pitch"]
    )
    if options["filter_drums"]:
        keep = keep & ~F.col("is_drum")
    if options["valid_programs"] is not None:
        keep = keep & F.col("program").isin(list(options["valid_programs"]))
    return seqs.notes.filter(keep)


def track_discards(seqs: SeqSet, line: DataFrame, ignore_polyphonic_notes: bool) -> DataFrame:
    """Tracks left out as a whole: ``seq_id, instrument, reason``."""
    uneven = F.max(F.col("steps_per_bar") != F.floor("steps_per_bar"))
    tracks = line.groupBy(*track(seqs)).agg(uneven.alias("uneven"), F.max("voices").alias("voices"))
    reason = F.when(F.col("uneven"), "non_integer_steps_per_bar_tracks_discarded")
    if not ignore_polyphonic_notes:
        reason = reason.when(F.col("voices") > 1, "polyphonic_tracks_discarded")
    return tracks.select("seq_id", "instrument", reason.alias("reason")).filter("reason is not null")


def melody_notes(seqs: SeqSet, options: dict) -> DataFrame:
    """Melody lines before the length checks: notes with ``melody_start`` and ends cut at the next onset.

    A rest of ``gap_bars`` bars or more ends a melody; the next one starts on the bar line before its first
    onset. With one note per step and track, a block of steps bounds the rows of each window.
    """
    line = one_note_per_step(candidates(seqs, options), track(seqs))
    if options["ignore_polyphonic_notes"]:
        line = line.filter(F.col("steps_per_bar") == F.floor("steps_per_bar"))
    else:
        lost = track_discards(seqs, line, False).select("seq_id", "instrument")
        line = line.join(lost, ["seq_id", "instrument"], "left_anti")
    gap = options["gap_bars"]
    placed = scan(
        line,
        track(seqs),
        "q_start",
        ["q_end", "steps_per_bar"],
        block=block_of("q_start", BLOCK_STEPS, seqs.bounded),
        starts_run=lambda before, row: row["q_start"] - before["q_end"] >= gap * row["steps_per_bar"],
        look_ahead=True,
    )
    bar = F.col("steps_per_bar").cast("bigint")
    head = F.col("run_head.q_start")
    return placed.withColumns(
        {"melody_start": head - head % bar, "q_end": F.least("q_end", "next.q_start")}
    ).drop("prev", "next", "run_head", "run_pos")


def within_limit(limit: int | None) -> Column:
    bar = F.col("steps_per_bar").cast("bigint")
    return F.lit(True) if limit is None else F.col("q_start") - F.col("melody_start") < limit * bar


def melody_extent(options: dict) -> dict[str, Column]:
    """Mergeable aggregates over the notes of a melody. A set of pitches has 128 members at most."""
    pitches = F.collect_set(F.when(within_limit(options["max_bars_truncate"]), F.col("pitch")))
    return {"last_end": F.max("q_end"), "pitches": pitches}


def melody_verdict(options: dict) -> dict[str, Column]:
    """What a row that has its melody's extent says of it: bars, steps, ``reason`` to discard it, truncated or not."""
    bar = F.col("steps_per_bar").cast("bigint")
    bars = F.ceil((F.col("last_end") - F.col("melody_start")) / F.col("steps_per_bar")).cast("bigint")
    limit, discard = options["max_bars_truncate"], options["max_bars_discard"]
    too_short = bars < options["min_bars"]
    too_long = F.lit(False) if discard is None else bars > discard
    truncated = F.lit(False) if limit is None else ~too_short & ~too_long & (bars > limit)
    kept_bars = bars if limit is None else F.least(bars, F.lit(limit))
    reason = (
        F.when(too_short, "melodies_discarded_too_short")
        .when(too_long, "melodies_discarded_too_long")
        .when(F.size("pitches") < options["min_unique_pitches"], "melodies_discarded_too_few_pitches")
    )
    return {
        "bars": kept_bars,
        "melody_steps": F.least(F.col("last_end") - F.col("melody_start"), kept_bars * bar),
        "reason": reason,
        "truncated": truncated,
    }


def melody_checks(seqs: SeqSet, options: dict) -> DataFrame:
    """One row per melody: its bars, the ``reason`` if it is discarded, and whether it is truncated."""
    extent = {**melody_extent(options), "steps_per_bar": F.max("steps_per_bar")}
    melodies = melody_notes(seqs, options).groupBy(*melody_of(seqs)).agg(*[c.alias(n) for n, c in extent.items()])
    return melodies.select(*melody_of(seqs), *[c.alias(n) for n, c in melody_verdict(options).items()])


@operator("processor", "melody_extractor", **DEFAULTS)
def extract_melodies(seqs: SeqSet, **given) -> SeqSet:
    """Monophonic melodies of every track, as sequences of their own counted from their first bar line.

    Of notes that start together the top one is kept (or, with ``ignore_polyphonic_notes=False``, the track is
    left out), and each note ends where the next starts. Melodies that are too short, too long or have too few
    pitches are dropped; ``melody_audit`` counts them.
    """
    options = {**DEFAULTS, **given}
    lines = melody_notes(seqs, options)
    lines = with_group(lines, melody_of(seqs), melody_extent(options), bounded=seqs.bounded)
    start = F.col("melody_start")
    kept = lines.withColumns(melody_verdict(options)).filter("reason is null")
    kept = kept.filter(F.col("q_start") - start < F.col("melody_steps"))
    melody_id = F.concat("seq_id", F.lit("#melody"), "instrument", F.lit("@"), start)
    notes = seqs.renamed(
        kept,
        melody_id,
        start_offset=start.cast("double"),
        is_drum=F.lit(False),
        q_start=F.col("q_start") - start,
        q_end=F.least(F.col("q_end") - start, F.col("melody_steps")),
        total_steps=F.col("melody_steps"),
    ).drop("voices", "melody_start", "last_end", "pitches", "bars", "melody_steps", "reason", "truncated")
    return SeqSet.derived(
        notes,
        lambda made: derive_sequences(seqs.sequences, made),
        lambda made: melody_events(seqs, made),
        max_rows=seqs.max_rows,
        monophonic=True,
    )


def melody_events(seqs: SeqSet, melodies: DataFrame) -> DataFrame:
    """Events of the melodies: tempo and signature in force at a start, and what lies inside, moved to the melody's time.

    The melodies of a track follow one another, so an event is in one per track at most. Controls count for their instrument.
    """
    starts = melodies.select(
        F.col("parent_id").alias("seq_id"),
        "instrument",
        F.col("seq_id").alias("new_id"),
        F.col("start_offset").alias("begin"),
        (F.col("start_offset") + F.col("total_steps")).alias("end"),
    ).distinct()
    events = on_grid(seqs)
    states = state_events(starts.drop("instrument", "end"), events.withColumn("time", F.col("at")), "begin", seqs.bounded)
    tracks = starts.select("seq_id", F.col("instrument").alias("track")).distinct()
    every = events.join(tracks, "seq_id").filter((F.col("kind") != "control") | (F.col("instrument") == F.col("track")))
    found = asof(
        every,
        starts.withColumnRenamed("instrument", "track"),
        ["seq_id", "track"],
        "at",
        "begin",
        values=["end", "new_id"],
        name="melody",
        bounded=seqs.bounded,
    )
    stated = F.col("kind").isin("tempo", "time_signature")
    inside = found.filter((F.col("at") < F.col("melody.end")) & (~stated | (F.col("at") > F.col("melody.time"))))
    placed = moved_events(inside.withColumn("begin", F.col("melody.time").cast("bigint")), seqs, F.col("begin"))
    placed = placed.withColumn("seq_id", F.col("melody.new_id"))
    if "q_step" in seqs.events.columns:
        states = states.withColumn("q_step", F.lit(0).cast("bigint"))
    return placed.select(*seqs.events.columns).unionByName(states, allowMissingColumns=True)


def melody_audit(seqs: SeqSet, **given) -> DataFrame:
    """Counters of the extraction: ``metric, value``."""
    options = {**DEFAULTS, **given}
    line = one_note_per_step(candidates(seqs, options), track(seqs))
    tracks = track_discards(seqs, line, options["ignore_polyphonic_notes"]).select("reason")
    checks = melody_checks(seqs, options)
    outcome = F.array_compact(
        F.array(
            F.coalesce("reason", F.lit("output_sequences")), F.when(F.col("truncated"), F.lit("melodies_truncated"))
        )
    )
    melodies = checks.select(F.explode(outcome).alias("reason"))
    return tracks.unionByName(melodies).groupBy(F.col("reason").alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def melody_lengths(seqs: SeqSet, **given) -> DataFrame:
    """Histogram of the extracted melodies' lengths in whole bars: ``bars, count``."""
    options = {**DEFAULTS, **given}
    checks = melody_checks(seqs, options).filter("reason is null")
    return checks.groupBy("bars").agg(F.count(F.lit(1)).alias("count"))
