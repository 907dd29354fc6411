"""Overlapping slices of whole bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.model import WINDOW_BARS, SeqSet, derive_sequences
from scoreloom.operators.split import moved_events, on_grid, state_events
from scoreloom.registry import operator

DEFAULTS = {
    "hop_size_bars": 1,
    "slice_size_bars": 2,
    "start_time": 0,
    "skip_splits_inside_notes": False,
    "allow_cropped_slices": False,
    "keep_shorter_slices": True,
}
SLICE = ["seq_id", "slice"]


def slice_notes(seqs: SeqSet, slice_size_bars: int, hop_size_bars: int, start_time: int) -> DataFrame:
    """Each note once per slice that holds its onset: adds ``slice, slice_start, slice_end, is_short, crosses_end``.

    The slices of a note follow from its own step, so this is a projection: no shuffle and no window.
    A slice is short when it runs past the last bar of its sequence.
    """
    bar = F.col("steps_per_bar")
    size, hop = bar * slice_size_bars, bar * hop_size_bars
    since = F.col("q_start") - F.lit(start_time)
    first = F.greatest(F.floor((since - size) / hop) + 1, F.lit(0)).cast("bigint")
    last = F.floor(since / hop).cast("bigint")
    begin = F.lit(start_time) + F.col("slice") * hop
    last_bar = F.ceil(F.col("total_steps") / bar) * bar
    # A negative start_time is allowed for; sequence() counts down if last < first, hence the guard.
    spans = F.when((since >= 0) & (first <= last), F.sequence(first, last))
    return (
        seqs.notes.withColumn("slice", F.explode(spans))
        .withColumns({"slice_start": begin, "slice_end": begin + size})
        .withColumns(
            {
                "is_short": F.col("slice_end") > last_bar,
                "crosses_end": F.col("q_end") > F.col("slice_end"),
            }
        )
    )


def cut_at_start(seqs: SeqSet, hop_size_bars: int, start_time: int) -> DataFrame:
    """Slices whose start falls inside a note: ``seq_id, slice``, once each."""
    hop = F.col("steps_per_bar") * hop_size_bars
    first = F.greatest(F.floor((F.col("q_start") - start_time) / hop) + 1, F.lit(0)).cast("bigint")
    last = (F.ceil((F.col("q_end") - start_time) / hop) - 1).cast("bigint")
    inside = F.when(first <= last, F.sequence(first, last))
    return seqs.notes.select("seq_id", F.explode(inside).alias("slice")).distinct()


def _uncropped(seqs: SeqSet, sliced: DataFrame, is_cropped: Column, size_bars: int) -> DataFrame:
    """Drop cropped slices: by a window where a slice is known to be small (few bars of one note per step, or
    part of a small sequence), otherwise by reducing the flags and anti-joining them."""
    if seqs.bounded or (seqs.monophonic and size_bars <= WINDOW_BARS):
        cropped = F.max(is_cropped).over(Window.partitionBy(*seqs.keys, "slice"))
        return sliced.withColumn("_cropped", cropped).filter(~F.col("_cropped")).drop("_cropped")
    return sliced.join(sliced.filter(is_cropped).select(*SLICE).distinct(), SLICE, "left_anti")


def select_slices(seqs: SeqSet, **given) -> DataFrame:
    """The notes of the slices that pass the options, still in their sequence's own steps."""
    o = {**DEFAULTS, **given}
    sliced = slice_notes(seqs, o["slice_size_bars"], o["hop_size_bars"], o["start_time"])
    if not o["keep_shorter_slices"]:
        sliced = sliced.filter(~F.col("is_short"))
    if not o["allow_cropped_slices"]:
        sliced = _uncropped(seqs, sliced, F.col("crosses_end"), o["slice_size_bars"])
    if o["skip_splits_inside_notes"]:
        sliced = sliced.join(cut_at_start(seqs, o["hop_size_bars"], o["start_time"]), SLICE, "left_anti")
    return sliced


@operator("processor", "slicer", **DEFAULTS)
def slice_bars(seqs: SeqSet, **given) -> SeqSet:
    """Slices of ``slice_size_bars`` bars every ``hop_size_bars`` bars; only slices with an onset are emitted.

    Notes belong to the slices that hold their onset. Short slices are dropped unless kept; slices whose end
    cuts a note are dropped unless cropping is allowed, in which case the note is clipped; with
    ``skip_splits_inside_notes`` slices whose start cuts a note are dropped as well.
    """
    o = {**DEFAULTS, **given}
    begin, end = F.col("slice_start").cast("bigint"), F.col("slice_end").cast("bigint")
    last_bar = F.ceil(F.col("total_steps") / F.col("steps_per_bar")) * F.col("steps_per_bar")
    selected = select_slices(seqs, **given)
    notes = seqs.renamed(
        selected,
        slice_id(),
        start_offset=begin.cast("double"),
        q_end=F.least("q_end", end) - begin,
        q_start=F.col("q_start") - begin,
        total_steps=F.least(F.col("slice_end"), last_bar).cast("bigint") - begin,
    ).drop("slice", "slice_start", "slice_end", "is_short", "crosses_end", "start_time", "end_time")
    return SeqSet.derived(
        notes,
        lambda made: derive_sequences(seqs.sequences, made),
        lambda made: slice_events(seqs, made, o["slice_size_bars"], o["hop_size_bars"], o["start_time"]),
        max_rows=seqs.max_rows,
        max_bars=o["slice_size_bars"],
        monophonic=seqs.monophonic,
    )


def slice_id() -> Column:
    return F.concat("seq_id", F.lit("#slice"), "slice")


def slice_events(seqs: SeqSet, slices: DataFrame, size_bars: int, hop_bars: int, start_time: int) -> DataFrame:
    """Events of the slices: tempo and signature in force where a slice starts, and the events inside it, moved to its time.

    As with notes, the slices of an event follow from its own step.
    """
    starts = slices.select(F.col("parent_id").alias("seq_id"), F.col("seq_id").alias("new_id"), F.col("start_offset").alias("begin")).distinct()
    events = on_grid(seqs)
    states = state_events(starts, events.withColumn("time", F.col("at")), "begin", seqs.bounded)
    bars = seqs.notes.groupBy("seq_id").agg(F.max("steps_per_bar").alias("bar"))
    hop, size = F.col("bar") * hop_bars, F.col("bar") * size_bars
    since = F.col("at") - start_time
    first, last = F.greatest(F.floor((since - size) / hop) + 1, F.lit(0)).cast("bigint"), F.floor(since / hop).cast("bigint")
    spread = events.join(bars, "seq_id").withColumn("slice", F.explode(F.when((since >= 0) & (first <= last), F.sequence(first, last))))
    begin = F.floor(start_time + F.col("slice") * hop).cast("bigint")
    spread = spread.filter(~F.col("kind").isin("tempo", "time_signature") | (F.col("at") > begin))
    placed = moved_events(spread.withColumns({"new_id": slice_id(), "begin": begin}), seqs, F.col("begin"))
    placed = placed.join(starts.select("new_id"), "new_id", "left_semi").withColumn("seq_id", F.col("new_id"))
    if "q_step" in seqs.events.columns:
        states = states.withColumn("q_step", F.lit(0).cast("bigint"))
    return placed.select(*seqs.events.columns).unionByName(states, allowMissingColumns=True)


def shorter_slices(seqs: SeqSet, **given) -> DataFrame:
    """Counter ``shorter_slices``: slices with an onset that run past the last bar, kept or not."""
    o = {**DEFAULTS, **given}
    sliced = slice_notes(seqs, o["slice_size_bars"], o["hop_size_bars"], o["start_time"]).filter("is_short")
    return sliced.select(*SLICE).distinct().agg(F.count(F.lit(1)).alias("shorter_slices"))
