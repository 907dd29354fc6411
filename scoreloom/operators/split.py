"""Cut sequences into consecutive segments: at a fixed hop, at tempo or signature changes, or at silences.

A note belongs to the segment that holds its start. Its end is clipped to the segment, and its times are
counted from the segment start, which ``start_offset`` keeps. Segments without a note are not emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import BLOCK_CELLS, BLOCK_SECONDS, asof, block_of, scan
from scoreloom.functions.storage import settled
from scoreloom.model import DEFAULT_DENOMINATOR, DEFAULT_NUMERATOR, DEFAULT_QPM, GRID, ROOT, SeqSet, derive_sequences
from scoreloom.operators.quantize import first_header, with_defaults
from scoreloom.registry import operator


def segment_id(parent: Column, op: str, start: Column) -> Column:
    """Identity of a segment: its parent and its start in whole microseconds."""
    return F.concat(parent, F.lit(f"#{op}@"), F.floor(start * 1e6 + 0.5).cast("string"))


def rebase(seqs: SeqSet, assigned: DataFrame, op: str, *extra: str) -> DataFrame:
    """Notes with ``seg_start`` (and ``seg_end``, null if open) moved to their segment's own time."""
    start = F.col("seg_start")
    moved = seqs.renamed(
        assigned,
        segment_id(F.col("seq_id"), op, start),
        start_offset=start,
        end_time=F.least("end_time", "seg_end") - start,
        start_time=F.col("start_time") - start,
    )
    kept = [c for c in moved.columns if c in seqs.notes.columns or c in (*extra, ROOT)]
    return moved.select(*kept, "parent_id", "start_offset")


def assemble(seqs: SeqSet, assigned: DataFrame, op: str, bounds: DataFrame) -> SeqSet:
    """Build the segments' three tables from notes with ``seg_start, seg_end`` and the distinct ``bounds``."""
    notes = rebase(seqs, assigned, op)
    # A segment has its share of the notes and events, and two more events where it starts.
    grown = None if seqs.max_rows is None else seqs.max_rows + 2
    return SeqSet.derived(
        notes, lambda made: derive_sequences(seqs.sequences, made), lambda _: segment_events(seqs, bounds, op), max_rows=grown
    )


def segment_events(seqs: SeqSet, bounds: DataFrame, op: str) -> DataFrame:
    """Events of each segment: those inside it, and the tempo and signature in force where it starts."""
    events, bounded = seqs.events, seqs.bounded
    columns = events.columns
    inside = asof(events, bounds, ["seq_id"], "time", "seg_start", values=["seg_end"], name="seg", bounded=bounded)
    inside = inside.filter(
        F.col("seg").isNotNull()
        & (F.col("seg.seg_end").isNull() | (F.col("time") < F.col("seg.seg_end")))
        & ((F.col("time") > F.col("seg.time")) | ~F.col("kind").isin("tempo", "time_signature"))
    ).withColumns(
        {
            "seq_id": segment_id(F.col("seq_id"), op, F.col("seg.time")),
            "time": F.col("time") - F.col("seg.time"),
        }
    )
    timeline = fill_timeline(events, bounded)
    heads = asof(bounds, timeline, ["seq_id"], "seg_start", "time", values=["qpm", "num", "den"], bounded=bounded)
    seq_id = segment_id(F.col("seq_id"), op, F.col("seg_start"))
    tempo = heads.filter("match.qpm is not null").select(
        seq_id.alias("seq_id"), F.lit("tempo").alias("kind"), F.lit(0.0).alias("time"), F.col("match.qpm").alias("qpm")
    )
    signature = heads.filter("match.num is not null").select(
        seq_id.alias("seq_id"),
        F.lit("time_signature").alias("kind"),
        F.lit(0.0).alias("time"),
        F.col("match.num").alias("num"),
        F.col("match.den").alias("den"),
    )
    return (
        inside.select(columns)
        .unionByName(tempo, allowMissingColumns=True)
        .unionByName(signature, allowMissingColumns=True)
    )


def fill_timeline(events: DataFrame, bounded: bool = False) -> DataFrame:
    """Tempo and signature in force from each time one of them is stated: ``seq_id, time, qpm, num, den``.

    ``before`` holds the same three values just before that time. Several statements at one time count once
    (the largest value), so the rows are unique on (seq_id, time) before they are ordered.
    """
    signature = F.when(F.col("kind") == "time_signature", F.struct("num", "den"))
    stated = (
        events.filter(F.col("kind").isin("tempo", "time_signature"))
        .groupBy("seq_id", "time")
        .agg(F.max(F.when(F.col("kind") == "tempo", F.col("qpm"))).alias("_qpm"), F.max(signature).alias("_sig"))
    )
    both = fill_forward(fill_forward(stated, "_qpm", bounded), "_sig", bounded)
    sig, sig_before = F.col("_sig_now"), F.col("_sig_before")
    return both.select(
        "seq_id",
        "time",
        F.col("_qpm_now").alias("qpm"),
        sig["num"].alias("num"),
        sig["den"].alias("den"),
        F.struct(
            F.col("_qpm_before").alias("qpm"), sig_before["num"].alias("num"), sig_before["den"].alias("den")
        ).alias("before"),
    )


def fill_forward(df: DataFrame, column: str, bounded: bool) -> DataFrame:
    """Fill a sparse column forward in time; adds ``<column>_now`` and ``<column>_before``.

    The largest (time, value) pair over the earlier rows is the latest stated value, so this is a reach scan.
    """
    pair = f"{column}_at"
    tagged = df.withColumn(pair, F.when(F.col(column).isNotNull(), F.struct("time", F.col(column).alias("value"))))
    block = block_of("time", BLOCK_SECONDS, bounded)
    filled = scan(tagged, ["seq_id"], "time", [], block=block, reach=pair, time="time")
    before = F.col("reach")["value"]
    return filled.withColumns({f"{column}_before": before, f"{column}_now": F.coalesce(column, before)}).drop(
        pair, "prev", "reach"
    )


def hop_notes(seqs: SeqSet, hop_size_seconds: float | None, hop_size_bars: int | None) -> DataFrame:
    """Notes with their hop length in seconds and the number of the hop cell that holds their start."""
    if (hop_size_seconds is None) == (hop_size_bars is None):
        raise ValueError("Exactly one of hop_size_seconds or hop_size_bars must be set.")
    if hop_size_seconds is not None:
        notes = seqs.notes.withColumn("hop", F.lit(float(hop_size_seconds)))
    else:
        header = with_defaults(
            seqs.sequences.select("seq_id").join(first_header(seqs.events), "seq_id", "left")
        )
        bar = F.col("num") * 4.0 / F.col("den") * 60.0 / F.col("qpm")
        notes = seqs.notes.join(header.select("seq_id", (hop_size_bars * bar).alias("hop")), "seq_id")
    return notes.withColumn("cell", F.floor(F.col("start_time") / F.col("hop")))


def uncovered_cells(notes: DataFrame, bounded: bool = False) -> DataFrame:
    """For each hop cell with notes, the cell that starts its segment once cuts inside notes are skipped.

    A cut at cell ``c`` is kept if no earlier note sounds past it. Of the cuts between two cells with notes
    the last is the least covered, so testing it alone is enough.
    """
    cells = notes.groupBy("seq_id", "cell").agg(F.max("end_time").alias("end_time"), F.min("hop").alias("hop"))
    return scan(
        cells,
        ["seq_id"],
        "cell",
        ["hop"],
        block=block_of("cell", BLOCK_CELLS, bounded),
        reach="end_time",
        starts_run=lambda reach, row: reach <= row["cell"] * row["hop"],
    ).select("seq_id", "cell", "hop", F.col("run_head.cell").alias("first_cell"))


@operator(
    "processor", "splitter", hop_size_seconds=None, hop_size_bars=2, skip_splits_inside_notes=False
)
def split_hop(
    seqs: SeqSet,
    hop_size_seconds: float | None = None,
    hop_size_bars: int | None = 2,
    skip_splits_inside_notes: bool = False,
) -> SeqSet:
    """Cut every ``hop`` seconds or bars. With ``skip_splits_inside_notes`` a cut that falls inside a note is left out."""
    notes = hop_notes(seqs, hop_size_seconds, hop_size_bars)
    if skip_splits_inside_notes:
        cells = uncovered_cells(notes, seqs.bounded)
        starts = cells.select("seq_id", "cell", "first_cell")
        assigned = (
            notes.join(starts, ["seq_id", "cell"])
            .withColumn("seg_start", F.col("first_cell") * F.col("hop"))
            .withColumn("seg_end", F.lit(None).cast("double"))
        )
        bounds = cells.select(
            "seq_id", (F.col("first_cell") * F.col("hop")).alias("seg_start"), F.lit(None).cast("double").alias("seg_end")
        ).distinct()
    else:
        assigned = notes.withColumns(
            {"seg_start": F.col("cell") * F.col("hop"), "seg_end": (F.col("cell") + 1) * F.col("hop")}
        )
        bounds = assigned.select("seq_id", "seg_start", "seg_end").distinct()
    return assemble(seqs, assigned, "split", bounds)


def time_changes(events: DataFrame, bounded: bool = False, with_before: bool = False) -> DataFrame:
    """Times at which tempo or signature really changes: ``seq_id, time, qpm, num, den`` (and the values ``before``).

    Restating the value in force is not a change. Values stated at or before time 0 open the sequence; they
    stand as a row at time 0 so that the first segment knows them.
    """
    events = events.withColumn("time", F.greatest("time", F.lit(0.0)))
    now = [F.coalesce(c, F.lit(d)) for c, d in _defaults("")]
    was = [F.coalesce(c, F.lit(d)) for c, d in _defaults("before.")]
    changed = (now[0] != was[0]) | (now[1] != was[1]) | (now[2] != was[2])
    changes = fill_timeline(events, bounded).filter(changed | (F.col("time") == 0))
    return changes if with_before else changes.drop("before")


def state_events(starts: DataFrame, events: DataFrame, start: str, bounded: bool = False) -> DataFrame:
    """Tempo and signature in force at the ``start`` of each derived sequence, as events at its time 0.

    ``starts`` has the parent's ``seq_id``, the ``new_id`` and the start; starts and the events' ``time`` are counted alike.
    """
    timeline = fill_timeline(events, bounded)
    found = asof(starts, timeline, ["seq_id"], start, "time", values=["qpm", "num", "den"], name="state", bounded=bounded)
    state = F.array(
        F.struct(F.lit("tempo").alias("kind"), F.col("state.qpm").alias("qpm"), F.lit(None).cast("int").alias("num"), F.lit(None).cast("int").alias("den")),
        F.struct(F.lit("time_signature").alias("kind"), F.lit(None).cast("double").alias("qpm"), F.col("state.num").alias("num"), F.col("state.den").alias("den")),
    )
    stated = found.select(F.col("new_id").alias("seq_id"), F.lit(0.0).alias("time"), F.inline(state))
    return stated.filter("qpm is not null or num is not null")


def on_grid(seqs: SeqSet) -> DataFrame:
    """Events of a quantized set with ``at``, their step; hand-made grids without steps have all events at the start."""
    step = F.col("q_step").cast("double") if "q_step" in seqs.events.columns else F.lit(0.0)
    return seqs.events.withColumn("at", step)


def moved_events(events: DataFrame, seqs: SeqSet, start: Column) -> DataFrame:
    """Events of derived quantized sequences: step and time counted from a start in steps. ``seq_id`` is still the parent's."""
    if "step_rate" in seqs.sequences.columns:
        rates = seqs.sequences.select("seq_id", "step_rate").distinct()
        events = events.join(rates, "seq_id").withColumn("time", F.col("time") - start / F.col("step_rate")).drop("step_rate")
    return events.withColumn("q_step", F.col("q_step") - start) if "q_step" in events.columns else events


def _defaults(prefix: str) -> list[tuple[Column, float | int]]:
    return [
        (F.col(f"{prefix}qpm"), DEFAULT_QPM),
        (F.col(f"{prefix}num"), DEFAULT_NUMERATOR),
        (F.col(f"{prefix}den"), DEFAULT_DENOMINATOR),
    ]


def open_cuts(cuts: DataFrame, notes: DataFrame, bounded: bool = False) -> DataFrame:
    """Cuts at which no note is sounding, by a reach scan over notes and cuts in time order.

    Notes are first collapsed to one row per start time; a cut sorts before notes that start on it.
    """
    starts = notes.groupBy("seq_id", F.col("start_time").alias("time")).agg(F.max("end_time").alias("end_time"))
    both = cuts.withColumn("_side", F.lit(0)).unionByName(
        starts.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    scanned = scan(
        both.withColumn("_at", F.struct("time", "_side")),
        ["seq_id"],
        "_at",
        [],
        block=block_of("time", BLOCK_SECONDS, bounded),
        reach="end_time",
        time="time",
    )
    free = F.col("reach").isNull() | (F.col("reach") <= F.col("time"))
    return scanned.filter((F.col("_side") == 0) & (free | (F.col("time") <= 0))).select(*cuts.columns)


@operator(
    "processor", "time_change_splitter", skip_splits_inside_notes=False, keep_time_signatures=["4/4"]
)
def split_time_changes(
    seqs: SeqSet, skip_splits_inside_notes: bool = False, keep_time_signatures: Sequence[str] | None = ("4/4",)
) -> SeqSet:
    """Cut where tempo or time signature changes, and keep segments whose signature is listed (none: all)."""
    cuts = segment_cuts(seqs, skip_splits_inside_notes)
    kept = signature_is(keep_time_signatures) if keep_time_signatures else F.lit(True)
    assigned = time_change_segments(seqs, cuts).filter(kept)
    # A segment has one tempo and one signature, if no change is left out. They stay on its notes, so that the grid needs no events.
    notes = rebase(seqs, assigned, "change", *(() if skip_splits_inside_notes else GRID))

    def events(made: DataFrame) -> DataFrame:
        found = change_events(seqs, cuts, kept)
        if skip_splits_inside_notes:
            found = found.unionByName(left_out_changes(seqs, cuts, kept))
        return found.join(made.select("seq_id").distinct(), "seq_id", "left_semi").select(*found.columns)

    grown = None if seqs.max_rows is None else seqs.max_rows + 2
    return SeqSet.derived(notes, lambda made: derive_sequences(seqs.sequences, made), events, max_rows=grown)


def filtered_sequences(
    seqs: SeqSet, skip_splits_inside_notes: bool = False, keep_time_signatures: Sequence[str] | None = ("4/4",)
) -> DataFrame:
    """Counter ``filtered_sequences``: segments with notes whose signature is not listed."""
    kept = signature_is(keep_time_signatures) if keep_time_signatures else F.lit(True)
    lost = time_change_segments(seqs, segment_cuts(seqs, skip_splits_inside_notes)).filter(~kept)
    return lost.select("seq_id", "seg_start").distinct().agg(F.count(F.lit(1)).alias("filtered_sequences"))


def left_out_changes(seqs: SeqSet, cuts: DataFrame, kept: Column) -> DataFrame:
    """The changes that do not cut, as events of the segment they fall in, at their time in it."""
    changes = time_changes(seqs.events, seqs.bounded, with_before=True)
    inside = changes.join(cuts.select("seq_id", "time"), ["seq_id", "time"], "left_anti")
    tempo = ~F.col("qpm").eqNullSafe(F.col("before.qpm"))
    signature = ~F.struct("num", "den").eqNullSafe(F.struct("before.num", "before.den"))
    inside = inside.select(
        "seq_id",
        "time",
        F.when(tempo, F.col("qpm")).alias("qpm"),
        F.when(signature, F.struct("num", "den")).alias("signature"),
    )
    found = asof(inside, cuts, ["seq_id"], "time", "time", values=["num", "den"], name="cut", bounded=seqs.bounded)
    found = found.withColumns({"num": F.col("cut.num"), "den": F.col("cut.den")}).filter(kept)
    start = F.coalesce("cut.time", F.lit(0.0))
    placed = found.select(
        segment_id(F.col("seq_id"), "change", start).alias("seq_id"),
        (F.col("time") - start).alias("time"),
        "qpm",
        F.col("signature.num").alias("num"),
        F.col("signature.den").alias("den"),
    )
    nothing = F.lit(None).cast("double")
    tempos = placed.filter("qpm is not null").withColumns({"kind": F.lit("tempo"), "num": nothing.cast("int"), "den": nothing.cast("int")})
    signatures = placed.filter("num is not null").withColumns({"kind": F.lit("time_signature"), "qpm": nothing})
    columns = seqs.events.schema
    both = tempos.unionByName(signatures)
    return both.select(*[F.col(f.name) if f.name in both.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns])


def change_events(seqs: SeqSet, cuts: DataFrame, kept: Column) -> DataFrame:
    """Events of each kept segment: its tempo and signature at its start, and the other events inside it.

    What no event states is left out: the defaults hold there.
    """
    seq_id = segment_id(F.col("seq_id"), "change", F.col("time"))
    tempo, signature = F.col("kind") == "tempo", F.col("kind") == "time_signature"
    heads = cuts.filter(kept).select(
        seq_id.alias("seq_id"),
        F.lit(0.0).alias("time"),
        F.explode(F.array(F.lit("tempo"), F.lit("time_signature"))).alias("kind"),
        "qpm",
        "num",
        "den",
    )
    heads = heads.withColumns(
        {"qpm": F.when(tempo, F.col("qpm")), "num": F.when(signature, F.col("num")), "den": F.when(signature, F.col("den"))}
    )
    heads = heads.filter((tempo & F.col("qpm").isNotNull()) | (signature & F.col("num").isNotNull()))
    others = seqs.events.filter(~F.col("kind").isin("tempo", "time_signature"))
    columns = seqs.events.columns
    found = asof(
        others, cuts, ["seq_id"], "time", "time", values=["num", "den"], name="cut", bounded=seqs.bounded
    )
    start = F.coalesce("cut.time", F.lit(0.0))
    placed = found.withColumns({"num": F.col("cut.num"), "den": F.col("cut.den")}).filter(kept).withColumns(
        {
            "seq_id": segment_id(F.col("seq_id"), "change", start),
            "time": F.col("time") - start,
            "num": F.lit(None).cast("int"),
            "den": F.lit(None).cast("int"),
        }
    )
    return heads.unionByName(placed.select(*columns), allowMissingColumns=True).select(*columns)


def segment_cuts(seqs: SeqSet, skip_splits_inside_notes: bool = False) -> DataFrame:
    """Segment starts with the tempo and signature in force, and ``cut_end``, where the next segment starts."""
    bounded = seqs.bounded
    cuts = time_changes(seqs.events, bounded)
    if skip_splits_inside_notes:
        cuts = open_cuts(cuts, seqs.notes, bounded)
    # A sequence that no event opens at time 0 has a first segment in which the defaults hold.
    late = cuts.groupBy("seq_id").agg(F.min("time").alias("first")).filter(F.col("first") > 0)
    cuts = cuts.unionByName(late.select("seq_id", F.lit(0.0).alias("time")), allowMissingColumns=True)
    block = block_of("time", BLOCK_SECONDS, bounded)
    cuts = scan(cuts, ["seq_id"], "time", [], block=block, look_ahead=True, time="time")
    cuts = cuts.select("seq_id", "time", "qpm", "num", "den", F.col("next.time").alias("cut_end"))
    # Notes, events and headers all look cuts up; with blocks each use would repeat the whole scan.
    return cuts if bounded else settled(cuts, "cuts")


def time_change_segments(seqs: SeqSet, cuts: DataFrame) -> DataFrame:
    """Notes with their segment (``seg_start, seg_end``) and the tempo and signature in force there.

    In a sequence without any such event the defaults hold, in one segment.
    """
    notes = seqs.notes.withColumn("_from", F.greatest("start_time", F.lit(0.0)))
    found = asof(
        notes, cuts, ["seq_id"], "_from", "time", values=["cut_end", "qpm", "num", "den"], name="cut", bounded=seqs.bounded
    )
    return found.withColumns(
        {
            "seg_start": F.coalesce("cut.time", F.lit(0.0)),
            "seg_end": F.col("cut.cut_end"),
            "qpm": F.coalesce("cut.qpm", F.lit(DEFAULT_QPM)),
            "num": F.coalesce("cut.num", F.lit(DEFAULT_NUMERATOR)),
            "den": F.coalesce("cut.den", F.lit(DEFAULT_DENOMINATOR)),
        }
    ).drop("cut", "_from")


def signature_is(allowed: Sequence[str]) -> Column:
    """Whether ``num/den`` is listed; no signature counts as the default."""
    stated = F.concat_ws("/", F.coalesce("num", F.lit(DEFAULT_NUMERATOR)), F.coalesce("den", F.lit(DEFAULT_DENOMINATOR)))
    return stated.isin(list(allowed))


def silence_cells(notes: DataFrame, gap_seconds: float, bounded: bool = False) -> DataFrame:
    """For each cell of one gap length, the start of its segment.

    Two notes that start in one cell are less than a gap apart, so no cut can fall between them and the cell
    can be collapsed to its first start and last end before any ordering.
    """
    cells = notes.groupBy("seq_id", F.floor(F.col("start_time") / gap_seconds).alias("cell")).agg(
        F.min("start_time").alias("first_start"), F.max("end_time").alias("last_end")
    )
    return scan(
        cells,
        ["seq_id"],
        "cell",
        ["first_start"],
        block=block_of("cell", BLOCK_CELLS, bounded),
        reach="last_end",
        starts_run=lambda reach, row: row["first_start"] - reach > gap_seconds,
    ).select("seq_id", "cell", F.col("run_head.first_start").alias("seg_start"))


@operator("processor", "silence_splitter", gap_seconds=3.0)
def split_silence(seqs: SeqSet, gap_seconds: float = 3.0) -> SeqSet:
    """Cut where nothing sounds for more than ``gap_seconds``; a segment starts with its first note."""
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")
    cells = silence_cells(seqs.notes, gap_seconds, seqs.bounded)
    bounds = cells.select("seq_id", "seg_start", F.lit(None).cast("double").alias("seg_end")).distinct()
    assigned = (
        seqs.notes.withColumn("cell", F.floor(F.col("start_time") / gap_seconds))
        .join(cells, ["seq_id", "cell"])
        .withColumn("seg_end", F.lit(None).cast("double"))
    )
    return assemble(seqs, assigned, "silence", bounds)
