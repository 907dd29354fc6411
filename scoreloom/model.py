"""The data model: three flat tables and the ``SeqSet`` that every operator takes and returns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.functions.storage import settled

# The MIDI and piano ranges, and the defaults used where a sequence has no event.
MIN_MIDI_PITCH, MAX_MIDI_PITCH = 0, 127
PIANO_MIN_PITCH, PIANO_MAX_PITCH = 21, 108
PIANO_PITCHES = 88
NOTES_PER_OCTAVE = 12
DEFAULT_STEPS_PER_QUARTER = 4
DEFAULT_QPM = 120.0
DEFAULT_NUMERATOR, DEFAULT_DENOMINATOR = 4, 4
MELODY_PROGRAMS = tuple(range(112))

# Tempo and signature, where they are known to be the same for all of a sequence and kept on its notes.
GRID = ("qpm", "num", "den")
# Column of derived notes that keeps the id of the sequence they come from in the first place.
ROOT = "root_id"

# A sequence of up to this many rows may be ordered by one window in one task.
WINDOW_ROWS = 1_000_000
# A melody of up to this many bars is far below that, having at most one note per step.
WINDOW_BARS = 64

ATTRIBUTES = (
    "toussaint",
    "note_density",
    "pitch_range",
    "contour",
    "unique_notes_ratio",
    "unique_bigrams_ratio",
    "unique_trigrams_ratio",
    "dynamic_range",
    "note_change_ratio",
    "ratio_note_off_steps",
    "ratio_hold_note_steps",
    "repetitive_section_ratio",
    "len_longest_rep_section",
)

SEQUENCES = T.StructType(
    [
        T.StructField("seq_id", T.StringType(), False),
        T.StructField("parent_id", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("filepath", T.StringType()),
        T.StructField("collection_name", T.StringType()),
        T.StructField("total_time", T.DoubleType()),
        T.StructField("start_offset", T.DoubleType()),
        T.StructField("metadata_json", T.StringType()),
    ]
)

NOTES = T.StructType(
    [
        T.StructField("seq_id", T.StringType(), False),
        T.StructField("note_idx", T.LongType(), False),
        T.StructField("pitch", T.IntegerType()),
        T.StructField("velocity", T.IntegerType()),
        T.StructField("start_time", T.DoubleType()),
        T.StructField("end_time", T.DoubleType()),
        T.StructField("instrument", T.IntegerType()),
        T.StructField("program", T.IntegerType()),
        T.StructField("is_drum", T.BooleanType()),
    ]
)

# kind is one of: tempo, time_signature, control, chord
EVENTS = T.StructType(
    [
        T.StructField("seq_id", T.StringType(), False),
        T.StructField("kind", T.StringType()),
        T.StructField("time", T.DoubleType()),
        T.StructField("num", T.IntegerType()),
        T.StructField("den", T.IntegerType()),
        T.StructField("qpm", T.DoubleType()),
        T.StructField("cc_number", T.IntegerType()),
        T.StructField("cc_value", T.IntegerType()),
        T.StructField("instrument", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)


Table = DataFrame | Callable[[], DataFrame]


class SeqSet:
    """A set of sequences as three lazy tables keyed by ``seq_id``.

    A table may be given as a function, which is called when the table is first read: building and analysing a plan takes
    time, and a chain whose result is read for its notes alone never builds the events of its steps.

    Quantizing adds ``q_start, q_end, steps_per_bar, total_steps`` to ``notes``. The last two repeat the
    sequence header on each note, so that later operators need no join to know the grid.

    Three fields say how many rows one sequence can hold, which decides whether a plain window over a
    sequence is safe: ``max_rows`` is a counted bound (``measured``), ``max_bars`` is set by slicing, and
    ``monophonic`` once at most one note can start per step. See ``bounded`` and ``functions.ordered``.
    """

    def __init__(
        self,
        sequences: Table,
        notes: Table,
        events: Table,
        max_rows: int | None = None,
        max_bars: int | None = None,
        monophonic: bool = False,
    ) -> None:
        self._tables = {"sequences": sequences, "notes": notes, "events": events}
        self._tables = {n: functools.cache(t) if callable(t) else t for n, t in self._tables.items()}
        self.max_rows, self.max_bars, self.monophonic = max_rows, max_bars, monophonic
        self._derived: tuple[DataFrame, Callable[[DataFrame], SeqSet]] | None = None

    @classmethod
    def derived(
        cls, notes: DataFrame, sequences: Callable[[DataFrame], DataFrame], events: Callable[[DataFrame], DataFrame], **bounds
    ) -> SeqSet:
        """A set whose headers and events follow from its notes, which have ``parent_id`` and ``start_offset`` here.

        When such a set is settled its notes are written first, and the other two tables are made from what was written.
        """
        made = cls(lambda: sequences(notes), notes.drop("parent_id", "start_offset"), lambda: events(notes), **bounds)
        made._derived = notes, lambda written: cls.derived(written, sequences, events, **bounds)
        return made

    def _table(self, name: str) -> DataFrame:
        table = self._tables[name]
        return table() if callable(table) else table

    @property
    def sequences(self) -> DataFrame:
        return self._table("sequences")

    @property
    def notes(self) -> DataFrame:
        return self._table("notes")

    @property
    def events(self) -> DataFrame:
        return self._table("events")

    def transform(self, fn: Callable[..., SeqSet], *args, **kwargs) -> SeqSet:
        return fn(self, *args, **kwargs)

    def with_(self, **changes) -> SeqSet:
        """The same set but for what is given. Tables that are not given are passed on unread."""
        return SeqSet(**{**self._tables, "max_rows": self.max_rows, "max_bars": self.max_bars, "monophonic": self.monophonic, **changes})

    @property
    def bounded(self) -> bool:
        """Whether the rows of any one sequence are known to fit a window in one task."""
        counted = self.max_rows is not None and self.max_rows <= WINDOW_ROWS
        return counted or (self.monophonic and self.short)

    @property
    def short(self) -> bool:
        return self.max_bars is not None and self.max_bars <= WINDOW_BARS

    @property
    def keys(self) -> list[str]:
        """What identifies a sequence in ``notes``.

        Derived notes of a bounded set keep ``root_id``, the id before the first derivation. Grouping by
        (root, id) is the same as grouping by id, and rows partitioned by the root once need no exchange for any
        later operator of a chain. A melody has one instrument, so that may be named as well: then rows that are
        partitioned by track need no exchange either.
        """
        if not (self.bounded and ROOT in self.notes.columns):
            return ["seq_id"]
        of_track = self.monophonic and "instrument" in self.notes.columns
        return [ROOT, "instrument", "seq_id"] if of_track else [ROOT, "seq_id"]

    def renamed(self, notes: DataFrame, seq_id: Column, **columns: Column) -> DataFrame:
        """Notes under new ids, with the root kept; the other columns are set in the same projection."""
        if self.bounded and ROOT not in notes.columns:
            columns[ROOT] = F.col("seq_id")
        return notes.withColumns({**columns, "parent_id": F.col("seq_id"), "seq_id": seq_id})

    def measured(self) -> SeqSet:
        """Count the rows of the largest sequence. One small job over the id columns, worth it once per source."""
        ids = self.notes.select("seq_id").unionByName(self.events.select("seq_id"))
        sizes = ids.groupBy("seq_id").agg(F.count(F.lit(1)).alias("n"))
        return self.with_(max_rows=sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0])

    def settled(self) -> SeqSet:
        """The same set, written once to the shared folder, so that later branches do not compute it again."""
        if self._derived is None:
            written = self.with_(notes=settled(self.notes.drop(ROOT), "notes"))
        else:
            notes, again = self._derived
            written = again(settled(notes.drop(ROOT), "notes"))
        return written.with_(sequences=settled(written.sequences, "sequences"), events=settled(written.events, "events"))

    @property
    def quantized(self) -> bool:
        return "q_start" in self.notes.columns

    def without_empty(self) -> SeqSet:
        """Drop sequences that have no note, and their events."""

        def sounding(table: DataFrame) -> DataFrame:
            return table.join(self.notes.select("seq_id").distinct(), "seq_id", "left_semi")

        return self.with_(sequences=lambda: sounding(self.sequences), events=lambda: sounding(self.events))

    def union(self, other: SeqSet) -> SeqSet:
        """Both sets together; their ids must differ."""

        def larger(a: int | None, b: int | None) -> int | None:
            return None if a is None or b is None else max(a, b)

        def alike(a: DataFrame, b: DataFrame) -> DataFrame:
            return a.drop(*[c for c in (*GRID, ROOT) if c not in b.columns])

        return SeqSet(
            lambda: self.sequences.unionByName(other.sequences, allowMissingColumns=True),
            lambda: alike(self.notes, other.notes).unionByName(alike(other.notes, self.notes), allowMissingColumns=True),
            lambda: self.events.unionByName(other.events, allowMissingColumns=True),
            max_rows=larger(self.max_rows, other.max_rows),
            max_bars=larger(self.max_bars, other.max_bars),
            monophonic=self.monophonic and other.monophonic,
        )


def derive_sequences(parents: DataFrame, derived: DataFrame) -> DataFrame:
    """Headers of derived sequences: one row per new ``seq_id`` found in ``derived``.

    ``derived`` has ``seq_id, parent_id, start_offset`` and one of ``total_time`` or ``total_steps`` on each
    note; the partial aggregate collapses them to one row per sequence before anything is shuffled. The offset of a
    quantized sequence is given in steps, and becomes seconds by the ``step_rate`` of its parent's header.
    """
    aggregates = [F.min("parent_id").alias("parent_id"), F.min("start_offset").alias("_offset")]
    if "total_steps" in derived.columns:
        aggregates.append(F.max("total_steps").alias("total_steps"))
    if "end_time" in derived.columns:
        aggregates.append(F.max("end_time").alias("total_time"))
    heads = derived.groupBy(*[k for k in (ROOT, "seq_id") if k in derived.columns]).agg(*aggregates).drop(ROOT)
    inherited = parents.drop("parent_id", "total_time", "total_steps").withColumnRenamed("seq_id", "parent_id")
    in_steps = "total_steps" in derived.columns and "step_rate" in parents.columns
    offset = F.col("_offset") / F.col("step_rate") if in_steps else F.col("_offset")
    return (
        heads.join(inherited, "parent_id")
        .withColumn("start_offset", F.coalesce(F.col("start_offset"), F.lit(0.0)) + offset)
        .drop("_offset")
    )
