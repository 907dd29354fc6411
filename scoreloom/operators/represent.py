"""Encode sequences as pitch tokens, parse stored examples, and decode tokens back to notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.ordered import BLOCK_STEPS, block_of, scan
from scoreloom.model import ATTRIBUTES, EVENTS, SeqSet
from scoreloom.operators.melody import one_note_per_step
from scoreloom.registry import operator

# Tokens 0 to 127 start a note of that pitch.
HOLD, REST = 128, 129
LEAD = "array<struct<at: int, token: bigint, continues: boolean>>"


def note_pieces(seqs: SeqSet, chunk_steps: int | None = None) -> DataFrame:
    """Melody notes, cut at chunk borders if there are chunks: ``seq_id, chunk, q_start, q_end, token, pitch`` in steps of the chunk."""
    notes = seqs.notes
    if not seqs.monophonic:
        line = one_note_per_step(notes, seqs.keys)
        block = block_of("q_start", BLOCK_STEPS, seqs.bounded or seqs.short)
        line = scan(line, seqs.keys, "q_start", [], block=block, look_ahead=True)
        notes = line.withColumn("q_end", F.least("q_end", "next.q_start"))
    if chunk_steps is None:
        whole = {"chunk": F.lit(0).cast("bigint"), "token": F.col("pitch"), "steps": F.col("total_steps").cast("int")}
        steps = {"q_start": F.col("q_start").cast("int"), "q_end": F.col("q_end").cast("int")}
        return notes.withColumns({**whole, **steps}).select(*seqs.keys, "chunk", "q_start", "q_end", "token", "pitch", "steps")
    first, last = F.floor(F.col("q_start") / chunk_steps), F.floor((F.col("q_end") - 1) / chunk_steps)
    begin = F.col("chunk") * chunk_steps
    return (
        notes.select(*seqs.keys, "q_start", "q_end", "pitch", "total_steps", F.explode(F.sequence(first, last)).alias("chunk"))
        .withColumn("token", F.when(F.col("q_start") >= begin, F.col("pitch")).otherwise(HOLD))
        .select(
            *seqs.keys,
            "chunk",
            (F.greatest(F.col("q_start"), begin) - begin).cast("int").alias("q_start"),
            (F.least(F.col("q_end"), begin + chunk_steps) - begin).cast("int").alias("q_end"),
            "token",
            "pitch",
            F.least(F.col("total_steps") - begin, F.lit(chunk_steps)).cast("int").alias("steps"),
        )
    )


def tokens_of(pieces: Column, steps: Column) -> Column:
    """Token array of one chunk from its notes in order: rests and holds are repeated in between.

    Notes do not overlap, so the only pieces of a chunk are its onsets and at most one hold at its border.
    """

    def note(piece: Column, i: Column) -> Column:
        following = F.coalesce(F.get(pieces, i + 1)["q_start"], steps)
        until = F.least(piece["q_end"], following)
        return F.concat(
            F.array_repeat(piece["token"], F.when(until > piece["q_start"], 1).otherwise(0)),
            F.array_repeat(F.lit(HOLD), F.greatest(until - piece["q_start"] - 1, F.lit(0))),
            F.array_repeat(F.lit(REST), following - until),
        )

    lead_in = F.array_repeat(F.lit(REST), F.coalesce(F.get(pieces, F.lit(0))["q_start"], steps))
    tokens = F.concat(lead_in, F.flatten(F.transform(pieces, note)))
    return tokens.cast("array<bigint>")


@operator("representation", "pitch_sequence", length=None, pad=REST)
def encode(seqs: SeqSet, length: int | None = None, pad: int = REST, chunk_steps: int | None = None) -> DataFrame:
    """``seq_id, pitch_seq``: one row per sequence, one token per step from step 0 to ``total_steps``.

    With ``length`` shorter arrays are padded to it; longer ones are kept whole, and ``fixed_length`` sets
    them apart when they are read. With ``chunk_steps`` a longer sequence continues in further rows, and there are two more
    columns: ``chunk``, its number, and ``held``, the pitch of a note that sounds on from the chunk before. All chunks of a
    sequence are stored, silent ones too, and the last is padded.
    """
    pieces = note_pieces(seqs, chunk_steps)
    if chunk_steps is not None:
        every = seqs.notes.select(*seqs.keys, "total_steps").distinct()
        last = F.floor((F.col("total_steps") - 1) / chunk_steps)
        every = every.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(last, F.lit(0)))))
        steps = F.least(F.col("total_steps") - F.col("chunk") * chunk_steps, F.lit(chunk_steps)).cast("int")
        pieces = pieces.unionByName(every.select(*seqs.keys, "chunk", steps.alias("steps")), allowMissingColumns=True)
    # Notes do not overlap, so there is at most one piece per step of the row that they become.
    piece = F.when(F.col("q_start").isNotNull(), F.struct("q_start", "q_end", "token"))
    grouped = pieces.groupBy(*seqs.keys, "chunk").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"),
        F.max("steps").alias("steps"),
        F.max(F.when(F.col("token") == HOLD, F.col("pitch"))).alias("held"),
    )
    tokens = tokens_of(F.col("pieces"), F.col("steps"))
    if length is not None:
        wanted = F.lit(length) if chunk_steps is None else F.least(length - F.col("chunk") * chunk_steps, F.lit(chunk_steps))
        tokens = F.concat(tokens, F.array_repeat(F.lit(pad).cast("bigint"), F.greatest(wanted - F.size(tokens), F.lit(0)).cast("int")))
    if chunk_steps is None:
        return grouped.select("seq_id", tokens.alias("pitch_seq"))
    return grouped.select("seq_id", "chunk", "held", tokens.alias("pitch_seq"))


def encode_with_context(
    seqs: SeqSet,
    attributes: Sequence[str] = ATTRIBUTES,
    length: int | None = None,
    pad: int = REST,
    chunk_steps: int | None = None,
) -> DataFrame:
    """Encoded sequences with the struct ``context`` of their attributes as floats (0 where not computed)."""
    examples = encode(seqs, length, pad, chunk_steps)
    known = seqs.sequences.columns
    zero = F.lit(0.0).cast("float")
    columns = [(F.coalesce(F.col(a).cast("float"), zero) if a in known else zero).alias(a) for a in attributes]
    context = seqs.sequences.select("seq_id", F.struct(*columns).alias("context"))
    return examples.join(context, "seq_id")


def parse(
    examples: DataFrame,
    attributes_to_parse: Sequence[str] | None = None,
    default_attributes_value: float | None = None,
    parse_sequence_feature: bool = False,
) -> DataFrame:
    """Read chosen features of stored examples: the named attributes, and the tokens if asked for.

    Only known attributes are read. One that an example lacks takes the default, or is an error without one.
    """
    stored = examples.schema["context"].dataType.names if "context" in examples.columns else []
    columns = [F.col(c) for c in ("seq_id", "chunk", "held", "split") if c in examples.columns]
    for name in ATTRIBUTES:
        if name not in (attributes_to_parse or ()):
            continue
        value = F.col(f"context.{name}") if name in stored else F.lit(None).cast("float")
        if default_attributes_value is None:
            missing = F.raise_error(F.lit(f"attribute {name} is missing and has no default")).cast("float")
        else:
            missing = F.lit(float(default_attributes_value)).cast("float")
        columns.append(F.coalesce(value, missing).alias(name))
    if parse_sequence_feature:
        columns.append(F.col("pitch_seq"))
    return examples.select(*columns)


def fixed_length(examples: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Examples whose token array has the length, and the quarantined others with their ``actual_length``.

    The length of a sequence in chunks is that of all of them together.
    """
    if "chunk" in examples.columns:
        keys = [c for c in ("split", "seq_id") if c in examples.columns]
        sizes = examples.groupBy(*keys).agg(F.sum(F.size("pitch_seq")).cast("int").alias("actual_length"))
        sized = examples.join(sizes, keys)
    else:
        sized = examples.withColumn("actual_length", F.size("pitch_seq"))
    fits = sized.filter(F.col("actual_length") == length).drop("actual_length")
    return fits, sized.filter(F.col("actual_length") != length)


def decode(examples: DataFrame, chunk_steps: int | None = None) -> DataFrame:
    """Notes from token arrays: ``seq_id, q_start, q_end, pitch``.

    A token array is one row, so its notes are found by array functions within the row: each onset lasts until
    the next token that is not a hold. Examples in chunks need the ``chunk_steps`` they were encoded with; what a note held over
    a border left in several rows is put together again, block by block, so no sequence is gathered in one task.
    """
    chunked = "chunk" in examples.columns
    if chunked and chunk_steps is None:
        raise ValueError("examples in chunks need the chunk_steps they were encoded with")
    tokens = F.col("pitch_seq")
    marks = F.transform(tokens, lambda t, i: F.struct(i.alias("at"), t.alias("token"), F.lit(False).alias("continues")))
    breaks = F.filter(marks, lambda s: s["token"] != HOLD)
    if chunked:
        lead = F.struct(F.lit(0).alias("at"), F.col("held").cast("bigint").alias("token"), F.lit(True).alias("continues"))
        goes_on = F.col("held").isNotNull() & (F.get(tokens, F.lit(0)) == HOLD)
        breaks = F.concat(F.when(goes_on, F.array(lead)).otherwise(F.array().cast(LEAD)), breaks)
    marked = examples.withColumn("_breaks", breaks)
    notes = F.transform(
        F.col("_breaks"),
        lambda s, i: F.struct(
            s["at"].alias("at"),
            F.coalesce(F.get(F.col("_breaks"), i + 1)["at"], F.size("pitch_seq")).alias("until"),
            s["token"].alias("token"),
            s["continues"].alias("continues"),
        ),
    )
    onsets = F.filter(notes, lambda s: s["token"] < HOLD)
    begin = F.col("chunk") * chunk_steps if chunked else F.lit(0)
    note = F.col("note")
    found = marked.select("seq_id", begin.alias("begin"), F.explode(onsets).alias("note")).select(
        "seq_id",
        (F.col("begin") + note["at"]).cast("bigint").alias("q_start"),
        (F.col("begin") + note["until"]).cast("bigint").alias("q_end"),
        note["token"].cast("int").alias("pitch"),
        note["continues"].alias("continues"),
    )
    if not chunked:
        return found.drop("continues")
    runs = scan(
        found,
        ["seq_id"],
        "q_start",
        ["continues"],
        block=block_of("q_start", BLOCK_STEPS, False),
        starts_run=lambda before, row: ~row["continues"],
    )
    whole = runs.groupBy("seq_id", F.col("run_head.q_start").alias("q_start"), "pitch").agg(F.max("q_end").alias("q_end"))
    return whole.select("seq_id", "q_start", "q_end", "pitch")


def decode_sequences(examples: DataFrame, chunk_steps: int | None = None) -> SeqSet:
    """Decoded examples as a set: melodies of one note per step, and headers with the length and the stored attributes.

    What an example does not store, as velocities, tempo and signature, is missing in the set.
    """

    def sequences() -> DataFrame:
        found = {"total_steps": F.sum(F.size("pitch_seq")).cast("bigint")}
        if "context" in examples.columns:
            # All chunks of a sequence have the same attributes.
            found["context"] = F.first("context")
        headers = examples.groupBy("seq_id").agg(*[c.alias(n) for n, c in found.items()])
        return headers.select("seq_id", "total_steps", "context.*") if "context" in found else headers

    def notes() -> DataFrame:
        placed = decode(examples, chunk_steps)
        return placed.withColumn("note_idx", F.col("q_start")).join(sequences().select("seq_id", "total_steps"), "seq_id")

    events = examples.sparkSession.createDataFrame([], EVENTS)
    return SeqSet(sequences, notes, events, monophonic=True)
