"""Small sequence sets written out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.model import EVENTS, NOTES, SEQUENCES, SeqSet


def seqset(spark, notes, events=(), ids=None, measured=True) -> SeqSet:
    """``notes``: dicts with id, start, end, pitch and more; ``events``: dicts with id, kind, time and values."""
    rows = []
    for i, n in enumerate(notes):
        rows.append(
            (
                n["id"],
                n.get("idx", i),
                n["pitch"],
                n.get("velocity", 80),
                float(n["start"]),
                float(n["end"]),
                n.get("instrument", 0),
                n.get("program", 0),
                n.get("drum", False),
            )
        )
    names = EVENTS.names[1:]
    event_rows = []
    for e in events:
        values = {**e, "time": float(e["time"])}
        event_rows.append((e["id"], *[values.get(n) for n in names]))
    ids = sorted(set(ids or []) | {n["id"] for n in notes})
    heads = [(i, None, i, f"raw/{i}.mid", "hand", 0.0, 0.0, None) for i in ids]
    seqs = SeqSet(
        spark.createDataFrame(heads, SEQUENCES),
        spark.createDataFrame(rows, NOTES),
        spark.createDataFrame(event_rows, EVENTS),
    )
    return seqs.measured() if measured else seqs


def grid(spark, notes, total_steps=None, steps_per_bar=16.0, **fields) -> SeqSet:
    """A quantized set from notes given in steps."""
    plain = seqset(spark, notes, **fields)
    steps = [(n.get("idx", i), n["start"], n["end"]) for i, n in enumerate(notes)]
    at = spark.createDataFrame(steps, "note_idx long, q_start long, q_end long")
    last = F.lit(total_steps).cast("long") if total_steps else F.lit(max(n["end"] for n in notes)).cast("long")
    quantized = plain.notes.join(at, "note_idx").withColumns(
        {"steps_per_bar": F.lit(float(steps_per_bar)), "total_steps": last}
    )
    return plain.with_(notes=quantized)


def n(id, start, end, pitch, **more):
    return {"id": id, "start": start, "end": end, "pitch": pitch, **more}


def rows(df, *columns):
    """Sorted tuples of the columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
