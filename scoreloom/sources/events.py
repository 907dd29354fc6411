"""Read an event stream table as sequences of notes, one sequence per user."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.model import SeqSet

# One hour of the stream is a quarter second of music: one sixteenth at 60 quarters per minute.
MICROS_PER_SECOND_OF_MUSIC = 14400000000.0
QPM = 60.0
INSTRUMENTS = {"click": 0, "view": 1, "purchase": 2, "signup": 3, "error": 9}


def notes_of(events: DataFrame, few_pitches: bool = False) -> DataFrame:
    """Note rows of an ``events`` table. ``few_pitches`` maps to five pitches, so that phrases repeat."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    start = micros / F.lit(MICROS_PER_SECOND_OF_MUSIC)
    return events.select(
        F.col("user_id").cast("string").alias("seq_id"),
        F.col("event_id").alias("note_idx"),
        (60 + k % 5 if few_pitches else 21 + k % 88).cast("int").alias("pitch"),
        (1 + F.floor("value").cast("int") % 127).cast("int").alias("velocity"),
        start.alias("start_time"),
        (start + 0.25 * (1 + k % 4)).alias("end_time"),
        _instrument().alias("instrument"),
        F.lit(0).alias("program"),
        (F.col("event_type") == "error").alias("is_drum"),
    )


def _instrument() -> Column:
    chosen = None
    for name, number in INSTRUMENTS.items():
        chosen = (F.when if chosen is None else chosen.when)(F.col("event_type") == name, number)
    return chosen



def headers_of(notes: DataFrame) -> DataFrame:
    text = F.lit(None).cast("string")
    return notes.groupBy("seq_id").agg(F.max("end_time").alias("total_time")).select(
        "seq_id",
        text.alias("parent_id"),
        F.lit("events").alias("source_id"),
        F.concat(F.lit("events/"), "seq_id", F.lit(".mid")).alias("filepath"),
        F.lit("events").alias("collection_name"),
        "total_time",
        F.lit(0.0).alias("start_offset"),
        text.alias("metadata_json"),
    )


def _event(kind: str, time: float, **fields) -> Column:
    types = {"num": "int", "den": "int", "qpm": "double", "cc_number": "int", "cc_value": "int", "instrument": "int", "text": "string"}
    values = [F.lit(kind).alias("kind"), F.lit(time).cast("double").alias("time")]
    values += [F.coalesce(fields[n], F.lit(None)).cast(t).alias(n) if n in fields else F.lit(None).cast(t).alias(n) for n, t in types.items()]
    return F.struct(*values)


def plain_events(headers: DataFrame) -> DataFrame:
    """One tempo and one signature (4/4) per sequence, both at time 0."""
    stated = F.array(
        _event("tempo", 0.0, qpm=F.lit(QPM)), _event("time_signature", 0.0, num=F.lit(4), den=F.lit(4))
    )
    return headers.select("seq_id", F.inline(stated))


def varied_events(headers: DataFrame, events: DataFrame) -> DataFrame:
    """Tempo and signature changes, bad signatures and pedal events, each for a share of the users."""
    user = F.col("seq_id").cast("bigint")
    signature = F.when(user % 5 == 0, 3).otherwise(4)
    below = F.when(user % 13 == 0, 3).otherwise(4)
    stated = F.array_compact(
        F.array(
            _event("tempo", 0.0, qpm=F.lit(QPM)),
            F.when(user % 11 == 0, _event("tempo", 120.0, qpm=F.lit(90.0))),
            _event("time_signature", 0.0, num=signature, den=below),
            F.when(user % 7 == 0, _event("time_signature", 96.0, num=F.lit(3), den=F.lit(4))),
        )
    )
    changes = headers.select("seq_id", F.inline(stated))
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    pedal = events.filter("event_type = 'signup'").select(
        F.col("user_id").cast("string").alias("seq_id"),
        F.lit("control").alias("kind"),
        (micros / F.lit(MICROS_PER_SECOND_OF_MUSIC)).alias("time"),
        F.lit(64).alias("cc_number"),
        (F.floor("value").cast("int") % 128).cast("int").alias("cc_value"),
        F.explode(F.array(*[F.lit(i) for i in INSTRUMENTS.values()])).alias("instrument"),
    )
    return changes.unionByName(pedal, allowMissingColumns=True)


def read_events(spark: SparkSession, folder: str, *, varied: bool = False, few_pitches: bool = False) -> SeqSet:
    """Sequences from ``<folder>/events.parquet``, plain or with the changes of ``varied_events``."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    original = notes = notes_of(events, few_pitches)
    headers = functools.cache(lambda: headers_of(original))
    # A sequence has one note and at most one pedal event per instrument for each row of its user.
    largest = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)))
    rows = largest.first()[0]
    if not varied:
        return SeqSet(headers, notes, lambda: plain_events(headers()), max_rows=rows + 2)
    # The first note of every seventeenth user is moved before time 0.
    first = notes.groupBy("seq_id").agg(F.min("note_idx").alias("note_idx"), F.lit(10.0).alias("_early"))
    first = first.filter(F.col("seq_id").cast("bigint") % 17 == 0)
    notes = notes.join(first, ["seq_id", "note_idx"], "left").withColumns(
        {
            "start_time": F.col("start_time") - F.coalesce("_early", F.lit(0.0)),
            "end_time": F.col("end_time") - F.coalesce("_early", F.lit(0.0)),
        }
    ).drop("_early")
    return SeqSet(headers, notes, lambda: varied_events(headers(), events), max_rows=rows * (1 + len(INSTRUMENTS)) + 4)
