"""Remove duplicate sequences and duplicate encoded examples, and report how many there were."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.hashing import row_hashes
from scoreloom.model import SeqSet

# What makes up the content of a note and of an event. Ids and file paths are left out.
NOTE_CONTENT = ("pitch", "velocity", "start_time", "end_time", "q_start", "q_end", "instrument", "program", "is_drum")
EVENT_CONTENT = ("kind", "time", "q_step", "num", "den", "qpm", "cc_number", "cc_value", "instrument", "text")


def content_keys(seqs: SeqSet) -> DataFrame:
    """``seq_id, content``: equal for sequences with the same bag of notes and events; one key for those without any.

    The key adds up hashes of the rows, together with their number. Sums merge, so a sequence of any length is
    reduced before the shuffle and never gathered to be compared.
    """
    parts = []
    for kind, table, names in (("note", seqs.notes, NOTE_CONTENT), ("event", seqs.events, EVENT_CONTENT)):
        present = [F.col(n) for n in names if n in table.columns]
        one, two = row_hashes(F.lit(kind), *present)
        parts.append(table.select("seq_id", one.alias("one"), two.alias("two")))
    sums = (
        parts[0]
        .unionByName(parts[1])
        .groupBy("seq_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two"))
    )
    keyed = seqs.sequences.select("seq_id").distinct().join(sums, "seq_id", "left")
    return keyed.select("seq_id", F.coalesce(F.concat_ws("-", "n", "one", "two"), F.lit("")).alias("content"))


def distinct_sequences(seqs: SeqSet, keys: str = "record") -> SeqSet:
    """Distinct sequences.

    ``record`` compares whole records, id and file path included. A record that occurs n times has each of its notes and
    events n times as often, equal events of one record included, so n-th parts of their numbers are kept. An id names one
    record: of records that share an id but differ, all different rows stay. ``content`` compares notes and events
    alone and keeps the smallest id of each group of copies.
    """
    if keys == "record":
        times = seqs.sequences.groupBy("seq_id").agg(F.count(F.lit(1)).alias("_records"))

        def once(table: DataFrame) -> DataFrame:
            counted = table.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("_rows")).join(times, "seq_id", "left")
            number = F.ceil(F.col("_rows") / F.coalesce("_records", F.lit(1))).cast("int")
            return counted.withColumn("_rows", F.explode(F.array_repeat(F.lit(1), number))).select(*table.columns)

        return seqs.with_(sequences=lambda: seqs.sequences.distinct(), notes=lambda: once(seqs.notes), events=lambda: once(seqs.events))
    if keys != "content":
        raise ValueError("keys must be 'record' or 'content'")
    kept = content_keys(seqs).groupBy("content").agg(F.min("seq_id").alias("seq_id")).select("seq_id")
    return seqs.with_(
        sequences=seqs.sequences.join(kept, "seq_id", "left_semi"),
        notes=seqs.notes.join(kept, "seq_id", "left_semi"),
        events=seqs.events.join(kept, "seq_id", "left_semi"),
    )


def distinct_examples(examples: DataFrame) -> DataFrame:
    """Distinct (split, tokens, context) with the smallest ``seq_id`` of each, and the number of its ``copies``.

    Copies are counted within each task before the shuffle, so a group of very many copies is one row there. Sequences in
    chunks are compared as wholes, by the sums of their chunks' hashes, and keep all their chunks.
    """
    if "chunk" not in examples.columns:
        columns = [c for c in ("split", "pitch_seq", "context") if c in examples.columns]
        return examples.groupBy(*columns).agg(F.min("seq_id").alias("seq_id"), F.count(F.lit(1)).alias("copies"))
    keys = [c for c in ("split", "seq_id") if c in examples.columns]
    content = [F.to_json(F.struct(*[c for c in ("chunk", "held", "pitch_seq", "context") if c in examples.columns]))]
    one, two = row_hashes(*content)
    whole = examples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(one).alias("_one"), F.sum(two).alias("_two"))
    same = [c for c in ("split", "_n", "_one", "_two") if c in whole.columns]
    kept = whole.groupBy(*same).agg(F.min("seq_id").alias("seq_id"), F.count(F.lit(1)).alias("copies"))
    return examples.join(kept.select(*keys, "copies"), keys)


def duplicate_report(counts: DataFrame) -> DataFrame:
    """From ``copies`` per distinct item: ``total, distinct, duplicates, duplicate_percent``."""
    total, kept = F.coalesce(F.sum("copies"), F.lit(0).cast("bigint")), F.count(F.lit(1))
    percent = F.coalesce(F.try_divide(F.lit(100.0) * (total - kept), total), F.lit(0.0))
    return counts.agg(
        total.alias("total"),
        kept.alias("distinct_count"),
        (total - kept).alias("duplicates"),
        F.round(percent, 6).alias("duplicate_percent"),
    )


def copies(items: DataFrame, *columns: str) -> DataFrame:
    """Number of copies of each distinct item, known by two 60-bit hashes: the items themselves are not moved."""
    one, two = row_hashes(*[F.to_json(F.struct(c)) for c in columns])
    return items.groupBy(one.alias("one"), two.alias("two")).agg(F.count(F.lit(1)).alias("copies"))
