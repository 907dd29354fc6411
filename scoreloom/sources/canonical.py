"""Turn raw files into sequences and back: choose a decoder by file suffix, decode, set failures apart; encode in a format."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.storage import settled
from scoreloom.model import EVENTS, NOTES, SEQUENCES, SeqSet
from scoreloom.registry import lookup, names, operator

# The file suffixes of each format. The comparison is case-sensitive. A decoder registered for a format of
# its own brings its suffixes, as ``operator("decoder", "abc", suffixes=(".abc",))``.
FORMATS = {
    "midi": (".mid", ".midi"),
    "musicxml": (".mxml", ".mxl"),
    "json": (".json",),
}

# What a decoder delivers per file, as a nested value. All fields may be missing.
DOCUMENT = (
    "struct<"
    "notes: array<struct<pitch: int, velocity: int, start: double, end: double, instrument: int, program: int, is_drum: boolean>>, "
    "tempos: array<struct<time: double, qpm: double>>, "
    "time_signatures: array<struct<time: double, num: int, den: int>>, "
    "controls: array<struct<time: double, number: int, value: int, instrument: int>>, "
    "chords: array<struct<time: double, text: string>>>"
)


@dataclass(frozen=True)
class Canonical:
    """Decoded sequences, and the files that could not be decoded: ``seq_id, filepath, source_type, error``."""

    seqs: SeqSet
    quarantine: DataFrame


def formats() -> dict[str, tuple[str, ...]]:
    """All formats with their suffixes, those of registered decoders included."""
    own = {name: tuple(lookup("decoder", name).defaults.get("suffixes", ())) for name in names("decoder")}
    return {**FORMATS, **{name: suffixes for name, suffixes in own.items() if suffixes}}


def format_of(source_type: Column) -> Column:
    """Format name of a file suffix; null if unsupported."""
    chosen = None
    for name, suffixes in formats().items():
        chosen = (F.when if chosen is None else chosen.when)(source_type.isin(*suffixes), name)
    return chosen


def dataset_format(files: DataFrame) -> DataFrame:
    """One row on whether all files agree on a format: ``format, formats, unsupported``.

    The format is that of the first file by path that has one.
    """
    fmt = format_of(F.col("source_type"))
    first = F.min(F.when(fmt.isNotNull(), F.struct("filepath", fmt.alias("format"))))
    return files.agg(
        first["format"].alias("format"),
        F.count_distinct(fmt).alias("formats"),
        F.count_if(fmt.isNull()).alias("unsupported"),
    )


@operator("decoder", "json")
def decode_json(files: DataFrame) -> DataFrame:
    """Note documents in JSON, parsed by Spark. A document that is not valid JSON is an error."""
    schema = DOCUMENT.removesuffix(">") + ", _corrupt: string>"
    text = F.decode("content", "UTF-8")
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_corrupt"})
    named = [F.col(f"_doc.{n}").alias(n) for n in ("notes", "tempos", "time_signatures", "controls", "chords")]
    bad = F.col("_doc").isNull() | F.col("_doc._corrupt").isNotNull() | F.col("_doc.notes").isNull()
    return (
        files.withColumn("_doc", parsed)
        .withColumn("error", F.when(bad, "malformed document"))
        .withColumn("document", F.struct(*named))
        .drop("_doc")
    )


def bytes_decoder(parse: Callable[[bytes], dict]) -> Callable[[DataFrame], DataFrame]:
    """A decoder from a function of one file's bytes that returns a document as a dict or raises.

    For binary formats only: the bytes of a batch of files go to Python through Arrow, and come back as JSON
    that Spark parses. Register it with ``operator("decoder", "midi")(bytes_decoder(parse))``.
    """

    def decode(files: DataFrame) -> DataFrame:
        def batches(frames: Iterator) -> Iterator:
            for frame in frames:
                texts, errors = [], []
                for content in frame["content"]:
                    try:
                        texts.append(json.dumps(parse(bytes(content))))
                        errors.append(None)
                    except Exception as problem:  # any failure of a decoder concerns its file alone
                        texts.append(None)
                        errors.append(f"{type(problem).__name__}: {problem}")
                yield frame.drop(columns=["content"]).assign(_text=texts, error=errors)

        kept = [f for f in files.schema.fields if f.name != "content"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", _text string, error string"
        decoded = files.select(*[f.name for f in kept], "content").mapInPandas(batches, schema)
        return decoded.withColumn("document", F.from_json("_text", DOCUMENT)).drop("_text")

    return decode


def decoded(files: DataFrame) -> DataFrame:
    """Files with their ``document``, or the ``error`` that kept it from being read; contents are left out.

    Files of unsupported types, of formats without a registered decoder, and files a decoder fails on have an error; none of
    them fails the job.
    """
    tagged = files.withColumn("_format", format_of(F.col("source_type")))
    known = [name for name in formats() if name in names("decoder")]
    columns = ["seq_id", "filepath", "source_type", "collection_name", "metadata_json", "document", "error"]
    reason = F.when(F.col("_format").isNull(), F.concat(F.lit("Unsupported file type: "), "source_type")).otherwise(
        F.concat(F.lit("no decoder for "), "_format")
    )
    outcome = tagged.filter(F.col("_format").isNull() | ~F.col("_format").isin(known)).withColumns(
        {"error": reason, "document": F.lit(None).cast(DOCUMENT)}
    )
    outcome = outcome.select(*columns)
    for name in known:
        part = lookup("decoder", name).fn(tagged.filter(F.col("_format") == name))
        outcome = outcome.unionByName(part.select(*columns))
    return outcome


def document_key() -> Column:
    """Equal for documents with the same notes and events in any order: a hash of all lists, sorted."""
    document = F.col("document").cast(DOCUMENT)
    lists = ("notes", "tempos", "time_signatures", "controls", "chords")
    return F.sha2(F.to_json(F.struct(*[F.sort_array(document[name]).alias(name) for name in lists])), 256)


def separated(outcome: DataFrame) -> Canonical:
    """The sequences of decoded files, and those that could not be decoded."""
    quarantine = outcome.filter("error is not null").select("seq_id", "filepath", "source_type", "error")
    return Canonical(to_tables(outcome.filter("error is null")), quarantine)


def canonicalize(files: DataFrame, once: bool = False) -> Canonical:
    """Decode files (``seq_id, filepath, source_type, collection_name, metadata_json, content``).

    Files that cannot be decoded go to the quarantine. Four tables come from the decoded files: with ``once`` these are written
    to the shared folder first, so that each file is read and decoded a single time.
    """
    outcome = decoded(files)
    return separated(settled(outcome, "decoded") if once else outcome)


def to_tables(decoded: DataFrame) -> SeqSet:
    """The three flat tables of decoded documents."""
    doc = F.col("document")
    last = F.array_max(F.transform(doc["notes"], lambda n: n["end"]))
    text = F.lit(None).cast("string")
    sequences = decoded.select(
        "seq_id",
        text.alias("parent_id"),
        F.col("seq_id").alias("source_id"),
        "filepath",
        "collection_name",
        F.coalesce(last, F.lit(0.0)).alias("total_time"),
        F.lit(0.0).alias("start_offset"),
        "metadata_json",
    )
    note = F.col("note")
    notes = decoded.select("seq_id", F.posexplode(doc["notes"]).alias("at", "note")).select(
        "seq_id",
        F.col("at").cast("bigint").alias("note_idx"),
        note["pitch"].alias("pitch"),
        F.coalesce(note["velocity"], F.lit(0)).alias("velocity"),
        note["start"].alias("start_time"),
        note["end"].alias("end_time"),
        F.coalesce(note["instrument"], F.lit(0)).alias("instrument"),
        F.coalesce(note["program"], F.lit(0)).alias("program"),
        F.coalesce(note["is_drum"], F.lit(False)).alias("is_drum"),
    )
    parts = {
        "tempo": ("tempos", {"qpm": "qpm"}),
        "time_signature": ("time_signatures", {"num": "num", "den": "den"}),
        "control": ("controls", {"cc_number": "number", "cc_value": "value", "instrument": "instrument"}),
        "chord": ("chords", {"text": "text"}),
    }
    types = {f.name: f.dataType for f in EVENTS.fields}
    # All four lists become one list of event structs per file.
    def event_list(kind: str, name: str, fields: dict[str, str]) -> Column:
        def event(e: Column) -> Column:
            rest = [n for n in types if n not in ("seq_id", "kind", "time")]
            values = [(e[fields[n]] if n in fields else F.lit(None)).cast(types[n]) for n in rest]
            # Notes and controls without an instrument are of the same one.
            values = [F.coalesce(v, F.lit(0)) if n == "instrument" and n in fields else v for n, v in zip(rest, values)]
            values = [v.alias(n) for n, v in zip(rest, values)]
            return F.struct(F.lit(kind).alias("kind"), e["time"].alias("time"), *values)

        return F.coalesce(F.transform(doc[name], event), F.array())

    lists = [event_list(kind, name, fields) for kind, (name, fields) in parts.items()]
    events = decoded.select("seq_id", F.inline(F.concat(*lists)))
    return SeqSet(
        sequences.select(*SEQUENCES.names), notes.select(*NOTES.names), events.select(*EVENTS.names)
    )


def documents(seqs: SeqSet) -> DataFrame:
    """``seq_id, document``: each sequence's notes and events as the nested value that decoders deliver, all in one exchange.

    A file holds a whole sequence, so its document is one value: this is the one place where a sequence is gathered.
    """
    note = F.struct("note_idx", "pitch", "velocity", F.col("start_time").alias("start"), F.col("end_time").alias("end"), "instrument", "program", "is_drum")
    lists = {
        "tempos": ("tempo", F.struct("time", "qpm")),
        "time_signatures": ("time_signature", F.struct("time", "num", "den")),
        "controls": ("control", F.struct("time", F.col("cc_number").alias("number"), F.col("cc_value").alias("value"), "instrument")),
        "chords": ("chord", F.struct("time", "text")),
    }
    events = [F.when(F.col("kind") == kind, value).alias(name) for name, (kind, value) in lists.items()]
    rows = seqs.sequences.select("seq_id").unionByName(seqs.notes.select("seq_id", note.alias("notes")), allowMissingColumns=True)
    rows = rows.unionByName(seqs.events.select("seq_id", *events), allowMissingColumns=True)
    # Missing values are not collected: each row adds to one list at most.
    whole = rows.groupBy("seq_id").agg(*[F.sort_array(F.collect_list(name)).alias(name) for name in ("notes", *lists)])
    in_order = F.transform("notes", lambda n: n.dropFields("note_idx"))
    return whole.select("seq_id", F.struct(in_order.alias("notes"), *lists).cast(DOCUMENT).alias("document"))


@operator("encoder", "json", suffix=".json")
def encode_json(documents: DataFrame) -> DataFrame:
    """Note documents in JSON, as ``decode_json`` reads them: ``content`` in place of ``document``."""
    return documents.withColumn("content", F.encode(F.to_json("document"), "UTF-8")).drop("document")


def bytes_encoder(render: Callable[[dict], bytes]) -> Callable[[DataFrame], DataFrame]:
    """An encoder from a function of one document, as a dict, that returns a file's bytes.

    For binary formats, the counterpart of ``bytes_decoder``. Register it with its suffix, as
    ``operator("encoder", "midi", suffix=".mid")(bytes_encoder(render))``. A document that it fails on stops the job.
    """

    def encode(documents: DataFrame) -> DataFrame:
        def batches(frames: Iterator) -> Iterator:
            for frame in frames:
                yield frame.drop(columns=["_text"]).assign(content=[render(json.loads(text)) for text in frame["_text"]])

        kept = [f for f in documents.schema.fields if f.name != "document"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", content binary"
        return documents.select(*[f.name for f in kept], F.to_json("document").alias("_text")).mapInPandas(batches, schema)

    return encode


def to_files(seqs: SeqSet, fmt: str = "json") -> DataFrame:
    """The sequences as files of a format: ``seq_id, filepath, source_type, collection_name, metadata_json, content``.

    The columns are those that ``canonicalize`` reads. A file is named after its sequence's file, with the format's suffix, or
    after its id if there is none.
    """
    encoder = lookup("encoder", fmt)
    suffix = encoder.defaults["suffix"]
    headers = seqs.sequences.select("seq_id", "filepath", "collection_name", "metadata_json")
    stem = F.regexp_replace(F.coalesce("filepath", "seq_id"), r"\.[^./]+$", "")
    headers = headers.withColumns({"filepath": F.concat(stem, F.lit(suffix)), "source_type": F.lit(suffix)})
    columns = ["seq_id", "filepath", "source_type", "collection_name", "metadata_json", "content"]
    return encoder.fn(documents(seqs)).join(headers, "seq_id").select(*columns)
