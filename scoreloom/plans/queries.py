"""Named queries over the given tables, one per operator. ``oracle`` has the same results in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import scoreloom.operators  # noqa: F401  (registers the operators)
from scoreloom.functions.storage import scratch_path, write_table
from scoreloom.loader import Loader, batch_rows
from scoreloom.model import ATTRIBUTES, SeqSet
from scoreloom.operators import (
    attributes,
    audit,
    augment,
    distinct,
    melody,
    quantize,
    represent,
    slicing,
    split,
    transform,
)
from scoreloom.operators import histogram as hist
from scoreloom.plans.datasets import Source, import_datasets, process_datasets, represented
from scoreloom.registry import apply_chain, operator
from scoreloom.representations import PitchSequence
from scoreloom.sinks import write_dataset, write_splits
from scoreloom.sources import canonical
from scoreloom.sources.events import read_events
from scoreloom.sources.files import import_tree, read_entry_files, suffix
from scoreloom.sources.index import entries_of_type, read_entries
from scoreloom.sources.tables import read_seqset, read_sequences, write_seqset

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RATIOS = {"train": 0.7, "validation": 0.2, "test": 0.1}
SLICES = {"slice_size_bars": 4, "hop_size_bars": 1, "keep_shorter_slices": False, "allow_cropped_slices": True}
MELODIES = {"min_bars": 2, "gap_bars": 4, "min_unique_pitches": 3}
LIMITED = {**MELODIES, "max_bars_truncate": 8, "max_bars_discard": 12}
CHAIN = {
    "time_change_splitter": {"order": 1, "skip_splits_inside_notes": False, "keep_time_signatures": ["4/4"]},
    "quantizer": {"order": 2, "steps_per_quarter": 4},
    "melody_extractor": {"order": 3, "gap_bars": 4, "min_bars": 4, "min_unique_pitches": 3},
    "slicer": {"order": 4, "slice_size_bars": 4, "hop_size_bars": 1, "keep_shorter_slices": False},
}
# Attributes that need repeated pitches are shown on the five-pitch reading of the table.
FEW_PITCHES = {
    "unique_bigrams_ratio": {},
    "unique_trigrams_ratio": {},
    "note_change_ratio": {},
    "repetitive_section_ratio": {"min_repetitions": 2},
    "len_longest_rep_section": {"min_repetitions": 2},
}
MANY_PITCHES = {
    "toussaint": {"bars": 4, "binary": True},
    "note_density": {"bars": 4, "binary": False},
    "pitch_range": {},
    "contour": {},
    "unique_notes_ratio": {},
    "dynamic_range": {},
    "ratio_note_off_steps": {},
    "ratio_hold_note_steps": {},
}
SHORT_NAMES = {
    "unique_notes_ratio": "unique_notes",
    "unique_bigrams_ratio": "bigrams",
    "unique_trigrams_ratio": "trigrams",
    "note_change_ratio": "note_change",
    "ratio_note_off_steps": "note_off",
    "ratio_hold_note_steps": "hold",
    "repetitive_section_ratio": "rep_ratio",
    "len_longest_rep_section": "longest_rep",
}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def plain(spark: SparkSession, folder: str, **options) -> SeqSet:
    return read_events(spark, folder, **options)


def gridded(spark: SparkSession, folder: str, **options) -> SeqSet:
    return quantize.quantize(read_events(spark, folder, **options))


def sliced(spark: SparkSession, folder: str, **options) -> SeqSet:
    return slicing.slice_bars(gridded(spark, folder, **options), **SLICES)


def timed(seqs: SeqSet) -> DataFrame:
    return seqs.notes.select("seq_id", "note_idx", "pitch", r6("start_time").alias("start_time"), r6("end_time").alias("end_time"))


def stepped(seqs: SeqSet) -> DataFrame:
    return seqs.notes.select("seq_id", "q_start", "q_end", "pitch", "velocity", "total_steps")


def per_slice(seqs: SeqSet) -> DataFrame:
    return (
        seqs.notes.groupBy(*seqs.keys)
        .agg(
            F.count(F.lit(1)).alias("notes"),
            F.sum("q_start").alias("starts"),
            F.sum("q_end").alias("ends"),
            F.sum("pitch").alias("pitches"),
            F.max("total_steps").alias("total_steps"),
        )
        .drop("root_id", "instrument")
    )


def as_text(examples: DataFrame) -> DataFrame:
    """Token arrays as comma-separated text, which every engine prints alike."""
    return examples.withColumn("tokens", F.array_join(F.col("pitch_seq").cast("array<string>"), ",")).drop("pitch_seq")


# Sources and sinks


@query("scan_sequences")
def _(spark, folder):
    path = scratch_path(spark, "canonical")
    write_seqset(plain(spark, folder), f"{path}/events")
    headers = read_sequences(spark, f"{path}/*")
    return headers.select("seq_id", "filepath", r6("total_time").alias("total_time"))


@query("loader_scan")
def _(spark, folder):
    rows = Loader(id_column="o_orderkey", batch_size=None).load(spark, f"{folder}/orders.parquet")
    return rows.select("o_orderkey", "o_totalprice", "epoch", "position")


@query("import_tree")
def _(spark, folder):
    path = scratch_path(spark, "tree")
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text")
    documents.write.partitionBy("lang").text(path)
    files = import_tree(spark, path)
    return files.groupBy(F.split("rel_path", "/")[0].alias("folder")).agg(F.sum("length").alias("bytes"))


@query("debug_tap")
def _(spark, folder):
    return audit.tap(plain(spark, folder).sequences, "1[0-9]").select("seq_id", "filepath")


def event_files(spark: SparkSession, folder: str) -> DataFrame:
    """One small document per event, with the suffix and the damage that its event type decides."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    note = F.struct(k.alias("pitch"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"))
    upper = F.struct((k + 4).alias("pitch"), F.lit(1.0).alias("start"), F.lit(2.0).alias("end"))
    text = F.to_json(F.struct(F.array(note, upper).alias("notes")))
    damaged = F.when(F.col("event_type") == "signup", F.substr(text, F.lit(1), F.lit(20))).otherwise(text)
    kind = (
        F.when(F.col("event_type") == "view", ".mid")
        .when(F.col("event_type") == "purchase", ".mxl")
        .when(F.col("event_type") == "error", ".xyz")
        .otherwise(".json")
    )
    name = F.concat(F.lit("raw/"), F.col("event_id").cast("string"), kind)
    return events.select(
        F.col("event_id").cast("string").alias("seq_id"),
        name.alias("filepath"),
        suffix(name).alias("source_type"),
        F.lit("events").alias("collection_name"),
        F.lit(None).cast("string").alias("metadata_json"),
        F.encode(damaged, "UTF-8").alias("content"),
    )


@query("canonicalize_json")
def _(spark, folder):
    done = canonical.canonicalize(event_files(spark, folder))
    notes = done.seqs.notes.groupBy("seq_id").agg(F.count(F.lit(1)).alias("notes"), F.sum("pitch").alias("pitches"))
    return notes.withColumn("error", F.lit("none")).unionByName(
        done.quarantine.select(
            "seq_id", F.lit(0).cast("bigint").alias("notes"), F.lit(0).cast("bigint").alias("pitches"), "error"
        )
    )


@query("format_dispatch")
def _(spark, folder):
    files = event_files(spark, folder)
    fmt = F.coalesce(canonical.format_of(F.col("source_type")), F.lit("unsupported"))
    return files.groupBy("source_type", fmt.alias("format")).agg(F.count(F.lit(1)).alias("files"))


def _heights(seqs: SeqSet) -> DataFrame:
    """What notes and stated events a set has, per sequence."""
    notes = seqs.notes.groupBy("seq_id").agg(
        F.count(F.lit(1)).alias("notes"), F.sum("pitch").alias("pitches"), F.round(F.sum("start_time"), 3).alias("starts"), F.round(F.sum("end_time"), 3).alias("ends")
    )
    events = seqs.events.groupBy("seq_id").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("time"), 3).alias("times"))
    return notes.join(events, "seq_id")


@query("encode_files")
def _(spark, folder):
    """Sequences written as JSON documents, one file's content each, and decoded again."""
    files = canonical.to_files(plain(spark, folder, varied=True))
    path = scratch_path(spark, "exported")
    write_table(files, path)
    return _heights(canonical.canonicalize(spark.read.parquet(path), once=True).seqs)


@query("custom_format")
def _(spark, folder):
    """A user's own format, one line per note, through a registered encoder and decoder."""

    def render(document: dict) -> bytes:
        return "\n".join(f"{n['pitch']} {n['start']!r} {n['end']!r}" for n in document["notes"]).encode()

    def parse(content: bytes) -> dict:
        lines = [line.split(" ") for line in content.decode().split("\n")]
        return {"notes": [{"pitch": int(p), "start": float(a), "end": float(b)} for p, a, b in lines]}

    operator("encoder", "lines", suffix=".lines")(canonical.bytes_encoder(render))
    operator("decoder", "lines", suffixes=(".lines",))(canonical.bytes_decoder(parse))
    files = canonical.to_files(plain(spark, folder), "lines")
    return timed(canonical.canonicalize(files, once=True).seqs)


@query("two_sources")
def _(spark, folder):
    """One job over two datasets, each with its own folder of input and output."""
    path = scratch_path(spark, "sources")
    seqs = plain(spark, folder)
    given = [Source("odd"), Source("even")]
    for source, rest in zip(given, (1, 0)):
        part = F.col("seq_id").cast("bigint") % 2 == rest
        write_seqset(SeqSet(seqs.sequences.filter(part), seqs.notes.filter(part), seqs.events.filter(part)), f"{path}/canonical/{source.folder}")
    config = {"silence_splitter": {"order": 1, "gap_seconds": 3.0}}
    report = process_datasets(spark, f"{path}/canonical", path, given, config, "segments")
    made = [
        per_sequence.withColumns({"dataset": F.lit(source.folder), "reported": F.lit(report[source.folder]["sequences"]).cast("bigint")})
        for source in given
        for per_sequence in [read_seqset(spark, report[source.folder]["path"], measure=False).notes.groupBy("seq_id").agg(F.count(F.lit(1)).alias("notes"))]
    ]
    return made[0].unionByName(made[1])


@query("write_splits")
def _(spark, folder):
    path = scratch_path(spark, "splits")
    seqs = augment.assign_splits(sliced(spark, folder), RATIOS)
    examples = represent.encode(seqs).join(seqs.sequences.select("seq_id", "split"), "seq_id")
    write_splits(examples, path)
    return as_text(spark.read.parquet(path)).select("seq_id", "split", "tokens")


@query("overwrite_policy")
def _(spark, folder):
    path = scratch_path(spark, "policy")
    headers = plain(spark, folder).sequences.select("seq_id")
    again = headers.select(F.concat("seq_id", F.lit("-again")).alias("seq_id"))
    first = write_dataset(headers, path)
    second = write_dataset(again, path)
    # A table without the marker that is written last is half-written, and replaced.
    half = scratch_path(spark, "half")
    again.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    third = write_dataset(headers, half)
    both = spark.read.parquet(path).join(spark.read.parquet(half), "seq_id")
    return both.select("seq_id", F.lit(first).alias("first"), F.lit(second).alias("second"), F.lit(third).alias("third"))


@query("scan_index")
def _(spark, folder):
    """Entries of an index with a line per document, written and read again."""
    path = scratch_path(spark, "index")
    file = F.struct(F.concat(F.lit("raw/"), "doc_id", F.lit(".txt")).alias("path"), F.sha2("text", 256).alias("checksum"))
    entry = F.struct(
        F.concat(F.lit("set/"), "doc_id").alias("id"), F.create_map(F.lit("doc"), file).alias("files"), F.struct("lang").alias("about")
    )
    documents = spark.read.parquet(f"{folder}/documents.parquet").withColumn("doc_id", F.col("doc_id").cast("string"))
    documents.select(F.to_json(entry)).write.text(path)
    return entries_of_type(read_entries(spark, path, "documents"), "doc")


@query("scan_entry_files")
def _(spark, folder):
    """The files of a tree that an index lists, and one that is not there."""
    path = scratch_path(spark, "files")
    spark.read.parquet(f"{folder}/documents.parquet").select("source", "text").write.partitionBy("source").text(path)
    there = import_tree(spark, path).select("rel_path").unionByName(spark.createDataFrame([("source=none/lost.txt",)], "rel_path string"))
    entries = there.select(F.split("rel_path", "/")[0].alias("seq_id"), F.col("rel_path").alias("filepath"))
    found, lost = read_entry_files(spark, entries, path)
    sizes = found.groupBy("seq_id").agg(F.sum("length").alias("bytes"), F.max("source_type").alias("source_type"))
    nothing = lost.select("seq_id", F.lit(0).cast("bigint").alias("bytes"), F.col("error").alias("source_type"))
    return sizes.unionByName(nothing)


@query("import_job")
def _(spark, folder):
    """A tree taken over as a table of files, with the number of files whose sums were found wrong."""
    root = scratch_path(spark, "import")
    spark.read.parquet(f"{folder}/documents.parquet").select("lang", "text").write.partitionBy("lang").text(f"{root}/in/docs-full")
    report = import_datasets(spark, f"{root}/in", f"{root}/out", [Source("docs")])["docs-full"]
    again = import_datasets(spark, f"{root}/in", f"{root}/out", [Source("docs")])["docs-full"]
    raw = spark.read.parquet(f"{root}/out/raw/docs-full")
    return raw.groupBy(F.split("rel_path", "/")[0].alias("folder")).agg(
        F.sum(F.octet_length("content")).alias("bytes"),
        F.lit(report["invalid_checksums"]).cast("bigint").alias("invalid"),
        F.lit(again["skipped"]).alias("skipped"),
    )


# Quantize and split


@query("quantize_relative")
def _(spark, folder):
    return gridded(spark, folder).notes.select("seq_id", "note_idx", "q_start", "q_end", "steps_per_bar", "total_steps")


@query("quantize_absolute")
def _(spark, folder):
    seqs = quantize.quantize(plain(spark, folder), steps_per_quarter=None, steps_per_second=10)
    return seqs.notes.select("seq_id", "note_idx", "q_start", "q_end", "total_steps")


@query("quantize_discards")
def _(spark, folder):
    return quantize.discards(plain(spark, folder, varied=True))


@query("split_hop_seconds")
def _(spark, folder):
    return timed(split.split_hop(plain(spark, folder), hop_size_seconds=1.5, hop_size_bars=None))


@query("split_hop_skip")
def _(spark, folder):
    seqs = split.split_hop(
        plain(spark, folder), hop_size_seconds=1.0, hop_size_bars=None, skip_splits_inside_notes=True
    )
    return timed(seqs)


@query("split_hop_bars")
def _(spark, folder):
    return timed(split.split_hop(plain(spark, folder, varied=True), hop_size_bars=2))


@query("split_time_change")
def _(spark, folder):
    return timed(split.split_time_changes(plain(spark, folder, varied=True), keep_time_signatures=None))


@query("split_time_change_skip")
def _(spark, folder):
    seqs = plain(spark, folder, varied=True)
    return timed(split.split_time_changes(seqs, skip_splits_inside_notes=True, keep_time_signatures=None))


@query("filter_time_signature")
def _(spark, folder):
    seqs = split.split_time_changes(plain(spark, folder, varied=True), keep_time_signatures=["4/4"])
    return seqs.notes.groupBy("seq_id").agg(F.count(F.lit(1)).alias("notes"), F.sum("pitch").alias("pitches"))


@query("split_events")
def _(spark, folder):
    """Tempo, signature and pedal events as they are handed to the segments of a split."""
    events = split.split_silence(plain(spark, folder, varied=True), 6.0).events
    return events.groupBy("seq_id", "kind").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("time")).alias("times"), F.coalesce(F.sum("qpm"), F.lit(0.0)).alias("qpm"), F.coalesce(F.sum("num"), F.lit(0)).alias("num")
    )


def event_sums(events: DataFrame, time: str = "time") -> DataFrame:
    return events.groupBy("seq_id", "kind").agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.sum(F.col(time).cast("double"))).alias("times"),
        r6(F.coalesce(F.sum("qpm"), F.lit(0.0))).alias("qpm"),
        F.coalesce(F.sum("num"), F.lit(0)).alias("num"),
    )


@query("change_events")
def _(spark, folder):
    """Events of segments when changes inside notes do not cut: those changes stay in them."""
    seqs = plain(spark, folder, varied=True)
    return event_sums(split.split_time_changes(seqs, skip_splits_inside_notes=True, keep_time_signatures=None).events)


@query("slice_events")
def _(spark, folder):
    return event_sums(slicing.slice_bars(gridded(spark, folder, varied=True), **SLICES).events, "q_step")


@query("melody_events")
def _(spark, folder):
    return event_sums(melody.extract_melodies(gridded(spark, folder, varied=True), **MELODIES).events, "q_step")


@query("header_offsets")
def _(spark, folder):
    seqs = gridded(spark, folder)
    headers = slicing.slice_bars(seqs, **SLICES).sequences.select("seq_id", "start_offset")
    return headers.unionByName(melody.extract_melodies(seqs, **MELODIES).sequences.select("seq_id", "start_offset"))


@query("split_silence")
def _(spark, folder):
    return timed(split.split_silence(plain(spark, folder), 3.0))


# Slices and melodies


@query("slice_bars")
def _(spark, folder):
    o = {**SLICES, "keep_shorter_slices": True}
    return per_slice(slicing.slice_bars(gridded(spark, folder), **o))


@query("slice_drop_short")
def _(spark, folder):
    return per_slice(sliced(spark, folder))


@query("slice_no_crop")
def _(spark, folder):
    o = {**SLICES, "allow_cropped_slices": False, "skip_splits_inside_notes": True, "hop_size_bars": 2}
    return per_slice(slicing.slice_bars(gridded(spark, folder), **o))


@query("slice_shorter_count")
def _(spark, folder):
    return slicing.shorter_slices(gridded(spark, folder), **SLICES)


@query("extract_melody")
def _(spark, folder):
    return stepped(melody.extract_melodies(gridded(spark, folder), **MELODIES))


@query("extract_melody_truncated")
def _(spark, folder):
    return stepped(melody.extract_melodies(gridded(spark, folder), **LIMITED))


@query("melody_audit")
def _(spark, folder):
    return melody.melody_audit(gridded(spark, folder), **LIMITED)


@query("melody_length_hist")
def _(spark, folder):
    return melody.melody_lengths(gridded(spark, folder), **MELODIES)


@query("process_written")
def _(spark, folder):
    """A chain's result written as three tables and read again."""
    path = scratch_path(spark, "processed")
    write_seqset(apply_chain(plain(spark, folder, varied=True), "processor", CHAIN, once=True), path)
    seqs = read_seqset(spark, path)
    stated = seqs.events.groupBy("seq_id").agg(F.count_if(F.col("kind").isin("tempo", "time_signature")).alias("stated"))
    return per_slice(seqs).join(seqs.sequences.select("seq_id"), "seq_id").join(stated, "seq_id")


@query("chain_process")
def _(spark, folder):
    return per_slice(apply_chain(plain(spark, folder, varied=True), "processor", CHAIN))


# Transforms


@query("stretch")
def _(spark, folder):
    return timed(transform.stretch(plain(spark, folder), 1.5))


@query("sustain")
def _(spark, folder):
    return timed(transform.sustain(plain(spark, folder, varied=True)))


@query("transpose")
def _(spark, folder):
    seqs = transform.transpose(plain(spark, folder), amount=7, min_allowed_pitch=40, max_allowed_pitch=100)
    return seqs.notes.select("seq_id", "note_idx", "pitch")


CHORDS = ("C", "F#m7", "Bb", "N.C.")


@query("transpose_chords")
def _(spark, folder):
    """Chord names of the sequences that have a note left after they are moved."""
    seqs = split.split_silence(plain(spark, folder))
    chords = seqs.sequences.select(
        "seq_id", F.lit("chord").alias("kind"), F.posexplode(F.array(*map(F.lit, CHORDS))).alias("time", "text")
    ).withColumn("time", F.col("time").cast("double"))
    seqs = seqs.with_(events=seqs.events.unionByName(chords, allowMissingColumns=True))
    moved = transform.transpose(seqs, amount=3, min_allowed_pitch=60, max_allowed_pitch=72)
    return moved.events.filter("kind = 'chord'").select("seq_id", "time", "text")


@query("stretch_events")
def _(spark, folder):
    return event_sums(transform.stretch(plain(spark, folder, varied=True), 1.5).events)


@query("transpose_strict")
def _(spark, folder):
    seqs = transform.transpose(
        split.split_silence(plain(spark, folder)), amount=-9, min_allowed_pitch=21, max_allowed_pitch=108, delete_notes=False
    )
    return seqs.notes.select("seq_id", "note_idx", "pitch")


@query("transpose_audit")
def _(spark, folder):
    seqs = split.split_silence(plain(spark, folder))
    return transform.transpose_audit(seqs, amount=7, min_allowed_pitch=40, max_allowed_pitch=100)


# Attributes


def _attribute_query(name: str, options: dict, few_pitches: bool) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return attributes.attribute_table(sliced(spark, folder, few_pitches=few_pitches), {name: options})

    QUERIES[f"attr_{SHORT_NAMES.get(name, name)}"] = run


for _name, _options in {**MANY_PITCHES, **FEW_PITCHES}.items():
    _attribute_query(_name, _options, _name in FEW_PITCHES)


@query("attributes_all")
def _(spark, folder):
    options = {a: FEW_PITCHES.get(a, MANY_PITCHES.get(a)) for a in ATTRIBUTES}
    return attributes.attribute_table(gridded(spark, folder, few_pitches=True), options)


@query("attributes_written")
def _(spark, folder):
    seqs = attributes.compute_attributes(gridded(spark, folder), ["contour", "pitch_range"])
    return seqs.sequences.select("seq_id", "filepath", "contour", "pitch_range")


@operator("attribute", "mean_velocity", scale=1.0)
def mean_velocity(scale: float = 1.0) -> Column:
    """Example of a user's own attribute: any aggregate over the onset rows."""
    return F.avg("velocity") * scale


@query("custom_attribute")
def _(spark, folder):
    return attributes.attribute_table(sliced(spark, folder), {"mean_velocity": {"scale": 0.5, "round_digits": 4}})


@query("attr_histogram")
def _(spark, folder):
    options = {a: MANY_PITCHES[a] for a in ("toussaint", "pitch_range", "contour")}
    table = attributes.attribute_table(sliced(spark, folder), options)
    counts = hist.histogram(table, ["toussaint", "pitch_range", "contour"], [30, 40, 50])
    return counts.select("metric", "bins", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


@query("histogram_stored")
def _(spark, folder):
    """The same from headers that were written with their attributes."""
    path = scratch_path(spark, "described")
    options = {a: MANY_PITCHES[a] for a in ("toussaint", "pitch_range", "contour")}
    seqs = attributes.compute_attributes(sliced(spark, folder), options)
    write_table(seqs.sequences, f"{path}/sequences")
    counts = hist.histogram(read_sequences(spark, path), ["toussaint", "pitch_range", "contour"], [30, 40, 50])
    return counts.select("metric", "bins", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count")


# Augment and split


@query("augment_gate")
def _(spark, folder):
    headers = plain(spark, folder).sequences
    return headers.select("seq_id", augment.gate(42, 0.7, F.col("seq_id")).alias("augmented"))


@query("augment_transpose")
def _(spark, folder):
    seqs = augment.augment_transpose(plain(spark, folder), threshold=0.3)
    return seqs.notes.select("seq_id", "note_idx", "pitch")


@query("augment_clamped")
def _(spark, folder):
    seqs = split.split_silence(plain(spark, folder))
    seqs = augment.augment_transpose(seqs, threshold=0.3, delete_notes=False)
    return seqs.notes.select("seq_id", "note_idx", "pitch")


@query("augment_append")
def _(spark, folder):
    seqs = split.split_silence(plain(spark, folder))
    seqs = augment.augment_transpose(seqs, threshold=0.3, in_place=False, min_allowed_pitch=50, max_allowed_pitch=80)
    return seqs.notes.select("seq_id", "note_idx", "pitch")


@query("augment_audit")
def _(spark, folder):
    seqs = split.split_silence(plain(spark, folder))
    return augment.augment_audit(seqs, threshold=0.3, min_allowed_pitch=50, max_allowed_pitch=80)


@query("split_dataset")
def _(spark, folder):
    return augment.assign_splits(plain(spark, folder), RATIOS).sequences.select("seq_id", "split")


@query("split_augment")
def _(spark, folder):
    seqs = augment.assign_splits(plain(spark, folder), RATIOS)
    seqs = augment.augment_transpose(seqs, threshold=0.3, only_splits=["train", "validation"])
    return seqs.notes.select("seq_id", "note_idx", "pitch")


@query("split_report")
def _(spark, folder):
    return augment.split_report(augment.assign_splits(plain(spark, folder), RATIOS).sequences, RATIOS)


# Represent


@query("encode_pitch_seq")
def _(spark, folder):
    return as_text(represent.encode(sliced(spark, folder), length=64)).select("seq_id", "tokens")


@query("encode_whole")
def _(spark, folder):
    return as_text(represent.encode(gridded(spark, folder))).select("seq_id", "tokens")


@query("encode_long")
def _(spark, folder):
    """In rows of 256 steps, silent ones included, with the pitch that is held over each border."""
    return as_text(represent.encode(gridded(spark, folder), chunk_steps=256)).select("seq_id", "chunk", "held", "tokens")


@query("decode_long")
def _(spark, folder):
    return represent.decode(represent.encode(gridded(spark, folder), chunk_steps=24), chunk_steps=24)


@query("distinct_long")
def _(spark, folder):
    seqs = with_copies(gridded(spark, folder), F.concat(F.lit("copy"), "seq_id"))
    kept = distinct.distinct_examples(represent.encode(seqs, chunk_steps=256))
    return as_text(kept).select("seq_id", "chunk", "tokens", "copies")


CONTEXT = ("pitch_range", "contour")


def with_context(spark: SparkSession, folder: str) -> DataFrame:
    seqs = sliced(spark, folder)
    seqs = attributes.compute_attributes(seqs, list(CONTEXT))
    return represent.encode_with_context(seqs, CONTEXT, length=64)


@query("encode_with_context")
def _(spark, folder):
    values = [F.round(F.col(f"context.{a}").cast("double"), 5).alias(a) for a in CONTEXT]
    return as_text(with_context(spark, folder)).select("seq_id", "tokens", *values)


@query("decode_with_context")
def _(spark, folder):
    """Notes and stored attributes of decoded examples."""
    seqs = represent.decode_sequences(with_context(spark, folder))
    notes = seqs.notes.groupBy("seq_id").agg(F.count(F.lit(1)).alias("notes"), F.sum("pitch").alias("pitches"))
    values = [F.round(F.col(a).cast("double"), 5).alias(a) for a in CONTEXT]
    return seqs.sequences.select("seq_id", "total_steps", *values).join(notes, "seq_id")


@query("parse_features")
def _(spark, folder):
    parsed = represent.parse(with_context(spark, folder), ["contour", "toussaint"], -1.0)
    values = [F.round(F.col(a).cast("double"), 5).alias(a) for a in ("contour", "toussaint")]
    return parsed.select("seq_id", *values)


@query("parse_fixed_length")
def _(spark, folder):
    fits, others = represent.fixed_length(represent.encode(gridded(spark, folder)), 718)
    return fits.select("seq_id", F.lit(718).alias("actual_length"), F.lit(True).alias("fits")).unionByName(
        others.select("seq_id", "actual_length", F.lit(False).alias("fits"))
    )


@query("decode_pitch_seq")
def _(spark, folder):
    return represent.decode(represent.encode(melody.extract_melodies(gridded(spark, folder), **MELODIES)))


# Distinct and counters


def with_copies(seqs: SeqSet, new_id: Column) -> SeqSet:
    """The set and a copy of each sequence under the id given."""

    def doubled(table: DataFrame) -> DataFrame:
        return table.unionByName(table.withColumn("seq_id", new_id))

    return seqs.with_(sequences=doubled(seqs.sequences), notes=doubled(seqs.notes), events=doubled(seqs.events))


def _counted(seqs: SeqSet) -> DataFrame:
    notes = seqs.notes.groupBy("seq_id").agg(F.count(F.lit(1)).alias("notes"))
    return seqs.sequences.select("seq_id").join(notes, "seq_id")


@query("distinct_sequences")
def _(spark, folder):
    """Records twice, each with its signature events twice, give each record once, events still twice."""
    seqs = plain(spark, folder, varied=True)
    again = seqs.events.filter("kind = 'time_signature'")
    seqs = seqs.with_(events=seqs.events.unionByName(again))
    kept = distinct.distinct_sequences(with_copies(seqs, F.col("seq_id")))
    events = kept.events.groupBy("seq_id").agg(
        F.count_if(F.col("kind") == "tempo").alias("tempos"), F.count_if(F.col("kind") == "time_signature").alias("signatures")
    )
    return _counted(kept).join(events, "seq_id")


@query("distinct_content")
def _(spark, folder):
    copied = with_copies(plain(spark, folder), F.concat(F.lit("copy"), "seq_id"))
    return _counted(distinct.distinct_sequences(copied, "content"))


@query("distinct_examples")
def _(spark, folder):
    seqs = slicing.slice_bars(gridded(spark, folder, few_pitches=True), slice_size_bars=1, allow_cropped_slices=True)
    split_config = {"train": {"ratio": 0.7, "augment": True}, "validation": {"ratio": 0.2}, "test": {"ratio": 0.1}}
    augmenters = {"transposer": {"order": 1, "threshold": 0.7, "delete_notes": False, "min_transpose_amount": -3, "max_transpose_amount": 3}}
    examples = represented(seqs, PitchSequence(16, pad=True), split_config, augmenters, distinct=True)
    return as_text(examples).select("split", "tokens", "seq_id", "copies")


@query("duplicate_report")
def _(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return distinct.duplicate_report(distinct.copies(documents, "text"))


@query("count_elements")
def _(spark, folder):
    notes, _seen = audit.count_elements(plain(spark, folder).notes)
    return notes.groupBy("instrument").agg(F.count(F.lit(1)).alias("total_elements"))


@query("stage_audit")
def _(spark, folder):
    before = plain(spark, folder, varied=True)
    reasons = quantize.discards(before)
    kept = audit.stage_audit("quantizer", before, quantize.quantize(before))
    lost = audit.counters(
        reasons,
        "quantizer",
        {f"sequences_discarded_{r}": F.count_if(F.col("reason") == r) for r in quantize.REASONS},
    )
    return kept.unionByName(lost)


# Loader


def orders(spark: SparkSession, folder: str, **options) -> DataFrame:
    return Loader(id_column="o_orderkey", **options).load(spark, f"{folder}/orders.parquet")


PLACE = ("o_orderkey", "epoch", "batch_id", "pos_in_batch")


def _narrow(rows: DataFrame) -> DataFrame:
    return rows.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("loader_parse")
def _(spark, folder):
    return orders(spark, folder, parse=_narrow, batch_size=None)


@query("loader_shuffle_unbatched")
def _(spark, folder):
    return orders(spark, folder, parse=_narrow, shuffle=True, seed=7, batch_size=None).select("o_orderkey", "position")


@query("loader_epochs")
def _(spark, folder):
    rows = orders(spark, folder, parse=_narrow, shuffle=True, seed=7, repeat_count=3, batch_size=50)
    return rows.select(*PLACE)


@query("loader_examples")
def _(spark, folder):
    """The distinct examples of a representation, shuffled and batched by the ids they keep."""
    seqs = slicing.slice_bars(gridded(spark, folder, few_pitches=True), slice_size_bars=1, allow_cropped_slices=True)
    examples = represented(seqs, PitchSequence(16, pad=True), distinct=True).drop("copies")
    rows = Loader(shuffle=True, seed=3, batch_size=16).run(examples)
    return as_text(rows).select("seq_id", "tokens", "batch_id", "pos_in_batch")


@query("loader_map")
def _(spark, folder):
    def thousands(rows: DataFrame) -> DataFrame:
        return rows.select("o_orderkey", F.floor(F.col("o_totalprice") / 1000).alias("thousands"))

    return orders(spark, folder, parse=_narrow, map=thousands, batch_size=None)


@query("loader_filter")
def _(spark, folder):
    return orders(spark, folder, parse=_narrow, filter=F.col("o_orderstatus") == "F", batch_size=None)


@query("loader_cache")
def _(spark, folder):
    path = scratch_path(spark, "cache")
    return orders(spark, folder, parse=_narrow, cache=True, cache_path=path, batch_size=None)


@query("loader_shuffle")
def _(spark, folder):
    return orders(spark, folder, parse=_narrow, shuffle=True, seed=7).select(*PLACE)


@query("loader_repeat")
def _(spark, folder):
    rows = orders(
        spark, folder, parse=_narrow, shuffle=True, shuffle_repeat=True, seed=7, repeat_count=3, batch_drop_remainder=True
    )
    return rows.select(*PLACE)


@query("loader_batch")
def _(spark, folder):
    rows = batch_rows(orders(spark, folder, parse=_narrow, batch_size=50), "o_orderkey")
    return rows.select("batch_id", F.array_join(F.col("o_orderkey").cast("array<string>"), ",").alias("keys"))
