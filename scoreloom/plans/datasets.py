"""Dataset jobs: canonicalize, process, represent and histogram, each over several source datasets.

Layout below the output root: ``canonical/<dataset>/<type>``, ``generated/<name>/<dataset>/<type>/<prefix>``
and ``representation/<name>/<dataset>/<type>/<prefix>``. Output that exists is skipped unless it may be
overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import scoreloom.operators  # noqa: F401  (registers the operators)
from scoreloom.functions.storage import rows_written
from scoreloom.model import SeqSet
from scoreloom.operators.attributes import compute_attributes
from scoreloom.operators.audit import stage_audit
from scoreloom.operators.augment import DEFAULT_SEED, assign_splits, augment_audit, check_ratios, original_id, split_of
from scoreloom.operators.distinct import distinct_examples, distinct_sequences
from scoreloom.operators.histogram import DEFAULT_BINS, histogram
from scoreloom.operators.melody import melody_audit
from scoreloom.operators.quantize import discards
from scoreloom.operators.slicing import shorter_slices
from scoreloom.operators.split import filtered_sequences
from scoreloom.operators.transform import transpose_audit
from scoreloom.registry import apply_chain, lookup, names, ordered_steps
from scoreloom.representations import Representation
from scoreloom.sinks import complete, mark_complete, unmark, write_dataset, write_debug, write_splits
from scoreloom.sources.canonical import canonicalize, dataset_format, to_files
from scoreloom.sources.files import binary_files, import_tree, read_entry_files, suffix
from scoreloom.sources.index import entries_of_type, read_index
from scoreloom.sources.tables import read_seqset, write_seqset


@dataclass(frozen=True)
class Source:
    name: str
    mode: str = "full"
    file_type: str = ""

    @property
    def folder(self) -> str:
        return "/".join(p for p in (f"{self.name}-{self.mode}", self.file_type) if p)


def sources(names_: Sequence[str], modes: Sequence[str], file_types: Sequence[str] | None = None) -> list[Source]:
    file_types = file_types or [""] * len(names_)
    if not len(names_) == len(modes) == len(file_types):
        raise ValueError("names, modes and file types must have the same length")
    return [Source(*triple) for triple in zip(names_, modes, file_types)]


def _each(
    spark: SparkSession,
    datasets: Sequence[Source],
    output: Callable[[Source], str],
    force_overwrite: bool,
    run: Callable[[Source, str], dict[str, Any]],
) -> dict[str, dict[str, Any]]:
    """Run a job per dataset. The report has one entry per dataset; ``skipped`` marks output that is complete.

    A marker is written last, so output that a failed run left half-written is written anew.
    """
    report = {}
    for source in datasets:
        path = output(source)
        if complete(spark, path) and not force_overwrite:
            report[source.folder] = {"skipped": True, "path": path}
        else:
            unmark(spark, path)
            report[source.folder] = {"skipped": False, "path": path, **run(source, path)}
            mark_complete(spark, path)
    return report


def import_datasets(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    datasets: Sequence[Source],
    checksums: DataFrame | None = None,
    allow_invalid_checksum: bool = False,
    force_overwrite: bool = False,
) -> dict[str, dict[str, Any]]:
    """Take over each dataset's whole folder as the table ``raw/<dataset>`` of paths, lengths, sums and contents.

    The report counts the files, and those whose sum does not match: these are left out unless they are allowed.
    """

    def run(source: Source, path: str) -> dict[str, Any]:
        root = f"{input_root}/{source.name}-{source.mode}"
        write_dataset(import_tree(spark, root, checksums, allow_invalid_checksum), path, True)
        # Contents are not read again for these counts.
        total = binary_files(spark, root).count()
        wrong = spark.read.parquet(path).filter("not checksum_ok").count() if allow_invalid_checksum else total - rows_written(spark, path)
        return {"files": total, "invalid_checksums": wrong}

    return _each(spark, datasets, lambda s: f"{output_root}/raw/{s.folder}", force_overwrite, run)


def canonicalize_datasets(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    datasets: Sequence[Source],
    force_overwrite: bool = False,
    debug_pattern: str | None = None,
) -> dict[str, dict[str, Any]]:
    """Read each dataset's ``index.json`` and files, decode each file once, and write sequences and a quarantine table.

    The report names the dataset's format, that of its first supported file by path, and says whether the files are of several. With ``debug_pattern`` the records whose id matches are written as JSON as well.
    """

    def run(source: Source, path: str) -> dict[str, Any]:
        root = f"{input_root}/{source.name}-{source.mode}"
        entries = entries_of_type(read_index(spark, f"{root}/index.json"), source.file_type)
        files, lost = read_entry_files(spark, entries, root)
        # Decided on the entries alone: no file is read for it.
        agreed = dataset_format(entries.filter("filepath is not null").withColumn("source_type", suffix(F.col("filepath")))).first()
        canonical = canonicalize(files, once=True)
        counts = write_seqset(canonical.seqs, path, "overwrite")
        if debug_pattern is not None:
            write_debug(canonical.seqs, path, "canonical", debug_pattern)
        failed = canonical.quarantine.select("seq_id", "filepath", "error").unionByName(
            lost.select("seq_id", "filepath", "error")
        )
        failed.write.mode("overwrite").parquet(f"{path}/quarantine")
        kinds = {"format": agreed["format"], "mixed_formats": agreed["formats"] > 1, "unsupported_files": agreed["unsupported"]}
        return {**counts, "conversion_errors": rows_written(spark, f"{path}/quarantine"), **kinds}

    return _each(spark, datasets, lambda s: f"{output_root}/canonical/{s.folder}", force_overwrite, run)


def export_datasets(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    datasets: Sequence[Source],
    fmt: str = "json",
    input_prefix: str = "",
    force_overwrite: bool = False,
) -> dict[str, dict[str, Any]]:
    """Write each dataset's sequences back in a format that has an encoder, as the table ``exported/<dataset>`` of paths and contents.

    The table has the columns of the raw files that ``canonicalize`` reads, so it can be read again as a source.
    """

    def run(source: Source, path: str) -> dict[str, Any]:
        folder = "/".join(p for p in (input_root, source.folder, input_prefix) if p)
        write_dataset(to_files(read_seqset(spark, folder, measure=False), fmt), path, True)
        return {"files": rows_written(spark, path)}

    return _each(spark, datasets, lambda s: f"{output_root}/exported/{s.folder}", force_overwrite, run)


def stage_counters(name: str, options: dict[str, Any], before: SeqSet, after: SeqSet) -> DataFrame:
    """``stage, metric, value``: sequences in and out, and the counters that are particular to the operator."""
    rows = stage_audit(name, before, after)
    stage = F.lit(name).alias("stage")
    if name == "time_change_splitter":
        lost = filtered_sequences(before, **options)
        rows = rows.unionByName(lost.select(stage, F.lit("filtered_sequences").alias("metric"), F.col("filtered_sequences").alias("value")))
    elif name == "quantizer":
        reasons = discards(before, **options).groupBy("reason").agg(F.count(F.lit(1)).alias("value"))
        rows = rows.unionByName(
            reasons.select(stage, F.concat(F.lit("sequences_discarded_"), "reason").alias("metric"), "value")
        )
    elif name == "melody_extractor":
        lost = melody_audit(before, **options).filter("metric <> 'output_sequences'")
        rows = rows.unionByName(lost.select(stage, "metric", "value"))
    elif name == "slicer":
        short = shorter_slices(before, **options).select(stage, F.lit("shorter_slices").alias("metric"), F.col("shorter_slices").alias("value"))
        rows = rows.unionByName(short)
    elif name == "transposer":
        counts = transpose_audit(before, **options).drop("deleted_mean")
        rows = rows.unionByName(counts.unpivot([], counts.columns, "metric", "value").select(stage, "metric", "value"))
    return rows


def duplicates(total: int, kept: int, prefix: str = "") -> dict[str, Any]:
    """How many were duplicates of others, and how many percent of all."""
    share = round(100 * (total - kept) / total, 6) if total else 0.0
    return {f"{prefix}duplicates": total - kept, f"{prefix}duplicate_percent": share}


def augmenter_counters(name: str, options: dict[str, Any], before: SeqSet, after: SeqSet) -> DataFrame:
    """``stage, split, metric, value`` of one augmenter; a user's own has its sequences in and out."""
    split = F.coalesce(F.col("split"), F.lit("total")) if "split" in before.sequences.columns else F.lit("total")
    if name == "transposer":
        counts = augment_audit(before, **options)
        counts = counts.withColumn("split", split)
        rows = counts.unpivot("split", [c for c in counts.columns if c != "split"], "metric", "value")
    else:
        each = [
            table.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("value")).withColumn("metric", F.lit(metric))
            for table, metric in ((before.sequences, "input_sequences"), (after.sequences, "output_sequences"))
        ]
        rows = each[0].unionByName(each[1])
    return rows.select(F.lit(name).alias("stage"), "split", "metric", F.col("value").cast("bigint").alias("value"))


def process_datasets(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    datasets: Sequence[Source],
    config: Mapping[str, Mapping[str, Any]] | Sequence[tuple[str, Mapping[str, Any]]],
    output_name: str,
    input_prefix: str = "",
    output_prefix: str = "data",
    distinct: bool = False,
    force_overwrite: bool = False,
    debug_pattern: str | None = None,
    audit: bool = False,
) -> dict[str, dict[str, Any]]:
    """Apply processors, and attributes if the configuration names any, in the configured order.

    Attributes describe the sequences the processors deliver; they are computed together in one pass. With
    ``audit`` the counters of every step are written to ``<output>/audit``; with ``debug_pattern`` the records
    whose id matches are written after every step. Both read the data again, so they are off by default.
    """
    steps = ordered_steps(config)
    attributes = {n: o for n, o in steps if n in names("attribute")}
    processors = [(n, o) for n, o in steps if n not in attributes]

    def run(source: Source, path: str) -> dict[str, Any]:
        folder = "/".join(p for p in (input_root, source.folder, input_prefix) if p)
        audits: list[DataFrame] = []

        def after(name: str, options: dict[str, Any], before: SeqSet, result: SeqSet) -> None:
            if audit:
                audits.append(stage_counters(name, options, before, result))
            if debug_pattern is not None:
                write_debug(result, path, f"processors/{name}", debug_pattern)

        result = apply_chain(read_seqset(spark, folder), "processor", processors, after, once=True)
        if attributes:
            result = compute_attributes(result, attributes)
            if debug_pattern is not None:
                write_debug(result, path, "attributes", debug_pattern)
        report = {}
        if distinct:
            result = result.settled()
            report["total_sequences"] = result.sequences.count()
            result = distinct_sequences(result)
        counts = write_seqset(result, path, "overwrite")
        if distinct:
            report["distinct_sequences"] = counts["sequences"]
            report |= duplicates(report["total_sequences"], counts["sequences"])
        else:
            report["total_sequences"] = counts["sequences"]
        if audits:
            reduce(DataFrame.unionByName, audits).write.mode("overwrite").parquet(f"{path}/audit")
        return {**counts, **report}

    def output(source: Source) -> str:
        return f"{output_root}/generated/{output_name}/{source.folder}/{output_prefix}"

    return _each(spark, datasets, output, force_overwrite, run)


# Augmenters whose copies keep the id they come from, as ``original_id`` reads it.
OWN_AUGMENTERS = ("transposer",)

SplitConfig = Mapping[str, Mapping[str, Any]]


def represent_datasets(
    spark: SparkSession,
    input_root: str,
    output_root: str,
    datasets: Sequence[Source],
    output_name: str,
    representation: Representation,
    input_prefix: str = "attributes",
    output_prefix: str = "data",
    split_config: SplitConfig | None = None,
    augmenters: Mapping[str, Mapping[str, Any]] | None = None,
    distinct: bool = False,
    force_overwrite: bool = False,
    seed: int = DEFAULT_SEED,
    debug_pattern: str | None = None,
    audit: bool = False,
) -> dict[str, dict[str, Any]]:
    """Split, augment the flagged splits, encode, drop duplicate examples, and write one directory per split.

    The report has, per split (``total`` without splits), the examples, the expected number and, with
    ``distinct``, the distinct ones and the duplicates; all are counted while the examples are written. With ``audit`` the
    augmenters' counters are written to ``<output>/_audit``, and with ``debug_pattern`` the matching records after each
    augmenter to ``<output>/_debug``, where readers of the examples pass them over.
    """
    ratios = {n: c["ratio"] for n, c in (split_config or {}).items()}
    if split_config:
        check_ratios(ratios)

    def run(source: Source, path: str) -> dict[str, Any]:
        folder = "/".join(p for p in (input_root, source.folder, input_prefix) if p)
        seqs = read_seqset(spark, folder)
        audits: list[DataFrame] = []
        taps: list[tuple[str, SeqSet]] = []

        def after(name: str, options: dict[str, Any], before: SeqSet, result: SeqSet) -> None:
            audits.append(augmenter_counters(name, options, before, result))
            taps.append((name, result))

        examples = represented(seqs, representation, split_config, augmenters, distinct, seed, after)
        number = F.col("copies") if distinct else F.lit(1)
        counted = Observation("examples")
        each = {}
        for name in ratios or ["total"]:
            here = F.col("split") == name if ratios else F.lit(True)
            each[f"{name}_sequences"] = F.coalesce(F.sum(F.when(here, number)), F.lit(0))
            if distinct:
                each[f"{name}_distinct_sequences"] = F.count_if(here)
        examples = examples.observe(counted, *[c.alias(n) for n, c in each.items()]).drop("copies")
        if split_config:
            write_splits(examples, path, True)
        else:
            write_dataset(examples, path, True)
        if audit and audits:
            reduce(DataFrame.unionByName, audits).write.mode("overwrite").parquet(f"{path}/_audit")
        for name, result in taps if debug_pattern is not None else []:
            write_debug(result, path, f"augmenters/{name}", debug_pattern, "_debug")
        total = seqs.sequences.count()
        report = {**counted.get, **{f"{n}_expected": int(total * r) for n, r in ratios.items()}}
        for name in each if distinct else []:
            if name.endswith("_distinct_sequences"):
                split = name.removesuffix("_distinct_sequences")
                report |= duplicates(report[f"{split}_sequences"], report[name], f"{split}_")
        return report

    def output(source: Source) -> str:
        return f"{output_root}/representation/{output_name}/{source.folder}/{output_prefix}"

    return _each(spark, datasets, output, force_overwrite, run)


def augmented(seqs: SeqSet, augmenters: Mapping[str, Mapping[str, Any]], flagged: Sequence[str] | None, after=None) -> SeqSet:
    """Apply augmenters to the sequences of the flagged splits (None: all).

    One that knows ``only_splits`` is told; any other is handed those sequences alone, and the rest is added again. The
    headers it returns must keep ``split`` if it adds sequences under new ids.
    """

    def step(current: SeqSet, name: str, options: dict[str, Any]) -> SeqSet:
        if flagged is None or "only_splits" in lookup("augmenter", name).defaults:
            told = {**options, "only_splits": flagged} if flagged is not None else options
            return apply_chain(current, "augmenter", [(name, told)], after)
        here = current.sequences.filter(F.col("split").isin(list(flagged)))

        def part(how: str) -> SeqSet:
            return current.with_(
                sequences=current.sequences.join(here.select("seq_id"), "seq_id", how),
                notes=current.notes.join(here.select("seq_id"), "seq_id", how),
                events=current.events.join(here.select("seq_id"), "seq_id", how),
            )

        return apply_chain(part("left_semi"), "augmenter", [(name, options)], after).union(part("left_anti"))

    return reduce(lambda current, item: step(current, *item), ordered_steps(augmenters), seqs)


def represented(
    seqs: SeqSet,
    representation: Representation,
    split_config: SplitConfig | None = None,
    augmenters: Mapping[str, Mapping[str, Any]] | None = None,
    distinct: bool = False,
    seed: int = DEFAULT_SEED,
    after: Callable[[str, dict, SeqSet, SeqSet], None] | None = None,
) -> DataFrame:
    """The examples of a set: one plan from headers and notes to encoded, split rows (``copies`` if distinct)."""
    flagged = None
    ratios = {n: c["ratio"] for n, c in (split_config or {}).items()}
    if split_config:
        seqs = assign_splits(seqs, ratios, seed)
        flagged = [n for n, c in split_config.items() if c.get("augment", False)]
    if augmenters and flagged != []:
        seqs = augmented(seqs, augmenters, flagged, after)
    examples = representation.encode(seqs)
    if split_config and "split" not in examples.columns:
        if any(n not in OWN_AUGMENTERS for n, _ in ordered_steps(augmenters or {})):
            # What a user's augmenter calls its copies is not known; their headers say which split they are in.
            examples = examples.join(seqs.sequences.select("seq_id", "split"), "seq_id")
        else:
            # The split follows from the id, so examples need no join to get it.
            examples = examples.withColumn("split", split_of(ratios, original_id(F.col("seq_id")), seed))
    return distinct_examples(examples) if distinct else examples


def histogram_datasets(
    spark: SparkSession,
    root: str,
    datasets: Sequence[Source],
    input_prefix: str,
    attributes: Sequence[str] | None = None,
    bins: Sequence[int] = DEFAULT_BINS,
    force_overwrite: bool = False,
) -> dict[str, dict[str, Any]]:
    """Write the histogram table of each dataset next to the sequences it describes."""

    def run(source: Source, path: str) -> dict[str, Any]:
        headers = spark.read.parquet(f"{root}/{source.folder}/{input_prefix}/sequences")
        write_dataset(histogram(headers, attributes, bins), path, True)
        return {"bins": rows_written(spark, path)}

    return _each(spark, datasets, lambda s: f"{root}/{s.folder}/{input_prefix}/histograms", force_overwrite, run)
