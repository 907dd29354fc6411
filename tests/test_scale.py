"""Plans and skew: what crosses the network, and that one huge sequence changes neither plan shape nor result."""

from __future__ import annotations

import re

import pytest
from build import rows
from pyspark.sql import functions as F

import __spark_entry__
from scoreloom.functions import ordered
from scoreloom.functions.ordered import asof, scan
from scoreloom.model import SeqSet
from scoreloom.operators import attributes, melody, quantize, represent, slicing, split, transform
from scoreloom.plans.datasets import Source, process_datasets
from scoreloom.plans.queries import CHAIN, MELODIES, SLICES
from scoreloom.registry import apply_chain, operator
from scoreloom.sources.events import headers_of, plain_events, read_events
from scoreloom.sources.tables import read_seqset, write_seqset


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def known(spark, data, tmp_path):
    """Quantized notes as a stored set, with a counted bound."""
    seqs = quantize.quantize(read_events(spark, data))
    path = str(tmp_path / "notes")
    seqs.notes.write.parquet(path)
    return seqs.with_(notes=spark.read.parquet(path))


def test_melody_slices_and_attributes_share_one_exchange(known):
    melodies = melody.extract_melodies(known, **MELODIES)
    slices = slicing.slice_bars(melodies, **SLICES)
    assert exchanges(melodies.notes) == 1 + 1  # one per step and track, then by track
    assert exchanges(slices.notes) == exchanges(melodies.notes)
    assert exchanges(attributes.attribute_table(slices, ["contour", "toussaint"])) == exchanges(slices.notes)
    assert exchanges(represent.encode(slices)) == exchanges(slices.notes)


def test_chain_moves_the_notes_once(spark, data):
    seqs = read_events(spark, data, varied=True)
    quantized = apply_chain(seqs, "processor", {k: v for k, v in CHAIN.items() if k != "slicer" and k != "melody_extractor"})
    chained = apply_chain(seqs, "processor", CHAIN)
    assert exchanges(chained.notes) == exchanges(quantized.notes)


def test_stateless_operators_need_no_exchange(spark, data):
    stored = read_events(spark, data)
    assert exchanges(transform.stretch(stored, 2.0).notes) == 0
    assert exchanges(split.split_hop(stored, 1.0, None).notes) == 0


@pytest.mark.parametrize("name", ["chain_process", "attributes_all", "encode_pitch_seq", "sustain", "loader_shuffle"])
def test_no_row_leaves_the_jvm(spark, data, name):
    text = plan(__spark_entry__.queries()[name](spark, data))
    for python in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct"):
        assert python not in text


def test_scan_reads_only_the_columns_used(spark, data):
    text = plan(quantize.quantize(read_events(spark, data)).notes.select("seq_id", "q_start"))
    assert "event_type" not in text.split("ReadSchema")[1].split("\n")[0]


def skewed(spark, data) -> SeqSet:
    """The events with a third of all rows in one sequence, and half of those within one second."""
    seqs = read_events(spark, data)
    hot = F.col("note_idx") % 3 == 0
    notes = seqs.notes.withColumns(
        {
            "seq_id": F.when(hot, "hot").otherwise(F.col("seq_id")),
            "start_time": F.when(hot & (F.col("note_idx") % 2 == 0), 40 + F.col("start_time") / 180).otherwise(
                F.col("start_time")
            ),
        }
    ).withColumn("end_time", F.col("start_time") + 0.25 * (1 + F.col("note_idx") % 4))
    headers = headers_of(notes)
    return SeqSet(headers, notes, plain_events(headers))


CASES = {
    "silence": lambda s: split.split_silence(s, 0.5).notes,
    "hop": lambda s: split.split_hop(s, 0.5, None, True).notes,
    "changes": lambda s: split.split_time_changes(s, True).notes,
    "sustain": lambda s: transform.sustain(s).notes,
    "melody": lambda s: melody.extract_melodies(quantize.quantize(s), **MELODIES).notes,
    "attributes": lambda s: attributes.attribute_table(quantize.quantize(s)),
    "tokens": lambda s: represent.encode(quantize.quantize(s), chunk_steps=64),
}


@pytest.mark.parametrize("name", CASES)
def test_a_huge_sequence_gives_the_same_rows_in_blocks(spark, data, monkeypatch, request, name):
    seqs = skewed(spark, data)
    expected = CASES[name](seqs.measured()).drop("root_id")
    wanted = rows(expected, *sorted(expected.columns))
    assert seqs.measured().max_rows > seqs.notes.count() / 3
    request.getfixturevalue("blocked")
    found = CASES[name](seqs)
    assert rows(found, *sorted(expected.columns)) == wanted


def test_blocked_scan_never_windows_over_a_whole_sequence(spark, data, blocked):
    text = plan(attributes.melody_line(quantize.quantize(skewed(spark, data))))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", text)
    assert windows
    # Windows over the bare id only see one summary row per block, which carries the block's count.
    for line in text.split("\n"):
        if "lag(_prev" in line or "lag(_row" in line or "row_number()" in line:
            assert "_block" in line


def test_scan_matches_plain_windows(spark, data):
    notes = read_events(spark, data).notes.select("seq_id", "note_idx", "pitch", "velocity", "end_time")
    options = dict(
        keys=["seq_id"], order="note_idx", state=["pitch"], look_back=2, look_ahead=True,
        starts_run=lambda before, row: before["pitch"] % 2 != row["pitch"] % 2,
    )
    columns = ["seq_id", "note_idx", "prev", "prev2", "next", "run_head", "run_pos"]
    plain = rows(scan(notes, **options), *columns)
    for size in (7, 100, 10_000):
        assert rows(scan(notes, **options, block=F.floor(F.col("note_idx") / size)), *columns) == plain


def test_reach_scan_matches_plain_windows(spark, data):
    notes = read_events(spark, data).notes.select("seq_id", "start_time", "end_time")
    options = dict(
        keys=["seq_id"], order="start_time", state=[], reach="end_time",
        starts_run=lambda reach, row: row["start_time"] > reach + 1.0,
    )
    columns = ["seq_id", "start_time", "reach", "run_head", "run_pos"]
    plain = rows(scan(notes, **options), *columns)
    for size in (0.5, 11.0, 1000.0):
        found = scan(notes, **options, block=F.floor(F.col("start_time") / size))
        # Positions in a run are only carried for runs of the previous row.
        assert rows(found, *columns[:4]) == [r[:4] for r in plain]


def test_asof_matches_plain_windows(spark, data):
    notes = read_events(spark, data).notes.select("seq_id", "note_idx", "start_time")
    marks = notes.filter("note_idx % 9 = 0").select("seq_id", F.col("start_time").alias("time"), "note_idx")
    options = dict(keys=["seq_id"], left_time="start_time", right_time="time", values=["note_idx"])
    plain = rows(asof(notes, marks, **options, bounded=True), "seq_id", "note_idx", "match")
    for size in (0.5, 30.0, 1000.0):
        found = asof(notes, marks, **options, block_seconds=size, rows_per_part=5)
        assert rows(found, "seq_id", "note_idx", "match") == plain


@pytest.fixture
def crowded(spark):
    """A hundred thousand notes of one sequence within a second, some at the same time, and as many marks."""
    notes = spark.range(100_000).select(
        F.lit("s").alias("seq_id"), F.col("id").alias("note_idx"), (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)).alias("start_time")
    )
    same = spark.range(100_000, 103_000).select(F.lit("s").alias("seq_id"), F.col("id").alias("note_idx"), F.lit(0.5).alias("start_time"))
    marks = spark.range(60_000).select(F.lit("s").alias("seq_id"), (F.col("id") / 60_000 + 0.1).alias("time"), F.col("id").alias("mark"))
    few = spark.createDataFrame([("t", 1, 0.25), ("t", 2, 40.0), (None, 3, 0.5)], "seq_id string, note_idx long, start_time double")
    return notes.unionByName(same).unionByName(few).cache(), marks.cache()


def test_dense_blocks_are_cut_again(crowded, monkeypatch):
    notes, marks = crowded
    monkeypatch.setattr(ordered, "DENSE_ROWS", 4_000)
    blocked = notes.withColumn("_block", F.floor(F.col("start_time") / 16))
    (cut,) = ordered.cut_dense([blocked], ["seq_id"], "start_time")
    sizes = cut.groupBy("seq_id", "_block").count().collect()
    assert max(r["count"] for r in sizes) <= 7_500 and len(sizes) > 20
    assert cut.count() == notes.count() and cut.columns == blocked.columns
    sparse = blocked.filter("seq_id = 't'")
    assert ordered.cut_dense([sparse], ["seq_id"], "start_time") == [sparse]


def test_asof_and_scan_in_dense_blocks(crowded, monkeypatch):
    notes, marks = crowded
    sums = [F.count("*"), F.sum("note_idx"), F.sum(F.xxhash64("note_idx", "found") % 1000)]
    options = dict(keys=["seq_id"], left_time="start_time", right_time="time", values=["mark"], name="found")
    plain = asof(notes, marks, **options, bounded=True).agg(*sums).first()
    starts = marks.withColumn("end", F.col("time") + F.pmod(F.xxhash64("mark"), F.lit(97)) / 10_000)
    scanned = dict(keys=["seq_id"], order="time", state=["mark"], look_ahead=True, reach="end")
    seen = [F.count("*"), F.sum(F.xxhash64("mark", "prev", "next", "reach") % 1000)]
    whole = scan(starts, **scanned).agg(*seen).first()
    monkeypatch.setattr(ordered, "DENSE_ROWS", 4_000)
    assert asof(notes, marks, **options, rows_per_part=2_000).agg(*sums).first() == plain
    assert scan(starts, **scanned, block=F.floor(F.col("time") / 16), time="time").agg(*seen).first() == whole


def test_events_that_nobody_reads_are_never_built(spark, data, monkeypatch):
    def built(*_):
        raise AssertionError("built")

    for module, name in ((melody, "melody_events"), (slicing, "slice_events"), (split, "change_events")):
        monkeypatch.setattr(module, name, built)
    seqs = apply_chain(read_events(spark, data, varied=True), "processor", CHAIN)
    assert seqs.notes.count() > 0
    assert attributes.attribute_table(seqs, ["contour"]).count() > 0
    with pytest.raises(AssertionError, match="built"):
        seqs.events


def test_tables_are_made_once(spark):
    calls = []

    def table():
        calls.append(1)
        return spark.range(1)

    seqs = SeqSet(table, table, table)
    assert not calls
    again = seqs.with_(max_rows=3)
    assert again.notes is seqs.notes and len(calls) == 1
    assert again.max_rows == 3 and again.with_(notes=spark.range(2)).notes.count() == 2
    assert len(calls) == 1


def test_a_job_runs_each_step_once(spark, data, tmp_path):
    """Three tables are written, and used again by later steps; a user's step still sees each note once."""
    seen = spark.sparkContext.accumulator(0)

    @operator("processor", "counting")
    def counting(seqs: SeqSet) -> SeqSet:
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        counted = seqs.notes.withColumns({"parent_id": F.col("seq_id"), "start_offset": F.lit(0.0)})
        return SeqSet.derived(
            counted.mapInArrow(count, counted.schema),
            lambda made: seqs.sequences.join(made.select("seq_id").distinct(), "seq_id", "left_semi"),
            lambda made: seqs.events.join(made.select("seq_id").distinct(), "seq_id", "left_semi"),
            max_rows=seqs.max_rows,
        )

    write_seqset(read_events(spark, data), str(tmp_path / "in" / "a-full"))
    chain = [("counting", {}), ("quantizer", {}), ("melody_extractor", {"min_bars": 1}), ("slicer", {})]
    report = process_datasets(spark, str(tmp_path / "in"), str(tmp_path), [Source("a")], chain, "out")["a-full"]
    assert seen.value == read_events(spark, data).notes.count()
    made = read_seqset(spark, report["path"], measure=False)
    assert made.sequences.count() == report["sequences"] == made.notes.select("seq_id").distinct().count()
    assert made.events.join(made.sequences, "seq_id", "left_anti").count() == 0
