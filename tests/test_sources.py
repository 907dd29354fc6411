"""Indexes, raw files, decoders, and the dataset jobs from files to histograms."""

from __future__ import annotations

import hashlib
import json
import uuid

import pytest
from build import n, rows, seqset
from pyspark.sql import functions as F

from scoreloom import registry
from scoreloom.loader import Loader
from scoreloom.model import ATTRIBUTES
from scoreloom.plans.datasets import (
    Source,
    canonicalize_datasets,
    histogram_datasets,
    process_datasets,
    represent_datasets,
    sources,
)
from scoreloom.registry import operator
from scoreloom.representations import PitchSequence
from scoreloom.sinks import write_dataset, write_debug
from scoreloom.sources.canonical import bytes_decoder, canonicalize, dataset_format
from scoreloom.sources.files import import_tree, read_entry_files
from scoreloom.sources.index import entries_of_type, read_index
from scoreloom.sources.tables import read_seqset, write_seqset


def document(start=0):
    """Sixteen bars of quarter notes: long enough for four-bar melodies."""
    notes = [
        {"pitch": 60 + (i * (start + 2)) % 12, "start": i * 0.5, "end": i * 0.5 + 0.5, "velocity": 60 + i % 20}
        for i in range(64)
    ]
    return {
        "notes": notes,
        "tempos": [{"time": 0.0, "qpm": 120.0}],
        "time_signatures": [{"time": 0.0, "num": 4, "den": 4}],
        "controls": [{"time": 1.0, "number": 64, "value": 100, "instrument": 0}],
    }


@pytest.fixture
def dataset(tmp_path):
    """A dataset folder with good files, a malformed one, an unsupported one, a missing one and a MIDI stand-in."""
    root = tmp_path / "in" / "chorales-full"
    (root / "files" / "deep").mkdir(parents=True)
    contents = {f"files/deep/s{i}.json": json.dumps(document(i)).encode() for i in range(4)}
    contents["files/broken.json"] = b'{"notes": [{"pitch": 6'
    contents["files/odd.xyz"] = b"?"
    contents["files/tune.mid"] = b"60 62 64"
    for name, content in contents.items():
        (root / name).write_bytes(content)
    entries = [
        {"id": f"x/y/{name.split('/')[-1].split('.')[0]}", "files": {"doc": {"path": name}}, "track": {"title": name}}
        for name in contents
    ]
    entries.append({"id": "x/lost", "files": {"doc": {"path": "files/lost.json"}}})
    entries.append({"id": "x/other", "files": {"pdf": {"path": "files/other.pdf"}}})
    (root / "index.json").write_text(json.dumps({"id": "chorales", "entries": entries}, indent=2))
    return root


def test_index_and_entry_files(spark, dataset):
    entries = entries_of_type(read_index(spark, str(dataset / "index.json")), "doc")
    assert entries.count() == 9
    assert rows(entries.filter("seq_id = 's1'"), "filepath", "collection_name", "metadata_json") == [
        ("files/deep/s1.json", "chorales", '{"title":"files/deep/s1.json"}')
    ]
    files, lost = read_entry_files(spark, entries, str(dataset))
    assert sorted(r[0] for r in rows(files, "seq_id")) == ["broken", "odd", "s0", "s1", "s2", "s3", "tune"]
    assert rows(lost, "seq_id", "error") == [("lost", "file not found"), ("other", "no file of this type")]
    assert rows(files.filter("seq_id = 'odd'"), "source_type") == [(".xyz",)]
    assert rows(dataset_format(files), "format", "formats", "unsupported") == [("json", 2, 1)]


def test_import_tree_checks_sums(spark, dataset):
    assert import_tree(spark, str(dataset)).count() == 8
    good = hashlib.sha256((dataset / "files/odd.xyz").read_bytes()).hexdigest()
    sums = spark.createDataFrame([("files/odd.xyz", good.upper()), ("files/tune.mid", "0" * 64)], "rel_path string, checksum string")
    kept = import_tree(spark, str(dataset), sums)
    assert "files/tune.mid" not in {r[0] for r in rows(kept, "rel_path")} and kept.count() == 7
    flagged = import_tree(spark, str(dataset), sums, allow_invalid_checksum=True)
    assert rows(flagged.filter("not checksum_ok"), "rel_path") == [("files/tune.mid",)]


def test_canonicalize_sets_failures_apart(spark, dataset):
    entries = entries_of_type(read_index(spark, str(dataset / "index.json")), "doc")
    files, _ = read_entry_files(spark, entries, str(dataset))
    done = canonicalize(files)
    assert rows(done.quarantine, "seq_id", "error") == [
        ("broken", "malformed document"),
        ("odd", "Unsupported file type: .xyz"),
        ("tune", "no decoder for midi"),
    ]
    assert done.seqs.notes.count() == 4 * 64
    assert rows(done.seqs.events.groupBy("kind").count(), "kind", "count") == [
        ("control", 4), ("tempo", 4), ("time_signature", 4),
    ]


def test_registered_bytes_decoder(spark, dataset, monkeypatch):
    def parse(content: bytes) -> dict:
        pitches = [int(p) for p in content.split()]
        return {"notes": [{"pitch": p, "start": float(i), "end": i + 1.0} for i, p in enumerate(pitches)]}

    monkeypatch.setattr(registry, "_OPERATORS", dict(registry._OPERATORS))
    operator("decoder", "midi")(bytes_decoder(parse))
    (dataset / "files" / "bad.mid").write_bytes(b"x")
    entries = spark.createDataFrame(
        [("tune", "files/tune.mid"), ("bad", "files/bad.mid")], "seq_id string, filepath string"
    ).selectExpr("*", "null as checksum", "'c' as collection_name", "cast(null as string) as metadata_json")
    files, _ = read_entry_files(spark, entries, str(dataset))
    done = canonicalize(files)
    assert rows(done.seqs.notes, "seq_id", "pitch", "start_time") == [("tune", 60, 0.0), ("tune", 62, 1.0), ("tune", 64, 2.0)]
    assert [r[0] for r in rows(done.quarantine, "seq_id")] == ["bad"]


def test_jobs_from_files_to_histograms(spark, dataset, tmp_path):
    data = sources(["chorales"], ["full"], ["doc"])
    raw, out = str(tmp_path / "in"), str(tmp_path / "out")
    report = canonicalize_datasets(spark, raw, out, data)["chorales-full/doc"]
    assert (report["sequences"], report["notes"], report["conversion_errors"]) == (4, 256, 5)

    chain = {
        "slicer": {"order": 4, "slice_size_bars": 4, "keep_shorter_slices": False},
        "melody_extractor": {"order": 3, "min_bars": 4},
        "quantizer": {"order": 2, "steps_per_quarter": 4},
        "time_change_splitter": {"order": 1},
        "stretcher": {"order": -1, "stretch_factor": 2.0},
    }
    canonical = f"{out}/canonical"
    options = {"distinct": True, "audit": True, "debug_pattern": "s1"}
    report = process_datasets(spark, canonical, out, data, chain, "bars", **options)["chorales-full/doc"]
    assert report["total_sequences"] == report["distinct_sequences"] == 4 * 13
    assert process_datasets(spark, canonical, out, data, chain, "bars")["chorales-full/doc"]["skipped"]

    generated = f"{out}/generated/bars"
    written = f"{generated}/chorales-full/doc/data"
    audit = dict(((r[0], r[1]), r[2]) for r in rows(spark.read.parquet(f"{written}/audit"), "stage", "metric", "value"))
    assert audit[("time_change_splitter", "input_sequences")] == 4
    assert audit[("slicer", "output_sequences")] == 52 and audit[("slicer", "shorter_slices")] == 12
    assert spark.read.json(f"{written}/debug/processors/quantizer/notes").count() == 64
    config = {"toussaint": {"order": 1, "bars": 4}, "contour": {"order": 2}}
    process_datasets(spark, generated, out, data, config, "bars", "data", "attributes")
    headers = read_seqset(spark, f"{generated}/chorales-full/doc/attributes").sequences
    assert headers.filter("toussaint is null or contour is null").count() == 0

    splits = {"train": {"ratio": 0.7, "augment": True}, "test": {"ratio": 0.3}}
    augmenters = {"transposer": {"order": 1, "threshold": 0.5, "delete_notes": False}}
    tokens = PitchSequence(64, keep_attributes=True)
    report = represent_datasets(
        spark, generated, out, data, "bars", tokens, "attributes", "pitchseq", splits, augmenters, distinct=True
    )["chorales-full/doc"]
    assert report["train_sequences"] + report["test_sequences"] == 52
    assert 0 < report["train_distinct_sequences"] <= report["train_sequences"]
    assert (report["train_expected"], report["test_expected"]) == (36, 15)
    stored = spark.read.parquet(f"{out}/representation/bars/chorales-full/doc/pitchseq")
    assert stored.filter(F.size("pitch_seq") != 64).count() == 0
    assert stored.select("context.*").columns == list(ATTRIBUTES)
    assert stored.filter("context.toussaint > 0 and context.note_density = 0").count() > 0
    assert {r[0] for r in stored.select("split").distinct().collect()} <= {"train", "test"}

    report = histogram_datasets(spark, generated, data, "attributes", ["toussaint"], [30, 40, 50])["chorales-full/doc"]
    assert report["bins"] == 120
    table = spark.read.parquet(f"{generated}/chorales-full/doc/attributes/histograms")
    assert rows(table.groupBy("bins").agg(F.sum("count")), "*") == [(30, 52), (40, 52), (50, 52)]


def test_sources_need_equal_lengths():
    with pytest.raises(ValueError):
        sources(["a", "b"], ["full"])
    assert sources(["a"], ["full"]) == [Source("a", "full", "")]


def test_existing_output_is_kept_or_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_dataset(spark.range(3), path)
    assert not write_dataset(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    assert write_dataset(spark.range(5), path, force_overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_debug_records_match_from_the_start(spark, tmp_path):
    seqs = seqset(spark, [n("ab", 0, 1, 60), n("ba", 0, 1, 60)])
    write_debug(seqs, str(tmp_path), "processors/slicer", "a|x")
    assert rows(spark.read.json(f"{tmp_path}/debug/processors/slicer/notes"), "seq_id", "pitch") == [("ab", 60)]


def test_stored_set_round_trip(spark, tmp_path):
    seqs = seqset(spark, [n("a", 0, 1, 60)], [{"id": "a", "kind": "tempo", "time": 0, "qpm": 90.0}])
    assert write_seqset(seqs, str(tmp_path / "s")) == {"sequences": 1, "notes": 1, "events": 1}
    back = read_seqset(spark, str(tmp_path / "s"))
    assert rows(back.notes, "*") == rows(seqs.notes, "*") and back.max_rows == 2


def test_each_file_is_decoded_once(spark, dataset, tmp_path, monkeypatch):
    calls = tmp_path / "calls"
    calls.mkdir()

    def parse(content: bytes) -> dict:
        (calls / uuid.uuid4().hex).write_bytes(content)
        return {"notes": [{"pitch": 60, "start": 0.0, "end": 1.0}], "controls": [{"time": 0.5, "number": 64, "value": 127}]}

    monkeypatch.setattr(registry, "_OPERATORS", dict(registry._OPERATORS))
    operator("decoder", "abc", suffixes=(".abc",))(bytes_decoder(parse))
    root = tmp_path / "in" / "tunes-full"
    root.mkdir(parents=True)
    entries = []
    for i in range(3):
        (root / f"{i}.abc").write_bytes(b"x%d" % i)
        entries.append({"id": str(i), "files": {"abc": {"path": f"{i}.abc"}}})
    (root / "index.json").write_text(json.dumps({"id": "tunes", "entries": entries}))
    report = canonicalize_datasets(spark, str(tmp_path / "in"), str(tmp_path / "out"), sources(["tunes"], ["full"], ["abc"]))
    assert report["tunes-full/abc"]["notes"] == 3 and report["tunes-full/abc"]["conversion_errors"] == 0
    assert len(list(calls.iterdir())) == 3
    stored = read_seqset(spark, str(tmp_path / "out" / "canonical" / "tunes-full" / "abc"))
    assert rows(stored.events, "kind", "instrument") == [("control", 0)] * 3


def test_half_written_output_is_written_anew(spark, dataset, tmp_path):
    data = sources(["chorales"], ["full"], ["doc"])
    raw, out = str(tmp_path / "in"), tmp_path / "out"
    (out / "canonical" / "chorales-full" / "doc" / "sequences").mkdir(parents=True)
    first = canonicalize_datasets(spark, raw, str(out), data, debug_pattern="s1")["chorales-full/doc"]
    assert not first["skipped"] and first["sequences"] == 4
    assert spark.read.json(f"{out}/canonical/chorales-full/doc/debug/canonical/notes").count() == 64
    assert canonicalize_datasets(spark, raw, str(out), data)["chorales-full/doc"]["skipped"]


def test_distinct_examples_into_the_loader_with_a_users_augmenter(spark, dataset, tmp_path, monkeypatch):
    """The representation job's written output, augmented by a function it knows nothing of, read as shuffled batches."""
    monkeypatch.setattr(registry, "_OPERATORS", dict(registry._OPERATORS))

    @operator("augmenter", "louder", by=1)
    def louder(seqs, by=1):
        copies = lambda table: table.unionByName(table.withColumn("seq_id", F.concat("seq_id", F.lit("+loud"))))
        moved = seqs.notes.withColumns({"seq_id": F.concat("seq_id", F.lit("+loud")), "pitch": F.col("pitch") + by})
        return seqs.with_(sequences=copies(seqs.sequences), notes=seqs.notes.unionByName(moved), events=copies(seqs.events))

    data = sources(["chorales"], ["full"], ["doc"])
    raw, out = str(tmp_path / "in"), str(tmp_path / "out")
    canonicalize_datasets(spark, raw, out, data)
    chain = {"quantizer": {}, "slicer": {"slice_size_bars": 4, "keep_shorter_slices": False, "allow_cropped_slices": True}}
    process_datasets(spark, f"{out}/canonical", out, data, chain, "bars")
    splits = {"train": {"ratio": 0.5, "augment": True}, "test": {"ratio": 0.5}}
    report = represent_datasets(
        spark, f"{out}/generated/bars", out, data, "bars", PitchSequence(64), "data", "seq", splits,
        {"louder": {"by": 2}}, distinct=True, debug_pattern=".*", audit=True,
    )["chorales-full/doc"]
    path = f"{out}/representation/bars/chorales-full/doc/seq"
    stored = spark.read.parquet(path)
    loud = stored.filter("seq_id like '%+loud'")
    assert loud.count() > 0 and {r[0] for r in loud.select("split").distinct().collect()} == {"train"}
    assert report["train_duplicates"] == report["train_sequences"] - report["train_distinct_sequences"]
    audit = {(r["split"], r["metric"]): r["value"] for r in spark.read.parquet(f"{path}/_audit").collect()}
    assert audit[("train", "output_sequences")] == 2 * audit[("train", "input_sequences")]
    assert spark.read.json(f"{path}/_debug/augmenters/louder/notes").count() > 0
    loaded = Loader(shuffle=True, seed=1, batch_size=8).load(spark, path)
    assert loaded.count() == stored.count() and loaded.select("batch_id", "pos_in_batch").distinct().count() == stored.count()
