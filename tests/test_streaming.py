from __future__ import annotations

import json

from build import rows

from scoreloom.streaming.arriving import canonicalize_arriving


def test_files_are_taken_once(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()

    def put(name, pitch):
        (inbox / f"{name}.json").write_text(json.dumps({"notes": [{"pitch": pitch, "start": 0.0, "end": 1.0}]}))

    def run():
        canonicalize_arriving(spark, str(inbox), out, state).awaitTermination(120)
        return rows(spark.read.parquet(f"{out}/*/notes"), "seq_id", "pitch")

    put("a", 60)
    assert run() == [("a", 60)]
    put("b", 62)
    (inbox / "c.json").write_text("{")
    assert run() == [("a", 60), ("b", 62)]
    assert rows(spark.read.parquet(f"{out}/*/quarantine"), "seq_id", "error") == [("c", "malformed document")]
    assert run() == [("a", 60), ("b", 62)]


def test_copies_that_arrive_later_are_passed_over(spark, tmp_path):
    """Each run is a restart: what was taken is known from the checkpoint. The order of notes and the name don't matter."""
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    one, two = ({"pitch": p, "start": float(i), "end": i + 1.0} for i, p in enumerate((60, 64)))

    def put(name, *notes, **more):
        (inbox / f"{name}.json").write_text(json.dumps({"notes": list(notes), **more}))

    def run():
        canonicalize_arriving(spark, str(inbox), out, state, distinct=True).awaitTermination(120)
        return rows(spark.read.parquet(f"{out}/*/notes").groupBy("seq_id").count(), "seq_id", "count")

    put("a", one, two)
    assert run() == [("a", 2)]
    put("copy", two, one)
    put("more", one, two, tempos=[{"time": 0.0, "qpm": 90.0}])
    put("b", one)
    (inbox / "bad.json").write_text("{")
    assert run() == [("a", 2), ("b", 1), ("more", 2)]
    put("b2", one)
    put("c", two)
    (inbox / "worse.json").write_text("{")
    assert run() == [("a", 2), ("b", 1), ("c", 1), ("more", 2)]
    assert rows(spark.read.parquet(f"{out}/*/quarantine"), "seq_id") == [("bad",), ("worse",)]
