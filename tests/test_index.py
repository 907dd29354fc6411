"""One JSON document read by several tasks gives the entries that a JSON parser finds, wherever it is cut."""

from __future__ import annotations

import json
import random

import pytest

from scoreloom.sources.index import entries_of_type, pieces, read_index

NASTY = ["}", "{", '"', "\\", "\\\"", "a } b", "[", "]", ",", "entries", "é😀", "\n", "{\"files\": {}}", "x" * 90, ""]


def text_of(draw):
    return "".join(draw.choice(NASTY) for _ in range(draw.randint(0, 5)))


def made(seed, entries):
    draw = random.Random(seed)
    listed = []
    for i in range(entries):
        files = {draw.choice(["doc", "pdf"]): {"path": text_of(draw), "checksum": f"{i}"} for _ in range(draw.randint(0, 2))}
        entry = {"id": f"{text_of(draw)}/e{i}", "files": files, "about": {"title": text_of(draw), "deep": {"more": [{"a": text_of(draw)}]}}}
        listed.append({k: entry[k] for k in draw.sample(list(entry), 3)})
    fields = [("id", text_of(draw) + "name"), ("entries", listed), ("about", {"note": text_of(draw), "entries": [{"id": "no"}]})]
    fields += [("others", [{"id": "not this", "files": {}}]), ("text", text_of(draw)), ("nothing", []), ("count", 3)]
    draw.shuffle(fields)
    return dict(fields)


@pytest.mark.parametrize("seed", range(3))
def test_cut_documents(spark, tmp_path, seed):
    index, indent = made(seed, 25), [None, 2, 1][seed]
    (tmp_path / "index.json").write_text(json.dumps(index, indent=indent, ensure_ascii=seed % 2 == 0) + "\n" * seed, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("97b", "1200b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            path = str(tmp_path / "index.json")
            ranges = pieces(spark, path).select("range").distinct().count()
            assert ranges > 2
            got = read_index(spark, path).collect()
            found = {r["entry_id"]: r for r in got}
            assert len(got) == len(found) == 25
            for entry in index["entries"]:
                row = found[entry["id"]]
                assert row["collection_name"] == index["id"]
                assert {k: tuple(v) for k, v in row["files"].items()} == {k: (f["path"], f["checksum"]) for k, f in entry["files"].items()}
                assert json.loads(row["metadata_json"]) == entry["about"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_documents_without_entries(spark, tmp_path):
    for number, text in enumerate(['{"id": "x", "entries": []}', '{}', '{"entries": [], "id": "y"}\n', '{"id": "z", "about": {"a": 1}}']):
        (tmp_path / f"{number}.json").write_text(text)
        assert read_index(spark, str(tmp_path / f"{number}.json")).count() == 0
    (tmp_path / "one.json").write_text('﻿{"entries":[{"id":"a/b","files":{"doc":{"path":"p","checksum":null}}}]}', encoding="utf-8")
    row = entries_of_type(read_index(spark, str(tmp_path / "one.json")), "doc").first()
    assert (row["seq_id"], row["filepath"], row["checksum"], row["collection_name"]) == ("b", "p", None, None)
