"""Targets by filling levels step by step, copies, and odd rows."""

from __future__ import annotations

import random

import pytest
from compare import connect, differences

from scoreloom.llm.mixing import mix, mixed_sizes, source_targets
from scoreloom.llm.queries import ORACLE, QUERIES


def shared_again(sizes: list[int], weights: list[int], cap: int) -> list[float]:
    """Share by weight; stop at the cap; share the excess among the others; until none is above."""
    targets, total = {}, float(sum(sizes))
    rest = set(range(len(sizes)))
    while rest:
        left = total - sum(targets.values())
        weight = sum(weights[i] for i in rest)
        over = {i for i in rest if left * weights[i] / weight > cap * sizes[i]}
        if not over:
            targets.update({i: left * weights[i] / weight for i in rest})
            break
        targets.update({i: float(cap * sizes[i]) for i in over})
        rest -= over
    return [targets[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(6))
def test_targets_by_steps(spark, seed):
    draw = random.Random(seed)
    n = draw.randint(1, 12)
    sizes = [draw.choice([0, 1, 5, 40, 300, 5000]) for _ in range(n)]
    names = sorted(f"s{i:02d}" for i in range(n))
    rows = spark.createDataFrame([(a, b) for a, b in zip(names, sizes)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    wanted = shared_again(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 3)
    assert [got[name] for name in names] == pytest.approx(wanted)
    assert sum(got.values()) == pytest.approx(sum(sizes))
    assert all(got[name] <= 3 * size + 1e-9 for name, size in zip(names, sizes))


def test_query(spark, data):
    assert differences(QUERIES["op9_mix_sources"](spark, data), connect(data), ORACLE["op9_mix_sources"]) == []


def test_taken_follows_targets_and_the_mix_itself(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes = mixed_sizes(docs)
    rows = sizes.collect()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, sizes.collect()))
    emitted = {r["doc_id"]: r["count"] for r in mix(docs).groupBy("doc_id").count().collect()}
    assert emitted == {r["doc_id"]: r["copies"] for r in rows if r["copies"]}
    assert mix(docs).columns == docs.columns


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, rate string, number int, source_key int, salt int"
    rows = [
        (1, None, "a", "x", 1, 1, 1),
        (2, "", "a", "x", 1, 1, 1),
        (3, "one two\tthree", None, "x", 1, 1, 1),
        (3, "one two\tthree", None, "x", 1, 1, 1),
        (None, "w " * 500, "b", None, None, None, None),
    ]
    docs = spark.createDataFrame(rows, schema)
    got = {(r["doc_id"], r["size"]): r for r in mixed_sizes(docs).collect()}
    assert {k: r["source_size"] for k, r in got.items()} == {(1, 0): 0, (2, 0): 0, (3, 3): 6, (None, 500): 500}
    assert mix(docs).columns == docs.columns
    assert mixed_sizes(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0


def test_rows_without_an_id_meet_the_target(spark):
    rows = [(None, f"w{i} x y z", "a") for i in range(1500)] + [(i, "x y z v", "b") for i in range(1500)]
    sizes = mixed_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in sizes.selectExpr("doc_id is null as a", "taken", "target").groupBy("a").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.1
