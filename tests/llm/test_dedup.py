from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import docs, none

from scoreloom.llm.dedup import QuotientFilter, deduplicated, exact_duplicates, merged, repeated_fingerprints
from scoreloom.llm.queries import ORACLE, QUERIES


@given(st.lists(st.lists(st.integers(0, 2**12 - 1), max_size=200), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_filters_merge_without_loss(parts):
    filters = []
    for part in parts:
        prints, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        built = QuotientFilter.from_bytes(QuotientFilter.build(prints, counts, 12).to_bytes())
        back = built.items()
        assert back[0].tolist() == prints.tolist() and back[1].tolist() == counts.tolist()
        filters.append(built)
    prints, counts = merged(filters)
    assert dict(zip(prints.tolist(), counts.tolist())) == Counter(x for part in parts for x in part)


def test_query(spark, data):
    assert differences(QUERIES["op1_exact_dedup"](spark, data), connect(data), ORACLE["op1_exact_dedup"]) == []


@pytest.mark.parametrize("bits", [4, 10, 60])
def test_colliding_fingerprints_are_told_apart(spark, data, bits):
    """With few bits nearly every fingerprint is shared by different texts, and bytes decide."""
    table = spark.read.parquet(f"{data}/documents.parquet")
    assert differences(exact_duplicates(table, bits, 4), connect(data), ORACLE["op1_exact_dedup"]) == []


def test_counts(spark):
    prints = spark.range(1000).selectExpr("id % 700 as print")
    got = {r["print"]: r["count"] for r in repeated_fingerprints(prints, 10, 8).collect()}
    assert got == {i: 2 for i in range(300)}


def test_odd_rows(spark):
    table = docs(spark)
    by_text: dict[str, list] = {}
    for r in table.collect():
        by_text.setdefault(r["text"] or "", []).append(r["doc_id"])
    for r in exact_duplicates(table).collect():
        group = next(g for t, g in by_text.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(group)
        assert r["keep_id"] == max((i for i in group if i is not None), default=None)
        assert r["kept"] == (r["keep_id"] == r["doc_id"])
    left = deduplicated(table)
    assert left.columns == table.columns
    assert Counter(r["text"] or "" for r in left.collect()) == Counter(by_text.keys())
    assert exact_duplicates(none(spark)).count() == 0 and deduplicated(none(spark)).count() == 0
