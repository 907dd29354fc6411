"""Every named query gives the result of its SQL counterpart, also when no sequence is known to be small."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__
from scoreloom.plans.oracle import ORACLE as SQL
from scoreloom.plans.queries import QUERIES

# Queries whose operators order notes in time, and so scan in blocks when sequences may be large.
ORDERED = [
    "quantize_relative",
    "split_hop_skip",
    "split_time_change",
    "split_time_change_skip",
    "split_events",
    "split_silence",
    "slice_no_crop",
    "extract_melody_truncated",
    "melody_audit",
    "sustain",
    "attributes_all",
    "attr_trigrams",
    "encode_whole",
    "decode_pitch_seq",
    "chain_process",
]


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    assert differences(QUERIES[name](spark, data), duck, SQL[name]) == []


@pytest.mark.parametrize("name", ORDERED)
def test_query_in_blocks(spark, data, duck, blocked, name):
    assert differences(QUERIES[name](spark, data), duck, SQL[name]) == []


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns == ["seq_id", "notes", "starts", "ends", "pitches", "total_steps"]
    assert result.count() >= 0
