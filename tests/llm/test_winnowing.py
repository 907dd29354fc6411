from __future__ import annotations

import hashlib
import random
import re

import pytest
from odd import docs, none

from scoreloom.llm.winnowing import GRAM, LONG, WINDOW, edited_fingerprints, with_marks


def winnowed(hashes: list[int], window: int) -> list[int]:
    """Positions by sliding the window: the rightmost of the least hashes of each."""
    width, found = min(window, len(hashes)), set()
    for start in range(len(hashes) - width + 1) if hashes else []:
        part = hashes[start : start + width]
        found.add(start + max(i for i, h in enumerate(part) if h == min(part)))
    return sorted(found)


@pytest.mark.parametrize(("gram", "window"), [(GRAM, WINDOW), (2, 5), (1, 1), (1, 3)])
def test_marks_are_rightmost_minima(spark, gram, window):
    """Texts of few different pieces, so that ties abound. The hashes of all k-grams are those a window of one marks."""
    texts = ["a b a a b c a b a a b b b a c c c a", "a", "", "a a", "a a a a a a a a a a a a", None, "abcdefghij klm\tnopq  rs é"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    every = {r["doc_id"]: r["text_hash"] for r in with_marks(table, "text", gram, 1).collect()}
    for r in with_marks(table, "text", gram, window).collect():
        places = winnowed(every[r["doc_id"]], window)
        assert r["text_at"] == places
        assert r["text_hash"] == [every[r["doc_id"]][i] for i in places]
        pieces = re.findall(r"[^\x20\x09-\x0D]{1,4}", r["text"] or "")
        assert len(every[r["doc_id"]]) == (len(pieces) - gram + 1 if len(pieces) >= gram else min(1, len(pieces)))


def test_shared_passage_leaves_a_shared_mark(spark):
    passage = " ".join(f"p{i}" for i in range(GRAM + WINDOW - 1))
    rows = [(0, f"one two three four five six seven {passage} eight"), (1, f"{passage} nine ten eleven twelve thirteen")]
    marks = [set(r["text_hash"]) for r in with_marks(spark.createDataFrame(rows, "doc_id long, text string"), "text").collect()]
    assert marks[0] & marks[1]


@pytest.mark.parametrize("alphabet", ["的一是不了人我在有他这中大来上", "กขคงจฉชซญด", "ABCDEFGHabcdefgh0123456789+/", "ab\u00a0\u3000c😀"])
def test_shared_passage_in_text_without_spaces(spark, alphabet):
    """Shifted by 0 to 3 characters, and with another text around it."""
    draw = random.Random(alphabet)
    some = lambda n: "".join(draw.choices(alphabet, k=n))
    passage = some(2 * LONG + 4 * (GRAM + WINDOW - 1))
    rows = [(i, some(40 + i) + passage + some(30)) for i in range(4)] + [(4, passage), (5, f"ab cd{passage}x yz")]
    rows += [(6, some(LONG) + " " + passage)]
    every = {r["doc_id"]: r for r in with_marks(spark.createDataFrame(rows, "doc_id long, text string"), "text").collect()}
    inner = set(every[4]["text_hash"][1:-1])
    assert inner and all(inner <= set(r["text_hash"]) for r in every.values())
    near = edited_fingerprints(spark.createDataFrame(rows[:4], "doc_id long, text string")).collect()
    assert all(r["near_next"] > 0.1 for r in near)


@pytest.mark.parametrize("size", range(LONG - 1, LONG + 4))
def test_long_words_are_cut_into_characters(spark, size):
    """The words around them keep their strides."""
    word = "".join(chr(ord("a") + i) for i in range(size))
    pieces = ["on", *re.findall(".{1,4}" if size <= LONG else ".", word), "thes", "e"]
    rows = [(0, f"on {word}\nthese"), (1, " ".join(pieces))]
    once = with_marks(spark.createDataFrame(rows, "doc_id long, text string"), "text", 1, 1)
    marks = {r["doc_id"]: r["text_hash"] for r in once.collect()}
    assert marks[0] == marks[1] and len(marks[0]) == len(pieces)


def test_edited_text_and_next_document(spark):
    table = docs(spark).select("doc_id", "text").unionByName(spark.range(20, 60).selectExpr("id as doc_id", "concat('t', id, ' x y') as text"))
    rows = sorted(
        ((r["doc_id"], r["text"] or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])
    )
    wanted = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        wanted.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = edited_fingerprints(table).selectExpr("doc_id", "n_chars", "sha2(edited, 256) as s", "near_edited", "near_next").collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["s"]) for r in got) == sorted(wanted)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert edited_fingerprints(none(spark)).count() == 0
    assert edited_fingerprints(table.where("doc_id = 4")).first()["near_next"] == 1.0


def test_likeness_on_the_table(spark, data):
    rows = edited_fingerprints(spark.read.parquet(f"{data}/documents.parquet")).where("n_chars >= 400").collect()
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.5
    assert sum(r["near_edited"] > r["near_next"] for r in rows) >= 0.98 * len(rows)
