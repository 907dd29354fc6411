from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import docs, none
from tokenizers import Tokenizer

from scoreloom.llm import bpe

PATH = bpe.default_vocabulary()
TOKENIZER = Tokenizer.from_file(PATH)
VOCABULARY = bpe.Vocabulary(PATH)


@given(st.text(max_size=60) | st.text(" \n\t'a1é<|endoftext>", max_size=60))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = [i for word in VOCABULARY.words(text) for i in VOCABULARY.encode(word)]
    assert ids == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert b"".join(VOCABULARY.piece_bytes[i] for i in ids).decode() == TOKENIZER.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("slice_size", [3, 10])
def test_cut_texts_give_the_same_words(monkeypatch, slice_size):
    texts = ["a bc  d   e f\n g h", " a b c", "abc " * 9, "don't we've x's  'tis 12 34", "   ", "a<|endoftext|> b c d"]
    whole = [VOCABULARY.words(t) for t in texts]
    monkeypatch.setattr(bpe, "SLICE", slice_size)
    assert [VOCABULARY.words(t) for t in texts] == whole
    assert ["".join(bpe.pieces(t)) for t in texts] == texts


@pytest.mark.parametrize("chunk_size", [500, 1 << 24])
def test_table_round_trip(spark, data, chunk_size):
    extra = spark.createDataFrame([(-1, "a<|endoftext|> b <|endoftext|>"), (-2, "q" * 40_000), (-3, " \u0085 x y ")], "doc_id long, text string")
    table = docs(spark).select("doc_id", "text").unionByName(extra)
    table = table.unionByName(spark.read.parquet(f"{data}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text").limit(60))
    wanted = []
    for r in table.collect():
        ids = TOKENIZER.encode(r["text"] or "", add_special_tokens=False).ids
        wanted.append((str(r["doc_id"]), ids, TOKENIZER.decode(ids, skip_special_tokens=False)))
    both = bpe.decode(bpe.encode(table, VOCABULARY, chunk_size), VOCABULARY)
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in both.collect()) == sorted(wanted)


def test_report(spark):
    got = {str(r["doc_id"]): r for r in bpe.encoding_report(docs(spark).where("doc_id in (2, 4)"), PATH).collect()}
    text = "The cat sat on the mat and looked at the very small dog"
    ids = TOKENIZER.encode(text).ids
    assert got["4"]["n_tokens"] == len(ids) and got["2"]["n_tokens"] == 0
    assert got["4"]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert got["4"]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got["2"]["ids_sha256"] == got["2"]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.encoding_report(none(spark), PATH).count() == 0
