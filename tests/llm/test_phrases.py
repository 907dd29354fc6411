"""Collocations against plain counting, tries against dictionaries, and odd rows."""

from __future__ import annotations

import pickle
import random
import re
from collections import Counter

import numpy as np
import odd
import pyarrow as pa
import pytest
from compare import connect, differences

from scoreloom.functions.storage import settled
from scoreloom.llm import phrases
from scoreloom.llm.phrases import Trie, collocations
from scoreloom.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """Collocations by dictionaries: ``lang, rank, phrase, a, l, r, n, score``."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        totals[lang] += 0
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = []
    for lang, own in counts.items():
        often = {p: f for p, f in own.items() if f >= least}
        kept = []
        for p, a in often.items():
            if len(p) == 1:
                continue
            score, _, left, right = min((2000000 * a // (often[p[:k]] + often[p[k:]]), k, often[p[:k]], often[p[k:]]) for k in range(1, len(p)))
            longer = [f for q, f in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f >= 80 * a for f in longer):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


@pytest.mark.parametrize("shard", [7, 1 << 20])
def test_against_plain_counts(spark, monkeypatch, shard):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 150)
    monkeypatch.setattr(phrases, "BLOCK", 3)
    draw = random.Random(3)
    vocabulary = ["The", "the", "of", "cat", "é", "É", "a b", "sat", "on", "mat", "x", "\U0001f600", "\x00z"]
    rows = []
    for i in range(150):
        parts = [draw.choice(["the cat sat on", "of the mat", *vocabulary]) for _ in range(draw.randint(0, 25))]
        rows.append((draw.choice(["en", "de", None, "und"]), "".join(p + draw.choice([" ", "\t", "  ", ". ", "\n", ",;", " "]) for p in parts)))
    rows += [("en", None), (None, ""), ("xx", " . "), ("en", "a " * 500), ("de", "the cat sat on the mat")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations(docs, least=4, top=40, shard=shard).collect())
    assert got == plain(rows, 4, 40)
    assert len(got) > 50


def test_phrases_of_many_chunks_leave_them_packed(spark):
    text = " ".join(f"w{i % 90}" for i in range(900)) + ". the end"
    docs = spark.createDataFrame([("en", text), ("de", text)] * 40, "lang string, text string").repartition(8)
    table = settled(phrases.chunked(docs), "chunks")
    chunks, bits = table.count(), 3
    assert chunks >= 12
    named = phrases.named_phrases(table, 30, bits, 30)
    assert chunks <= named.count() <= chunks << bits
    got = sorted(tuple(r) for r in phrases.frequent_candidates(named).collect())
    pieces = [piece.split() for piece in text.split(".")]
    own = {" ".join(w[i : i + k]) for w in pieces for k in range(1, 5) for i in range(len(w) - k + 1)}
    assert got == sorted((lang, phrase) for lang in ("de", "en") for phrase in own)


def test_query(spark, data):
    assert differences(QUERIES["op11_collocations"](spark, data), connect(data), ORACLE["op11_collocations"]) == []


def test_odd_rows(spark):
    rows = [(r[2], r[1]) for r in odd.rows()]
    got = sorted(tuple(r) for r in collocations(odd.docs(spark), least=2).collect())
    assert got == plain(rows, 2, 2000)
    assert collocations(odd.none(spark)).count() == 0
    assert collocations(odd.docs(spark), least=10**9).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_trie(seed):
    draw = random.Random(seed)
    words = [f"w{i}".encode() for i in range(60)]
    keys = sorted({(draw.choice("ab"), b" ".join(draw.choices(words, k=draw.randint(1, 4)))) for _ in range(400)})
    keys += [("a", b" ".join([words[0], w])) for w in words if ("a", b" ".join([words[0], w])) not in keys]
    trie = pickle.loads(pickle.dumps(Trie(pa.array([k[0] for k in keys]), pa.array([k[1].decode() for k in keys]))))
    text = [draw.randrange(62) for _ in range(4000)]
    names = [b"\n", b"", *words]
    codes = np.array([c if c != 1 else 0 for c in text] + [0])
    for lang in "ab":
        totals = np.zeros(len(trie.base), np.int64)
        trie.count(lang, names, codes, totals)
        seen = Counter(b" ".join(names[c] for c in codes[i : i + k]) for k in range(1, 5) for i in range(len(codes) - k + 1) if 0 not in codes[i : i + k])
        assert totals[trie.accepting].tolist() == [seen[p] if own == lang else 0 for own, p in keys]
