"""Katz scores against a plain model in dictionaries, whose probabilities are checked to sum to one."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from scoreloom.llm.scoring import katz_scores

K = 5


def tokens_of(text):
    return (text or "").encode().lower().split() + [b"</s>"]


def factors(counts):
    having = Counter(counts)
    found = {}
    for r in range(1, K + 1):
        found[r] = (r - 0.5) / r
        if having[1]:
            large = (K + 1) * having[K + 1] / having[1]
            if large != 1 and having[r]:
                d = ((r + 1) * having[r + 1] / having[r] / r - large) / (1 - large)
                if 0 < d < 1:
                    found[r] = d
    return found


class Plain:
    def __init__(self, texts):
        self.words, self.after = Counter(), defaultdict(Counter)
        for text in texts:
            sequence = tokens_of(text)
            self.words.update(sequence)
            for a, b in zip([b"<s>", *sequence], sequence):
                self.after[a][b] += 1
        self.n = sum(self.words.values())
        self.single = factors(self.words.values())
        self.pair = factors([c for row in self.after.values() for c in row.values()])
        kept = {w: c * self.single.get(c, 1.0) for w, c in self.words.items()}
        if self.n and sum(kept.values()) == self.n:
            kept = {w: c - 0.5 for w, c in self.words.items()}
        self.one = {w: x / self.n for w, x in kept.items()}
        self.unknown = 1 - sum(self.one.values())

    def given(self, context):
        row = self.after[context]
        kept = {w: c * self.pair.get(c, 1.0) for w, c in row.items()}
        if sum(kept.values()) == sum(row.values()):
            kept = {w: c - 0.5 for w, c in row.items()}
        return kept, sum(row.values())

    def probability(self, word, context):
        alone = self.one.get(word, self.unknown)
        if context not in self.after:
            return alone
        kept, total = self.given(context)
        if word in kept:
            return kept[word] / total
        left = 1 - sum(kept.values()) / total
        return left / (1 - sum(self.one[w] for w in kept)) * alone

    def score(self, text):
        sequence = tokens_of(text)
        return sum(math.log10(self.probability(b, a)) for a, b in zip([b"<s>", *sequence], sequence))


def check(spark, rows, **options):
    training = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    plain = Plain(training)
    types = len(plain.words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(katz_scores(docs, **options).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["score"]))
    assert len(got) == len(rows)
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append(t)
    for row in got:
        if len(by_id[row["doc_id"]]) > 1:
            continue
        text = by_id[row["doc_id"]][0]
        sequence = tokens_of(text)
        base = sum(math.log10((plain.words[w] + 0.5) / (plain.n + 0.5 * (types + 1))) for w in sequence)
        assert row["held_out"] == (zlib.crc32(("" if row["doc_id"] is None else str(row["doc_id"])).encode()) % 5 == 1)
        assert (row["n_tokens"], row["train_tokens"]) == (len(sequence), plain.n)
        assert row["n_known"] == sum(plain.words[w] > 0 for w in sequence)
        assert row["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert row["score"] == pytest.approx(plain.score(text), rel=1e-9, abs=1e-9)
    return plain


@pytest.mark.parametrize("chunk_size", [200, 1 << 20])
def test_against_plain_model(spark, chunk_size):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    rows = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 30)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "W1  w2\tw3\nUNSEEN é É"), (503, "w0 " * 400), (None, "w0 w1"), (7, "twice w0")]
    plain = check(spark, rows, chunk_size=chunk_size)
    everything = [*plain.words, b"never seen"]
    for context in [*list(plain.after)[:30], b"never seen"]:
        assert sum(plain.probability(w, context) for w in everything) == pytest.approx(1, abs=1e-9)


def test_few_rows(spark):
    check(spark, [(0, "a b a b")])
    check(spark, [(0, "a a a a a a a a a a"), (2, "a a a a a a a a")])
    assert katz_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = katz_scores(spark.createDataFrame([(held, "only held out")], "doc_id long, text string")).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)


def test_better_than_single_words_on_held_out_text(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [r for r in katz_scores(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
