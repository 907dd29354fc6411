"""The audit against plain sums over all terms, in small blocks too; exact arithmetic; odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import odd
import pytest
from compare import connect, differences

from scoreloom.llm import divergence
from scoreloom.llm.divergence import audit_report, exact_sums, level
from scoreloom.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=200):
    """``lang, source, part, item, value, rank`` by loops over ``(lang, source, text)``."""
    counts, documents, groups = {}, {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
        groups.setdefault(lang, set()).add(source)
        counts.setdefault((lang, source), Counter()).update(terms)
        documents.setdefault(lang, Counter()).update(set(terms))
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= 3]

        def p_of(own):
            total = sum(own[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (own[t] + 1) // total for t in kept}

        whole = p_of(sum((counts[lang, s] for s in sources), Counter()))
        own = {s: p_of(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept), o) for o in sources - {s}]
            terms = [((own[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1) if part == "pair" or rank <= top]
    return sorted(found)


def random_rows(seed, n=300):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefghé" for b in "xyzñ"]
    rows = []
    for _ in range(n):
        source = draw.choice(["s1", "s1", "s2", "s3", "s4", "s5", None])
        weights = [1 / (1 + (i * (ord((source or "s0")[1]) - 40)) % 17) for i in range(len(words))]
        text = " ".join(draw.choices(words, weights, k=draw.randint(0, 40)))
        rows.append((draw.choice(["en", "en", "en", "de", None]), source, text.upper() if draw.random() < 0.2 else text))
    return [*rows, ("xx", "only", "a b c"), ("xx", "other", None), ("de", "empty", " 1 2 3 "), ("en", "s1", "ax " * 5000)]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_sums(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(divergence, "SOURCES", 2)
        monkeypatch.setattr(divergence, "BLOCK_ENTRIES", 20)
        monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    rows = random_rows(4)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    assert sorted(map(tuple, audit_report(docs, 9).collect())) == plain(rows, 9)


@pytest.mark.parametrize("dense", [0, 3, 256])
def test_joint_levels_are_the_matrix_product(monkeypatch, dense):
    monkeypatch.setattr(divergence, "DENSE_COLUMNS", dense)
    monkeypatch.setattr(divergence, "DENSE_ROWS", 4)
    draw = np.random.default_rng(dense)
    matrix = draw.random((50, 12)) < draw.random(12)
    term, column = np.nonzero(matrix)
    a, b, common = divergence.joint_levels(term, column, 50, 12)
    wanted = np.triu(matrix.T.astype(int) @ matrix, 1)
    got = np.zeros((12, 12), int)
    got[a, b] = common
    assert (got == wanted).all()


def test_exact_numbers():
    draw = random.Random(2)
    count = [draw.randrange(10**15) for _ in range(200)]
    total = [c + 1 + draw.randrange(10 ** draw.randint(1, 15)) for c in count]
    assert level(np.array(count), np.array(total)).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(count, total)]
    values = [draw.randrange(10**18) for _ in range(300)]
    times = [draw.randrange(2**31) for _ in range(300)]
    group = [draw.randrange(4) for _ in range(300)]
    wanted = [sum(v * t for v, t, g in zip(values, times, group) if g == i) for i in range(4)]
    assert exact_sums(np.array(values), np.array(times), np.array(group), 4) == wanted


def test_query(spark, data):
    assert differences(QUERIES["op13_divergence"](spark, data), connect(data), ORACLE["op13_divergence"]) == []


def test_odd_rows(spark):
    rows = [(r[2], r[3], r[1]) for r in odd.rows()]
    assert sorted(map(tuple, audit_report(odd.docs(spark)).collect())) == plain(rows)
    assert audit_report(odd.none(spark)).count() == 0
