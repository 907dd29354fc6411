from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import docs, none

from scoreloom.llm import jaccard
from scoreloom.llm.common import give_back
from scoreloom.llm.components import connected_components
from scoreloom.llm.jaccard import Join, placed


def shingles(text, words):
    x = (text or "").encode().lower().split()
    return frozenset([tuple(x)] if 0 < len(x) < words else [tuple(x[i : i + words]) for i in range(len(x) - words + 1)] if x else [])


def joined(rows, words, percent):
    """Size and least reachable id of each row, by comparing all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                up[find(i)] = find(j)
    groups: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted((str(doc_id), len(s), str(least[find(i)])) for i, ((doc_id, _), s) in enumerate(zip(rows, sets)))


def got(frame):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in frame.collect())


@given(st.integers(2, 400), st.integers(0, 40), st.integers(0, 40), st.sampled_from([60, 80, 90, 100]), st.integers(0, 2**32))
@settings(max_examples=300, deadline=None)
def test_similar_sets_share_a_signature(size, less, more, percent, seed):
    draw = np.random.default_rng(seed)
    a = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[min(less, len(a) - 1) :], draw.integers(0, 2**64, more, dtype=np.uint64)]))
    join = Join(3, percent)
    if join.alike(a, b):
        assert len(a) == len(b) == len(np.intersect1d(a, b)) or np.intersect1d(join.signatures(a), join.signatures(b)).size
        flips = np.unpackbits((join.sketch(a) ^ join.sketch(b)).view(np.uint8)).sum()
        assert flips * (100 + percent) <= (len(a) + len(b)) * (100 - percent)
        assert join.wide_possible(join.wide_sketch(a), join.wide_sketch(b))


def test_wide_sketches_tell_large_sets_apart():
    """Folded ones too: sets on both sides of a size at which sketches get longer."""
    draw, join = np.random.default_rng(1), Join()
    for size in (4500, 4700, 20_000):
        a = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
        more = draw.integers(0, 2**64, size, dtype=np.uint64)
        linked, not_linked = (np.unique(np.concatenate([a[: int(size * (1 - x))], more[: int(size * x)]])) for x in (0.08, 0.3))
        linked = np.unique(np.concatenate([linked, more[-size // 40 :]]))
        assert join.alike(a, linked) and join.wide_possible(join.wide_sketch(a), join.wide_sketch(linked))
        assert not join.alike(a, not_linked) and not join.wide_possible(join.wide_sketch(a), join.wide_sketch(not_linked))
    assert len({len(join.wide_sketch(np.arange(n, dtype=np.uint64))) for n in (4500, 4700)}) == 2


def test_pairs_of_a_round_are_no_more_than_its_sets(spark):
    """Each signature of a group has a leader of its own; a set is compared with one of them, and same signatures count once."""
    signed = [(g, g) for g in range(30)] + [(g, s) for g in range(30) for s in range(100, 140) if (s * g) % 7] + [(99, s) for s in (1, 101, 102)]
    signed += [(g + 1000, s) for g, s in signed]
    members = Join().shared(spark.createDataFrame(signed, "signature long, set_id long"))
    kept = {r["signature"]: r["weight"] for r in members.collect()}
    assert all(g < 1000 for g in kept) and kept[99] == 4
    light = spark.createDataFrame([(s, 500, *[0] * 32) for s in {s for _, s in signed}], ["set_id", "n", *[f"s{i}" for i in range(32)]])
    tried = spark.createDataFrame([], "a long, b long")
    pairs = Join().stars(members.selectExpr("*", "set_id as component"), tried, light).collect()
    assert pairs and len({r["b"] for r in pairs}) == len(pairs) and all(r["a"] != r["b"] for r in pairs)


def test_rounds_share_one_comparison_of_sketches(spark, monkeypatch):
    """Further rounds take their pairs from those of the first, which are the same as if they were looked for again."""
    signed = [(g, s) for g in range(20) for s in range(100, 130) if (s * 31 + g * 17) % 5 < 2]
    members = Join().shared(spark.createDataFrame(signed, "signature long, set_id long"))
    light = spark.createDataFrame([(s, 500, *[0] * 32) for s in range(100, 130)], ["set_id", "n", *[f"s{i}" for i in range(32)]])
    tried = spark.createDataFrame([(129, 100), (128, 101)], "a long, b long")
    found = spark.createDataFrame([(s, 100 + s % 3) for s in range(100, 118)], "node long, component long")
    led = Join().led(members.selectExpr("*", "set_id as component"), light)
    again = Join().stars(placed(members, found), tried, light)
    assert sorted(Join.nearest(Join.parted(led, found), tried).collect()) == sorted(again.collect()) != []

    calls, possible = [], Join.possible_pairs
    monkeypatch.setattr(Join, "possible_pairs", lambda *args: calls.append(1) or possible(*args))
    text = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(text[: 100 - i] + [f"x{i}_{k}" for k in range(i)])) for i in range(0, 40, 2)]
    assert got(Join(1, 90).components(spark.createDataFrame(rows, "doc_id long, text string"))) == joined(rows, 1, 90)
    assert len(calls) == 1


def test_a_task_compares_a_bounded_number_of_rows(spark, monkeypatch):
    """However few bytes the rows have before they get their sketches."""
    monkeypatch.setattr(jaccard, "COMPARED_ROWS", 10)
    rows = spark.createDataFrame([(g, s, s) for g in range(40) for s in (2 * g, 2 * g + 1, 200)], "signature long, set_id long, component long")
    light = spark.createDataFrame([(s, 500, *[0] * 32) for s in [*range(80), 200]], ["set_id", "n", *[f"s{i}" for i in range(32)]])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 12)
    pairs = Join().apart(rows, light)
    assert f"hashpartitioning(signature, {tasks})" in re.sub(r"#\d+L?", "", pairs._jdf.queryExecution().toString()).replace(", REPARTITION", "")
    assert {frozenset(p) for p in pairs.collect()} == {frozenset(p) for g in range(40) for p in [(2 * g, 2 * g + 1), (2 * g, 200), (2 * g + 1, 200)]}


def test_large_sets_are_told_apart_where_they_meet(spark):
    """Else each pair of large sets with a common signature would be a row."""
    join = Join(1, 80)
    texts = [" ".join(f"{name}{i}" for i in range(6000)) for name in "abcd"]
    texts += [" ".join(f"a{i}" for i in range(200, 6200)), "e f g", "e f h"]
    ids = [join.set_id(s) for s in join.sets(texts)]
    light = join.light(spark.createDataFrame([(t, False) for t in texts], "text string, again boolean"))
    assert {r["set_id"] for r in light.collect() if r["more"]} == set(ids[:5])
    rows = spark.createDataFrame([(g, i, i) for g in range(3) for i in ids], "signature long, set_id long, component long")
    found = {frozenset(p) for p in join.apart(rows, light).collect()}
    assert frozenset((ids[0], ids[4])) in found and not any(len(p & set(ids[:4])) > 1 for p in found)


@pytest.mark.parametrize(("block", "gathered", "pairs"), [(1 << 11, 1 << 13, 1 << 15), (7, 20, 30)])
def test_sets_of_a_signature_meet_in_blocks(spark, monkeypatch, block, gathered, pairs):
    """Where 200 sets share a signature, each pair in two components is compared, by bits of all longs, whatever the blocks."""
    for name, value in (("BLOCK_ROWS", block), ("GATHERED_ROWS", gathered), ("HELD_PAIRS", pairs)):
        monkeypatch.setattr(jaccard, name, value)
    join, draw = Join(1, 80), random.Random(3)
    texts = []
    for group in range(20):
        start = [f"g{group}w{i}" for i in range(40 + 60 * group)]
        start = start if group else [f"w{i}" for i in range(2500)]
        for edits in range(10):
            texts.append(" ".join([f"x{group}y{edits}z{i}" if draw.random() < edits / 40 else w for i, w in enumerate(start)]))
    ids = [join.set_id(x) for x in join.sets(texts)]
    sets = dict(zip(ids, join.sets(texts)))
    light = join.light(spark.createDataFrame([(t, False) for t in texts], "text string, again boolean"))
    # One large component, small ones, and a second signature of a few sets.
    part = {i: 1 if k % 10 < 3 or k < 10 else i for k, i in enumerate(ids)}
    signed = [(1, i) for i in ids] + [(2, i) for i in ids[5:12]]
    found = spark.createDataFrame([(g, i, part[i]) for g, i in signed], "signature long, set_id long, component long")

    def possible(a, b):
        most = (len(a) + len(b)) * 20 // 180
        flips = lambda x, y: np.unpackbits((x ^ y).view(np.uint8)).sum()
        near = 100 * len(a) >= 80 * len(b) and 100 * len(b) >= 80 * len(a) and flips(join.sketch(a), join.sketch(b)) <= most
        large = join.large(len(a)) and join.large(len(b))
        return near and (not large or flips(join.parities(a, 64 * jaccard.MORE), join.parities(b, 64 * jaccard.MORE)) <= most)

    wanted = {(min(a, b), max(a, b)) for a in ids for b in ids if part[a] != part[b] and possible(sets[a], sets[b])}
    assert len(wanted) > 50
    got_pairs = [(r["a"], r["b"]) for r in join.apart(found, light).collect()]
    assert len(got_pairs) == len(set(got_pairs)) and set(got_pairs) == wanted


def test_workers_return_what_they_freed():
    """Also what lies below blocks that are still held."""

    def held():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    blocks = [bytes(60_000) for _ in range(5000)]
    full, kept = held(), blocks[::500] + blocks[-1:]
    blocks.clear()
    give_back()
    assert full - held() > 150_000_000 and len(kept) == 11


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_table(spark, data, words, percent):
    table = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert got(Join(words, percent).components(table)) == joined(rows, words, percent)


@pytest.mark.parametrize("words", [1, 3])
def test_chains_and_edited_copies(spark, words):
    """Copies of one text with more and more edits: some link, some only through others, some not at all."""
    draw = random.Random(words)
    start = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    rows, text = [], list(start)
    for i in range(60):
        rows.append((1000 - i, " ".join(text)))
        text[draw.randrange(len(text))] = f"x{i}"
    for i in range(120):
        edited = list(start)
        for _ in range(draw.randrange(1, 25)):
            edited[draw.randrange(len(edited))] = f"y{draw.randrange(10**6)}"
        rows.append((2000 + i, " ".join(edited)))
    rows += [(5, "  ".join(start).upper()), (6, "a b"), (7, "A  B"), (8, "a"), (9, None), (10, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for percent in (80, 90):
        assert got(Join(words, percent).components(table)) == joined(rows, words, percent)


def test_odd_rows(spark):
    table = docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    assert got(Join(3, 90).components(table)) == joined(rows, 3, 90)
    left = Join(3, 90).without_near_copies(table)
    assert left.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "3", "4", "6", "7", "8", "9", "None", "None"]
    assert Join().components(none(spark)).count() == 0 and Join().without_near_copies(none(spark)).count() == 0


def test_rows_without_an_id(spark):
    """They link with documents, with one another, and link documents that are only alike through them."""
    words = lambda name: [f"{name}{i}" for i in range(300)]
    edited = lambda text, *places: [f"x{i}" if i in places else w for i, w in enumerate(text)]
    a, b, c, d, e = map(words, "abcde")
    rows = [(1, a), (None, edited(a, 7)), (None, b), (None, edited(b, 7)), (None, edited(b, 7)), (None, edited(b, 7, 90)), (None, d)]
    rows += [(2, edited(c, 20, 60, 100)), (None, c), (3, edited(c, 150, 200, 250)), (None, e), (None, e), (None, e)]
    rows = [(i, " ".join(text)) for i, text in rows]
    assert joined([r for r in rows if r[0]], 3, 90) != sorted(r for r in joined(rows, 3, 90) if r[0] != "None")
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(Join(3, 90).components(table)) == joined(rows, 3, 90)
    left = Join(3, 90).without_near_copies(table).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"]) == [1, 2]
    assert sorted(r["text"][0] for r in left if r["doc_id"] is None) == ["b", "d", "e"]


def test_components(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(draw.randrange(300, 330), draw.randrange(300, 330)) for _ in range(25)]
    draw.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found})
    parts = {r["node"]: r["component"] for r in found}
    assert all(parts.get(a) == parts.get(b) for a, b in links if a != b)
    assert all(parts[c] == c for c in set(parts.values()))
    assert {parts[i] for i in range(61)} == {0} and {parts[i] for i in range(100, 150)} == {100}
    assert all(c <= n for n, c in parts.items())
